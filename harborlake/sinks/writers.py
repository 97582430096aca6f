"""Writers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, functions as F


def balanced(df: DataFrame, columns: Sequence[str] = ()) -> DataFrame:
    """Shuffle so that equal values of ``columns`` are written by few tasks.

    Without it every task writes a file into every partition directory. A plain
    ``repartition`` by the column would instead put a hot year into one task; the
    rebalance hint lets adaptive execution cut such a partition into pieces of
    ``spark.sql.adaptive.advisoryPartitionSizeInBytes`` and merge small ones.
    """
    return df.hint("rebalance", *[F.col(c) for c in columns])


def _counted(df: DataFrame, sent: Observation | None) -> DataFrame:
    # The last step before the write: a count below a shuffle would count the rows of
    # a map task again when it has to be repeated.
    return df if sent is None else df.observe(sent, F.count(F.lit(1)).alias("rows"))


def overwrite_table(df: DataFrame, path: str, *, sent: Observation | None = None) -> None:
    """Replace a whole Parquet table. ``sent`` receives the number of ``rows`` written."""
    _counted(df, sent).write.mode("overwrite").parquet(path)


def overwrite_partitions(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str],
    *,
    only_present: bool = False,
    sent: Observation | None = None,
) -> None:
    """Write a partitioned Parquet table, replacing it all.

    With ``only_present`` just the partitions that occur in ``df`` are replaced and all
    others stay as they are. ``df`` must not read from ``path``. ``sent`` receives the
    number of ``rows`` written.
    """
    (
        _counted(balanced(df, partition_by), sent)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic" if only_present else "static")
        .partitionBy(*partition_by)
        .parquet(path)
    )


def write_delimited(df: DataFrame, path: str, *, sep: str = ",", header: bool = True) -> None:
    """Replace a folder of delimited files. Blanks at both ends of a text are trimmed by the writer."""
    df.write.mode("overwrite").option("header", header).option("sep", sep).csv(path)


def land(df: DataFrame, path: str, fmt: str = "parquet", **options: str) -> None:
    """Replace a landed copy of a source."""
    df.write.mode("overwrite").options(**options).format(fmt).save(path)


def save_table(df: DataFrame, name: str, *, path: str | None = None, partition_by: Sequence[str] = ()) -> None:
    """Replace a catalog table, so that many users can query it by name under the catalog's access rules."""
    rows = balanced(df, partition_by) if partition_by else df
    writer = rows.write.mode("overwrite").format("parquet")
    if path is not None:
        writer = writer.option("path", path)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(name)


def preview(df: DataFrame, rows: int = 1) -> DataFrame:
    return df.limit(rows)
