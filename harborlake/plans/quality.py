"""Quality reports and checked writes."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, Observation, functions as F

from harborlake.operators import unmatched_counts
from harborlake.sinks import delete, overwrite_partitions, overwrite_table
from harborlake.sinks.paths import swap_in
from harborlake.operators.labels import PORT_BLOCK_MARKER
from harborlake.sources import read_table
from harborlake.versions import Version, write_version


class QualityError(ValueError):
    """A written table does not hold what was sent to it."""


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row (table, rows) per table."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table"), "rows")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def duplicate_report(df: DataFrame) -> DataFrame:
    """Rows, distinct rows and how many a full-row de-duplication removes, in one pass."""
    copies = df.groupBy(*[F.col(f"`{c}`") for c in df.columns]).agg(F.count(F.lit(1)).alias("__copies"))
    return copies.agg(
        F.coalesce(F.sum("__copies"), F.lit(0)).alias("rows"),
        F.count(F.lit(1)).alias("distinct_rows"),
    ).withColumn("removed", F.col("rows") - F.col("distinct_rows"))


def unmatched_report(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str) -> DataFrame:
    """How many rows, and how many different keys, an inner join with ``dim`` drops."""
    lost = unmatched_counts(fact, dim, fact_key, dim_key)
    return lost.agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("unmatched_rows"),
        F.count(F.lit(1)).alias("unmatched_keys"),
        F.coalesce(F.sum(F.when(F.col(fact_key).isNull(), F.col("rows"))), F.lit(0)).alias("null_key_rows"),
    )


@dataclass(frozen=True)
class Written:
    """What a checked write did."""

    sent: int
    stored: int


def write_checked(
    df: DataFrame, path: str, partition_by: Sequence[str] = (), *, allow_empty: bool = False
) -> Written:
    """Replace a plain Parquet folder, but only by one that holds the rows that were sent, some unless ``allow_empty``.

    For readers that know nothing of versions, on a file system that renames folders at once. Between the two renames there is no
    table for a moment, and object stores copy it; ``write_checked_version`` has neither fault.

    The new table is written beside the old one, counted, and then takes its place; when a check or the
    write fails, the old table stays as it was. The rows sent are counted while they are written; the count
    of the stored table needs no data pages, only the Parquet footers.
    """
    spark, path, sent = df.sparkSession, path.rstrip("/"), Observation()
    staged = f"{path}__staged-{uuid.uuid4().hex}"  # two runs do not meet
    if partition_by:
        overwrite_partitions(df, staged, partition_by, sent=sent)
    else:
        overwrite_table(df, staged, sent=sent)
    stored = read_table(spark, staged, df.schema).count()
    result = Written(sent=sent.get["rows"], stored=stored)
    if result.sent != result.stored or (result.stored == 0 and not allow_empty):
        delete(spark, staged)
        wrong = "no rows" if result.sent == result.stored else f"{result.sent} rows sent, {result.stored} stored"
        raise QualityError(f"{path}: {wrong}")
    swap_in(spark, staged, path)
    return result


def write_checked_version(
    df: DataFrame, path: str, partition_by: Sequence[str] = (), *, allow_empty: bool = False
) -> Version:
    """Make a new version of a table, but only one that holds the rows that were sent, some unless ``allow_empty``.

    Readers see the version before until the new one is complete and checked.
    """
    try:
        return write_version(df, path, partition_by, allow_empty=allow_empty)
    except (ValueError, OSError) as error:
        raise QualityError(f"{path}: {error}") from error


def port_conflicts(ports: DataFrame) -> DataFrame:
    """(port_id, names): codes that stand for several names."""
    named = ports.groupBy("port_id").agg(F.array_sort(F.collect_set(F.coalesce("city_state", F.lit("")))).alias("names"), F.count("*").alias("n"))
    return named.where("n > 1").select("port_id", "names")


def check_ports(texts: DataFrame, ports: DataFrame, text_column: str = "value", marker: str = PORT_BLOCK_MARKER, shown: int = 5) -> None:
    """An error if a label text has no block of ports, no port was found at all, or a code has several names."""
    without = texts.where(~F.coalesce(F.col(text_column).contains(marker), F.lit(False))).count()
    if without:
        raise QualityError(f"ports: {without} label texts without {marker}")
    if ports.isEmpty():
        raise QualityError("ports: no rows")
    wrong = port_conflicts(ports).orderBy("port_id").limit(shown).collect()
    if wrong:
        raise QualityError("ports: several names for " + "; ".join(f"{r.port_id}: {', '.join(r.names)}" for r in wrong))
