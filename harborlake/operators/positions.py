"""Row positions over the whole cluster, and tables put side by side by them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from harborlake.sinks.paths import scratch_path

_AT = "__at"
_PARTITION_BITS = 33  # monotonically_increasing_id: the row within its partition in the lower bits, the partition above


def numbered(df: DataFrame, name: str, order: Sequence[str | Column]) -> DataFrame:
    """Add the position of each row, 0 to n - 1, in the order of some columns.

    Rows are dealt out by ranges of that order and sorted within; a row's position is its place in its partition plus the number of
    rows in partitions before. These sums are the only thing that reaches the driver, one number per partition. Rows
    that are equal in ``order`` are put in order of a hash of the whole row, so a range can be cut among them and positions are the
    same in every run. The rows are written once to the shared scratch folder, with their places: what is read there later can't be dealt out
    in another way by a task that runs again.
    """
    spark = df.sparkSession
    by = [c if isinstance(c, Column) else F.col(f"`{c}`") for c in order]
    by.append(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]))
    placed = df.repartitionByRange(*by).sortWithinPartitions(*by).withColumn(_AT, F.monotonically_increasing_id())
    path = scratch_path(spark, "numbered")
    placed.write.parquet(path)
    placed = spark.read.schema(placed.schema).parquet(path)
    partition = F.shiftright(_AT, _PARTITION_BITS).cast("int")
    counts = sorted(placed.groupBy(partition.alias("p")).agg(F.count("*").alias("n")).collect())
    before, starts = 0, []
    for p, n in counts:
        starts.append((p, before))
        before += n
    offsets = F.broadcast(spark.createDataFrame(starts, "__p int, __before bigint"))  # a row per partition
    within = F.col(_AT).bitwiseAND(F.lit((1 << _PARTITION_BITS) - 1))
    met = placed.join(offsets, partition == F.col("__p"))
    return met.select(*[F.col(f"`{c}`") for c in df.columns], (F.col("__before") + within).alias(name))


def side_by_side(
    left: DataFrame, right: DataFrame, left_order: Sequence[str | Column], right_order: Sequence[str | Column], *, name: str | None = None
) -> DataFrame:
    """The n-th row of one table beside the n-th row of the other, each in its own order; the shorter one is filled up with nulls.

    ``name`` keeps the position under that name. Columns of both tables must differ in name.
    """
    clash = {c.lower() for c in left.columns} & {c.lower() for c in right.columns}
    if clash:
        raise ValueError(f"columns of both tables: {', '.join(sorted(clash))}")
    a, b = numbered(left, "__left", left_order), numbered(right, "__right", right_order)
    columns = [F.col(f"`{c}`") for c in (*left.columns, *right.columns)]
    if name is not None:
        columns.insert(0, F.coalesce("__left", "__right").alias(name))
    return a.join(b, F.col("__left") == F.col("__right"), "full").select(*columns)
