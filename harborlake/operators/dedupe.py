"""De-duplication."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from harborlake.functions.digests import row_digest
from harborlake.sinks.paths import scratch_path

LEAST_BITS, MOST_BITS = 15, 30  # of the bitmap of repeated digests: 4 KB to 128 MB


def dedupe(df: DataFrame, on: Sequence[str] | None = None) -> DataFrame:
    """Distinct full rows, or one row per key when ``on`` is given.

    Both forms aggregate inside each map task first, so copies of a hot row are
    gone before the shuffle. Nulls equal nulls, NaN equals NaN, -0.0 equals 0.0.

    With keys, the smallest remaining row of each key is kept; rows that are structs of text are reduced by sorting (SortAggregate). ``dropDuplicates(keys)``
    keeps whichever row arrives first, which may differ when a lost task runs again.
    """
    if on is None:
        return df.dropDuplicates()
    rest = [c for c in df.columns if c not in on]
    if not rest:
        return df.dropDuplicates()
    kept = F.min(F.struct(*[_quoted(c) for c in rest])).alias("__kept")
    one_each = df.groupBy(*[_quoted(c) for c in on]).agg(kept)
    return one_each.select(
        *[_quoted(c) if c in on else F.col("__kept").getField(c).alias(c) for c in df.columns]
    )


def dedupe_by_digest(df: DataFrame, *, most_bits: int = MOST_BITS, digest: Sequence[Column] | None = None) -> DataFrame:
    """Distinct full rows, as ``dedupe`` gives them, with 16 bytes a row shuffled instead of whole rows.

    Digests are counted first. Those that occur more than once are marked in a bitmap, eight bits for each of them and
    ``2 ** most_bits`` bits at most, which all tasks get. A row whose bit is not set is alone in having its digest, and passes without
    a shuffle; the others, copies and what a full bitmap or a collision of digests brings along, are de-duplicated as whole rows. So the
    result never depends on the digests. ``df`` is evaluated three times and must give the same rows each time: a stored table.

    Worth it where rows are wide and copies few; where most rows are copies, ``dedupe`` shuffles as little.
    """
    spark = df.sparkSession
    a, b = digest or row_digest(df)
    path = scratch_path(spark, "repeated")
    counted = df.select(a.alias("a"), b.alias("b")).groupBy("a", "b").agg(F.count("*").alias("n"))
    counted.where("n > 1").select("a").write.parquet(path)
    repeated = spark.read.schema("a bigint").parquet(path)
    bits = min(most_bits, max(LEAST_BITS, (8 * repeated.count()).bit_length()))
    at = F.pmod("a", F.lit(1 << bits))
    bitmap = F.broadcast(  # 2 ** bits / 8 bytes at most
        repeated.groupBy(F.bitmap_bucket_number(at).alias("__bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("__bits"))
    )
    marked = df.withColumn("__at", F.pmod(a, F.lit(1 << bits)))
    met = marked.join(bitmap, F.bitmap_bucket_number("__at") == F.col("__bucket"), "left")
    bit = F.bitmap_bit_position("__at")
    byte = F.conv(F.hex(F.expr("substring(__bits, cast(bitmap_bit_position(__at) div 8 as int) + 1, 1)")), 16, 10).cast("bigint")
    is_marked = F.col("__bits").isNotNull() & (F.getbit(byte, (bit % 8).cast("int")) == 1)
    columns = [_quoted(c) for c in df.columns]
    alone, others = met.where(~is_marked).select(*columns), met.where(is_marked).select(*columns)
    return alone.unionByName(dedupe(others))


def _quoted(name: str):
    return F.col("`" + name.replace("`", "``") + "`")
