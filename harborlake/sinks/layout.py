"""Layouts that let readers skip data: rows near each other in several columns at once, and bucketed catalog tables."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

BITS = 8  # of each column: ranges of a 256th of the rows


def _number(df: DataFrame, column: str) -> Column:
    """A number in the order of the values."""
    kind, value = df.schema[column].dataType, F.col(f"`{column}`")
    if isinstance(kind, T.StringType):  # the order of the first characters is enough to be near each other
        return F.conv(F.substring(F.hex(F.rpad(F.coalesce(value, F.lit("")), 7, "\0")), 1, 14), 16, 10).cast("double")
    if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return F.unix_seconds(value.cast("timestamp")).cast("double")
    return value.cast("double")


def _codes(df: DataFrame, columns: Sequence[str], bits: int) -> list[Column]:
    """Of each column, number of the range that a value lies in, of about equally many rows each; missing values are in the first.

    The bounds are estimates from ``approx_percentile``, all from one scan: one number per range reaches the driver. A value
    finds its range by halving.
    """
    values = [_number(df, c) for c in columns]
    share = F.array(*[F.lit(n / (1 << bits)) for n in range(1, 1 << bits)])
    found = df.select(*[F.approx_percentile(v, share, 10_000).alias(f"b{n}") for n, v in enumerate(values)]).first()
    return [_range_of(v, sorted(set(bounds or [])), bits) for v, bounds in zip(values, found)]


def _range_of(value: Column, bounds: list[float], bits: int) -> Column:
    if not bounds:
        return F.lit(0)
    known, steps = F.array(*[F.lit(b) for b in bounds]), F.array(*[F.lit(1 << k) for k in reversed(range(bits))])
    below = F.aggregate(steps, F.lit(0), lambda at, step: at + F.when(F.get(known, at + step - 1) < value, step).otherwise(0))
    return F.floor(below * (1 << bits) / (len(bounds) + 1)).cast("int")  # few different values spread over all bits, too


def interleaved(codes: Sequence[Column], bits: int = BITS) -> Column:
    """One number whose bits are those of the codes in turn, highest first: codes that are near each other stay near in all of them."""
    parts = [
        F.shiftleft(F.shiftright(code, bit).bitwiseAND(F.lit(1)).cast("bigint"), bit * len(codes) + len(codes) - 1 - n)
        for bit in range(bits)
        for n, code in enumerate(codes)
    ]
    return reduce(lambda a, b: a.bitwiseOR(b), parts)


def write_clustered(
    df: DataFrame, path: str, columns: Sequence[str], *, bloom: Sequence[str] = (), files: int | None = None, bits: int = BITS
) -> None:
    """Replace a Parquet table by one whose files each hold a small range of all ``columns`` at once.

    Readers that ask for a point or a range of any of the columns skip files and row groups by their least and largest
    values. Columns in ``bloom`` get Bloom filters, so row groups without a value are skipped even where the range has it; Parquet leaves
    them out where a dictionary says the same.
    Rows are dealt out by ranges, so equal codes of a hot value can share a file, but are not gathered in one task beyond that;
    ``files`` is their number, by default as many as shuffles have.
    """
    codes = {f"__code{n}": code for n, code in enumerate(_codes(df, columns, bits))}  # columns, so that no code is computed for each of its bits
    placed = df.withColumns(codes).withColumn("__code", interleaved([F.col(c) for c in codes], bits)).drop(*codes)
    tie = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])  # a hot range can be cut
    by = [F.col("__code"), tie]
    placed = placed.repartitionByRange(files, *by) if files else placed.repartitionByRange(*by)
    writer = placed.sortWithinPartitions("__code", *[F.col(f"`{c}`") for c in columns]).drop("__code").write.mode("overwrite")
    for column in bloom:
        writer = writer.option(f"parquet.bloom.filter.enabled#{column}", "true")
    writer.parquet(path)


def save_bucketed(
    df: DataFrame, name: str, columns: Sequence[str], buckets: int, *, path: str | None = None, analyze: bool = True
) -> None:
    """Replace a catalog table that is stored by the hash of some columns, sorted by them within.

    Joins and groupings on exactly these columns need no shuffle of the table, of two tables with as many buckets none at all, for
    each of the many readers. Rows are dealt out once before they are written, so there is one file per bucket. With ``analyze``
    the catalog learns the number of rows and, for each column, values, nulls, least and largest, which joins are planned with.
    """
    by = [F.col(f"`{c}`") for c in columns]
    writer = df.repartition(buckets, *by).write.mode("overwrite").format("parquet").bucketBy(buckets, *columns).sortBy(*columns)
    if path is not None:
        writer = writer.option("path", path)
    writer.saveAsTable(name)
    if analyze:
        analyze_table(df.sparkSession, name)


def analyze_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"analyze table {name} compute statistics for all columns").collect()
