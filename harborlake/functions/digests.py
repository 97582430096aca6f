"""Digests of whole rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T


def row_digest(df: DataFrame, names: tuple[str, str] = ("__a", "__b")) -> list[Column]:
    """Two 64-bit columns that are equal for equal rows: nulls equal nulls, NaN equals NaN, -0.0 equals 0.0.

    ``xxhash64`` passes over nulls, so whether a value is missing is hashed beside it: (1, null) and (null, 1) differ.
    """
    parts = []
    for f in df.schema:
        column = F.col("`" + f.name.replace("`", "``") + "`")
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            column = F.when(column == 0, F.lit(0).cast(f.dataType)).otherwise(column)
        parts += [column.isNull(), column]
    return [F.xxhash64(F.lit(seed), *parts).alias(name) for seed, name in enumerate(names)]
