"""Pivot to one column per value."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def pivot_values(df: DataFrame, pivot_column: str) -> list:
    """Sorted distinct values, null first.

    They become column names, so their number is bounded by Spark's own limit for
    pivots (``spark.sql.pivotMaxValues``); more than that is an error.
    """
    bound = int(df.sparkSession.conf.get("spark.sql.pivotMaxValues"))
    rows = df.select(pivot_column).distinct().limit(bound + 1).collect()
    if len(rows) > bound:
        raise ValueError(f"{pivot_column} has more than spark.sql.pivotMaxValues={bound} values")
    found = [row[0] for row in rows]
    return ([None] if None in found else []) + sorted(v for v in found if v is not None)


def pivot_max(
    df: DataFrame,
    keys: Sequence[str],
    pivot_column: str,
    value_column: str,
    values: Sequence | None = None,
    fill: float | None = 0,
) -> DataFrame:
    """One row per key and one column per pivot value, holding the largest value of the cell.

    With ``values`` given nothing runs before the action and rows with other values only
    contribute their keys; without, the values are discovered first. Each cell is a
    conditional maximum, so this is a single aggregation: one shuffle, after every map
    task has reduced its rows to one per key. ``pivot()`` needs two.

    ``fill`` replaces nulls in *all* numeric columns, keys included, as ``fillna`` does.
    """
    if values is None:
        values = pivot_values(df, pivot_column)
    cells = [
        F.max(F.when(F.col(f"`{pivot_column}`").eqNullSafe(F.lit(v)), F.col(f"`{value_column}`"))).alias(
            "null" if v is None else str(v).lower() if isinstance(v, bool) else str(v)
        )
        for v in values
    ]
    wide = df.groupBy(*[F.col(f"`{k}`") for k in keys]).agg(*cells)
    return wide if fill is None else wide.fillna(fill)


def pivot_max_map(df: DataFrame, keys: Sequence[str], pivot_column: str, value_column: str, into: str = "cells") -> DataFrame:
    """One row per key and a map from pivot value to the largest value of the cell, however many pivot values there are.

    Cells are reduced first, so a key's map holds one entry per value that it really has; columns are taken out of the map where they
    are needed (``cell``), not made for every value in the data. Cells without a value and rows without a pivot value only
    contribute their keys. The map's entries are in no particular order.
    """
    by = [F.col(f"`{k}`") for k in keys]
    cells = df.groupBy(*by, F.col(f"`{pivot_column}`").alias("__value")).agg(F.max(F.col(f"`{value_column}`")).alias("__max"))
    entry = F.when(F.col("__value").isNotNull() & F.col("__max").isNotNull(), F.struct("__value", "__max"))
    return cells.groupBy(*by).agg(F.map_from_entries(F.collect_list(entry)).alias(into))


def cell(value, fill: float | None = 0, of: str = "cells") -> Column:
    """A cell of ``pivot_max_map``."""
    found = F.try_element_at(F.col(of), F.lit(value))
    return found if fill is None else F.coalesce(found, F.lit(fill))
