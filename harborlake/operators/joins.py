"""Joins of large tables with reference tables.

No broadcast is forced here. The reference side is pruned to its key and the wanted
columns, so Spark's own estimate of its size is small when the table is; below
``spark.sql.autoBroadcastJoinThreshold`` it is broadcast, above it both sides are
shuffled, adaptive execution may still switch to a broadcast once the real size is
known, and it splits partitions of hot keys (``spark.sql.adaptive.skewJoin.enabled``).
All of these give the same rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from harborlake.functions.text import lower_key

_KEY = "__key"


def _reference_side(dim: DataFrame, key: Column, payload: Mapping[str, str]) -> DataFrame:
    return dim.select(key.alias(_KEY), *[F.col(f"`{source}`").alias(name) for name, source in payload.items()])


def _payload(payload: Mapping[str, str] | Sequence[str]) -> Mapping[str, str]:
    return payload if isinstance(payload, Mapping) else {name: name for name in payload}


def lookup_join(
    fact: DataFrame,
    dim: DataFrame,
    fact_key: str,
    dim_key: str,
    payload: Mapping[str, str] | Sequence[str],
) -> DataFrame:
    """Inner join that adds ``payload`` (output name -> reference column) to every matching row.

    Rows with a null or unknown key are dropped; a reference key that occurs more than
    once repeats the row.
    """
    side = _reference_side(dim, F.col(dim_key), _payload(payload))
    return fact.join(side, F.col(fact_key) == F.col(_KEY), "inner").drop(_KEY)


def conform_join(
    left: DataFrame,
    dim: DataFrame,
    left_key: str,
    dim_key: str,
    payload: Mapping[str, str] | Sequence[str],
    *,
    key_as: str | None = None,
    also: Mapping[str, str] | None = None,
) -> DataFrame:
    """Inner join of names that differ in case only.

    ``left_key`` is lower-cased and, when ``key_as`` is given, kept under that name;
    ``dim_key`` must already be in lower case. ``also`` adds exact equalities
    (left column -> reference column) to the condition.
    """
    key = lower_key(F.col(f"`{left_key}`"))
    if key_as is not None:
        left = left.withColumn(key_as, key)
        key = F.col(f"`{key_as}`")
    extra = {f"__also_{i}": source for i, source in enumerate((also or {}).values())}
    side = _reference_side(dim, F.col(dim_key), {**_payload(payload), **extra})
    condition = key == F.col(_KEY)
    for name, left_column in zip(extra, also or {}):
        condition = condition & (F.col(f"`{left_column}`") == F.col(name))
    return left.join(side, condition, "inner").drop(_KEY, *extra)


def known_keys_only(fact: DataFrame, dim: DataFrame, fact_key: Column, dim_key: str) -> DataFrame:
    """Drop rows that a later inner join on the key drops anyway, before an expensive step in between.

    De-duplicating full rows shuffles every column of every row, so rows of unknown
    ports should be gone by then. Whether the keys are broadcast is Spark's choice.
    """
    keys = dim.select(F.col(dim_key).alias(_KEY))
    return fact.join(keys, fact_key == F.col(_KEY), "left_semi")


def unmatched(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str) -> DataFrame:
    """Rows that an inner join with ``dim`` would drop, null keys included."""
    side = dim.select(F.col(dim_key).alias(_KEY))
    return fact.join(side, F.col(fact_key) == F.col(_KEY), "left_anti")


def unmatched_counts(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str) -> DataFrame:
    """Number of rows per key that has no match in ``dim``.

    The rows are counted per key before the join, so a hot key is one row by then and
    only the key column of the large table is read.
    """
    counted = fact.groupBy(fact_key).agg(F.count(F.lit(1)).alias("rows"))
    return unmatched(counted, dim, fact_key, dim_key)
