"""Aggregates that follow a table of batches: partial results per batch, merged when they are read.

A state table has one row per key and batch: sums, counts and maxima, which can be put together in any order. When the followed
table gets a batch, only that batch is aggregated; when it takes rows back by a void, the state takes back the partial results of
the same values, and those of the batch that replaces the rows come with it. Nothing is subtracted, so maxima are as right as sums.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from harborlake.sinks import delete
from harborlake.versions import Version, VersionConflict, Void, commit, history, latest, new_batch, read_batches, read_version, write_batch
from harborlake.versions.table import void_values

SOURCE = "followed"
COUNT, SUM, MAX = "count", "sum", "max"
EXACT = "decimal(38,6)"  # sums of doubles depend on their order, sums of decimals do not

Measures = Mapping[str, tuple[str, str | None]]
"""Name of a column of the state -> (count, sum or max, column of the table; None counts rows)."""


def _partial(kind: str, column: str | None) -> Column:
    if kind == COUNT:
        return F.count(F.lit(1) if column is None else F.col(column))
    if kind == SUM:
        value = F.col(column)
        return F.sum(F.when(~F.isnan(value.cast("double")), value).cast(EXACT))
    return F.max(column)


def _partials(rows: DataFrame, keys: Mapping[str, Column], measures: Measures) -> DataFrame:
    return rows.groupBy(*[c.alias(n) for n, c in keys.items()]).agg(*[_partial(*m).alias(n) for n, m in measures.items()])


def follow(spark: SparkSession, table: str, state: str, keys: Mapping[str, Column], measures: Measures) -> Version:
    """Bring a state up to the newest version of ``table``; returns the state's newest version.

    Appended batches are aggregated by themselves. A replaced table, or a void on a column that is not a key under its own name, is
    aggregated anew. Doing it again changes nothing.
    """
    table, state = table.rstrip("/"), state.rstrip("/")
    versions, base = history(spark, table), latest(spark, state)
    if not versions:
        raise FileNotFoundError(f"{table} has no version")
    newest = versions[0]
    done = base.applied.get(SOURCE, 0) if base else 0
    if done == newest.number:
        return base
    steps = [v for v in reversed(versions) if v.number > done]
    reached = base is not None and steps[0].base == done
    before = next((v for v in versions if v.number == done), None)
    added, voids = [], []
    for step in steps:
        if not reached or before is None or step.operation == "replace":
            reached = False
            break
        if step.operation == "append":
            added += [b for b in step.batches if b not in before.batches]
            voids += [v for v in step.voids if v not in before.voids]
        before = step
    # Voids of one step with batches in between, or on something that the state does not know: not worth its own path.
    reached = reached and all(v.column in keys for v in voids) and (not voids or len(steps) == 1)
    rows = read_batches(spark, table, newest, added) if reached else read_version(spark, table, newest.number)
    batch = new_batch(base)
    found = _partials(rows, keys, measures)
    stored = write_batch(found, state, batch)
    taken_back = [
        void_values(_values(spark, table, newest, v), state, v.column, base.batches[-1]) for v in voids if base.batches
    ] if reached else []
    kept = base if reached else None
    version = Version(
        number=0,
        base=base.number if base else 0,
        schema=found.schema.json(),
        partition_by=(),
        batches=(*(kept.batches if kept else ()), *([batch] if stored else [])),
        rows=stored + (kept.rows if kept else 0),
        operation="append" if kept else "replace",
        voids=(*(kept.voids if kept else ()), *taken_back),
        applied={SOURCE: newest.number},
    )
    try:
        return commit(spark, state, version)
    except VersionConflict:
        delete(spark, f"{state}/__batch={batch}")
        raise


def _values(spark: SparkSession, table: str, version: Version, void: Void) -> DataFrame:
    kind = version.struct[void.column].dataType
    return spark.read.schema(T.StructType([T.StructField("value", kind)])).parquet(f"{table}/_voids/{void.folder}")


def read_state(spark: SparkSession, state: str, keys: Sequence[str], measures: Measures) -> DataFrame:
    """One row per key, the partial results merged; keys left out are merged over, too."""
    merged = [(F.max if kind == MAX else F.sum)(n).alias(n) for n, (kind, _) in measures.items()]
    return read_version(spark, state).groupBy(*keys).agg(*merged)


# The states that the reports need.

ARRIVALS = {n: F.col for n in ("i94port", "port_city", "port_state", "year", "month")}
ARRIVALS_MEASURES: Measures = {"arrivals": (COUNT, None)}
TEMPERATURES_MEASURES: Measures = {
    "total": (SUM, "AverageTemperature"),
    "measurements": (COUNT, "AverageTemperature"),
    "highest": (MAX, "AverageTemperature"),
}


def follow_arrivals(spark: SparkSession, fact: str, state: str) -> Version:
    """Arrivals per port, its city and state, year and month."""
    return follow(spark, fact, state, {n: c(n) for n, c in ARRIVALS.items()}, ARRIVALS_MEASURES)


def arrivals_counted(spark: SparkSession, state: str, *keys: str) -> DataFrame:
    """Number of ``arrivals`` per key: a table that the reports take with ``weight="arrivals"``."""
    return read_state(spark, state, keys or tuple(ARRIVALS), ARRIVALS_MEASURES)


def follow_temperatures(spark: SparkSession, table: str, state: str) -> Version:
    """Temperatures per port and day: exact sum, number and highest."""
    return follow(spark, table, state, {"port_id": F.col("port_id"), "dt": F.col("dt")}, TEMPERATURES_MEASURES)


def maintained_trend(spark: SparkSession, state: str, *, period: str = "month") -> DataFrame:
    """Average temperature, number of measurements and highest value per port and period (day, month, quarter or year)."""
    days = read_version(spark, state)
    start = F.col("dt") if period == "day" else F.trunc("dt", period)
    merged = days.groupBy("port_id", start.alias("period")).agg(
        F.sum("total").alias("total"), F.sum("measurements").alias("measurements"), F.max("highest").alias("highest_temperature")
    )
    average = F.try_divide(F.col("total").cast("double"), F.col("measurements")).alias("avg_temperature")
    return merged.select("port_id", "period", average, "measurements", "highest_temperature")
