"""Builds that say what became of their source rows, with one scan of the source and counts that repeated tasks can't change.

The rows are de-duplicated with a count beside each distinct row; rows that the later join would drop are counted, too, as one row per task.
What the table needs of them is written to the shared scratch folder, narrow as it is, and both the counts and the table are
taken from there. Counts that are observed while rows flow by would be wrong after a map task ran twice.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, functions as F

from harborlake.functions import lower_key
from harborlake.operators import conform_join, recent
from harborlake.plans.tables import RECENT_DAYS, build_airports, build_arrivals
from harborlake.schemas import TEMPERATURE_TYPES
from harborlake.sinks import scratch_path
from harborlake.sources import with_types

_COPIES, _KNOWN = "__copies", "__known"


@dataclass(frozen=True)
class Measured:
    """A table to be written, and one row (rows, copies, unmatched, distinct_rows) about its source."""

    table: DataFrame
    counts: DataFrame


def distinct_counted(
    rows: DataFrame, needed: Sequence[str], key: Column | None = None, dim: DataFrame | None = None, dim_key: str | None = None
) -> DataFrame:
    """``needed`` columns of the distinct rows with how often each occurs and whether ``key`` is among those of ``dim``; stored.

    Rows with an unknown or missing key are one row together, which holds their number.
    """
    spark = rows.sparkSession
    if key is None:
        marked = rows.withColumn(_KNOWN, F.lit(True))
    else:
        keys = dim.select(F.col(dim_key).alias("__key")).where("__key is not null").distinct()
        marked = rows.join(keys, key == F.col("__key"), "left").withColumn(_KNOWN, F.col("__key").isNotNull()).drop("__key")
    whole = [F.when(F.col(_KNOWN), F.col(f"`{c}`")).alias(c) for c in rows.columns]
    counted = marked.select(_KNOWN, *whole).groupBy(_KNOWN, *[F.col(f"`{c}`") for c in rows.columns]).agg(F.count("*").alias(_COPIES))
    counted = counted.select(*[F.col(f"`{c}`") for c in needed], _KNOWN, _COPIES)
    path = scratch_path(spark, "counted")
    counted.write.parquet(path)
    return spark.read.schema(counted.schema).parquet(path)


def _measured(counted: DataFrame) -> DataFrame:
    known = F.col(_KNOWN)
    return counted.agg(
        F.coalesce(F.sum(_COPIES), F.lit(0)).alias("rows"),
        F.coalesce(F.sum(F.when(known, F.col(_COPIES) - 1)), F.lit(0)).alias("copies"),
        F.coalesce(F.sum(F.when(~known, F.col(_COPIES))), F.lit(0)).alias("unmatched"),
        F.count_if(known).alias("distinct_rows"),
    )


def measured_arrivals(arrivals: DataFrame, ports: DataFrame) -> Measured:
    """The arrivals fact, as ``build_arrivals`` makes it."""
    counted = distinct_counted(arrivals, ["cicid", "i94port", "arrdate"], F.col("i94port"), ports, "port_id")
    known = counted.where(_KNOWN).drop(_KNOWN, _COPIES)
    return Measured(build_arrivals(known, ports, already_distinct=True), _measured(counted))


def measured_airports(airports: DataFrame) -> Measured:
    """The airport dimension, as ``build_airports`` makes it."""
    counted = distinct_counted(airports, ["ident", "type", "iso_region"])
    return Measured(build_airports(counted.drop(_KNOWN, _COPIES), already_distinct=True), _measured(counted))


def measured_temperatures(
    temperatures: DataFrame, ports: DataFrame, *, as_of: date | Column | None = None, max_days: int = RECENT_DAYS
) -> Measured:
    """The temperature dimension, as ``build_land_temperatures`` makes it; its source rows are the recent ones."""
    rows = recent(with_types(temperatures, TEMPERATURE_TYPES), "dt", max_days, as_of)
    counted = distinct_counted(rows, ["dt", "AverageTemperature", "City"], lower_key("City"), ports, "city")
    known = counted.where(_KNOWN).drop(_KNOWN, _COPIES)
    joined = conform_join(known, ports, "City", "city", ["port_id"], key_as="city_lower")
    return Measured(joined.select("AverageTemperature", "city_lower", "port_id", "dt"), _measured(counted))
