"""The five tables, each a pure function of its sources.

De-duplication is over full source rows, before columns are dropped, so two different
source rows may end as equal output rows. ``dedupe_on`` switches to one row per key and
lets the scan read just the columns the table needs.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, functions as F

from harborlake.functions import lower_key, part_of, sas_date, strip, unquote, without_chars
from harborlake.operators import (
    conform_join,
    dedupe,
    known_keys_only,
    label_pairs,
    lookup_join,
    pivot_max,
    recent,
)
from harborlake.schemas import (
    DEMOGRAPHICS_KEYS,
    DEMOGRAPHICS_NAMES,
    DEMOGRAPHICS_TYPES,
    RACES,
    TEMPERATURE_TYPES,
)
from harborlake.sources import with_types

# What is removed from a port code.
_CODE_CHARS = "',)"
# Fixed value: how far back temperatures go, in days.
RECENT_DAYS = 9000


def _distinct(df: DataFrame, needed: Sequence[str], on: Sequence[str] | None) -> DataFrame:
    if on is None:
        return dedupe(df)
    return dedupe(df.select(*dict.fromkeys([*on, *needed])), on)


def build_ports(texts: DataFrame, text_column: str = "value", *, carried: Sequence[str] = ()) -> DataFrame:
    """Port reference table (port_id, city_state, city, state) from SAS label texts.

    A label is split at its first comma; without one the whole label is the city and
    the state is null. Empty texts are null, as they are after a trip through CSV.
    A port that several texts name alike is one port. Columns of the texts in ``carried`` stay beside their ports.
    """
    pairs = label_pairs(texts.select(*carried, F.col(text_column).alias("value")))
    named = pairs.select(
        *carried,
        strip(without_chars("code", _CODE_CHARS)).alias("port_id"),
        unquote("label").alias("city_state"),
    )
    parts = F.split("city_state", ",", 2)
    columns = {
        "port_id": F.col("port_id"),
        "city_state": strip("city_state"),
        "city": strip(F.lower(F.get(parts, F.lit(0)))),
        "state": strip(F.get(parts, F.lit(1))),
    }
    return dedupe(named.select(*carried, *[F.nullif(c, F.lit("")).alias(name) for name, c in columns.items()]))


def build_airports(
    airports: DataFrame, *, dedupe_on: Sequence[str] | None = None, already_distinct: bool = False
) -> DataFrame:
    """Airport dimension: the state is the second part of the region code (``US-PA`` -> ``PA``)."""
    needed = ["ident", "type", "iso_region"]
    rows = airports if already_distinct else _distinct(airports, needed, dedupe_on)
    return rows.select(*needed, part_of("iso_region", "-", 1).alias("state"))


def build_city_demographics(
    demographics: DataFrame, ports: DataFrame, *, match_state: bool = False
) -> DataFrame:
    """Demographics dimension: races become columns, missing numbers 0, one row per port of that city name.

    Cities of the same name in different states go to each other's ports unless
    ``match_state`` also compares the state.
    """
    typed = with_types(demographics, DEMOGRAPHICS_TYPES)
    wide = dedupe(pivot_max(typed, DEMOGRAPHICS_KEYS, "Race", "Count", list(RACES)))
    joined = conform_join(
        wide,
        ports,
        "City",
        "city",
        ["port_id"],
        key_as="city_lower",
        also={"State Code": "state"} if match_state else None,
    )
    return joined.select("port_id", "city_lower", *[F.col(f"`{c}`").alias(n) for c, n in DEMOGRAPHICS_NAMES.items()])


def build_arrivals(
    arrivals: DataFrame,
    ports: DataFrame,
    *,
    dedupe_on: Sequence[str] | None = None,
    already_distinct: bool = False,
) -> DataFrame:
    """Arrivals fact: dated by SAS day number, with the port's city and state, for known ports only.

    Rows without a usable date stay, with null date, year and month. ``already_distinct``
    says that the rows come from a de-duplicated store and saves the shuffle.
    """
    needed = ["cicid", "i94port", "arrdate"]
    if already_distinct:
        rows = arrivals.select(*needed)
    elif dedupe_on is None:  # rows of unknown ports go before all columns of all rows are shuffled
        rows = dedupe(known_keys_only(arrivals, ports, F.col("i94port"), "port_id"))
    else:
        rows = _distinct(arrivals, needed, dedupe_on)
    joined = lookup_join(rows, ports, "i94port", "port_id", {"port_city": "city", "port_state": "state"})
    dated = joined.withColumn("arrival_date", sas_date("arrdate"))
    return dated.select(
        "cicid",
        "arrival_date",
        "i94port",
        "port_city",
        "port_state",
        F.month("arrival_date").alias("month"),
        F.year("arrival_date").alias("year"),
    )


def build_land_temperatures(
    temperatures: DataFrame,
    ports: DataFrame,
    *,
    as_of: date | Column | None = None,
    max_days: int = RECENT_DAYS,
    country: str | None = None,
    dedupe_on: Sequence[str] | None = None,
) -> DataFrame:
    """Temperature dimension: the last ``max_days`` days, one row per port of that city name.

    Cities of other countries with the name of a port city are included unless
    ``country`` is given. The measurements are worldwide and few cities are ports, so
    other cities are dropped before the rows are shuffled for de-duplication.
    """
    rows = recent(with_types(temperatures, TEMPERATURE_TYPES), "dt", max_days, as_of)
    if country is not None:
        rows = rows.where(F.col("Country") == country)
    if dedupe_on is None:
        rows = dedupe(known_keys_only(rows, ports, lower_key("City"), "city"))
    else:
        rows = _distinct(rows, ["dt", "AverageTemperature", "City"], dedupe_on)
    joined = conform_join(rows, ports, "City", "city", ["port_id"], key_as="city_lower")
    return joined.select("AverageTemperature", "city_lower", "port_id", "dt")
