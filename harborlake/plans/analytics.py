"""The questions the tables are there to answer.

The arrivals are always counted per join key before they meet a dimension: a popular
port or state is one row per map task by then, and the join works on counts.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from harborlake.functions import exact_avg
from harborlake.schemas import RACES



def arrivals_by_port_month(
    arrivals: DataFrame, *, port: str = "i94port", year: str = "year", month: str = "month"
) -> DataFrame:
    """Number of arrivals per port, year and month."""
    return arrivals.groupBy(port, year, month).agg(F.count(F.lit(1)).alias("arrivals"))


def _per_port(arrivals: DataFrame, port: str, weight: str | None) -> DataFrame:
    arrived = F.count(F.lit(1)) if weight is None else F.sum(weight)
    return arrivals.groupBy(port).agg(arrived.alias("arrivals"))


def top_ports(arrivals: DataFrame, k: int, *, port: str = "i94port", weight: str | None = None) -> DataFrame:
    """The ``k`` ports with most arrivals; ties go to the smaller port id.

    ``weight`` names a column that says how many arrivals a row stands for.
    """
    counted = _per_port(arrivals, port, weight)
    return counted.orderBy(F.desc("arrivals"), port).limit(k)


def port_demographics(
    arrivals: DataFrame,
    demographics: DataFrame,
    *,
    k: int | None = None,
    port: str = "i94port",
    dim_key: str = "port_id",
    total: str = "total_pop",
    measures: Sequence[str] = (*RACES.values(), "Foreign-Born"),
    weight: str | None = None,
) -> DataFrame:
    """Arrivals per port with its population columns and their shares of the total.

    ``k`` keeps the most popular ports only. A share is null where the total is 0. ``weight`` as in ``top_ports``.
    """
    counted = _per_port(arrivals, port, weight) if k is None else top_ports(arrivals, k, port=port, weight=weight)
    shares = [
        F.try_divide(F.col(f"`{m}`").cast("double"), F.col(f"`{total}`").cast("double")).alias(f"{m}_share")
        for m in measures
    ]
    side = demographics.select(
        F.col(f"`{dim_key}`").alias("__port"),
        *[F.col(f"`{c}`") for c in demographics.columns if c not in (dim_key, port)],
        *shares,
    )
    return counted.join(side, F.col(port) == F.col("__port")).drop("__port")


def airport_types_by_state(
    arrivals: DataFrame,
    airports: DataFrame,
    *,
    fact_state: str = "port_state",
    dim_state: str = "state",
    dim_type: str = "type",
    weight: str | None = None,
) -> DataFrame:
    """Airports per state and type, with the arrivals of that state.

    Both sides are counted first; joining the tables themselves would pair every
    arrival with every airport of its state. ``weight`` names a column that says how
    many arrivals a row stands for, when they have been counted in part already.
    """
    arrived = F.count(F.lit(1)) if weight is None else F.sum(weight)
    by_state = arrivals.groupBy(F.col(fact_state).alias("__state")).agg(arrived.alias("arrivals"))
    by_type = airports.groupBy(F.col(dim_state).alias("state"), F.col(dim_type).alias("type")).agg(
        F.count(F.lit(1)).alias("airports")
    )
    return by_type.join(by_state, F.col("state") == F.col("__state")).drop("__state")


def temperature_trend(
    temperatures: DataFrame,
    *,
    period: str = "month",
    port: str = "port_id",
    measured_on: str = "dt",
    value: str = "AverageTemperature",
    scale: int | None = None,
) -> DataFrame:
    """Average temperature and number of measurements per port and period (day, month, quarter or year).

    ``scale`` is the number of decimals of the data, see ``exact_avg``.
    """
    start = F.col(measured_on).cast("date") if period == "day" else F.trunc(F.col(measured_on), period)
    return temperatures.groupBy(port, start.alias("period")).agg(
        exact_avg(value, scale).alias("avg_temperature"), F.count(value).alias("measurements")
    )


def arrivals_with_temperature(
    arrivals: DataFrame,
    temperatures: DataFrame,
    *,
    by_month: bool = False,
    port: str = "i94port",
    arrived_on: str = "arrival_date",
    temperature_port: str = "port_id",
    measured_on: str = "dt",
    value: str = "AverageTemperature",
    scale: int | None = None,
) -> DataFrame:
    """Arrivals per port next to its average temperature, overall or month by month of the same year."""
    key: Mapping[str, tuple] = {"port_id": (F.col(port), F.col(temperature_port))}
    if by_month:
        key = {**key, "period": (F.trunc(arrived_on, "month"), F.trunc(measured_on, "month"))}
    arrived = arrivals.groupBy(*[a.alias(n) for n, (a, _) in key.items()]).agg(
        F.count(F.lit(1)).alias("arrivals")
    )
    measured = temperatures.groupBy(*[t.alias(n) for n, (_, t) in key.items()]).agg(
        exact_avg(value, scale).alias("avg_temperature"), F.count(value).alias("measurements")
    )
    return arrived.join(measured, list(key))
