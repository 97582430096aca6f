"""Ports by edition of the label text: what a code stood for at a date, and arrivals that meet the edition of their day.

An edition is valid from its date to the day before the next one; the first also holds for days before it, the last for all
days after. A code that an edition does not have is no port while that edition is valid.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from harborlake.functions import sas_date
from harborlake.operators import dedupe, known_keys_only
from harborlake.plans.quality import QualityError
from harborlake.plans.tables import build_ports

_NAMES = ("port_id", "city_state", "city", "state")


def build_port_editions(texts: DataFrame, *, value: str = "value", valid_from: str = "valid_from") -> DataFrame:
    """(port_id, city_state, city, state, valid_from, valid_to) from label texts with the date from which each is valid.

    ``valid_to`` is the first day on which the row is not valid any more, null while it is. Editions in which a port stays
    the same make one row. A code with several names in one edition is an error that says which.
    """
    editions = texts.select(F.col(valid_from).alias("valid_from")).distinct()
    editions = editions.select(  # one row per edition
        "valid_from", F.lead("valid_from").over(Window.orderBy("valid_from")).alias("next"), F.row_number().over(Window.orderBy("valid_from")).alias("edition")
    )
    named = build_ports(texts.select(F.col(value).alias("value"), F.col(valid_from).alias("valid_from")), carried=["valid_from"])
    twice = named.groupBy("valid_from", "port_id").agg(F.count("*").alias("n"), F.array_sort(F.collect_set("city_state")).alias("names")).where("n > 1")
    wrong = twice.orderBy("valid_from", "port_id").limit(5).collect()
    if wrong:
        raise QualityError("ports: several names for " + "; ".join(f"{r.port_id} from {r.valid_from}: {', '.join(r.names)}" for r in wrong))
    known = named.join(editions, "valid_from")
    # Editions of a port that follow each other with the same names share the difference of their numbers and their rank.
    same = Window.partitionBy(*_NAMES).orderBy("edition")
    runs = known.withColumn("run", F.col("edition") - F.row_number().over(same))
    last = F.max(F.struct("edition", "next")).alias("last")
    merged = runs.groupBy(*_NAMES, "run").agg(F.min("valid_from").alias("valid_from"), last)
    return merged.select(*_NAMES, "valid_from", F.col("last.next").alias("valid_to"))


def join_editions(
    rows: DataFrame, editions: DataFrame, key: str, day: Column, *, edition_key: str = "port_id", payload: dict[str, str]
) -> DataFrame:
    """Inner join of each row with the edition of its key that is valid on its day; rows without a day meet the newest one.

    Intervals are cut into years, and rows meet them on key and year, so no task compares a key's rows with all its editions. Days before
    the first edition and after the last are taken as of its year; only these two numbers reach the driver.
    """
    span = editions.agg(F.min(F.year("valid_from")).alias("low"), F.max(F.year(F.coalesce("valid_to", "valid_from"))).alias("high")).first()
    low, high = span.low or 0, (span.high or 0) + 1  # the year after the last change stands for all later ones
    first = editions.agg(F.min("valid_from")).first()[0]
    from_year = F.when(F.col("valid_from") == F.lit(first), F.lit(low)).otherwise(F.year("valid_from"))
    to_year = F.when(F.col("valid_to").isNull(), F.lit(high)).otherwise(F.year(F.date_sub("valid_to", 1)))
    cut = editions.select(
        F.col(edition_key).alias("__key"),
        F.when(F.col("valid_from") > F.lit(first), F.col("valid_from")).alias("__from"),
        F.col("valid_to").alias("__to"),
        F.explode(F.sequence(from_year, F.greatest(to_year, from_year))).alias("__year"),
        *[F.col(source).alias(name) for name, source in payload.items()],
    )
    year = F.coalesce(F.greatest(F.least(F.year(day), F.lit(high)), F.lit(low)), F.lit(high))
    valid = (F.col("__from").isNull() | (F.col("__day") >= F.col("__from")) | F.col("__day").isNull()) & (
        F.col("__to").isNull() | (F.col("__day") < F.col("__to"))
    )
    marked = rows.withColumns({"__day": day, "__year_of": year})
    met = marked.join(cut, (F.col(key) == F.col("__key")) & (F.col("__year_of") == F.col("__year")) & valid)
    return met.drop("__day", "__year_of", "__key", "__from", "__to", "__year")


def build_arrivals_by_edition(arrivals: DataFrame, editions: DataFrame) -> DataFrame:
    """The arrivals fact with each port as it was called on the day of arrival."""
    once = dedupe(known_keys_only(arrivals, editions.select("port_id").distinct(), F.col("i94port"), "port_id"))
    day = sas_date("arrdate")
    joined = join_editions(once, editions, "i94port", day, payload={"port_city": "city", "port_state": "state"})
    dated = joined.withColumn("arrival_date", day)
    return dated.select(
        "cicid", "arrival_date", "i94port", "port_city", "port_state", F.month("arrival_date").alias("month"), F.year("arrival_date").alias("year")
    )
