"""Plan shapes side by side: the straightforward form of a job and the form used here.

Both forms of a pair give the same rows, which is checked first. Prints one line of JSON
per pair. ``BENCH_SF_DIR`` and ``BENCH_CPUS`` as in bench.py.
"""

from __future__ import annotations

import json
import sys
import time

from pyspark.sql import DataFrame, functions as F

from bench import SF_DIR, session
from harborlake.catalogue.derived import AS_OF, MAX_DAYS, ports, raw_arrivals, raw_temperatures, table
from harborlake.catalogue.queries import EVENT_TYPES, PRIORITIES
from harborlake.functions import part_of
from harborlake.operators import conform_join, dedupe, lookup_join, pivot_max, recent, unmatched, unmatched_counts
from harborlake.plans import airport_types_by_state, build_land_temperatures
from harborlake.sinks import overwrite_partitions, overwrite_table, scratch_path, write_delimited
from harborlake.sources import read_delimited, read_table

PAIRS = {}


def pair(function):
    PAIRS[function.__name__] = function
    return function


def fingerprint(df: DataFrame) -> tuple:
    columns = [F.col(f"`{c}`") for c in sorted(df.columns)]
    row = df.agg(F.count(F.lit(1)), F.sum(F.xxhash64(*columns).cast("decimal(38,0)"))).first()
    return tuple(row)


@pair
def pivot_of_events(spark):
    """discovered values and pivot() | one conditional aggregation with discovered values"""
    events = table(spark, SF_DIR, "events")
    return (
        lambda: events.groupBy("user_id").pivot("event_type").max("value").fillna(0),
        lambda: pivot_max(events, ["user_id"], "event_type", "value"),
    )


@pair
def pivot_with_known_values(spark):
    """pivot() with values | one conditional aggregation with values"""
    events = table(spark, SF_DIR, "events")
    return (
        lambda: events.groupBy("user_id").pivot("event_type", EVENT_TYPES).max("value").fillna(0),
        lambda: pivot_max(events, ["user_id"], "event_type", "value", EVENT_TYPES),
    )


@pair
def pivot_with_many_keys(spark):
    """pivot() with values | one conditional aggregation, many keys"""
    orders, keys = table(spark, SF_DIR, "orders"), ["o_custkey", "o_orderstatus"]
    return (
        lambda: orders.groupBy(*keys).pivot("o_orderpriority", PRIORITIES).max("o_totalprice").fillna(0),
        lambda: pivot_max(orders, keys, "o_orderpriority", "o_totalprice", PRIORITIES),
    )


@pair
def recent_days_of_a_stored_table(spark):
    """difference of dates below a limit | date above a constant, on a table sorted by date"""
    path = scratch_path(spark, "sorted")
    raw_temperatures(spark, SF_DIR).repartitionByRange(16, "dt").sortWithinPartitions("dt").write.parquet(path)
    stored = read_table(spark, path)
    return (
        lambda: stored.where(F.datediff(F.lit(AS_OF), "dt") < 100),
        lambda: recent(stored, "dt", 100, AS_OF),
    )


@pair
def typed_csv(spark):
    """types guessed from the data | types declared by name"""
    path = scratch_path(spark, "typed")
    write_delimited(table(spark, SF_DIR, "lineitem").drop("l_shipdate"), path)
    kinds = {f.name: f.dataType.simpleString() for f in read_delimited(spark, path, infer=True).schema}
    return (
        lambda: read_delimited(spark, path, infer=True),
        lambda: read_delimited(spark, path, types={n: k for n, k in kinds.items() if k != "string"}),
    )


@pair
def airports_and_arrivals_by_state(spark):
    """join rows, then count | count both sides, then join counts"""
    airports = table(spark, SF_DIR, "part").select(
        "p_partkey", F.col("p_type").alias("type"), part_of("p_brand", "#", 1).alias("state")
    )
    arrivals = lookup_join(
        table(spark, SF_DIR, "orders").select((F.col("o_orderkey") % 1000).alias("k")),
        airports,
        "k",
        "p_partkey",
        {"port_state": "state"},
    )

    def joined_first():
        both = arrivals.join(airports, F.col("port_state") == F.col("state"))
        return both.groupBy("state", "type").agg(
            F.count(F.lit(1)).alias("pairs"), F.countDistinct("p_partkey").alias("airports")
        ).select("state", "type", "airports", (F.col("pairs") / F.col("airports")).cast("bigint").alias("arrivals"))

    return joined_first, lambda: airport_types_by_state(arrivals, airports)


@pair
def unmatched_ports(spark):
    """anti join of rows, then count | count per key, then anti join"""
    raw, known = raw_arrivals(spark, SF_DIR), ports(spark, SF_DIR)
    return (
        lambda: unmatched(raw, known, "i94port", "port_id").groupBy("i94port").agg(F.count(F.lit(1)).alias("rows")),
        lambda: unmatched_counts(raw, known, "i94port", "port_id"),
    )


@pair
def one_row_per_key(spark):
    """number the rows of each key | smallest row per key, reduced before the shuffle"""
    lineitem, keys = table(spark, SF_DIR, "lineitem"), ["l_orderkey", "l_linenumber"]
    rest = [c for c in lineitem.columns if c not in keys]
    return (
        lambda: spark.sql(
            f"select * except (n) from (select *, row_number() over (partition by {', '.join(keys)} "
            f"order by {', '.join(rest)}) n from {{lineitem}}) where n = 1",
            lineitem=lineitem,
        ),
        lambda: dedupe(lineitem, keys),
    )


@pair
def measurements_of_few_cities(spark):
    """de-duplicate all rows, then join | drop rows of other cities first"""
    path = scratch_path(spark, "few_ports")
    overwrite_table(ports(spark, SF_DIR).where("city = 'nation_3'"), path)
    known = read_table(spark, path)
    raw = raw_temperatures(spark, SF_DIR).withColumn("n", F.monotonically_increasing_id() % 100_000)

    def all_rows():
        joined = conform_join(dedupe(raw), known, "City", "city", ["port_id"], key_as="city_lower")
        return joined.select("AverageTemperature", "city_lower", "port_id", "dt")

    return all_rows, lambda: build_land_temperatures(raw, known, as_of=AS_OF)


@pair
def table_partitioned_by_date(spark):
    """every task writes every date | balanced by date"""
    rows = recent(raw_temperatures(spark, SF_DIR), "dt", MAX_DAYS // 3, AS_OF).repartition(8)

    def plain():
        path = scratch_path(spark, "plain")
        rows.write.partitionBy("dt").parquet(path)
        return read_table(spark, path)

    def balanced():
        path = scratch_path(spark, "balanced")
        overwrite_partitions(rows, path, ["dt"])
        return read_table(spark, path)

    return plain, balanced


def main(names: list[str]) -> None:
    spark = session()
    for name in names or PAIRS:
        forms = PAIRS[name](spark)
        same = len({fingerprint(form()) for form in forms}) == 1
        seconds = []
        for form in forms:
            best = float("inf")
            for _ in range(3):
                start = time.perf_counter()
                form().write.format("noop").mode("overwrite").save()
                best = min(best, time.perf_counter() - start)
            seconds.append(round(best, 3))
        line = {"pair": name, "forms": PAIRS[name].__doc__, "same_rows": same}
        print(json.dumps({**line, "straightforward": seconds[0], "here": seconds[1]}), flush=True)
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1:])
