"""Queries of loads that keep arriving, versions and maintained aggregates."""

from __future__ import annotations

import uuid
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, functions as F

from harborlake import operators, plans, streaming, versions
from harborlake.catalogue.derived import (
    AS_OF,
    MAX_DAYS,
    label_texts,
    ports,
    raw_airports,
    raw_arrivals,
    raw_demographics,
    raw_temperatures,
    table,
    text,
)
from harborlake.catalogue.queries import _dated, query
from harborlake.plans import maintained, measured
from harborlake.plans.editions import build_arrivals_by_edition, build_port_editions
from harborlake.operators.pivot import cell
from harborlake.sinks import scratch_path
from harborlake.sinks.landing import land_files, landed_files, manifest
from harborlake.sinks.layout import save_bucketed, write_clustered
from harborlake.sources import read_delimited, read_table, type_misfits, with_types

_RAW = "cicid string, i94yr string, i94port string, arrdate string"
# Overlapping years of arrival, one wave of files each.
_WAVES = ("i94yr <= '1996.0'", "i94yr between '1995.0' and '1999.0'", "i94yr >= '1994.0'")


@query
def table_versions(spark, sf_dir):
    """A table written, replaced and added to; its first and last version side by side."""
    path = scratch_path(spark, "versions")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.year("o_orderdate").alias("year"))
    versions.write_version(orders.where("year < 1996"), path, ["year"])
    versions.write_version(orders.where("year = 1996"), path, ["year"])
    versions.write_version(orders.where("year > 1996"), path, ["year"], append=True)
    read = [versions.read_version(spark, path, n).withColumn("version", F.lit(n)) for n in (1, 3)]
    return reduce(DataFrame.unionByName, read)


def _earlier_ports(known: DataFrame) -> DataFrame:
    """An edition in which one port is missing, another has another name, and one is closed since."""
    renamed = F.when(F.col("port_id") == "P5", "old name").otherwise(F.col("city")).alias("city")
    earlier = known.where("port_id <> 'P3'").select("port_id", "city_state", renamed, "state")
    return earlier.union(known.where("port_id = 'P4'").select(F.lit("P27"), "city_state", "city", "state"))


def _three_waves(spark, sf_dir, path, after_each=lambda: None) -> str:
    """Arrivals in three overlapping waves, the last with other ports; returns the path of the fact."""
    raw, known = raw_arrivals(spark, sf_dir), ports(spark, sf_dir)
    for n, years in enumerate(_WAVES):
        raw.where(years).write.mode("append").option("header", True).csv(f"{path}/in")
        used = known if n == 2 else _earlier_ports(known)
        streaming.ingest_arrivals(spark, f"{path}/in", _RAW, f"{path}/raw", f"{path}/imm", used, f"{path}/checkpoint")
        after_each()
    return f"{path}/imm"


@query
def append_only_arrivals(spark, sf_dir):
    """Three overlapping waves with a change of ports before the last; the fact equals a full build with the last ports."""
    return _dated(read_table(spark, _three_waves(spark, sf_dir, scratch_path(spark, "waves"))))


@query
def maintained_reports(spark, sf_dir):
    """The four reports from states that were kept up to date over three batches each."""
    path = scratch_path(spark, "maintained")
    known = ports(spark, sf_dir)
    arrivals, trend = f"{path}/state", f"{path}/trend"

    def follow_arrivals() -> None:
        _three_waves(spark, sf_dir, path, lambda: maintained.follow_arrivals(spark, f"{path}/imm", arrivals))

    def follow_temperatures() -> None:
        measured, raw = raw_temperatures(spark, sf_dir), f"{path}/raw_temperatures"
        for n, days in enumerate(("dt < date'2000-06-01'", "dt between date'2000-01-01' and date'2000-12-31'", "dt > date'2000-06-01'")):
            version = streaming.append_distinct(measured.where(days), raw, source=("files", n))
            new = versions.read_batches(spark, raw, version, version.added["files"])
            built = plans.build_land_temperatures(new, known, as_of=AS_OF, max_days=MAX_DAYS)
            versions.write_version(built, f"{path}/land_temp", append=True, source=("files", n))
            maintained.follow_temperatures(spark, f"{path}/land_temp", trend)

    # Neither reads what the other writes: side by side they use the cores that small jobs and last tasks leave idle.
    with ThreadPoolExecutor(max_workers=2) as pool:
        loads = [pool.submit(inheritable_thread_target(spark)(load)) for load in (follow_arrivals, follow_temperatures)]
        for load in loads:
            load.result()

    counted = maintained.arrivals_counted(spark, arrivals)
    by_month = counted.select(
        F.lit("port and month").alias("report"),
        F.col("i94port").alias("key"),
        F.concat_ws("-", text(F.coalesce("year", F.lit(0))), text(F.coalesce("month", F.lit(0)))).alias("part"),
        F.col("arrivals").alias("n"),
        F.lit(0.0).alias("value"),
    )
    airports = plans.build_airports(raw_airports(spark, sf_dir))
    types = plans.airport_types_by_state(counted, airports, weight="arrivals")
    types = types.select(F.lit("airport types"), "state", "type", "arrivals", F.col("airports").cast("double"))
    months = maintained.maintained_trend(spark, trend).select(
        F.lit("temperatures"), "port_id", text("period"), "measurements", F.coalesce("avg_temperature", F.lit(0.0))
    )
    demographics = plans.build_city_demographics(raw_demographics(spark, sf_dir), known)
    people = plans.port_demographics(counted, demographics, weight="arrivals").select(
        F.lit("demographics"), "i94port", text("total_pop"), "arrivals", F.coalesce("White_share", F.lit(0.0))
    )
    return by_month.union(types).union(months).union(people)


@query
def stream_without_copies(spark, sf_dir):
    """Events in three files, with copies of the latest days and rows that come two weeks late; what is kept and what is late."""
    path = scratch_path(spark, "stream")
    events = table(spark, sf_dir, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"), "event_type")
    waves = (
        "ts < '2024-01-12'",
        "ts >= '2024-01-11' and ts < '2024-01-22'",
        "ts >= '2024-01-21' or ts < '2024-01-08' and event_id % 3 = 0",
    )
    for n, wave in enumerate(waves):
        events.where(wave).coalesce(1).write.parquet(f"{path}/in/{n}")
    arriving = spark.readStream.schema(events.schema).option("recursiveFileLookup", True).option("maxFilesPerTrigger", 1).parquet(f"{path}/in")
    streaming.ingest_distinct(arriving, f"{path}/out", f"{path}/checkpoint", keys=["event_id"], event_time="ts", delay="2 days")
    kept = streaming.on_time(spark, f"{path}/out").withColumn("late", F.lit(False))
    found = kept.unionByName(streaming.late_rows(spark, f"{path}/out").withColumn("late", F.lit(True)))
    return found.select("event_id", "event_type", "late")


@query
def dedupe_by_digest(spark, sf_dir):
    """Wide rows, some of them twice."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    return operators.dedupe_by_digest(documents.unionAll(documents.where("doc_id % 10 = 0")))


@query
def side_by_side(spark, sf_dir):
    """Suppliers by name beside customers by balance, of which there are more, from differently dealt tables."""
    suppliers = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name").repartition(5)
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal").repartition(11, "c_custkey")
    return operators.side_by_side(suppliers, customers, ["s_name", "s_suppkey"], ["c_acctbal", "c_custkey"], name="position")


@query
def pivot_of_many_values(spark, sf_dir):
    """Largest quantity per supplier and part, with more parts than columns are allowed; a few cells taken out."""
    cells = operators.pivot_max_map(table(spark, sf_dir, "lineitem"), ["l_suppkey"], "l_partkey", "l_quantity")
    some = [cell(p, 0.0).alias(f"part_{p}") for p in (1, 2, 3)]
    return cells.select("l_suppkey", F.size("cells").cast("bigint").alias("parts"), *some)


@query
def whole_numbers_with_fractions(spark, sf_dir):
    """Numbers as an export of floats writes them, some of them no whole numbers; how each column misfits beside its sum."""
    path = scratch_path(spark, "floats")
    customer = table(spark, sf_dir, "customer")
    written = customer.select(
        F.concat(text("c_custkey"), F.lit(".0")).alias("key"),
        F.when(F.col("c_custkey") % 7 == 0, "n/a").otherwise(F.concat(text("c_nationkey"), F.lit(".00"))).alias("nation"),
        F.concat(text("c_nationkey"), F.when(F.col("c_custkey") % 5 == 0, ".5").otherwise(".0")).alias("half"),
    )
    written.write.option("header", True).csv(path)
    types = {"key": "bigint", "nation": "int", "half": "int"}
    raw = read_delimited(spark, path)
    typed = with_types(raw, types).agg(*[F.sum(c).alias(c) for c in types])
    sums = typed.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("total")) for c in types])))
    return sums.join(type_misfits(raw, types), "column", "left").select("column", "total", F.coalesce("misfits", F.lit(0)).alias("misfits"))


@query
def landed_bytes(spark, sf_dir):
    """A file per nation with quotes, blanks and line ends, landed byte for byte in two runs: what the manifest and the bytes say."""
    path = scratch_path(spark, "bytes")
    lines = table(spark, sf_dir, "customer").select(
        F.concat(F.lit('  "'), F.col("c_name"), F.lit('",\t\r')).alias("value"), "c_custkey", F.col("c_nationkey").alias("n")
    )

    def arrive(some):
        some = some.repartition("n").sortWithinPartitions("n", "c_custkey").drop("c_custkey")
        some.write.mode("append").partitionBy("n").text(f"{path}/in")
        land_files(spark, f"{path}/in", f"{path}/out", suffix=".txt", piece_bytes=1000)

    arrive(lines.where("n < 11"))
    arrive(lines.where("n >= 11"))
    nation = F.regexp_extract("path", "n=([0-9]+)", 1).cast("int").alias("nation")
    landed = landed_files(spark, f"{path}/out").select(nation, "length", F.sha2("content", 256).alias("sha256"))
    return landed.join(manifest(spark, f"{path}/out").select(nation, "pieces"), "nation")


@query
def arrivals_by_edition(spark, sf_dir):
    """Arrivals with their ports as of the day of arrival, from three editions of the label text."""
    now = label_texts(spark, sf_dir)
    earlier = F.regexp_replace(F.regexp_replace("value", "'P3'[^\\n]*\\n", "\n"), "(?i)nation_5, 5 ", "Old Town, 5 ")
    editions = [
        now.select(earlier.alias("value"), F.lit("1993-01-01").cast("date").alias("valid_from")),
        now.select("value", F.lit("1995-07-01").cast("date").alias("valid_from")),
        now.select(F.regexp_replace("value", "(?i)nation_7, 7 ", "New Town, 7 ").alias("value"), F.lit("1997-02-15").cast("date").alias("valid_from")),
    ]
    known = build_port_editions(reduce(DataFrame.unionByName, editions))
    return _dated(build_arrivals_by_edition(raw_arrivals(spark, sf_dir), known))


@query
def point_of_clustered_table(spark, sf_dir):
    """A range of days and one supplier from line items that are clustered by both."""
    path = scratch_path(spark, "clustered")
    items = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", "l_shipdate", "l_quantity")
    write_clustered(items, path, ["l_suppkey", "l_shipdate"], bloom=["l_suppkey"], files=16)
    days = F.col("l_shipdate").cast("date").between("1995-01-01", "1995-12-31")
    return read_table(spark, path).where(days | (F.col("l_suppkey") == 7)).select("l_orderkey", "l_linenumber", "l_quantity")


@query
def bucketed_lookup(spark, sf_dir):
    """Orders and customers as bucketed catalog tables, joined on their buckets and counted per customer."""
    names = {n: f"harborlake_{n}_{uuid.uuid4().hex[:8]}" for n in ("orders", "customer")}
    orders = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("custkey"), "o_totalprice")
    save_bucketed(orders, names["orders"], ["custkey"], 8, path=scratch_path(spark, "bucketed"))
    customers = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("custkey"), "c_name")
    save_bucketed(customers, names["customer"], ["custkey"], 8, path=scratch_path(spark, "bucketed"))
    joined = operators.lookup_join(spark.table(names["orders"]), spark.table(names["customer"]), "custkey", "custkey", ["c_name"])
    counted = joined.groupBy("custkey", "c_name").agg(F.count("*").alias("orders"), F.max("o_totalprice").alias("dearest"))
    for name in names.values():  # the plan has its files already, which stay in the scratch folder
        spark.sql(f"drop table {name}")
    return counted


@query
def measured_builds(spark, sf_dir):
    """Per table: source rows, copies among them, rows without a port, distinct rows, and rows of the table."""
    known = ports(spark, sf_dir)
    builds = {
        "imm": measured.measured_arrivals(raw_arrivals(spark, sf_dir), known),
        "airport": measured.measured_airports(raw_airports(spark, sf_dir)),
        "land_temp": measured.measured_temperatures(raw_temperatures(spark, sf_dir), known, as_of=AS_OF, max_days=MAX_DAYS),
    }
    tables = plans.row_counts({name: build.table for name, build in builds.items()}).withColumnRenamed("rows", "written")
    counts = [build.counts.withColumn("table", F.lit(name)) for name, build in builds.items()]
    return reduce(DataFrame.unionByName, counts).join(tables, "table")
