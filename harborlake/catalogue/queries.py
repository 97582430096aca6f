"""One query per operator or job; each takes (spark, folder of the driver's tables)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from harborlake import functions, plans, streaming
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
from harborlake.functions import part_of, sas_date, strip, unquote, without_chars
from harborlake.functions.dates import SAS_EPOCH
from harborlake.operators import (
    conform_join,
    dedupe,
    lines_matching,
    lookup_join,
    pivot_max,
    recent,
    recent_by_difference,
    unmatched,
)
from harborlake.sinks import (
    land,
    overwrite_partitions,
    overwrite_table,
    preview,
    save_table,
    scratch_path,
    write_delimited,
)
from harborlake.sources import read_any, read_delimited, read_table, read_texts

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# The event types, order priorities and market segments of the driver's tables.
EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]
PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


# --- columns -----------------------------------------------------------------------


@query
def split_second(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", part_of("event_type", "u", 1).alias("tail"))


@query
def label_text_functions(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    padded = F.concat(F.lit(" \t"), F.col("p_name"), F.lit("\t \r"))
    quoted = F.concat(F.lit("'"), F.col("p_type"), F.lit("'"))
    coded = F.concat(F.lit("'"), F.col("p_brand"), F.lit(",)'"))
    return part.select(
        "p_partkey",
        strip(padded).alias("name"),
        F.lower(unquote(quoted)).alias("type"),
        without_chars(coded, "',)").alias("brand"),
        F.trim(F.concat(F.lit("  "), text("p_size"), F.lit(" "))).alias("size"),
    )


@query
def sas_days_to_date(spark, sf_dir):
    days = F.concat(text(F.col("o_orderkey") % 20000 + 1), F.lit(".0"))
    dated = table(spark, sf_dir, "orders").select("o_orderkey", sas_date(days).alias("arrival_date"))
    return dated.withColumns({"year": F.year("arrival_date"), "month": F.month("arrival_date")})


@query
def calendar_parts(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        "event_id", *[c.alias(name) for name, c in functions.calendar_parts("ts").items()]
    )


@query
def renamed_columns(spark, sf_dir):
    raw = raw_demographics(spark, sf_dir).fillna(0, ["Number of Veterans"])
    return raw.withColumnsRenamed({"Median Age": "median_age", "Number of Veterans": "veterans_num"}).select(
        "City", "median_age", "veterans_num", "Foreign-Born", F.col("`State Code`").alias("state_code")
    )


@query
def columns_named_by_position(spark, sf_dir):
    part = table(spark, sf_dir, "part").select("p_partkey", F.split("p_name", " ", 2).alias("words"))
    return part.select("p_partkey", F.get("words", F.lit(0)), F.get("words", F.lit(1))).toDF("id", "colour", "thing")


# --- filters -----------------------------------------------------------------------


@query
def recent_days(spark, sf_dir):
    lineitem = table(spark, sf_dir, "lineitem")
    return recent(lineitem, "l_shipdate", MAX_DAYS, AS_OF).select(
        "l_orderkey", "l_linenumber", F.col("l_shipdate").cast("date").alias("dt")
    )


@query
def recent_day_differences(spark, sf_dir):
    lineitem = table(spark, sf_dir, "lineitem")
    return recent_by_difference(lineitem, "l_shipdate", MAX_DAYS, AS_OF).select(
        "l_orderkey", "l_linenumber", "date_diff"
    )


@query
def recent_until_today(spark, sf_dir):
    lineitem = table(spark, sf_dir, "lineitem")
    return recent(lineitem, "l_shipdate", 11_500).select("l_orderkey", "l_linenumber")


@query
def matching_lines(spark, sf_dir):
    documents = table(spark, sf_dir, "documents")
    lines = documents.select("doc_id", F.explode(F.split("text", "\n")).alias("line"))
    return lines_matching(lines, "line", "[0-9]=[0-9]|[a-z]@[a-z]|LICENSE|License")


# --- de-duplication and pivots -----------------------------------------------------


@query
def dedupe_full_row(spark, sf_dir):
    return dedupe(table(spark, sf_dir, "events").select("user_id", "event_type"))


@query
def dedupe_by_key(spark, sf_dir):
    return dedupe(table(spark, sf_dir, "lineitem"), on=["l_orderkey", "l_linenumber"])


@query
def dedupe_then_project(spark, sf_dir):
    return dedupe(table(spark, sf_dir, "orders").select("o_custkey", "o_orderstatus")).select("o_orderstatus")


@query
def pivot_max_fill(spark, sf_dir):
    return pivot_max(table(spark, sf_dir, "events"), ["user_id"], "event_type", "value", EVENT_TYPES)


@query
def pivot_discover(spark, sf_dir):
    return pivot_max(table(spark, sf_dir, "events"), ["user_id"], "event_type", "value")


@query
def pivot_multi_key(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    return pivot_max(orders, ["o_custkey", "o_orderstatus"], "o_orderpriority", "o_totalprice", PRIORITIES)


@query
def fillna_numeric(spark, sf_dir):
    large = F.col("value") > 5
    return (
        table(spark, sf_dir, "events")
        .select("event_id", F.when(large, F.col("value")).alias("v"), F.when(large, F.col("event_type")).alias("s"))
        .fillna(0)
    )


# --- joins -------------------------------------------------------------------------


@query
def lookup_port(spark, sf_dir):
    return lookup_join(
        table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey"),
        table(spark, sf_dir, "nation"),
        "c_nationkey",
        "n_nationkey",
        {"nation": "n_name", "region": "n_regionkey"},
    )


@query
def conform_lower_join(spark, sf_dir):
    customer = table(spark, sf_dir, "customer").select(
        "c_custkey", F.concat(F.lit("Nation_"), text("c_nationkey")).alias("City")
    )
    cities = table(spark, sf_dir, "nation").withColumn("city", F.lower("n_name"))
    return conform_join(customer, cities, "City", "city", ["n_nationkey"], key_as="city_lower").drop("City")


@query
def fanout_join(spark, sf_dir):
    customer = table(spark, sf_dir, "customer").select(
        "c_custkey", F.concat(F.lit("Nation_"), text("c_nationkey")).alias("City")
    )
    return conform_join(customer, ports(spark, sf_dir), "City", "city", ["port_id", "state"])


@query
def unmatched_keys(spark, sf_dir):
    return unmatched(raw_arrivals(spark, sf_dir), ports(spark, sf_dir), "i94port", "port_id").select("cicid", "i94port")


# --- sources and sinks -------------------------------------------------------------


@query
def csv_string_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "csv_strings")
    write_delimited(table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment"), path)
    return read_delimited(spark, path)


@query
def csv_glob_infer(spark, sf_dir):
    path = scratch_path(spark, "csv_infer")
    write_delimited(table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal"), path, sep=";")
    return read_delimited(spark, f"{path}/*.csv", sep=";", infer=True)


@query
def csv_typed_by_name(spark, sf_dir):
    path = scratch_path(spark, "csv_typed")
    write_delimited(table(spark, sf_dir, "supplier"), path)
    return read_delimited(spark, path, types={"s_suppkey": "bigint", "s_nationkey": "int", "s_acctbal": "double"})


@query
def recursive_suffix_scan(spark, sf_dir):
    path = scratch_path(spark, "nested")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_name", F.col("c_nationkey").alias("n"))
    overwrite = customer.write.mode("overwrite").partitionBy("n").option("header", True)
    overwrite.csv(f"{path}/a")
    land(customer, f"{path}/b", "json")
    return read_delimited(spark, path, schema="c_custkey bigint, c_name string", suffix=".csv", recursive=True)


@query
def format_scan(spark, sf_dir):
    path = scratch_path(spark, "orc")
    land(table(spark, sf_dir, "supplier"), path, "orc")
    return read_any(spark, "orc", path).select("s_suppkey", "s_name", "s_nationkey")


@query
def whole_text_scan(spark, sf_dir):
    path = scratch_path(spark, "texts")
    names = table(spark, sf_dir, "customer").select(F.col("c_name").alias("value"))
    # Bounded files, since each is read back as one value.
    names.write.mode("overwrite").option("maxRecordsPerFile", 100_000).text(path)
    lines = read_texts(spark, path).select(F.explode(F.split("value", "\n")).alias("c_name"))
    return lines.where("c_name <> ''")


@query
def flat_table_scan(spark, sf_dir):
    path = scratch_path(spark, "flat")
    overwrite_table(table(spark, sf_dir, "part"), path)
    return read_table(spark, path).select("p_partkey", "p_type")


@query
def partitioned_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "by_year")
    orders = table(spark, sf_dir, "orders").withColumn("year", F.year("o_orderdate"))
    overwrite_partitions(orders, path, ["year"])
    return read_table(spark, path).select("o_orderkey", "o_orderstatus", "year")


@query
def partitioned_by_date_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "by_date")
    events = table(spark, sf_dir, "events").select("event_id", "value", F.col("ts").cast("date").alias("dt"))
    overwrite_partitions(events, path, ["dt"])
    return read_table(spark, path)


@query
def refreshed_partitions(spark, sf_dir):
    """All years are written as old, then the later ones again as new."""
    path = scratch_path(spark, "refreshed")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.year("o_orderdate").alias("year"))
    overwrite_partitions(orders.withColumn("load", F.lit("old")), path, ["year"])
    later = orders.where("year >= 1999").withColumn("load", F.lit("new"))
    overwrite_partitions(later, path, ["year"], only_present=True)
    return read_table(spark, path)


@query
def saved_table(spark, sf_dir):
    save_table(
        table(spark, sf_dir, "supplier"), "harborlake_supplier", path=scratch_path(spark, "supplier")
    )
    found = spark.sql("select s_suppkey, s_name from harborlake_supplier")
    spark.sql("drop table harborlake_supplier")  # its files stay in the scratch folder
    return found


@query
def landed_extracts(spark, sf_dir):
    """Extracts in nested folders, two of them of the same file name, become one dataset."""
    path = scratch_path(spark, "extracts")
    raw = raw_arrivals(spark, sf_dir)
    raw.withColumn("source_year", F.col("i94yr")).write.mode("overwrite").partitionBy("source_year").json(
        f"{path}/in"
    )
    schema = "cicid string, i94yr string, i94port string, arrdate string"
    plans.land_extracts(spark, plans.Extract(f"{path}/in", "json", suffix=".json", schema=schema), f"{path}/out")
    return read_table(spark, f"{path}/out", schema)


@query
def sorted_dim_sample(spark, sf_dir):
    return preview(table(spark, sf_dir, "supplier").orderBy("s_name").select("s_suppkey", "s_name"))


# --- the five tables ---------------------------------------------------------------


def _dated(fact: DataFrame) -> DataFrame:
    """Missing dates as day zero, since tools print a missing date or integer in different ways."""
    return fact.withColumn("arrival_date", F.coalesce("arrival_date", F.lit(SAS_EPOCH))).fillna(0, ["year", "month"])


@query
def label_lines(spark, sf_dir):
    return ports(spark, sf_dir)


@query
def build_ports(spark, sf_dir):
    """One label text per customer, written with the code block between other blocks."""
    texts = table(spark, sf_dir, "customer").select(
        F.format_string(
            "/* I94CIT */\n 1 = 'A'\n;\nI94PORT codes\n   'C%1$d'\t=\t'%2$s, %3$s   '\n;\n 'X%1$d' = 'Y'\n;",
            "c_custkey",
            "c_name",
            "c_mktsegment",
        ).alias("value")
    )
    return plans.build_ports(texts)


@query
def split_dim(spark, sf_dir):
    part = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("ident"),
        F.col("p_type").alias("type"),
        F.translate("p_brand", "#", "-").alias("iso_region"),
    )
    return plans.build_airports(part)


@query
def build_airports(spark, sf_dir):
    path = scratch_path(spark, "airport")
    plans.write_checked(plans.build_airports(raw_airports(spark, sf_dir)), path)
    return read_table(spark, path)


@query
def build_city_demographics(spark, sf_dir):
    return plans.build_city_demographics(raw_demographics(spark, sf_dir), ports(spark, sf_dir))


@query
def build_city_demographics_same_state(spark, sf_dir):
    return plans.build_city_demographics(
        raw_demographics(spark, sf_dir), ports(spark, sf_dir), match_state=True
    )


@query
def build_arrivals(spark, sf_dir):
    path = scratch_path(spark, "imm")
    plans.write_checked(plans.build_arrivals(raw_arrivals(spark, sf_dir), ports(spark, sf_dir)), path, ["year"])
    return _dated(read_table(spark, path))


@query
def build_arrivals_by_key(spark, sf_dir):
    raw = raw_arrivals(spark, sf_dir)
    return _dated(plans.build_arrivals(raw, ports(spark, sf_dir), dedupe_on=["cicid"]))


@query
def build_land_temperatures(spark, sf_dir):
    return plans.build_land_temperatures(
        raw_temperatures(spark, sf_dir), ports(spark, sf_dir), as_of=AS_OF, max_days=MAX_DAYS
    )


@query
def build_land_temperatures_one_country(spark, sf_dir):
    return plans.build_land_temperatures(
        raw_temperatures(spark, sf_dir), ports(spark, sf_dir), as_of=AS_OF, max_days=MAX_DAYS, country="O"
    )


# --- quality -----------------------------------------------------------------------


@query
def duplicate_report(spark, sf_dir):
    return plans.duplicate_report(table(spark, sf_dir, "orders").select("o_custkey", "o_orderstatus"))


@query
def row_count_report(spark, sf_dir):
    return plans.row_counts({name: table(spark, sf_dir, name) for name in ("orders", "customer")})


@query
def unmatched_report(spark, sf_dir):
    return plans.unmatched_report(raw_arrivals(spark, sf_dir), ports(spark, sf_dir), "i94port", "port_id")


@query
def checked_write(spark, sf_dir):
    path = scratch_path(spark, "checked")
    lineitem = table(spark, sf_dir, "lineitem").withColumn("year", F.year("l_shipdate"))
    written = plans.write_checked(lineitem, path, ["year"])
    stored = plans.row_counts({"lineitem": read_table(spark, path)})
    return stored.withColumn("sent", F.lit(written.sent).cast("bigint"))


# --- analytics ---------------------------------------------------------------------


def _orders_by_nation(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(
        "o_custkey", F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month")
    )
    return lookup_join(orders, table(spark, sf_dir, "customer"), "o_custkey", "c_custkey", ["c_nationkey"])


@query
def arrivals_by_port_month(spark, sf_dir):
    return plans.arrivals_by_port_month(_orders_by_nation(spark, sf_dir), port="c_nationkey")


def _counted_by_nation(spark, sf_dir):
    """Orders are counted per customer before they meet the customers."""
    counted = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("orders"))
    return lookup_join(counted, table(spark, sf_dir, "customer"), "o_custkey", "c_custkey", ["c_nationkey"])


@query
def top_ports(spark, sf_dir):
    return plans.top_ports(_counted_by_nation(spark, sf_dir), 5, port="c_nationkey", weight="orders")


@query
def port_demographics(spark, sf_dir):
    population = (
        table(spark, sf_dir, "customer")
        .groupBy(F.col("c_nationkey").alias("port_id"))
        .agg(
            F.count(F.lit(1)).alias("total_pop"),
            *[F.count_if(F.col("c_mktsegment") == s).alias(s.lower()) for s in SEGMENTS],
        )
    )
    return plans.port_demographics(
        _counted_by_nation(spark, sf_dir),
        population,
        port="c_nationkey",
        measures=[s.lower() for s in SEGMENTS],
        weight="orders",
    )


@query
def popular_port_demographics(spark, sf_dir):
    """The five ports with most arrivals, from the built fact and dimension."""
    known = ports(spark, sf_dir)
    return plans.port_demographics(
        plans.build_arrivals(raw_arrivals(spark, sf_dir), known),
        plans.build_city_demographics(raw_demographics(spark, sf_dir), known),
        k=5,
    )


@query
def airport_types_by_state(spark, sf_dir):
    """Sold items stand for arrivals in the state of their part's brand."""
    airports = table(spark, sf_dir, "part").select(
        "p_partkey", F.col("p_type").alias("type"), part_of("p_brand", "#", 1).alias("state")
    )
    # Counted per part first: one shuffle, on the key the join needs, and no hot part in it.
    sold = table(spark, sf_dir, "lineitem").groupBy("l_partkey").agg(F.count(F.lit(1)).alias("items"))
    arrivals = lookup_join(sold, airports, "l_partkey", "p_partkey", {"port_state": "state"})
    return plans.airport_types_by_state(arrivals, airports, weight="items")


@query
def airport_types_of_arrivals(spark, sf_dir):
    """The same report from the built fact and dimension."""
    return plans.airport_types_by_state(
        plans.build_arrivals(raw_arrivals(spark, sf_dir), ports(spark, sf_dir)),
        plans.build_airports(raw_airports(spark, sf_dir)),
    )


@query
def port_value_trend(spark, sf_dir):
    return plans.temperature_trend(
        table(spark, sf_dir, "events"),
        period="day",
        port="event_type",
        measured_on="ts",
        value="value",
        scale=2,
    )


@query
def port_temperature_trend(spark, sf_dir):
    known = ports(spark, sf_dir)
    temperatures = plans.build_land_temperatures(
        raw_temperatures(spark, sf_dir), known, as_of=AS_OF, max_days=MAX_DAYS
    )
    return plans.temperature_trend(temperatures, scale=2)


@query
def arrivals_with_temperature(spark, sf_dir):
    known = ports(spark, sf_dir)
    return plans.arrivals_with_temperature(
        plans.build_arrivals(raw_arrivals(spark, sf_dir), known),
        plans.build_land_temperatures(raw_temperatures(spark, sf_dir), known, as_of=AS_OF, max_days=MAX_DAYS),
        by_month=True,
        scale=2,
    )


@query
def arrivals_with_temperature_overall(spark, sf_dir):
    """The same over all years, from stored tables."""
    known, path = ports(spark, sf_dir), scratch_path(spark, "overall")
    overwrite_table(plans.build_arrivals(raw_arrivals(spark, sf_dir), known), f"{path}/imm")
    temperatures = plans.build_land_temperatures(raw_temperatures(spark, sf_dir), known, as_of=AS_OF, max_days=MAX_DAYS)
    overwrite_table(temperatures, f"{path}/land_temp")
    return plans.arrivals_with_temperature(read_table(spark, f"{path}/imm"), read_table(spark, f"{path}/land_temp"), scale=2)


# --- runs and incremental loads ----------------------------------------------------


def _run(spark, sf_dir) -> tuple[plans.Locations, list[plans.TableResult]]:
    """Arrivals landed from extracts by year, other sources as CSV; all tables built."""
    root = scratch_path(spark, "run")
    where = plans.Locations(landing=f"{root}/landing", tables=f"{root}/tables")
    write_delimited(raw_airports(spark, sf_dir), where.landed("airport"))
    write_delimited(raw_demographics(spark, sf_dir), where.landed("city_demo"), sep=";")
    write_delimited(raw_temperatures(spark, sf_dir), where.landed("land_temp"))
    by_year = raw_arrivals(spark, sf_dir).withColumn("source_year", F.col("i94yr"))
    by_year.write.partitionBy("source_year").json(f"{root}/extracts")
    raw = plans.Extract(
        f"{root}/extracts", "json", suffix=".json", schema="cicid string, i94yr string, i94port string, arrdate string"
    )
    results = plans.run_pipeline(
        spark,
        where,
        as_of=AS_OF,
        max_days=MAX_DAYS,
        extracts={"imm": raw},
        sources={"labels": label_texts(spark, sf_dir)},
    )
    return where, results


@query
def whole_run(spark, sf_dir):
    """What a whole run reports."""
    return plans.pipeline_report(spark, _run(spark, sf_dir)[1])


@query
def whole_run_contents(spark, sf_dir):
    """What a whole run has stored, by sums over each table's columns."""
    where, _ = _run(spark, sf_dir)

    def summed(name, *parts):
        total = sum((F.coalesce(F.sum(part.cast("bigint")), F.lit(0)) for part in parts[1:]), F.coalesce(F.sum(parts[0].cast("bigint")), F.lit(0)))
        return read_table(spark, where.table(name)).agg(F.count("*").alias("rows"), total.alias("content")).select(F.lit(name).alias("table"), "rows", "content")

    numbers = ["male_pop", "female_pop", "total_pop", "veterans_num", "Foreign-Born", "ai_an", "Asian", "black_aa", "h_l", "White"]
    days = F.datediff("arrival_date", F.lit(SAS_EPOCH))
    return (
        summed("imm", F.regexp_extract("cicid", "[0-9]+", 0), days, F.col("month"), F.col("year"), F.length("port_city"), F.length("port_state"))
        .union(summed("city_demo", *[F.col(f"`{c}`") for c in numbers], F.length("port_id"), F.col("avg_household") * 2))
        .union(summed("airport", F.length("ident"), F.length("type"), F.length("iso_region"), F.length("state")))
        .union(summed("land_temp", F.col("AverageTemperature"), F.length("port_id"), F.datediff("dt", F.lit(SAS_EPOCH))))
    )


@query
def incremental_append(spark, sf_dir):
    """Two arrivals of files, three runs: every file is stored once."""
    path = scratch_path(spark, "append")
    schema = "c_custkey bigint, c_name string, c_nationkey int"
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")

    def arrive(rows, mode):
        rows.write.mode(mode).option("header", True).csv(f"{path}/in")

    def ingest():
        streaming.ingest_new_files(spark, f"{path}/in", schema, f"{path}/out", f"{path}/checkpoint")

    arrive(customer.where("c_nationkey < 12"), "overwrite")
    ingest()
    arrive(customer.where("c_nationkey >= 12"), "append")
    ingest()
    ingest()
    return read_table(spark, f"{path}/out")


@query
def incremental_arrivals(spark, sf_dir):
    """Arrival files in two waves that overlap; the fact equals a full build."""
    path = scratch_path(spark, "daily")
    raw = raw_arrivals(spark, sf_dir)
    schema = "cicid string, i94yr string, i94port string, arrdate string"

    def arrive(rows, mode):
        rows.write.mode(mode).option("header", True).csv(f"{path}/in")

    def ingest():
        streaming.ingest_arrivals(
            spark,
            f"{path}/in",
            schema,
            f"{path}/raw",
            f"{path}/imm",
            ports(spark, sf_dir),
            f"{path}/checkpoint",
        )

    arrive(raw.where("i94yr <= '1999.0'"), "overwrite")
    ingest()
    arrive(raw.where("i94yr >= '1999.0'"), "append")
    ingest()
    return _dated(read_table(spark, f"{path}/imm"))
