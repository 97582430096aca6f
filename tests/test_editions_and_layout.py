"""Ports by edition, clustered tables and bucketed tables."""

import hashlib
from datetime import date

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from conftest import final_plan, plan, rows
from harborlake.operators import lookup_join
from harborlake.plans import QualityError, port_demographics
from harborlake.plans.editions import build_arrivals_by_edition, build_port_editions
from harborlake.sinks.layout import _codes, interleaved, save_bucketed, write_clustered


def texts(spark, *editions):
    data = [("I94PORT\n" + "\n".join(f"'{c}' = '{name}'" for c, name in pairs) + "\n;", day) for day, pairs in editions]
    return spark.createDataFrame(data, "value string, valid_from date")


FIRST, SECOND, THIRD = date(2015, 1, 1), date(2016, 6, 1), date(2016, 9, 1)


@pytest.fixture(scope="module")
def editions(spark):
    return build_port_editions(
        texts(
            spark,
            (FIRST, [("NYC", "NEW YORK, NY"), ("OLD", "GONE, XX"), ("POM", "PORTLAND, ME")]),
            (SECOND, [("NYC", "NEW YORK, NY"), ("POM", "PORT LAND, ME"), ("NEW", "HERE, YY")]),
            (THIRD, [("NYC", "NEW YORK, NY"), ("POM", "PORTLAND, ME"), ("NEW", "HERE, YY"), ("OLD", "GONE, XX")]),
        )
    ).persist()


def test_validity(editions):
    found = {tuple(r) for r in editions.select("port_id", "city", "valid_from", "valid_to").collect()}
    assert found == set(
        [
            ("NYC", "new york", FIRST, None),
            ("OLD", "gone", FIRST, SECOND),
            ("OLD", "gone", THIRD, None),
            ("POM", "portland", FIRST, SECOND),
            ("POM", "port land", SECOND, THIRD),
            ("POM", "portland", THIRD, None),
            ("NEW", "here", SECOND, None),
        ]
    )


def test_each_arrival_meets_the_edition_of_its_day(spark, editions):
    """Every port on days around each change, long before the first and long after the last, and without a day."""
    days = [date(1990, 1, 1), FIRST, date(2016, 5, 31), SECOND, date(2016, 8, 31), THIRD, date(2016, 12, 31), date(2017, 1, 1), date(2050, 1, 1), None]
    data = [(f"{p}{n}", p, None if d is None else str((d - date(1960, 1, 1)).days)) for p in ("NYC", "OLD", "POM", "NEW", "XXX") for n, d in enumerate(days)]
    arrivals = spark.createDataFrame(data, "cicid string, i94port string, arrdate string")
    found = build_arrivals_by_edition(arrivals.union(arrivals), editions)
    known = [tuple(r) for r in editions.collect()]
    expected = []
    for cicid, port, number in data:
        d = days[int(cicid[3:])]
        for port_id, _, city, state, start, end in known:
            begins = start == FIRST or (d is None or d >= start)
            ends = end is None or (d is not None and d < end)
            if port_id == port and begins and ends:
                expected.append((cicid, d, port, city, state, d and d.month, d and d.year))
    assert rows(found) == sorted(expected, key=lambda r: [(v is not None, str(v)) for v in r])
    assert len(expected) == 10 + 8 + 10 + 7 and "NestedLoop" not in plan(found)


def test_conflicting_names_fail_by_name(spark):
    with pytest.raises(QualityError, match="A from 2015-01-01: X, NY, Y, NY"):
        build_port_editions(texts(spark, (FIRST, [("A", "X, NY"), ("A", "Y, NY"), ("B", "Z")]), (SECOND, [("A", "X, NY")])))


def test_no_editions(spark):
    none = build_port_editions(texts(spark, (FIRST, [("A", "X")])).where("1 = 0"))
    arrivals = spark.createDataFrame([("1", "A", "20000")], "cicid string, i94port string, arrdate string")
    assert none.collect() == [] and build_arrivals_by_edition(arrivals, none).collect() == []


def test_bits_are_interleaved(spark):
    found = spark.createDataFrame([(5, 3)], "a int, b int").select(interleaved([F.col("a"), F.col("b")], 3)).first()[0]
    assert found == 0b10_01_11


def test_codes_are_found_by_halving(spark):
    """As many as bounds below the value, of repeated, missing and odd values; no comparison with every bound."""
    values = [None, float("nan"), float("-inf"), *[float(n * n % 1013) for n in range(3000)], *[7.0] * 500]
    df = spark.createDataFrame([(v, n % 3) for n, v in enumerate(values)], "a double, b int").repartition(3)
    for bits in (2, 8):
        codes = _codes(df, ["a", "b"], bits)
        share = [n / (1 << bits) for n in range(1, 1 << bits)]
        bounds = sorted(set(df.select(F.approx_percentile("a", share, 10_000)).first()[0]))
        few = sorted(set(df.select(F.approx_percentile(F.col("b").cast("double"), share, 10_000)).first()[0]))
        expected = F.coalesce(F.size(F.filter(F.array(*[F.lit(b) for b in bounds]), lambda b: b < F.col("a"))), F.lit(0))
        fewer = F.size(F.filter(F.array(*[F.lit(b) for b in few]), lambda b: b < F.col("b").cast("double")))
        spread = [F.floor(e * (1 << bits) / (len(found) + 1)).cast("int") for e, found in ((expected, bounds), (fewer, few))]
        assert df.select(*codes, *spread).where(~(codes[0] == spread[0]) | ~(codes[1] == spread[1])).count() == 0
        assert "filter(" not in plan(df.select(*codes))


@pytest.mark.parametrize("column, value", [("day", date(2020, 4, 9)), ("port", "P17"), ("n", 41)])
def test_a_clustered_table_is_skipped_in_every_column(spark, tmp_path, column, value):
    df = spark.range(0, 40_000, 1, 8).select(
        F.expr("date_add(date'2020-01-01', cast(id * 7919 % 365 as int))").alias("day"),
        F.concat(F.lit("P"), F.lpad((F.col("id") * 104729 % 60).cast("string"), 2, "0")).alias("port"),
        (F.col("id") * 31 % 97).alias("n"),
        "id",
    )
    columns = ["day", "port", "n"]
    write_clustered(df, str(tmp_path / "t"), columns, bloom=["port"], files=27)
    df.repartition(27).write.parquet(str(tmp_path / "plain"))
    assert rows(spark.read.parquet(str(tmp_path / "t")).where(F.col(column) == value)) == rows(df.where(F.col(column) == value))

    def read(folder):
        """Row groups whose least and largest values do not exclude the value."""
        groups = 0
        for file in (tmp_path / folder).glob("*.parquet"):
            meta = pq.ParquetFile(file).metadata
            at = [i for i in range(meta.num_columns) if meta.row_group(0).column(i).path_in_schema == column][0] if meta.num_row_groups else 0
            stats = [meta.row_group(g).column(at).statistics for g in range(meta.num_row_groups)]
            groups += sum(s.min <= value <= s.max for s in stats)
        return groups

    assert read("plain") == 27 and read("t") <= 18


def test_bloom_filters_are_written(spark, tmp_path):
    df = spark.range(40_000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("port"))
    sizes = {}
    for name, bloom in (("with", ["port"]), ("without", [])):
        write_clustered(df, str(tmp_path / name), ["id"], bloom=bloom, files=1)
        sizes[name] = sum(p.stat().st_size for p in (tmp_path / name).glob("*.parquet"))
    assert sizes["with"] > sizes["without"]
    found = spark.read.parquet(str(tmp_path / "with")).where(F.col("port") == hashlib.sha256(b"7").hexdigest())
    assert "EqualTo(port," in plan(found) and rows(found.select("id")) == [(7,)]


def test_bucketed_tables_are_joined_without_a_shuffle(spark, tmp_path, conf):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    fact = spark.range(2000).select(F.when(F.col("id") % 3 == 0, "P0").otherwise(F.concat(F.lit("P"), F.col("id") % 9)).alias("i94port"), "id")
    ports = spark.createDataFrame([(f"P{n}", f"c{n}", n, n * 2) for n in range(8)], "port_id string, city string, total_pop int, White int")
    for name, df, key in (("fact_b", fact, "i94port"), ("ports_b", ports, "port_id")):
        for _ in range(2):
            save_bucketed(df, name, [key], 8, path=str(tmp_path / name))
    joined = lookup_join(spark.table("fact_b"), spark.table("ports_b"), "i94port", "port_id", ["city"])
    assert "Exchange" not in final_plan(joined)
    assert rows(joined) == rows(lookup_join(fact, ports, "i94port", "port_id", ["city"]))
    reported = port_demographics(spark.table("fact_b"), spark.table("ports_b"), measures=["White"])
    assert "Exchange" not in final_plan(reported)
    assert rows(reported) == rows(port_demographics(fact, ports, measures=["White"]))
    stats = {r["info_name"]: r["info_value"] for r in spark.sql("describe extended fact_b i94port").collect()}
    assert stats["distinct_count"] == "7" and stats["num_nulls"] == "0"
    spark.sql("drop table fact_b")
    spark.sql("drop table ports_b")
