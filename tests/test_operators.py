from datetime import date, datetime

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from conftest import final_plan, plan, rows
from harborlake.operators import (
    conform_join,
    dedupe,
    known_keys_only,
    lines_matching,
    lookup_join,
    pivot_max,
    pivot_values,
    recent,
    recent_by_difference,
    unmatched,
    unmatched_counts,
)

NAN = float("nan")


# --- de-duplication ----------------------------------------------------------------


def test_distinct_rows_treat_null_nan_and_zero_as_equal(spark):
    data = [(None, 0.0), (None, -0.0), ("a", NAN), ("a", NAN), ("a", 1.0)]
    assert dedupe(spark.createDataFrame(data, "k string, v double")).count() == 3


small_rows = st.lists(
    st.tuples(st.sampled_from([None, "a", "b"]), st.sampled_from([None, 1, 2]), st.sampled_from([0, 1])), max_size=25
)


@settings(max_examples=10, deadline=None)
@given(small_rows)
def test_dedupe_properties(spark, data):
    frame = spark.createDataFrame(data, "k string, `v.w` int, x int").repartition(3)
    once = dedupe(frame)
    assert rows(once) == sorted(set(data), key=lambda r: [(v is not None, str(v)) for v in r])
    assert rows(dedupe(once)) == rows(once)
    by_key = {tuple(r)[0]: tuple(r) for r in dedupe(frame, ["k"]).collect()}
    lowest = {}
    for row in sorted(data, key=lambda r: [(v is not None, v if v is not None else 0) for v in r[1:]], reverse=True):
        lowest[row[0]] = row
    assert by_key == lowest


def test_dedupe_keeps_column_order_and_needs_one_shuffle(spark):
    frame = spark.createDataFrame([(1, "a", 2.0)], "x int, k string, y double")
    found = dedupe(frame, ["k"])
    assert found.columns == ["x", "k", "y"]
    assert plan(found).count("Exchange") == 1
    assert "partial_min" in plan(found)


# --- pivots ------------------------------------------------------------------------


def test_pivot_without_values_discovers_them(spark):
    frame = spark.createDataFrame(
        [("k", "b", 1), ("k", "a", 3), ("k", "a", 2), ("l", None, 4)], "key string, p string, v int"
    )
    assert pivot_values(frame, "p") == [None, "a", "b"]
    found = pivot_max(frame, ["key"], "p", "v")
    assert found.columns == ["key", "null", "a", "b"]
    assert rows(found) == [("k", 0, 3, 1), ("l", 4, 0, 0)]
    assert rows(found) == rows(frame.groupBy("key").pivot("p").max("v").fillna(0))


def test_pivot_with_values(spark):
    frame = spark.createDataFrame([("k", 1.5, "b", 1), (None, None, "z", 3)], "key string, m double, p string, v int")
    found = pivot_max(frame, ["key", "m"], "p", "v", ["b", "missing"])
    assert rows(found) == [(None, 0.0, 0, 0), ("k", 1.5, 1, 0)]
    assert rows(pivot_max(frame, ["key", "m"], "p", "v", ["b"], fill=None)) == [(None, None, None), ("k", 1.5, 1)]
    text = plan(found)
    assert text.count("Exchange") == 1 and "partial_max" in text


def test_pivot_refuses_too_many_values(spark, conf):
    conf("spark.sql.pivotMaxValues", "3")
    frame = spark.range(10).selectExpr("id", "cast(id as string) p")
    with pytest.raises(ValueError, match="pivotMaxValues"):
        pivot_values(frame, "p")


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.sampled_from("kl"), st.sampled_from(["a", "b", "c"]), st.integers(-5, 5)), min_size=1))
def test_pivot_agrees_with_the_built_in(spark, data):
    frame = spark.createDataFrame(data, "key string, p string, v int")
    built_in = frame.groupBy("key").pivot("p", ["a", "b"]).max("v").fillna(0)
    assert rows(pivot_max(frame, ["key"], "p", "v", ["a", "b"])) == rows(built_in)


# --- filters -----------------------------------------------------------------------


def test_recent_bounds(spark):
    days = [date(1989, 2, 7), date(1989, 2, 8), date(1989, 2, 9), date(2013, 10, 5), None]
    frame = spark.createDataFrame([(d,) for d in days], "dt date")
    found = recent(frame, "dt", 9000, date(2013, 9, 30))
    assert rows(found) == [(date(1989, 2, 9),), (date(2013, 10, 5),)]
    assert rows(recent_by_difference(frame, "dt", 9000, date(2013, 9, 30))) == [
        (date(1989, 2, 9), 8999),
        (date(2013, 10, 5), -5),
    ]


def test_recent_compares_timestamps_by_date(spark):
    moments = [datetime(2000, 1, 1, 23, 59, 59), datetime(2000, 1, 2), datetime(2000, 1, 2, 0, 0, 1)]
    for kind in ("timestamp_ntz", "timestamp"):
        frame = spark.createDataFrame([(m,) for m in moments], f"ts {kind}")
        expected = frame.where("datediff(date'2000-01-11', cast(ts as date)) < 10")
        assert rows(recent(frame, "ts", 10, date(2000, 1, 11))) == rows(expected)
        assert recent(frame, "ts", 10, date(2000, 1, 11)).count() == 2
    texts = spark.createDataFrame([("2000-01-01",), ("2000-01-02",)], "dt string")
    assert rows(recent(texts, "dt", 10, date(2000, 1, 11))) == [("2000-01-02",)]


def test_recent_defaults_to_today(spark):
    frame = spark.sql("select date_sub(current_date(), 9) dt union all select date_sub(current_date(), 10)")
    assert recent(frame, "dt", 10).count() == 1


def test_recent_reaches_the_scan(spark, tmp_path):
    spark.sql("select date'2000-01-01' dt, 1 x").write.parquet(str(tmp_path / "t"))
    found = recent(spark.read.parquet(str(tmp_path / "t")), "dt", 10, date(2000, 1, 5))
    assert "GreaterThanOrEqual(dt,1999-12-27)" in plan(found)
    spark.sql("select date'2000-01-01' dt, 1 x").write.partitionBy("dt").parquet(str(tmp_path / "p"))
    found = recent(spark.read.parquet(str(tmp_path / "p")), "dt", 10, date(2000, 1, 5))
    assert "PartitionFilters: [isnotnull(dt" in plan(found)


def test_lines_matching(spark):
    frame = spark.createDataFrame([("a = b",), ("a b",), (None,)], "line string")
    assert rows(lines_matching(frame, "line", "(.+)=(.+)")) == [("a = b",)]


# --- joins -------------------------------------------------------------------------


@pytest.fixture(scope="module")
def dim(spark):
    data = [("A", "portland", "ME"), ("B", "portland", "OR"), ("C", "york", None), (None, "nowhere", "X"), ("D", None, "Y")]
    return spark.createDataFrame(data, "port_id string, city string, state string")


@pytest.fixture(scope="module")
def fact(spark):
    data = [(1, "A", "Portland"), (2, "C", "YORK"), (3, "Z", "Paris"), (4, None, None), (5, "A", "portland")]
    return spark.createDataFrame(data, "id int, port string, City string")


def test_lookup(fact, dim):
    found = lookup_join(fact, dim, "port", "port_id", {"port_city": "city"})
    assert rows(found.select("id", "port_city")) == [(1, "portland"), (2, "york"), (5, "portland")]
    assert found.columns == ["id", "port", "City", "port_city"]


def test_lookup_splits_the_input(fact, dim):
    matched = lookup_join(fact, dim, "port", "port_id", ["state"]).count()
    lost = unmatched(fact, dim, "port", "port_id")
    assert rows(lost.select("id")) == [(3,), (4,)]
    assert matched + lost.count() == fact.count()
    assert rows(unmatched_counts(fact, dim, "port", "port_id")) == [(None, 1), ("Z", 1)]


def test_conform_join_fans_out(fact, dim):
    found = conform_join(fact, dim, "City", "city", ["port_id"], key_as="city_lower")
    assert rows(found.select("id", "city_lower", "port_id")) == [
        (1, "portland", "A"),
        (1, "portland", "B"),
        (2, "york", "C"),
        (5, "portland", "A"),
        (5, "portland", "B"),
    ]
    assert found.columns == ["id", "port", "City", "city_lower", "port_id"]


def test_conform_join_with_more_equalities(spark, dim):
    left = spark.createDataFrame([("Portland", "OR"), ("York", None)], "City string, `State Code` string")
    found = conform_join(left, dim, "City", "city", ["port_id"], also={"State Code": "state"})
    assert rows(found.select("port_id")) == [("B",)]


def test_small_reference_table_is_broadcast_and_large_one_is_not(fact, dim, conf):
    assert "BroadcastHashJoin" in final_plan(lookup_join(fact, dim, "port", "port_id", ["state"]))
    small = rows(conform_join(fact, dim, "City", "city", ["port_id"]))
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    assert "BroadcastHashJoin" not in final_plan(lookup_join(fact, dim, "port", "port_id", ["state"]))
    assert rows(conform_join(fact, dim, "City", "city", ["port_id"])) == small


def test_hot_key_is_split_when_the_reference_table_is_large(spark, conf):
    """A third of the rows have one key; the shuffled join cuts that partition into pieces."""
    for name, value in {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "50KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1KB",
    }.items():
        conf(name, value)
    large = spark.range(0, 60000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, F.lit("k0")).otherwise(F.concat(F.lit("k"), F.col("id") % 1000)).alias("port"),
        F.sha2(F.col("id").cast("string"), 256).alias("text"),
    )
    reference = spark.range(1000).select(F.concat(F.lit("k"), F.col("id")).alias("port_id"), F.col("id").alias("n"))
    for join in (
        lookup_join(large, reference, "port", "port_id", ["n"]),
        conform_join(large, reference, "port", "port_id", ["n"]),
    ):
        assert "skew=true" in final_plan(join)
        assert join.count() == 60000


def test_unknown_keys_are_dropped_early_however_large_the_keys_are(spark, fact, conf):
    dim = spark.sql("select * from values ('A'), ('A'), ('C'), (null), ('D') as t(port_id)")
    early = known_keys_only(fact, dim, F.col("port"), "port_id")
    assert rows(early.select("id")) == [(1,), (2,), (5,)]
    assert plan(dedupe(early)).count("Exchange hashpartitioning") == 1
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    later = known_keys_only(fact, dim, F.col("port"), "port_id")
    assert rows(later.select("id")) == [(1,), (2,), (5,)] and "LeftSemi" in plan(later)
