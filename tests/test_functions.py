from datetime import date, datetime

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from harborlake.functions import (
    calendar_parts,
    day_difference,
    exact_avg,
    lower_key,
    part_of,
    sas_date,
    strip,
    unquote,
    without_chars,
)


def apply(spark, values, column, kind="string"):
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}").coalesce(1)
    return [r[0] for r in frame.orderBy("i").select(column).collect()]


def test_second_part(spark):
    values = ["US-PA", "US-U-A", "US", "", "US-", None]
    assert apply(spark, values, part_of("v", "-", 1)) == ["PA", "U", None, None, "", None]
    assert apply(spark, values, part_of("v", "-", 0)) == ["US", "US", "US", "", "US", None]


@pytest.mark.parametrize("separator", [".", "|", "#", "a", "+", "\\", "[", "^", "$", "::"])
def test_separator_is_literal(spark, separator):
    assert apply(spark, [f"x{separator}y{separator}z"], part_of("v", separator, 1)) == ["y"]


def test_sas_day_numbers(spark):
    values = ["20573.0", "20573", "20573.9", "0", "x", "", "1e300", "NaN", None]
    day = date(2016, 4, 29)
    assert apply(spark, values, sas_date("v")) == [day, day, day, date(1960, 1, 1), None, None, None, None, None]
    assert apply(spark, [20545.0, None], sas_date("v"), "double") == [date(2016, 4, 1), None]


@settings(max_examples=15, deadline=None)
@given(st.lists(st.text(alphabet=" \t\r\n\x0b\x0c\x1c\x1f\x85\xa0 　ab'=,;", max_size=8), min_size=1, max_size=30))
def test_text_functions_agree_with_python(spark, values):
    assert apply(spark, values, strip("v")) == [v.strip() for v in values]
    assert apply(spark, values, unquote("v")) == [v[1:-1] for v in values]
    assert apply(spark, values, without_chars("v", "',)")) == [
        v.replace("'", "").replace(",", "").replace(")", "") for v in values
    ]
    assert apply(spark, values, lower_key("v")) == [v.lower() for v in values]


def test_calendar_parts(spark):
    frame = spark.createDataFrame([(datetime(2016, 1, 3, 14, 5),)], "ts timestamp_ntz")
    row = frame.select(*[c.alias(n) for n, c in calendar_parts("ts").items()]).first()
    assert row.asDict() == {"day": 3, "hour": 14, "week": 53, "hour_stamp": "2016-01-03 14"}


def test_day_difference(spark):
    frame = spark.createDataFrame([(date(2013, 9, 30), date(1989, 2, 7))], "a date, b date")
    assert frame.select(day_difference("a", "b")).first()[0] == 9001


def test_exact_average(spark):
    frame = spark.createDataFrame([(0.1,), (0.2,), (0.3,), (None,)], "v double")
    row = frame.select(exact_avg("v", 1), exact_avg("v"), exact_avg(F.lit(None).cast("double"), 1)).first()
    assert row[0] == 0.6 / 3 and abs(row[1] - 0.2) < 1e-12 and row[2] is None


def test_settings_grow_with_the_data():
    from harborlake.settings import settings_for

    def partitions(size, cores):
        return int(settings_for(size, cores)["spark.sql.shuffle.partitions"])

    assert partitions(1, 8) == 8
    assert partitions(100 * 2**30, 8) == 800
    assert partitions(10**12, 8000) == 8000
    assert partitions(10**14, 8000) == 40_000
    assert settings_for(10**9, 8)["spark.sql.files.maxPartitionBytes"] == "128MB"
    assert settings_for(10**14, 8000)["spark.sql.files.maxPartitionBytes"] == "1024MB"
