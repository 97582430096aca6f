"""The five tables on small sources with known results."""

from datetime import date

import pytest

from conftest import plan, rows
from harborlake import schemas
from harborlake.plans import (
    Extract,
    Locations,
    QualityError,
    build_airports,
    build_arrivals,
    build_city_demographics,
    build_land_temperatures,
    build_ports,
    read_ports,
    register_views,
    run_pipeline,
    unmatched_report,
    write_checked,
)
from harborlake.sinks import overwrite_partitions, write_delimited
from harborlake.sources import read_delimited, read_table, read_texts
from sources import AIRPORTS, ARRIVALS, DEMOGRAPHICS, LABELS, TEMPERATURES, write

AS_OF = date(2013, 9, 30)
PORTS = [
    ("NYC", "NEW YORK, NY", "new york", "NY"),
    ("POM", "PORTLAND, ME", "portland", "ME"),
    ("POO", "PORTLAND, OR", "portland", "OR"),
    ("WAS", "WASHINGTON DC", "washington dc", None),
    ("XXX", "NOT REPORTED/UNKNOWN", "not reported/unknown", None),
]


def texts(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value string")


@pytest.fixture(scope="module")
def ports(spark):
    return build_ports(texts(spark, LABELS)).persist()


@pytest.fixture(scope="module")
def landing(tmp_path_factory):
    root = tmp_path_factory.mktemp("landing")
    write(root / "labels" / "labels.SAS", LABELS)
    write(root / "airport" / "airports.csv", AIRPORTS)
    write(root / "city_demo" / "demographics.csv", DEMOGRAPHICS)
    header, *lines = ARRIVALS.splitlines(keepends=True)
    write(root / "imm" / "april.csv", header + "".join(lines[:4]))
    write(root / "imm" / "rest.csv", header + "".join(lines[4:]))
    write(root / "land_temp" / "temperatures.csv", TEMPERATURES)
    return root


@pytest.fixture(scope="module")
def demographics(spark, landing):
    return read_delimited(spark, str(landing / "city_demo"), sep=";", types=schemas.DEMOGRAPHICS_TYPES)


@pytest.fixture(scope="module")
def temperatures(spark, landing):
    return read_delimited(spark, str(landing / "land_temp"), types=schemas.TEMPERATURE_TYPES)


def test_ports(spark, landing):
    assert rows(build_ports(read_texts(spark, str(landing / "labels")))) == PORTS


def test_ports_survive_the_csv_roundtrip(spark, ports, tmp_path):
    write_delimited(ports.repartition(4), str(tmp_path / "ports"))
    assert rows(read_ports(spark, str(tmp_path / "ports"))) == PORTS


def test_port_label_cases(spark):
    text = (
        "I94PORT codes\r\n 'BOS' = 'BOSTON, MA, X' \r\n 'A=B' = 'EQUALS, EQ'\n'EMP' = ''\n no pair here\n"
        " 'ONE' = 'X' Y'\n;\n 'OUT' = 'OUTSIDE, NO'\nI94PORT second block\n 'SEC' = 'SECOND, NO'\n;"
    )
    assert rows(build_ports(texts(spark, text, "no block", "I94PORT without an end\n'A' = 'B'"))) == [
        ("A=B", "EQUALS, EQ", "equals", "EQ"),
        ("BOS", "BOSTON, MA, X", "boston", "MA, X"),
        ("EMP", None, None, None),
        ("ONE", "X' Y", "x' y", None),
    ]


def test_demographics(demographics, ports):
    found = build_city_demographics(demographics, ports)
    assert found.columns == list(schemas.DEMOGRAPHICS)
    assert dict(found.dtypes) == schemas.DEMOGRAPHICS
    oregon = ("portland", 36.7, 313516, 318671, 632187, 29940, 86041, 2.43, "OR", 0, 58000, 0, 0, 528140)
    maine = ("portland", 38.0, 32000, 34875, 66875, 0, 9000, 2.1, "ME", 0, 0, 0, 0, 56000)
    york = ("new york", 36.0, 4081698, 4468707, 8550405, 156961, 3212500, 2.68, "NY", 0, 0, 2192248, 2485125, 0)
    expected = [("NYC", *york), ("POM", *maine), ("POM", *oregon), ("POO", *maine), ("POO", *oregon)]
    assert sorted(map(tuple, found.collect()), key=str) == sorted(expected, key=str)


def test_untyped_sources_give_the_same_tables(spark, landing, demographics, temperatures, ports):
    text = read_delimited(spark, str(landing / "city_demo"), sep=";")
    assert rows(build_city_demographics(text, ports)) == rows(build_city_demographics(demographics, ports))
    text = read_delimited(spark, str(landing / "land_temp"))
    found, typed = (build_land_temperatures(t, ports, as_of=AS_OF) for t in (text, temperatures))
    assert found.dtypes == typed.dtypes and rows(found) == rows(typed)


def test_demographics_of_the_same_state(demographics, ports):
    found = build_city_demographics(demographics, ports, match_state=True)
    assert rows(found.select("port_id", "state_code")) == [("NYC", "NY"), ("POM", "ME"), ("POO", "OR")]


def test_demographics_equal_after_zero_fill_are_one_row(spark, ports):
    columns = ", ".join(
        f"`{c}` {schemas.DEMOGRAPHICS_TYPES.get(c, 'string')}" for c in [*schemas.DEMOGRAPHICS_KEYS, "Race", "Count"]
    )
    one = ["New York", "New York", 36.0, 1, 2, 3, None, 5, 2.5, "NY", "White", 9]
    two = [*one[:6], 0, *one[7:]]
    found = build_city_demographics(spark.createDataFrame([one, two], columns), ports)
    assert found.count() == 1


def test_airports(spark, landing):
    raw = read_delimited(spark, str(landing / "airport"))
    found = build_airports(raw)
    assert dict(found.dtypes) == schemas.AIRPORTS
    total = ("00A", "heliport", "US-PA", "PA")
    others = [
        ("00B", "small_airport", "US-U-A", "U"),
        ("00C", "closed", "US", None),
        ("00D", "small_airport", None, None),
    ]
    assert rows(found) == [total, total, *others]
    assert rows(build_airports(raw, dedupe_on=["ident"])) == [total, *others]


def test_arrivals(spark, landing, ports, tmp_path):
    raw = read_delimited(spark, str(landing / "imm"))
    found = build_arrivals(raw, ports)
    assert dict(found.dtypes) == schemas.ARRIVALS
    overwrite_partitions(found, str(tmp_path / "imm"), ["year"])
    stored = read_table(spark, str(tmp_path / "imm"))
    assert stored.columns == list(schemas.ARRIVALS)
    assert rows(stored) == [
        ("11.0", date(2015, 12, 31), "XXX", "not reported/unknown", None, 12, 2015),
        ("6.0", date(2016, 4, 29), "NYC", "new york", "NY", 4, 2016),
        ("7.0", date(2016, 4, 1), "POO", "portland", "OR", 4, 2016),
        ("9.0", None, "POM", "portland", "ME", None, None),
    ]
    assert {p.name for p in (tmp_path / "imm").iterdir() if p.is_dir()} == {
        "year=2015",
        "year=2016",
        "year=__HIVE_DEFAULT_PARTITION__",
    }
    assert rows(unmatched_report(raw, ports, "i94port", "port_id")) == [(2, 2, 1)]


def test_arrivals_by_key_read_needed_columns_only(spark, landing, ports, tmp_path):
    raw = read_delimited(spark, str(landing / "imm"))
    raw.write.parquet(str(tmp_path / "raw"))
    by_key = build_arrivals(read_table(spark, str(tmp_path / "raw")), ports, dedupe_on=["cicid"])
    assert rows(by_key.select("cicid")) == [("11.0",), ("6.0",), ("7.0",), ("9.0",)]
    scan = by_key._jdf.queryExecution().executedPlan().toString()
    assert "i94mon" not in scan and "i94yr" not in scan


def test_land_temperatures(spark, temperatures, ports):
    found = build_land_temperatures(temperatures, ports, as_of=AS_OF)
    assert dict(found.dtypes) == schemas.TEMPERATURES
    hot = date(2013, 9, 1)
    assert rows(found.select("dt", "AverageTemperature", "city_lower", "port_id")) == [
        (date(1989, 2, 9), 3.0, "new york", "NYC"),
        (hot, None, "new york", "NYC"),
        (hot, 15.5, "portland", "POM"),
        (hot, 15.5, "portland", "POM"),
        (hot, 15.5, "portland", "POO"),
        (hot, 15.5, "portland", "POO"),
        (date(2013, 10, 5), 5.5, "new york", "NYC"),
    ]


def test_land_temperatures_of_one_country(spark, temperatures):
    ports = spark.createDataFrame([("WAS", "washington")], "port_id string, city string")
    assert build_land_temperatures(temperatures, ports, as_of=AS_OF).count() == 1
    assert build_land_temperatures(temperatures, ports, as_of=AS_OF, country="United States").count() == 0


def test_whole_run(spark, landing, tmp_path):
    where = Locations(landing=str(landing), tables=str(tmp_path / "tables"))
    results = {r.table: r for r in run_pipeline(spark, where, as_of=AS_OF)}
    assert {n: (r.rows, r.error) for n, r in results.items()} == {
        "airport": (5, None),
        "city_demo": (5, None),
        "imm": (4, None),
        "land_temp": (7, None),
    }
    stored = read_table(spark, where.table("land_temp"))
    assert dict(stored.dtypes) == schemas.TEMPERATURES
    assert dict(read_table(spark, where.table("city_demo")).dtypes) == schemas.DEMOGRAPHICS
    register_views(spark, where)
    found = spark.sql("""
        select i.port_city, max(d.total_pop) total_pop, count(distinct t.dt) days
        from imm i join city_demo d on i.i94port = d.port_id join land_temp t on i.i94port = t.port_id
        join ports p on p.port_id = i.i94port
        where i.year = 2016 group by i.port_city""")
    assert rows(found) == [("new york", 8550405, 3), ("portland", 632187, 1)]
    assert spark.table("airport").count() == 5


def test_extracts_are_landed_before_the_builds(spark, landing, tmp_path):
    where = Locations(landing=str(tmp_path / "landing"), tables=str(tmp_path / "tables"))
    csv = {"header": "true"}
    extracts = {
        "airport": Extract(str(landing / "airport"), "csv", options=csv),
        "city_demo": Extract(str(landing / "city_demo"), "csv", suffix=".csv", options={**csv, "sep": ";"}),
        "imm": Extract(str(landing / "imm"), "csv", options=csv),
        "land_temp": Extract(str(tmp_path / "nowhere"), "csv", options=csv),
    }
    labels = read_texts(spark, str(landing / "labels"))
    results = run_pipeline(spark, where, as_of=AS_OF, extracts=extracts, sources={"labels": labels})
    assert [(r.table, r.rows) for r in results] == [("airport", 5), ("city_demo", 5), ("imm", 4), ("land_temp", None)]
    assert "nowhere" in results[-1].error


def test_a_failing_table_does_not_stop_the_others(spark, landing, tmp_path):
    where = Locations(landing=str(landing), tables=str(tmp_path / "tables"))
    broken = spark.createDataFrame([(1,)], "other int")
    results = {r.table: r for r in run_pipeline(spark, where, as_of=AS_OF, sources={"airport": broken})}
    assert "iso_region" in results["airport"].error or "ident" in results["airport"].error
    assert [results[n].error for n in ("city_demo", "imm", "land_temp")] == [None] * 3


def test_an_empty_table_is_a_failure(spark, landing, tmp_path):
    where = Locations(landing=str(landing), tables=str(tmp_path / "tables"))
    nothing = read_delimited(spark, str(landing / "airport")).where("1 = 0")
    results = {r.table: r for r in run_pipeline(spark, where, as_of=AS_OF, sources={"airport": nothing})}
    assert "no rows" in results["airport"].error


def test_command_line(spark, landing, tmp_path, capsys):
    from harborlake.__main__ import main

    assert main([str(landing), str(tmp_path / "tables"), "--as-of", "2013-09-30"]) == 0
    assert "imm: 4 rows" in capsys.readouterr().out
    assert main([str(landing), str(tmp_path / "tables"), "--as-of", "2030-01-01", "--concurrency", "1"]) == 0
    assert main([str(landing), str(tmp_path / "tables"), "--as-of", "2050-01-01"]) == 1
    assert "land_temp: QualityError" in capsys.readouterr().out


def test_large_reference_table_gives_the_same_rows(landing, ports, spark, temperatures, conf):
    raw = read_delimited(spark, str(landing / "imm"))
    small = rows(build_arrivals(raw, ports)), rows(build_land_temperatures(temperatures, ports, as_of=AS_OF))
    assert "LeftSemi" in plan(build_land_temperatures(temperatures, ports, as_of=AS_OF))
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    for build in (build_arrivals(raw, ports), build_land_temperatures(temperatures, ports, as_of=AS_OF)):
        found = plan(build)  # the outermost operator comes first
        assert "SortMergeJoin" in found and found.index("HashAggregate") < found.index("LeftSemi")
    large = rows(build_arrivals(raw, ports)), rows(build_land_temperatures(temperatures, ports, as_of=AS_OF))
    assert large == small


@pytest.mark.parametrize("partition_by", [(), ("year",)])
def test_a_failed_check_keeps_the_old_table(spark, tmp_path, partition_by):
    good = spark.createDataFrame([(1, 2015), (2, 2016)], "id int, year int")
    path = str(tmp_path / "t")
    assert write_checked(good, path, partition_by).stored == 2
    with pytest.raises(QualityError):
        write_checked(good.where("id > 9"), path, partition_by)
    assert rows(spark.read.parquet(path)) == [(1, 2015), (2, 2016)]
    assert write_checked(good.where("id > 1"), path, partition_by).stored == 1
    assert rows(spark.read.parquet(path)) == [(2, 2016)]
    assert [p.name for p in tmp_path.iterdir()] == ["t"]
