"""Builds that count what becomes of their rows."""

from datetime import date

from conftest import rows
from harborlake.plans import build_airports, build_arrivals, build_land_temperatures
from harborlake.plans.measured import distinct_counted, measured_airports, measured_arrivals, measured_temperatures
from test_lost_tasks import arrivals, lossy, ports

AS_OF = date(2013, 10, 31)


def counts(measured):
    return tuple(measured.counts.select("rows", "copies", "unmatched", "distinct_rows").first())


def test_arrivals_are_counted_right_when_tasks_run_twice(spark):
    raw, known = arrivals(spark), ports(spark)
    found = measured_arrivals(lossy(raw), known)
    assert rows(found.table) == rows(build_arrivals(raw, known))
    distinct = raw.distinct().join(known, raw.i94port == known.port_id, "left_semi").count()
    matched = raw.join(known, raw.i94port == known.port_id, "left_semi").count()
    assert counts(found) == (3000, matched - distinct, 3000 - matched, distinct)


def test_other_tables(spark):
    data = [("a", "x", "US-PA", 1), ("a", "x", "US-PA", 1), ("a", "x", "US-PA", 2), (None, None, None, None)]
    airports = spark.createDataFrame(data, "ident string, type string, iso_region string, other int")
    found = measured_airports(airports)
    assert rows(found.table) == rows(build_airports(airports)) and counts(found) == (4, 1, 0, 3)
    measurements = [("2013-10-01", 1.0, "C1"), ("2013-10-01", 1.0, "C1"), ("2013-10-01", None, "c1"), ("2013-10-02", 2.0, "nowhere"), ("2013-10-02", 3.0, None), ("1950-01-01", 4.0, "C1")]
    temperatures = spark.createDataFrame(measurements, "dt string, AverageTemperature double, City string")
    found = measured_temperatures(temperatures, ports(spark), as_of=AS_OF)
    assert rows(found.table) == rows(build_land_temperatures(temperatures, ports(spark), as_of=AS_OF))
    assert counts(found) == (5, 1, 2, 2)


def test_nothing(spark):
    found = measured_arrivals(arrivals(spark).where("1 = 0"), ports(spark))
    assert found.table.collect() == [] and counts(found) == (0, 0, 0, 0)


def test_the_source_is_read_once(spark, tmp_path, monkeypatch):
    arrivals(spark).write.parquet(str(tmp_path / "raw"))
    raw, seen = spark.read.parquet(str(tmp_path / "raw")), []
    from harborlake.plans import measured

    monkeypatch.setattr(measured, "scratch_path", lambda s, n: seen.append(n) or str(tmp_path / f"counted{len(seen)}"))
    found = measured_arrivals(raw, ports(spark))
    assert len(seen) == 1  # the only job that reads the source; table and counts read what it wrote
    for df in (found.table, found.counts):
        assert df.inputFiles() and all("/counted1/" in f for f in df.inputFiles())
    assert distinct_counted(raw, ["cicid"]).columns == ["cicid", "__known", "__copies"]
