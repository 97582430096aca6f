import shutil

import pytest
from pyspark.sql import Row

from conftest import plan, rows
from harborlake.plans import build_arrivals, build_ports
from harborlake.sources import read_delimited, read_table
from harborlake.streaming import incremental, ingest_arrivals, ingest_new_files, upsert_partitions
from harborlake.streaming.appending import in_partitions
from sources import ARRIVALS, LABELS, write

SCHEMA = "cicid string, i94yr string, i94mon string, i94port string, arrdate string"
HEADER, *LINES = ARRIVALS.splitlines(keepends=True)


def part(*indexes):
    return HEADER + "".join(LINES[i] for i in indexes)


@pytest.fixture(scope="module")
def ports(spark):
    return build_ports(spark.createDataFrame([(LABELS,)], "value string")).persist()


def test_each_file_is_appended_once(spark, tmp_path):
    source, target, checkpoint = (str(tmp_path / n) for n in ("in", "out", "checkpoint"))

    def ingest():
        ingest_new_files(spark, source, "x int, y string", target, checkpoint, files_per_batch=1)

    write(tmp_path / "in" / "a.csv", "x,y\n1,a\n1,a\n")
    write(tmp_path / "in" / "b.csv", "x,y\n2,\n")
    ingest()
    assert rows(read_table(spark, target)) == [(1, "a"), (1, "a"), (2, None)]
    write(tmp_path / "in" / "c.csv", "x,y\n3,c\n")
    ingest()
    ingest()
    assert rows(read_table(spark, target)) == [(1, "a"), (1, "a"), (2, None), (3, "c")]


def frame(spark, *data):
    return spark.createDataFrame(data, "id int, text string, year int")


def test_upsert_adds_missing_rows_only(spark, tmp_path):
    target = str(tmp_path / "t")
    upsert_partitions(frame(spark, (1, "a", 2015), (1, "a", 2015), (2, "b", 2016), (3, None, None)), target, ["year"])
    untouched = {p.name for p in (tmp_path / "t" / "year=2015").glob("*.parquet")}
    new = frame(spark, (2, "b", 2016), (4, "d", 2016), (3, None, None), (5, "e", 2017))
    for _ in range(2):
        touched = upsert_partitions(new, target, ["year"])
        assert {r.year for r in touched} == {2016, 2017, None}
        assert rows(read_table(spark, target)) == [
            (1, "a", 2015),
            (2, "b", 2016),
            (3, None, None),
            (4, "d", 2016),
            (5, "e", 2017),
        ]
    assert {p.name for p in (tmp_path / "t" / "year=2015").glob("*.parquet")} == untouched


def test_upsert_of_nothing_changes_nothing(spark, tmp_path):
    target = str(tmp_path / "t")
    upsert_partitions(frame(spark, (1, "a", 2015)), target, ["year"])
    assert upsert_partitions(frame(spark, (2, "b", 2016)).where("1 = 0"), target, ["year"]) == []
    assert rows(read_table(spark, target)) == [(1, "a", 2015)]


def test_upsert_by_key_and_two_partition_columns(spark, tmp_path):
    target = str(tmp_path / "t")
    upsert_partitions(frame(spark, (1, "m", 2015), (2, "m", 2015)), target, ["year", "text"], on=["id", "year"])
    upsert_partitions(frame(spark, (1, "m", 2015), (3, "007", 2015)), target, ["year", "text"], on=["id", "year"])
    stored = spark.read.schema("id int, year int, text string").parquet(target)
    assert rows(stored) == [(1, 2015, "m"), (2, 2015, "m"), (3, 2015, "007")]


def test_upsert_lists_partitions_however_many(spark, tmp_path):
    target = str(tmp_path / "t")
    data = [(i, "x", 2000 + i) for i in range(60)] + [(9, None, None)]
    upsert_partitions(frame(spark, *data), target, ["year"])
    assert len(upsert_partitions(frame(spark, *data, (100, "new", 2001)), target, ["year"])) == 61
    assert read_table(spark, target).count() == 62


def test_slice_prunes_partitions(spark, tmp_path):
    target = str(tmp_path / "t")
    upsert_partitions(frame(spark, (1, "a", 2015), (2, "b", 2016)), target, ["year"])
    found = incremental._slice(spark, target, frame(spark, (7, "z", 2016)), ["year"])
    assert "PartitionFilters: [isnotnull(year" in plan(found) or "PartitionFilters: [(year" in plan(found)
    assert rows(found) == [(2, "b", 2016)]


def test_filter_on_many_partitions(spark):
    values = [Row(y=y, m=m) for y in (None, *range(1900, 1980)) for m in (None, *range(1, 12))]
    data = spark.createDataFrame([(1950, 3), (1950, 12), (1985, 3), (None, None), (None, 12)], "y int, m int")
    assert rows(data.where(in_partitions(values, ["y", "m"]))) == [(None, None), (1950, 3)]
    assert data.where(in_partitions([], ["y", "m"])).count() == 0


def test_upsert_goes_on_after_a_cut(spark, tmp_path, monkeypatch):
    """The run dies while it replaces partitions; the same call restores what the table lost."""
    target, stage = str(tmp_path / "t"), str(tmp_path / "stage")
    upsert_partitions(frame(spark, (1, "a", 2015), (2, "b", 2016)), target, ["year"])
    new = frame(spark, (3, "c", 2016))

    def cut(*args, **options):
        shutil.rmtree(tmp_path / "t" / "year=2016")
        raise RuntimeError("executor and driver lost")

    with monkeypatch.context() as patched:
        patched.setattr(incremental, "overwrite_partitions", cut)
        with pytest.raises(RuntimeError):
            upsert_partitions(new, target, ["year"], stage=stage)
    upsert_partitions(new, target, ["year"], stage=stage)
    assert rows(read_table(spark, target)) == [(1, "a", 2015), (2, "b", 2016), (3, "c", 2016)]
    assert not (tmp_path / "stage").exists()


@pytest.mark.parametrize("partition_by", [["year"], ["year", "month"]])
def test_incremental_arrivals_equal_a_full_build(spark, tmp_path, ports, partition_by):
    paths = {n: str(tmp_path / n) for n in ("raw", "imm", "checkpoint")}

    def ingest():
        ingest_arrivals(
            spark,
            str(tmp_path / "in"),
            SCHEMA,
            paths["raw"],
            paths["imm"],
            ports,
            paths["checkpoint"],
            partition_by=partition_by,
        )

    def compare():
        full = build_arrivals(read_delimited(spark, str(tmp_path / "in")), ports)
        assert rows(read_table(spark, paths["imm"]).select(*full.columns)) == rows(full)

    write(tmp_path / "in" / "a.csv", part(0, 2, 4, 6))
    ingest()
    compare()
    # The same arrival again, an earlier year, an unknown port, no date.
    write(tmp_path / "in" / "b.csv", part(1, 3, 5, 4) + "12.0,2015.0,12.0,NYC,20453.0\n")
    write(tmp_path / "in" / "c.csv", part(0))
    ingest()
    compare()
    # A file without rows.
    write(tmp_path / "in" / "d.csv", HEADER)
    ingest()
    compare()
    # A batch that was done but not recorded as done is repeated.
    last = max(int(p.name) for p in (tmp_path / "checkpoint" / "commits").iterdir() if p.name.isdigit())
    (tmp_path / "checkpoint" / "commits" / str(last)).unlink()
    (tmp_path / "checkpoint" / "commits" / f".{last}.crc").unlink(missing_ok=True)
    ingest()
    compare()
