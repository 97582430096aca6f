import json
from datetime import date
from types import SimpleNamespace

import pytest
from pyspark.sql import Observation, functions as F

from conftest import plan, rows
from harborlake.plans import Extract, QualityError, duplicate_report, land_extracts, row_counts, write_checked
from harborlake.sinks import (
    balanced,
    land,
    overwrite_partitions,
    overwrite_table,
    preview,
    save_table,
    scratch_path,
    write_delimited,
)
from harborlake.sinks.paths import CHECKPOINT_DIR
from harborlake.sources import read_any, read_delimited, read_table, read_texts
from sources import write


def jobs_of(spark, action):
    """Number of Spark jobs an action starts."""
    group = f"count-{id(action)}"
    spark.sparkContext.setJobGroup(group, group)
    try:
        result = action()
        return result, len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


# --- scans -------------------------------------------------------------------------


def test_header_only_scan_gives_text(spark, tmp_path):
    path = write(tmp_path / "a.csv", "x,y\n1,\n02,b\n")
    found = read_delimited(spark, path)
    assert found.dtypes == [("x", "string"), ("y", "string")]
    assert rows(found) == [("02", "b"), ("1", None)]


def test_inferred_scan(spark, tmp_path):
    path = write(tmp_path / "a.csv", "i;d;day;s\n1;1.5;2013-09-01;a\n2;;2013-09-02;b\n")
    found = read_delimited(spark, path, sep=";", infer=True)
    assert [t for _, t in found.dtypes] == ["int", "double", "date", "string"]


def test_declared_scan_starts_no_job(spark, tmp_path):
    path = write(tmp_path / "a.csv", "x,y\n1,a\n")
    found, jobs = jobs_of(spark, lambda: read_delimited(spark, path, schema="x int, y string"))
    assert jobs == 0 and rows(found) == [(1, "a")]


def test_types_by_name_keep_undeclared_columns(spark, tmp_path):
    path = write(tmp_path / "a.csv", "extra,Median Age,dt\nq,36.7,2013-09-01\nr,old,never\n")
    found = read_delimited(spark, path, types={"Median Age": "double", "dt": "date"})
    assert rows(found) == [("q", 36.7, date(2013, 9, 1)), ("r", None, None)]


def test_columns_in_another_order_are_an_error_not_shifted_data(spark, tmp_path):
    path = write(tmp_path / "a.csv", "y,x\na,b\n")
    with pytest.raises(Exception, match="(?i)header|schema"):
        read_delimited(spark, path, schema="x string, y string").collect()


def test_many_files_by_glob_folder_and_suffix(spark, tmp_path):
    write(tmp_path / "in" / "a.csv", "x\n1\n")
    write(tmp_path / "in" / "b.csv", "x\n2\n")
    write(tmp_path / "in" / "deep" / "er" / "c.csv", "x\n3\n")
    write(tmp_path / "in" / "deep" / "d.txt", "x\n4\n")
    folder = str(tmp_path / "in")
    assert rows(read_delimited(spark, f"{folder}/*.csv")) == [("1",), ("2",)]
    assert rows(read_delimited(spark, [f"{folder}/a.csv", f"{folder}/b.csv"])) == [("1",), ("2",)]
    assert rows(read_delimited(spark, folder, suffix=".csv", recursive=True)) == [("1",), ("2",), ("3",)]
    traced = read_delimited(spark, folder, suffix=".csv", recursive=True, file_column="file")
    assert {r.x: r.file.rsplit("/", 1)[1] for r in traced.collect()} == {"1": "a.csv", "2": "b.csv", "3": "c.csv"}


def test_whole_texts_and_lines(spark, tmp_path):
    write(tmp_path / "t" / "a.SAS", "one\ntwo;\n")
    write(tmp_path / "t" / "b.SAS", "three")
    assert rows(read_texts(spark, str(tmp_path / "t"))) == [("one\ntwo;\n",), ("three",)]
    assert rows(read_texts(spark, str(tmp_path / "t"), whole=False)) == [("one",), ("three",), ("two;",)]


@pytest.mark.parametrize("fmt", ["csv", "json", "orc", "parquet"])
def test_any_format(spark, tmp_path, fmt):
    frame = spark.createDataFrame([(1, "a"), (2, None)], "x int, y string")
    land(frame, str(tmp_path / "t"), fmt)
    found = read_any(spark, fmt, str(tmp_path / "t"), schema="x int, y string")
    assert rows(found) == [(1, "a"), (2, None)]


# --- writers -----------------------------------------------------------------------


def test_delimited_text_is_trimmed_and_empty_text_becomes_null(spark, tmp_path):
    frame = spark.createDataFrame([("not reported   ", ""), ("a", "b, c")], "x string, y string")
    write_delimited(frame, str(tmp_path / "t"))
    assert rows(read_delimited(spark, str(tmp_path / "t"))) == [("a", "b, c"), ("not reported", None)]


def test_only_present_partitions_are_replaced(spark, tmp_path):
    path = str(tmp_path / "t")
    frame = spark.range(12).selectExpr("id", "cast(2010 + id % 3 as int) year")
    overwrite_partitions(frame, path, ["year"])
    overwrite_partitions(frame.where("id = 1"), path, ["year"], only_present=True)
    found = read_table(spark, path)
    assert rows(found.groupBy("year").count()) == [(2010, 4), (2011, 1), (2012, 4)]
    overwrite_partitions(frame.where("id = 1"), path, ["year"])
    assert read_table(spark, path).count() == 1
    assert "PartitionFilters: [isnotnull(year" in plan(read_table(spark, path).where("year = 2011"))


def test_few_files_per_partition(spark, tmp_path):
    frame = spark.range(0, 3000, 1, 6).selectExpr("id", "date_add(date'2020-01-01', cast(id % 30 as int)) dt")
    overwrite_partitions(frame, str(tmp_path / "t"), ["dt"])
    assert len(list((tmp_path / "t").glob("dt=*/*.parquet"))) == 30


def test_a_hot_partition_is_written_by_several_tasks(spark, tmp_path, conf):
    """A third of the rows are of one year: they must not all go through one task."""
    conf("spark.sql.adaptive.advisoryPartitionSizeInBytes", "256KB")
    frame = spark.range(0, 90000, 1, 8).select(
        F.sha2(F.col("id").cast("string"), 256).alias("text"),
        F.when(F.col("id") % 3 == 0, 2016).otherwise((F.col("id") % 60).cast("int") + 1950).alias("year"),
    )
    sent = Observation()
    overwrite_partitions(frame, str(tmp_path / "t"), ["year"], sent=sent)
    files = list((tmp_path / "t" / "year=2016").glob("*.parquet"))
    assert len(files) > 3
    assert sent.get["rows"] == 90000 == read_table(spark, str(tmp_path / "t")).count()


def test_balanced_is_a_hash_shuffle(spark):
    text = plan(balanced(spark.range(10).selectExpr("id", "id % 2 k"), ["k"]))
    assert "REBALANCE_PARTITIONS_BY_COL" in text and "hashpartitioning" in text


def test_saved_table(spark, tmp_path):
    frame = spark.createDataFrame([(1, 2016), (2, 2015)], "id int, year int")
    for _ in range(2):
        save_table(frame, "saved_arrivals", path=str(tmp_path / "t"), partition_by=["year"])
        assert rows(spark.sql("select id from saved_arrivals where year = 2016")) == [(1,)]
    spark.sql("drop table saved_arrivals")


def test_preview(spark):
    assert preview(spark.range(10)).count() == 1


def test_scratch_is_below_the_shared_folder(spark):
    base = spark.conf.get(CHECKPOINT_DIR)
    one, two = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert one.startswith(f"{base}/harborlake-{spark.sparkContext.applicationId}/x-") and one != two
    assert scratch_path(spark, "x", keep=True).startswith(f"{base}/x-")


def test_no_machine_local_scratch_on_a_cluster():
    session = SimpleNamespace(
        conf=SimpleNamespace(get=lambda name, default: default), sparkContext=SimpleNamespace(master="yarn", getCheckpointDir=lambda: None)
    )
    with pytest.raises(ValueError, match="all executors share"):
        scratch_path(session, "x")


# --- landing and checks ------------------------------------------------------------


def test_all_extracts_are_landed(spark, tmp_path):
    for month in ("apr", "may"):
        for name in ("same.json", "other.json"):
            write(tmp_path / "in" / month / name, json.dumps({"cicid": f"{month}-{name}"}) + "\n")
    write(tmp_path / "in" / "notes.txt", "not an extract")
    extract = Extract(str(tmp_path / "in"), "json", suffix=".json", schema="cicid string")
    for fmt in ("csv", "parquet"):
        first = land_extracts(spark, extract, str(tmp_path / fmt), fmt=fmt)
        assert first.count() == 1
    assert read_delimited(spark, str(tmp_path / "csv")).count() == 4
    assert read_table(spark, str(tmp_path / "parquet")).count() == 4


def test_checked_write(spark, tmp_path):
    frame = spark.range(100).selectExpr("id", "id % 4 year")
    assert write_checked(frame, str(tmp_path / "flat")).stored == 100
    assert write_checked(frame, str(tmp_path / "parts"), ["year"]).sent == 100
    with pytest.raises(QualityError, match="no rows"):
        write_checked(frame.where("id < 0"), str(tmp_path / "none"))
    with pytest.raises(QualityError, match="no rows"):
        write_checked(frame.where("id < 0"), str(tmp_path / "none"), ["year"])
    assert write_checked(frame.where("id < 0"), str(tmp_path / "none"), ["year"], allow_empty=True).stored == 0


def test_checked_write_notices_lost_rows(spark, tmp_path, monkeypatch):
    from harborlake.plans import quality

    monkeypatch.setattr(quality, "read_table", lambda s, p, schema: s.read.schema(schema).parquet(p).limit(7))
    with pytest.raises(QualityError, match="10 rows sent, 7 stored"):
        write_checked(spark.range(10), str(tmp_path / "t"))


def test_reports(spark):
    frame = spark.createDataFrame([(1, None), (1, None), (1, "a")], "x int, `y z` string")
    assert rows(duplicate_report(frame)) == [(3, 2, 1)]
    assert rows(duplicate_report(frame.where("x > 1"))) == [(0, 0, 0)]
    assert rows(row_counts({"a": frame, "b": frame.limit(1)})) == [("a", 3), ("b", 1)]


def test_counting_needs_no_columns(spark, tmp_path):
    overwrite_table(spark.range(10).selectExpr("id", "id x"), str(tmp_path / "t"))
    assert "ReadSchema: struct<>" in plan(row_counts({"t": read_table(spark, str(tmp_path / "t"))}))
