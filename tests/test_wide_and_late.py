"""Bounded streams, digest-first de-duplication, row positions, byte-exact landing, strict types, checked ports, wide pivots."""

import hashlib
import shutil
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from conftest import plan, rows
from harborlake import streaming, versions
from harborlake.operators import dedupe, dedupe_by_digest, numbered, pivot_max_map, side_by_side
from harborlake.operators.pivot import cell
from harborlake.plans import Extract, Locations, QualityError, build_ports, check_ports, land_extracts, port_conflicts, run_pipeline
from harborlake.sinks.landing import land_files, landed_files, landed_texts, manifest
from harborlake.sources import read_table, type_misfits, with_types
from sources import AIRPORTS, ARRIVALS, DEMOGRAPHICS, LABELS, TEMPERATURES, write
from test_lost_tasks import lossy


# --- streams -------------------------------------------------------------------------

EVENT = "id long, at timestamp, text string"


def moment(day, hour=0):
    return datetime(2024, 1, day, hour)


def ingest(spark, tmp_path, **options):
    arriving = spark.readStream.schema(EVENT).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).parquet(str(tmp_path / "in"))
    return streaming.ingest_distinct(
        arriving, str(tmp_path / "out"), str(tmp_path / "checkpoint"), keys=["id"], event_time="at", delay="2 days", **options
    )


def arrive(spark, tmp_path, name, *data):
    spark.createDataFrame(data, EVENT).coalesce(1).write.parquet(str(tmp_path / "in" / name))


def stored(spark, tmp_path):
    kept, late = (f(spark, str(tmp_path / "out")) for f in (streaming.on_time, streaming.late_rows))
    return [(r.id, r.text) for r in kept.orderBy("id", "text").collect()], sorted((r.id, r.text) for r in late.collect())


def test_copies_go_and_late_rows_are_kept_aside(spark, tmp_path):
    arrive(spark, tmp_path, "a", (1, moment(1), "a"), (2, moment(9), "a"), (3, moment(10), "a"), (3, moment(10), "a"))
    arrive(spark, tmp_path, "b", (2, moment(9, 1), "copy"), (4, moment(2), "in time still"), (6, moment(20), "b"), (7, None, "no time"))
    arrive(spark, tmp_path, "c", (1, moment(1), "late copy"), (2, moment(9, 2), "copy"), (5, moment(8), "just too late"), (8, moment(8, 1), "c"))
    arrive(spark, tmp_path, "d", (2, moment(25), "again"), (9, moment(17), "late"))
    ingest(spark, tmp_path)
    assert stored(spark, tmp_path) == (
        [(1, "a"), (2, "a"), (2, "again"), (3, "a"), (4, "in time still"), (6, "b"), (8, "c")],
        [(1, "late copy"), (5, "just too late"), (7, "no time"), (9, "late")],
    )
    before = versions.latest(spark, str(tmp_path / "out"))
    ingest(spark, tmp_path)  # nothing new
    assert versions.latest(spark, str(tmp_path / "out")).rows == before.rows


def test_a_repeated_stream_batch_adds_nothing(spark, tmp_path):
    arrive(spark, tmp_path, "a", (1, moment(1), "a"))
    ingest(spark, tmp_path)
    arrive(spark, tmp_path, "b", (1, moment(1), "copy"), (2, moment(2), "b"))
    ingest(spark, tmp_path)
    expected, last = stored(spark, tmp_path), max((p for p in (tmp_path / "checkpoint" / "commits").iterdir() if p.name.isdigit()), key=lambda p: int(p.name))
    last.unlink()
    (last.parent / f".{last.name}.crc").unlink(missing_ok=True)
    ingest(spark, tmp_path)
    assert stored(spark, tmp_path) == expected


def test_state_stays_bounded(spark, tmp_path):
    """Thirty days of a thousand keys each: the state holds those of a few days, at the end as in the middle."""
    sizes = []
    for day in range(1, 31, 3):
        some = spark.range(1000).select((F.col("id") + day * 10_000).alias("id"), F.lit(moment(day)).alias("at"), F.lit("x").alias("text"))
        some.coalesce(1).write.parquet(str(tmp_path / "in" / str(day)))
        query = ingest(spark, tmp_path)
        sizes.append(query.lastProgress["stateOperators"][0]["numRowsTotal"])
    assert max(sizes) <= 2000 and streaming.on_time(spark, str(tmp_path / "out")).count() == 10_000


# --- digests -------------------------------------------------------------------------


def wide(spark, n=4000, copies=50):
    rows = spark.range(0, n, 1, 6).select("id", *[F.sha2(F.concat("id", F.lit(i)), 512).alias(f"c{i}") for i in range(6)], F.when(F.col("id") % 5 > 0, F.col("id") / 3).alias("x"))
    return rows.union(rows.where(F.col("id") < copies)).union(rows.where("id < 2"))


def shuffled_bytes(df):
    """Bytes that all exchanges of the executed plan wrote."""
    df.collect()
    total, todo = 0, [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        kind = node.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
        elif kind.endswith("QueryStageExec"):
            todo.append(node.plan())
        else:
            if kind == "ShuffleExchangeExec":
                total += node.metrics().get("shuffleBytesWritten").get().value()
            children = node.children()
            todo += [children.apply(i) for i in range(children.size())]
    return total


def test_digest_first_gives_the_same_rows(spark, tmp_path):
    wide(spark).write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    expected = rows(dedupe(df))
    assert len(expected) == 4000
    for digest in (None, [F.lit(1).cast("bigint"), F.lit(2).cast("bigint")], [F.col("id") % 7, F.lit(0).cast("bigint")]):
        assert rows(dedupe_by_digest(df, digest=digest)) == expected  # none, one or seven digests for all rows
    assert rows(dedupe_by_digest(df, most_bits=3)) == expected  # a bitmap that is full
    assert rows(dedupe_by_digest(lossy(df))) == expected
    nulls = spark.createDataFrame([(None, None), (None, 1), (1, None), (None, None)], "x int, `y z` int")
    assert rows(dedupe_by_digest(nulls)) == rows(dedupe(nulls))
    assert dedupe_by_digest(nulls.where("x = 9")).collect() == []


def test_digest_first_shuffles_a_third_at_most(spark, tmp_path):
    wide(spark).write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    from harborlake.functions import row_digest

    digests = df.select(*row_digest(df)).groupBy("__a", "__b").count()
    assert 3 * (shuffled_bytes(dedupe_by_digest(df)) + shuffled_bytes(digests)) <= shuffled_bytes(dedupe(df))


# --- positions -----------------------------------------------------------------------


def test_positions_are_dense_and_ordered(spark):
    df = spark.range(0, 5000, 1, 7).select((F.col("id") * 7919 % 5000).alias("k"), F.when(F.col("id") % 3 > 0, F.col("id") % 3).alias("hot"))
    found = numbered(df, "at", ["hot", "k"]).orderBy("at").collect()
    assert [r["at"] for r in found] == list(range(5000))
    keys = [(r.hot is not None, r.hot or 0, r.k) for r in found]
    assert keys == sorted(keys)
    assert rows(numbered(lossy(df), "at", ["hot"])) == rows(numbered(df.repartition(3), "at", ["hot"]))  # ties by the whole row
    assert numbered(df.where("k < 0"), "at", ["k"]).collect() == []


def test_tables_side_by_side(spark):
    left, right = spark.createDataFrame([(3, "c"), (1, "a"), (2, "b")], "n int, x string"), spark.createDataFrame([(9.0,), (8.0,)], "y double")
    assert rows(side_by_side(left, right, ["n"], [F.desc("y")])) == [(1, "a", 9.0), (2, "b", 8.0), (3, "c", None)]
    assert rows(side_by_side(right, left, ["y"], ["n"], name="at")) == [(0, 8.0, 1, "a"), (1, 9.0, 2, "b"), (2, None, 3, "c")]
    text = plan(side_by_side(left, right, ["n"], ["y"]))
    assert "SinglePartition" not in text and "Window" not in text
    with pytest.raises(ValueError, match="x"):
        side_by_side(left, left.select(F.col("x").alias("X")), ["n"], ["X"])


def test_pivot_without_a_limit(spark, conf):
    conf("spark.sql.pivotMaxValues", "10")
    df = spark.range(3000).select((F.col("id") % 2).alias("k"), (F.col("id") % 50).alias("v"), "id").union(spark.createDataFrame([(5, None, 1), (0, 7, None)], "k long, v long, id long"))
    found = pivot_max_map(df, ["k"], "v", "id")
    assert rows(found.select("k", F.size("cells"), cell(2), cell(3, None))) == [(0, 25, 2952, None), (1, 25, 0, 2953), (5, 0, 0, None)]


# --- landing -------------------------------------------------------------------------


CONTENTS = {"a/same.txt": b'  "q",\r\n\n x \t', "b/same.txt": b"\n", "b/long.bin": bytes(range(256)) * 50, "c/latin.txt": "é".encode("latin-1")}


def test_files_are_landed_byte_for_byte(spark, tmp_path):
    for name, content in CONTENTS.items():
        (tmp_path / "in" / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / "in" / name).write_bytes(content)
    source, target = str(tmp_path / "in"), str(tmp_path / "out")
    land_files(spark, source, target, piece_bytes=1000)

    def landed():
        return {r.path.split("/in/")[1]: bytes(r.content) for r in landed_files(spark, target).collect()}

    assert landed() == CONTENTS
    listed = {r.path.split("/in/")[1]: r for r in manifest(spark, target).collect()}
    assert all(listed[n].sha256 == hashlib.sha256(c).hexdigest() and listed[n].length == len(c) for n, c in CONTENTS.items())
    assert listed["b/long.bin"].pieces == 13
    assert {r.value for r in landed_texts(spark, target, "ISO-8859-1").where("path like '%latin%'").collect()} == {"é"}
    rows_before = versions.latest(spark, target).rows
    assert land_files(spark, source, target).rows == rows_before  # nothing new: no content is read
    (tmp_path / "in" / "a" / "same.txt").write_bytes(b"changed")
    (tmp_path / "in" / "d.txt").write_bytes(b"new")
    assert land_files(spark, source, target, suffix=".txt").rows == rows_before + 2
    assert landed() == {**CONTENTS, "a/same.txt": b"changed", "d.txt": b"new"}


def test_broken_bytes_are_noticed(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_bytes(b"right")
    land_files(spark, str(tmp_path / "in"), str(tmp_path / "out"))
    good = versions.read_version(spark, str(tmp_path / "out")).withColumn("content", F.lit(b"wrong"))
    good.write.parquet(str(tmp_path / "wrong"))
    versions.write_version(spark.read.parquet(str(tmp_path / "wrong")), str(tmp_path / "out"))
    with pytest.raises(Exception, match="differ from their digest"):
        landed_files(spark, str(tmp_path / "out")).collect()


def test_parquet_landing_keeps_texts(spark, tmp_path):
    write(tmp_path / "in" / "a.json", '{"x": "two\\nlines"}\n{"x": ""}\n{"x": "  \\"blank\\" "}\n')
    land_extracts(spark, Extract(str(tmp_path / "in"), "json", suffix=".json"), str(tmp_path / "out"))
    assert rows(read_table(spark, str(tmp_path / "out"))) == [("",), ('  "blank" ',), ("two\nlines",)]


# --- types and ports -----------------------------------------------------------------


def test_whole_numbers_with_fractions(spark):
    texts = ["1000.0", "12", " 7.000 ", "1e3", "1.5", "x", "", None, "9999999999", "-0.0", "9223372036854775807"]
    df = spark.createDataFrame([(t, t) for t in texts], "i string, l string")
    types = {"i": "int", "l": "bigint"}
    typed = [tuple(r) for r in with_types(df, types).collect()]
    assert [t[0] for t in typed] == [1000, 12, 7, 1000, None, None, None, None, None, 0, None]
    assert [t[1] for t in typed] == [1000, 12, 7, 1000, None, None, None, None, 9999999999, 0, 9223372036854775807]
    assert rows(type_misfits(df, types)) == [("i", 4, "1.5"), ("l", 2, "1.5")]
    assert type_misfits(df.select(F.lit(1).alias("i")), types).collect() == []
    with pytest.raises(Exception, match="is no (int|bigint): "):
        with_types(df, types, strict=True).collect()
    assert with_types(df.where("i in ('12', '1000.0') or i = '' or i is null"), types, strict=True).count() == 4


def test_ports_are_checked(spark, tmp_path):
    def texts(*values):
        return spark.createDataFrame([(v,) for v in values], "value string")

    good = texts(LABELS)
    check_ports(good, build_ports(good))
    for wrong, message in (
        (texts(LABELS, "no block"), "1 label texts without I94PORT"),
        (texts("I94PORT\n;"), "no rows"),
        (texts("I94PORT\n'A' = 'X, NY'\n'A' = 'Y, NY'\n'B' = 'Z';"), "A: X, NY, Y, NY"),
    ):
        with pytest.raises(QualityError, match=message):
            check_ports(wrong, build_ports(wrong))
    assert port_conflicts(build_ports(good)).collect() == []
    where = Locations(landing=str(tmp_path / "landing"), tables=str(tmp_path / "tables"))
    with pytest.raises(QualityError, match="without I94PORT"):
        run_pipeline(spark, where, sources={"labels": texts(LABELS, "nothing")})


def test_a_second_run_makes_a_second_version(spark, tmp_path):
    for name, text in (("labels", LABELS), ("airport", AIRPORTS), ("city_demo", DEMOGRAPHICS), ("imm", ARRIVALS), ("land_temp", TEMPERATURES)):
        write(tmp_path / "landing" / name / "a.csv", text)
    where = Locations(landing=str(tmp_path / "landing"), tables=str(tmp_path / "tables"))
    run_pipeline(spark, where)
    first = rows(read_table(spark, where.table("airport")))
    shutil.rmtree(tmp_path / "landing" / "airport")
    assert [r.table for r in run_pipeline(spark, where) if r.error] == ["airport"]
    assert rows(read_table(spark, where.table("airport"))) == first
    assert versions.latest(spark, where.table("airport")).number == 1 and versions.latest(spark, where.table("imm")).number == 2
