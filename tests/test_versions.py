"""Versions, append-only loads and maintained aggregates: also when a run is cut at any step, comes twice, or meets another."""

import json
from pathlib import Path
from threading import Barrier

import pytest
from pyspark.sql import functions as F

from conftest import plan, rows
from harborlake import streaming, versions
from harborlake.catalogue import loads
from harborlake.functions import row_digest
from harborlake.plans import build_arrivals, build_ports, maintained
from harborlake.sinks import paths
from harborlake.sources import read_delimited, read_table
from harborlake.streaming import append_distinct, appending, ingest_arrivals, raw_rows
from harborlake.versions import VersionConflict, compact, expire, history, latest, read_version, write_version
from harborlake.versions import table as module
from sources import ARRIVALS, LABELS, write
from test_lost_tasks import lossy

SCHEMA = "cicid string, i94yr string, i94mon string, i94port string, arrdate string"
HEADER, *LINES = ARRIVALS.splitlines(keepends=True)


def frame(spark, *data):
    return spark.createDataFrame(data, "id int, text string, year int")


def files(folder):
    return {str(p) for p in Path(folder).rglob("*.parquet")}


@pytest.mark.parametrize("partition_by", [(), ("year",), ("year", "text")])
def test_versions_can_be_read_later(spark, tmp_path, partition_by):
    t = str(tmp_path / "t")
    one, two = frame(spark, (1, "a", 2015), (2, None, None)), frame(spark, (3, "b", 2016))
    write_version(one, t, partition_by)
    write_version(two, t, partition_by, append=True)
    write_version(two, t, partition_by)
    assert rows(read_version(spark, t, 1)) == rows(one)
    assert rows(read_version(spark, t, 2)) == rows(one.union(two))
    assert rows(read_table(spark, t)) == rows(two) and dict(read_table(spark, t).dtypes) == dict(two.dtypes)
    assert [(v.number, v.rows, v.operation) for v in history(spark, t)] == [(3, 1, "replace"), (2, 3, "append"), (1, 2, "replace")]


def test_empty_versions(spark, tmp_path):
    t = str(tmp_path / "t")
    none = frame(spark, (1, "a", 2015)).where("1 = 0")
    write_version(none, t, ["year"])
    assert rows(read_table(spark, t)) == [] and read_table(spark, t).columns == ["id", "text", "year"]
    with pytest.raises(ValueError, match="no rows"):
        write_version(none, t, allow_empty=False)
    assert latest(spark, t).number == 1
    with pytest.raises(FileNotFoundError):
        read_version(spark, str(tmp_path / "nowhere"))


def cut_after(monkeypatch, number):
    """The driver dies at the ``number``-th thing it asks of the file system or writes."""
    seen = []

    def dying(function):
        def call(*args, **kwargs):
            seen.append(function.__name__)
            if len(seen) == number:
                raise KeyboardInterrupt("driver lost")
            return function(*args, **kwargs)

        return call

    for name in ("create_file", "delete", "names", "read_file", "exists"):
        monkeypatch.setattr(paths, name, dying(getattr(paths, name)))
    monkeypatch.setattr(module, "write_batch", dying(module.write_batch))
    return seen


def test_a_run_cut_at_any_step_leaves_a_whole_table(spark, tmp_path, monkeypatch):
    old, new = frame(spark, (1, "a", 2015), (2, "b", 2016)), frame(spark, (3, "c", 2017))
    number = 0
    while True:
        number += 1
        t = str(tmp_path / f"t{number}")
        write_version(old, t, ["year"])
        with monkeypatch.context() as patched:
            cut_after(patched, number)
            try:
                write_version(new, t, ["year"])
                done = True
            except KeyboardInterrupt:
                done = False
        assert rows(read_table(spark, t)) in ([rows(new)] if done else [rows(old), rows(new)])
        write_version(new, t, ["year"])
        assert rows(read_table(spark, t)) == rows(new)
        if done:
            break
    assert number > 5


def test_an_unfinished_pointer_is_no_version(spark, tmp_path):
    t = str(tmp_path / "t")
    write_version(frame(spark, (1, "a", 2015)), t)
    (tmp_path / "t" / "_versions" / "000000000002.json").write_text('{"number": 2, "ba')
    assert rows(read_table(spark, t)) == [(1, "a", 2015)]
    assert write_version(frame(spark, (2, "b", 2015)), t, append=True).number == 3
    assert rows(read_table(spark, t)) == [(1, "a", 2015), (2, "b", 2015)]


def test_two_writers(spark, tmp_path, monkeypatch):
    """Another writer commits between this one's read of the newest version and its own commit."""
    t = str(tmp_path / "t")
    write_version(frame(spark, (1, "a", 2015)), t)
    base = latest(spark, t)
    write_version(frame(spark, (2, "b", 2015)), t, append=True)
    with pytest.raises(VersionConflict):
        versions.commit(spark, t, versions.Version(**{**base.__dict__, "base": base.number}))
    meanwhile, inner = [frame(spark, (3, "c", 2015))], module.write_batch

    def interrupted(*args):
        if meanwhile:
            write_version(meanwhile.pop(), t, append=True)
        return inner(*args)

    monkeypatch.setattr(module, "write_batch", interrupted)
    write_version(frame(spark, (4, "d", 2015)), t, append=True)
    assert [r[0] for r in rows(read_table(spark, t))] == [1, 2, 3, 4]


def test_voids_compaction_and_expiry(spark, tmp_path):
    t = str(tmp_path / "t")
    write_version(frame(spark, (1, "a", 2015), (2, "b", 2016), (3, None, 2016)), t, ["year"])
    base = latest(spark, t)
    void = module.void_values(spark.createDataFrame([("a",), (None,)], "text string"), t, "text", base.batches[-1])
    versions.commit(spark, t, versions.Version(**{**base.__dict__, "base": 1, "voids": (void,)}))
    write_version(frame(spark, (4, "a", 2016)), t, ["year"], append=True)
    expected = [(2, "b", 2016), (4, "a", 2016)]
    assert rows(read_table(spark, t)) == expected
    assert compact(spark, t).voids == () and rows(read_table(spark, t)) == expected
    assert compact(spark, t).number == 4  # nothing left to do
    assert expire(spark, t) == []  # all of it is young
    assert len(expire(spark, t, keep=2, min_age_seconds=0)) == 2  # two pointers
    assert rows(read_version(spark, t, 3)) == expected
    assert len(expire(spark, t, min_age_seconds=0)) == 4  # a pointer, two batches, a void
    assert rows(read_table(spark, t)) == expected and len(history(spark, t)) == 1


def test_digests_tell_rows_apart(spark):
    data = [(1, None), (None, 1), (1, 1), (None, None), (0, None)]
    df = spark.createDataFrame(data, "x int, y int")
    assert len({tuple(r) for r in df.select(*row_digest(df)).collect()}) == len(data)
    zeros = spark.createDataFrame([(0.0,), (-0.0,)], "x double")
    assert len({tuple(r) for r in zeros.select(*row_digest(zeros)).collect()}) == 1


def test_append_distinct(spark, tmp_path):
    t = str(tmp_path / "t")
    append_distinct(frame(spark, (1, "a", 2015), (1, "a", 2015), (2, None, None)), t, ["year"], source=("s", 0))
    before = files(t)
    new = frame(spark, (2, None, None), (1, "a", 2015), (1, "a", 2016), (1, None, 2015), (3, "c", None))
    for _ in range(2):
        append_distinct(lossy(new), t, ["year"], source=("s", 1))
        assert rows(raw_rows(spark, t)) == rows(frame(spark, (1, "a", 2015), (2, None, None), (1, "a", 2016), (1, None, 2015), (3, "c", None)))
    assert before < files(t) and latest(spark, t).number == 2
    append_distinct(new, t, ["year"], source=("s", 2))
    assert latest(spark, t).added == {"s": ()} and len(history(spark, t)) == 3


def labels_of(*pairs):
    return "/* I94PORT */\n" + "\n".join(f"'{c}' = '{name}'" for c, name in pairs) + "\n;"


@pytest.fixture(scope="module")
def ports(spark):
    return build_ports(spark.createDataFrame([(LABELS,)], "value string")).persist()


def part(*indexes):
    return HEADER + "".join(LINES[i] for i in indexes)


def load(spark, tmp_path, ports):
    ingest_arrivals(spark, str(tmp_path / "in"), SCHEMA, *(str(tmp_path / n) for n in ("raw", "imm")), ports, str(tmp_path / "checkpoint"))


def full(spark, tmp_path, ports):
    return build_arrivals(read_delimited(spark, str(tmp_path / "in")), ports)


def test_old_files_stay_and_replays_change_nothing(spark, tmp_path, ports):
    write(tmp_path / "in" / "a.csv", part(0, 2, 4, 6))
    load(spark, tmp_path, ports)
    before = {p: Path(p).stat().st_mtime_ns for n in ("raw", "imm") for p in files(tmp_path / n)}
    write(tmp_path / "in" / "b.csv", part(1, 2, 3, 5))
    load(spark, tmp_path, ports)
    assert {p: Path(p).stat().st_mtime_ns for p in before} == before
    assert rows(read_table(spark, str(tmp_path / "imm"))) == rows(full(spark, tmp_path, ports))
    after = files(tmp_path / "raw") | files(tmp_path / "imm"), latest(spark, str(tmp_path / "imm"))
    last = max(int(p.name) for p in (tmp_path / "checkpoint" / "commits").iterdir() if p.name.isdigit())
    (tmp_path / "checkpoint" / "commits" / str(last)).unlink()
    (tmp_path / "checkpoint" / "commits" / f".{last}.crc").unlink(missing_ok=True)
    load(spark, tmp_path, ports)
    assert (files(tmp_path / "raw") | files(tmp_path / "imm"), latest(spark, str(tmp_path / "imm"))) == after


def test_a_batch_cut_between_the_two_tables_is_finished_later(spark, tmp_path, ports, monkeypatch):
    write(tmp_path / "in" / "a.csv", part(0, 2))
    load(spark, tmp_path, ports)
    write(tmp_path / "in" / "b.csv", part(1, 3, 4))
    with monkeypatch.context() as patched:
        patched.setattr(streaming.appending, "refresh_fact", lambda *a, **o: 1 / 0)
        with pytest.raises(Exception, match="ZeroDivision|division"):
            load(spark, tmp_path, ports)
    assert latest(spark, str(tmp_path / "raw")).number == 2 and latest(spark, str(tmp_path / "imm")).number == 1
    load(spark, tmp_path, ports)
    assert rows(read_table(spark, str(tmp_path / "imm"))) == rows(full(spark, tmp_path, ports))


def test_changed_ports_redo_their_own_rows_only(spark, tmp_path):
    first = build_ports(spark.createDataFrame([(labels_of(("NYC", "NEW YORK, NY"), ("POM", "PORTLAND, ME")),)], "value string"))
    then = build_ports(spark.createDataFrame([(labels_of(("NYC", "NEW YORK, NY"), ("POM", "PORT LAND, ME"), ("POO", "PORTLAND, OR")),)], "value string"))
    write(tmp_path / "in" / "a.csv", HEADER + "1,2015.0,1.0,NYC,20453.0\n2,2015.0,1.0,POM,20453.0\n3,2015.0,1.0,POO,20453.0\n4,2015.0,1.0,XXX,\n")
    load(spark, tmp_path, first)
    before = files(tmp_path / "imm")
    assert [r[0] for r in rows(read_table(spark, str(tmp_path / "imm")))] == ["1", "2"]
    write(tmp_path / "in" / "b.csv", HEADER + "2,2015.0,1.0,POM,20453.0\n5,2016.0,1.0,POM,20600.0\n")
    load(spark, tmp_path, then)
    fact = str(tmp_path / "imm")
    assert rows(read_table(spark, fact)) == rows(full(spark, tmp_path, then)) and before < files(fact)
    version = latest(spark, fact)
    assert rows(versions.read_batches(spark, fact, version, version.batches[1:]).select("i94port").distinct()) == [("POM",), ("POO",)]
    write(tmp_path / "in" / "c.csv", HEADER + "6,2016.0,1.0,NYC,20600.0\n")
    load(spark, tmp_path, first)  # and back again
    assert rows(read_table(spark, fact)) == rows(full(spark, tmp_path, first))
    compact(spark, fact)
    compact(spark, str(tmp_path / "raw"))
    write(tmp_path / "in" / "d.csv", HEADER + "7,2016.0,1.0,POO,20600.0\n")
    load(spark, tmp_path, then)
    assert rows(read_table(spark, fact)) == rows(full(spark, tmp_path, then))


def test_states_follow_their_table(spark, tmp_path, monkeypatch):
    t, state = str(tmp_path / "t"), str(tmp_path / "s")
    keys, measures = {"text": F.col("text"), "year": F.col("year")}, {"n": ("count", None), "total": ("sum", "id"), "top": ("max", "id")}

    def check():
        maintained.follow(spark, t, state, keys, measures)
        found = maintained.read_state(spark, state, ["text", "year"], measures)
        expected = read_table(spark, t).groupBy("text", "year").agg(F.count("*"), F.sum("id").cast("decimal(38,6)"), F.max("id"))
        assert rows(found) == rows(expected)
        return latest(spark, state)

    write_version(frame(spark, (1, "a", 2015), (5, "a", 2015), (2, None, None)), t)
    assert check().operation == "replace"
    write_version(frame(spark, (7, "a", 2015), (1, "b", 2015)), t, append=True)
    write_version(frame(spark, (9, "b", 2015)), t, append=True)
    assert check().operation == "append" and check().number == 2  # nothing new the second time
    base = latest(spark, t)
    void = module.void_values(spark.createDataFrame([("a",)], "text string"), t, "text", base.batches[-1])
    more = versions.new_batch(base)
    versions.write_batch(frame(spark, (3, "a", 2015)), t, more)
    versions.commit(spark, t, versions.Version(**{**base.__dict__, "base": base.number, "voids": (void,), "batches": (*base.batches, more), "operation": "append"}))
    assert check().operation == "append"
    compact(spark, t)
    assert check().operation == "append"
    write_version(frame(spark, (4, "z", 2015)), t)
    assert check().operation == "replace"
    write_version(frame(spark, (4, "y", 2015)), t, append=True)
    compact(spark, t)
    expire(spark, t, min_age_seconds=0)  # the step that the state has not seen is gone
    assert check().operation == "replace"


def test_pointers_are_small_json(spark, tmp_path):
    t = tmp_path / "t"
    write_version(frame(spark, (1, "a", 2015)), str(t))
    found = json.loads((t / "_versions" / "000000000001.json").read_text())
    assert found["rows"] == 1 and found["batches"][0].startswith("000000000001-")


def test_rows_of_new_partitions_are_appended_without_a_join(spark, tmp_path, monkeypatch):
    sent = []

    def write_batch(df, *args):
        sent.append(plan(df))
        return module.write_batch(df, *args)

    monkeypatch.setattr(appending, "write_batch", write_batch)
    t = str(tmp_path / "t")
    first = frame(spark, (1, "a", 2015), (1, "a", 2015), (2, "b", None), (3, None, 2016))
    append_distinct(first, t, ["year"])
    assert "hashpartitioning(id" in sent[-1]
    assert not any("__a" in line for line in sent[-1].splitlines() if "Exchange hashpartitioning" in line)  # digests come after it
    append_distinct(frame(spark, (1, "a", 2017), (1, "a", 2017), (4, None, 2018)), t, ["year"])
    assert "Join" not in sent[-1]
    mixed = frame(spark, (1, "a", 2015), (2, "b", None), (2, "c", None), (5, "a", 2019), (5, "a", 2019), (3, None, 2016), (3, "", 2017))
    assert append_distinct(mixed, t, ["year"]).rows == 8
    assert "Join" in sent[-1]
    expected = [(1, "a", 2015), (2, "b", None), (3, None, 2016), (1, "a", 2017), (4, None, 2018), (2, "c", None), (5, "a", 2019), (3, "", 2017)]
    assert rows(raw_rows(spark, t)) == rows(frame(spark, *expected))
    assert append_distinct(mixed, t, ["year"]).rows == 8
    deeper = str(tmp_path / "deeper")  # known in one month, new in another, and no month at all
    dated = "id int, y int, m int"
    append_distinct(spark.createDataFrame([(1, 2015, 1), (2, None, None)], dated), deeper, ["y", "m"])
    append_distinct(spark.createDataFrame([(1, 2015, 1), (1, 2015, 2), (1, 2016, 1), (2, None, None), (3, 2015, None)], dated), deeper, ["y", "m"])
    expected = [(1, 2015, 1), (2, None, None), (1, 2015, 2), (1, 2016, 1), (3, 2015, None)]
    assert rows(raw_rows(spark, deeper)) == rows(spark.createDataFrame(expected, dated))


def test_a_batch_for_a_table_without_partitions_is_written_once(spark, tmp_path, monkeypatch):
    staged = []

    def delete(spark, path):
        staged.append(Path(path).exists())
        paths.delete(spark, path)

    monkeypatch.setattr(appending, "delete", delete)
    t = str(tmp_path / "t")
    append_distinct(frame(spark, (1, "a", 2015), (1, "a", 2015), (2, None, None)), t)
    append_distinct(frame(spark, (2, None, None), (1, "a", 2016), (1, "a", 2016)), t)
    assert staged == [False, False]
    assert rows(raw_rows(spark, t)) == rows(frame(spark, (1, "a", 2015), (2, None, None), (1, "a", 2016)))


def driver_tables(spark, folder):
    """A few rows of the tables that ``maintained_reports`` reads."""
    days = [f"199{5 + n}-0{n + 1}-1{n}" for n in range(5)] + ["2000-05-01", "2000-07-01", "2001-07-01"]
    tables = {
        "nation": ([(n, f"NATION_{n}", n % 5) for n in range(25)], "n_nationkey int, n_name string, n_regionkey int"),
        "orders": (
            [(n, n % 6, "FPO"[n % 3], f"{days[n % 8]}", ["1-URGENT", "4-NOT SPECIFIED", "5-LOW"][n % 5 % 3]) for n in range(48)],
            "o_orderkey long, o_custkey long, o_orderstatus string, o_orderdate string, o_orderpriority string",
        ),
        "lineitem": (
            [(n, 1 + n % 3, n % 7, float(n % 4), 0.01 * (n % 2), "NAR"[n % 3], "OF"[n % 2], days[n % 8]) for n in range(64)],
            "l_orderkey long, l_linenumber int, l_suppkey long, l_quantity double, l_discount double, l_returnflag string, l_linestatus string, l_shipdate string",
        ),
        "customer": ([(n, n % 7, n * 1.5, "BUILDING") for n in range(20)], "c_custkey long, c_nationkey int, c_acctbal double, c_mktsegment string"),
        "part": ([(n, "name", f"Brand#{n}", "TIN", n) for n in range(30)], "p_partkey long, p_name string, p_brand string, p_type string, p_size int"),
    }
    for name, (data, kinds) in tables.items():
        df = spark.createDataFrame(data, kinds)
        moments = {c: F.col(c).cast("timestamp") for c in df.columns if c.endswith("date")}
        df.withColumns(moments).write.parquet(f"{folder}/{name}.parquet")


def test_loads_of_the_maintained_reports_run_side_by_side(spark, tmp_path, monkeypatch):
    """Arrivals and temperatures wait for each other once, which one after the other never ends."""
    driver_tables(spark, str(tmp_path))
    both, met = Barrier(2, timeout=60), set()

    def meeting(function):
        def call(*args, **kwargs):
            if function not in met:
                met.add(function)
                both.wait()
            return function(*args, **kwargs)

        return call

    monkeypatch.setattr(streaming, "append_distinct", meeting(streaming.append_distinct))
    monkeypatch.setattr(maintained, "follow_arrivals", meeting(maintained.follow_arrivals))
    found = loads.maintained_reports(spark, str(tmp_path))
    assert found.where("report = 'port and month'").agg(F.sum("n")).first()[0] == loads._dated(
        build_arrivals(loads.raw_arrivals(spark, str(tmp_path)), loads.ports(spark, str(tmp_path)))
    ).count()
    assert found.where("report = 'temperatures'").count() > 0


def test_a_load_of_the_maintained_reports_that_fails_is_reported(spark, tmp_path, monkeypatch):
    driver_tables(spark, str(tmp_path))

    def failing(*args, **kwargs):
        raise OSError("no temperatures today")

    monkeypatch.setattr(maintained, "follow_temperatures", failing)
    with pytest.raises(OSError, match="no temperatures today"):
        loads.maintained_reports(spark, str(tmp_path))
