"""Line de-duplication, periodic runs and prefix tries against plain Python and SQL."""

import hashlib
import random
import re
import zlib

import duckdb
import numpy as np
import pytest
from hypothesis import given, strategies as st
from pyspark.sql import functions as F

import brute
from harborlake.llm import common, line_dedup, periods, prefix_trie, queries
from harborlake.llm.oracles import ORACLES

rng = random.Random(11)
CLASHING = "doc_id long, text string, lines string, t int, u int, a int, b int, dropped int, at int, key string, runs int, ids int"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "x", 1, 2, 3, 4, 5, 6, "k", 7, 8) for i, t in rows], CLASHING).repartition(3)


def tuples(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def no_python(df):
    text = df._jdf.queryExecution().executedPlan().toString()
    return not any(word in text for word in ("Python", "Arrow", "Pandas"))


# --- lines ---------------------------------------------------------------------------


def lines_by_hand(rows, min_docs, min_chars=1):
    strip = re.compile(r"\A[\x20\x09-\x0D]+|[\x20\x09-\x0D]+\Z")

    def key(line):
        return brute.lower(strip.sub("", line))

    stands = {}
    for number, (i, t) in enumerate(rows):
        for line in (t or "").split("\n"):
            stands.setdefault(key(line), set()).add(("no id", t or "") if i is None else i)
    shared = {k for k, found in stands.items() if len(k) >= min_chars and len(found) >= min_docs}
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [line for line in lines if key(line) not in shared]
        out.append((i, len(lines), len(lines) - len(kept), brute.sha("\n".join(kept))))
    return sorted(out, key=str)


LINES = ["same line", " Same LINE\t", "ÄÖ same", "äö same", "x", "", "  ", "\x0b\x0c x\r", "end ", "rare %d"]


@pytest.mark.parametrize("min_docs, min_chars", [(2, 1), (3, 2), (10, 1)])
def test_lines(spark, min_docs, min_chars):
    rows = [(n, "\n".join(rng.choice(LINES).replace("%d", str(n)) for _ in range(rng.randint(1, 9)))) for n in range(40)]
    rows += [(100, None), (101, ""), (102, "\n\n"), (None, "x\nsame line"), (None, "x\nsame line"), (None, "y"), (3, "x\nx"), (3, "x\nx")]
    rows += [(200, "\n".join(f"line {k % 7}" if k % 3 else f"own {k}" for k in range(20_000)))] + [(300 + k, "line 1\nline 2") for k in range(10)]
    found = line_dedup.digests(line_dedup.without_shared_lines(frame(spark, rows), min_docs=min_docs, min_chars=min_chars))
    assert tuples(found) == lines_by_hand(rows, min_docs, min_chars)
    assert no_python(found)


def test_lines_when_none_is_heavy_and_when_all_are(spark, monkeypatch):
    rows = [(n, "a\nb\nc" if n % 3 else f"a\n{n}\n{n % 5}") for n in range(60)]
    for heavy in (1, 10**9):
        monkeypatch.setattr(common, "HEAVY", heavy)
        assert tuples(line_dedup.digests(line_dedup.without_shared_lines(frame(spark, rows), min_docs=5))) == lines_by_hand(rows, 5)


def test_lines_keep_whole_texts(spark):
    rows = [(1, "a\nkeep\nb"), (2, "b \n\nkeep too\nA")]
    found = line_dedup.without_shared_lines(frame(spark, rows), min_docs=2)
    assert tuples(found) == [(1, 3, 2, "keep"), (2, 4, 2, "\nkeep too")]
    assert line_dedup.without_shared_lines(frame(spark, rows).where("1 = 0")).collect() == []


# --- runs ----------------------------------------------------------------------------


@given(st.lists(st.integers(0, 40)))
def test_z_function(x):
    expected = [next((k for k in range(len(x) - i) if x[k] != x[i + k]), len(x) - i) for i in range(len(x))]
    assert periods.z_function(x) == expected


def some_words(n):
    words = []
    while len(words) < n:
        if rng.random() < 0.6:
            block = [rng.choice("ab") for _ in range(rng.randint(1, 12))]
            words += (block * rng.randint(2, 9))[: rng.randint(1, 70)]
        else:
            words += [rng.choice("abcdefé") for _ in range(rng.randint(0, 20))]
    return words


def rewrite(doc_id, words):
    return [w.decode() for w in queries.repeating_tail(doc_id, [w.encode() for w in words])]


def test_runs(spark):
    rows = [(n, rng.choice([" ", "\n", " \t"]).join(some_words(rng.randint(1, 200)))) for n in range(300)]
    rows += [(1001, None), (1002, ""), (1003, " \n"), (1004, "a a a a a"), (1005, "a a a a a a"), (None, "b b b b b b b"), (7, "x " * 9), (7, "x " * 9)]
    rows += [(2000 + k, " ".join(some_words(700))) for k in range(3)]
    found = periods.digests(periods.periodic_runs(frame(spark, rows), rewrite=queries.repeating_tail))
    assert len(found.collect()) == len(rows)
    assert {tuple(r) for r in found.collect()} == brute.periods(rows, rewrite)


def test_contract_rewrites_a_tenth_of_the_documents():
    n = next(n for n in range(1000) if zlib.crc32(str(n).encode()) % 10 == 0)
    g, words = zlib.crc32(str(n).encode()) // 10, [str(k).encode() for k in range(50)]
    a = g % 50
    p = 1 + (50 - a) // (3 + g % 8)
    assert queries.repeating_tail(n, words) == words[:a] + [words[a + (i - a) % p] for i in range(a, 50)]
    assert queries.repeating_tail(None, words) == words and queries.repeating_tail(n, []) == []


def test_long_runs_cross_many_tiles(spark):
    block = [f"w{rng.random()}" for _ in range(3000)]
    long = ["x"] + block * 5 + ["y"] * 40_000 + block[:3] * 4000
    row = periods.periodic_runs(frame(spark, [(1, " ".join(long))])).first()
    assert [tuple(r) for r in row.runs] == [(1, 15_000, 3000), (15_001, 40_000, 1), (55_001, 12_000, 3)]
    assert row.collapsed.split() == ["x", *block, "y", *block[:3]]


def test_collisions_of_fingerprints_add_no_run(spark, monkeypatch):
    monkeypatch.setattr(periods, "BASE", np.uint64(0))  # a fingerprint of nothing but the first word
    words = some_words(120)
    ids = {w: k for k, w in enumerate(dict.fromkeys(words))}
    found = list(periods.boundaries(np.array([ids[w] for w in words]), np.array([len(words)])))
    assert sum(len(at) for _, at in found) > 0
    rows = [(1, " ".join(words))]
    assert [tuple(r) for r in periods.periodic_runs(frame(spark, rows)).first().runs] == brute.runs(words)


def test_runs_of_nothing(spark):
    assert periods.digests(periods.periodic_runs(frame(spark, []))).collect() == []


# --- tries ---------------------------------------------------------------------------

TURNS = "conv_id long, turn long, role string, text string, head string, turns int, origin int, node int"


def conversations(spark, rows):
    return spark.createDataFrame([(*r, "h", 1, 2, 3) for r in rows], TURNS).repartition(3)


def trie_by_hand(rows):
    own = {}
    for c, t, r, x in sorted((r for r in rows if r[0] is not None), key=lambda r: (r[0], r[1] is not None, r[1] or 0)):
        own.setdefault(c, []).append((r or "", x or ""))
    rebuilt = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        rebuilt[c] = own.get(c - c % 100, [])[:h] + turns[h:]
    nodes = {}
    for c, turns in rebuilt.items():
        for d in range(len(turns) + 1):
            nodes.setdefault(tuple(turns[:d]), []).append(c)
    out = []
    for path, members in nodes.items():
        subtree = [p for p in nodes if p[: len(path)] == path]
        children = [p for p in nodes if p[:-1] == path and p]
        leaves = [p for p in subtree if not any(q[:-1] == p and q for q in subtree)]
        saved = sum((len(nodes[p]) - 1) * len(p[-1][1]) for p in subtree if p)
        ends = ",".join(str(c) for c in sorted(members) if len(rebuilt[c]) == len(path))
        parent = min(nodes[path[:-1]]) if path else None
        out.append((min(members), len(path), parent, len(members), len(children), len(leaves), saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def some_conversations(n):
    rows = []
    for c in rng.sample(range(3 * n), n):
        for t in range(rng.choice([1, 1, 2, 3, 5, 8])):
            text = rng.choice(["hello", "hé", "", None, "bye", f"own {rng.randint(0, 9)}"])
            rows.append((c, None if t == 0 and c % 2 else t, rng.choice(["user", "user", None]), text))
    return rows + [(None, 0, "user", "nobody's")]


def trie(spark, rows, **options):
    shared = F.crc32(F.col("conv_id").cast("string")) % 6
    df = prefix_trie.prefix_trie(prefix_trie.sequences(conversations(spark, rows), shared_turns=shared), **options)
    return tuples(df.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"))


@pytest.mark.parametrize("limit", [2000, 20, 1])
def test_trie(spark, limit):
    rows = some_conversations(250)
    assert trie(spark, rows, limit=limit) == trie_by_hand(rows)


def test_trie_of_copies_and_deep_conversations(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "PACK", 7)
    rows = [(c, t, "user", f"turn {t}") for c in range(0, 60) for t in range(6)]
    rows += [(c, t, "user", f"deep {t}" if t < 30 + c % 5 else f"{c}") for c in range(100, 130) for t in range(40)]
    rows += [(400, 1, "user", "twice"), (400, 1, "user", "twice")]
    for limit in (2000, 3):
        assert trie(spark, rows, limit=limit) == trie_by_hand(rows)


def test_bursts_bound_containers_and_heads(spark):
    rows = some_conversations(300)
    found = prefix_trie.distinct_sequences(prefix_trie.sequences(conversations(spark, rows))).persist()
    heads = prefix_trie.burst(found, 5)
    sizes = prefix_trie.contained(found, heads).where("container is not null").groupBy("container").count().collect()
    assert len(heads) > 3 and max(r["count"] for r in sizes) <= 5
    assert len(heads) - 1 <= sum(len(r.turns) // prefix_trie.TURN for r in found.collect()) / 5


def test_trie_of_nothing(spark):
    assert trie(spark, []) == []
    assert trie(spark, [(None, 1, "user", "x")]) == []


# --- SQL -----------------------------------------------------------------------------


@pytest.mark.parametrize("name", ORACLES)
def test_sql(spark, testdata, name):
    connection = duckdb.connect()
    for table in ("documents", "conversations", "benchmark"):
        connection.sql(f"create view {table} as select * from '{testdata}/{table}.parquet'")
    expected = connection.sql(ORACLES[name])
    found = queries.QUERIES[name](spark, testdata)
    columns = ", ".join(found.columns)
    assert {f.name: f.dataType.simpleString().replace("string", "varchar").upper() for f in found.schema} == dict(zip(expected.columns, map(str, expected.types)))
    assert tuples(found) == sorted(connection.sql(f"select {columns} from ({ORACLES[name]})").fetchall(), key=str)
