"""The two classifiers: scores by hand, scores that depend on the text alone, and odd tables."""

import math
import random
import re
import tracemalloc

import numpy as np
import pytest
from pyspark.sql import functions as F

from harborlake.llm import learn, quality, toxicity
from harborlake.llm.common import plain_words
from test_lost_tasks import lossy
from test_training_data import frame, prose, sample_of

rng = random.Random(8)
SCORES = {"toxicity": toxicity.toxicity_scores, "quality": quality.quality_scores}


def toxic_model(seed=1):
    draw = np.random.default_rng(seed)
    m = {"embedding": draw.normal(0, 2, (toxicity.BUCKETS + 1, toxicity.DIMENSIONS)), "score": draw.normal(size=toxicity.FILTERS * 3), "score_bias": np.ones(1)}
    m["embedding"][toxicity.BUCKETS] = 0
    for w in toxicity.WIDTHS:
        m[f"filters{w}"] = draw.normal(size=(w, toxicity.DIMENSIONS, toxicity.FILTERS))
        m[f"bias{w}"] = draw.normal(size=toxicity.FILTERS)
    return m


def logit_by_hand(m, words):
    """Windows that begin at a word or just behind the last one, strongest response of each filter."""
    ids = [i.tolist() for i in toxicity.word_ids(words)] + [[toxicity.BUCKETS] * 2] * toxicity.PADS
    x = [m["embedding"][a] + m["embedding"][b] for a, b in ids]
    total, at = float(m["score_bias"][0]), 0
    for w in toxicity.WIDTHS:
        for f in range(toxicity.FILTERS):
            answers = [
                m[f"bias{w}"][f] + sum(float(x[p + k][d]) * m[f"filters{w}"][k][d][f] for k in range(w) for d in range(toxicity.DIMENSIONS))
                for p in range(len(words) + 1)
            ]
            total += max(0, max(answers)) * m["score"][at]
            at += 1
    return total


def test_toxicity_by_hand():
    m = toxic_model()
    texts = [plain_words(prose(n).encode()) for n in (0, 1, 2, 7, 30)]
    found = toxicity.logits(toxicity.rounded(m), [toxicity.word_ids(t) for t in texts])
    assert found == pytest.approx([logit_by_hand(m, t) for t in texts], rel=1e-3, abs=1e-2)


def test_toxicity_does_not_depend_on_the_documents_beside():
    m = toxicity.rounded(toxic_model())
    docs = [toxicity.word_ids(plain_words(prose(rng.randint(0, 400)).encode())) for _ in range(60)]
    together = toxicity.logits(m, docs)
    assert together.tolist() == [float(toxicity.logits(m, [d])[0]) for d in docs]
    assert together.tolist() == toxicity.logits(m, docs[::-1])[::-1].tolist()


def test_toxicity_of_long_texts_holds_responses_of_some_places_only(monkeypatch):
    m = toxicity.rounded(toxic_model())
    draw = np.random.default_rng(5)
    docs = [draw.integers(0, toxicity.BUCKETS, (n, 2)) for n in (*range(12), 70, 0, 0, 31)]
    whole = toxicity.logits(m, docs).tolist()
    for places in range(1, 20):
        monkeypatch.setattr(toxicity, "PLACES", places)
        assert toxicity.logits(m, docs).tolist() == whole
    monkeypatch.undo()
    long = [draw.integers(0, toxicity.BUCKETS, (n, 2)) for n in (100_000, 3, 100_000)]
    tracemalloc.start()
    toxicity.logits(m, long)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 2 * sum(d.nbytes for d in long) + (8 << 20)


def test_kept_rows_bring_their_text_once(spark):
    rows = [(n, None if n == 3 else prose(20 + n % 5), f"s{n}") for n in range(40)] + [(None, "", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    labels = spark.createDataFrame([(n, n % 2) for n in range(40)], "doc_id long, toxic int")
    alone = toxicity.toxicity_scores(docs, labels)
    told = {r.doc_id: (r.score, r.predicted, r.language) for r in alone.collect()}
    for keep in (["source", "text", "doc_id"], ["doc_id", "source"]):
        kept = toxicity.toxicity_scores(docs, labels, keep=keep)
        found = kept.collect()
        assert {r["_row"].doc_id: (r["_score"], r["_predicted"], r["_language"]) for r in found} == told
        assert sorted(map(str, (r["_row"] for r in found))) == sorted(map(str, docs.select(*keep).collect()))
        plan = kept._jdf.queryExecution().optimizedPlan().toString()
        assert ("coalesce(text" in plan) == ("text" not in keep)


def quality_model(seed=2):
    draw = np.random.default_rng(seed)
    shapes = {
        "embedding": (quality.BUCKETS, quality.HIDDEN), "encode": (quality.FEATURES, quality.HIDDEN), "encode_bias": (quality.HIDDEN,),
        "gate_tanh": (quality.HIDDEN, quality.GATE), "gate_sigmoid": (quality.HIDDEN, quality.GATE), "attend": (quality.GATE,),
        "score": (quality.HIDDEN,), "score_bias": (1,), "centre": (quality.FEATURES,),
    }
    return {k: draw.normal(0, 0.5, v) for k, v in shapes.items()} | {"spread": np.full(quality.FEATURES, 2.0)}


def quality_by_hand(m, bag):
    """Gated attention over passages: weights e^s / sum e^s with s = attend . (tanh(V h) * sigmoid(U h))."""
    features, size, _, buckets = bag
    encoded, scores, at = [], [], 0
    for f, n in zip(features, size):
        own = buckets[at : at + n]
        at += n
        h = []
        for j in range(quality.HIDDEN):
            a = sum((f[k] - m["centre"][k]) / m["spread"][k] * m["encode"][k][j] for k in range(quality.FEATURES)) + m["encode_bias"][j]
            h.append(math.tanh(a + sum(m["embedding"][b][j] for b in own) / max(1, n)))
        gate = [
            math.tanh(sum(h[j] * m["gate_tanh"][j][g] for j in range(quality.HIDDEN))) / (1 + math.exp(-sum(h[j] * m["gate_sigmoid"][j][g] for j in range(quality.HIDDEN))))
            for g in range(quality.GATE)
        ]
        encoded.append(h)
        scores.append(sum(g * a for g, a in zip(gate, m["attend"])))
    weights = [math.exp(s) for s in scores]
    z = [sum(w * h[j] for w, h in zip(weights, encoded)) / sum(weights) for j in range(quality.HIDDEN)]
    return sum(a * b for a, b in zip(z, m["score"])) + m["score_bias"][0]


def test_quality_by_hand_and_apart():
    m = quality_model()
    texts = [prose(n).encode() for n in (0, 1, 64, 65, 300, 700)]
    together = quality.forward(m, *quality.passages(texts), times=quality.product)["logit"]
    assert together == pytest.approx([quality_by_hand(m, quality.passages([t])) for t in texts], rel=1e-9)
    assert together.tolist() == [float(quality.forward(m, *quality.passages([t]), times=quality.product)["logit"][0]) for t in texts]


@pytest.mark.parametrize("name", SCORES)
def test_scores_do_not_depend_on_partitions_or_lost_tasks(spark, name):
    docs, labels = sample_of(spark, ["zonk", "zonky", "blarg"], name == "quality")

    def scores(df, marks):
        return sorted(tuple(r) for r in SCORES[name](df, marks).select("doc_id", "score", "predicted").collect())

    expected = scores(docs, labels)
    assert scores(docs.repartition(7), labels.repartition(3)) == expected
    assert scores(lossy(docs.repartition(4)), lossy(labels)) == expected


@pytest.mark.parametrize("name", SCORES)
def test_odd_tables(spark, name):
    docs, labels = sample_of(spark, ["zonk"], name == "quality", 60)
    assert SCORES[name](docs.limit(0), labels).collect() == []
    assert SCORES[name](docs.limit(0), labels.limit(0)).collect() == []
    odd = [(None, "zonk a b"), (None, "zonk a b"), (None, None), (3, "zonk a b"), (3, "zonk a b"), (4, ""), (5, "word " * 100_000), (6, "字" * 3000)]
    found = SCORES[name](docs.union(frame(spark, odd)), labels).collect()
    assert len(found) == 61 + len(odd) and all(0 <= r.score <= 1 for r in found)
    alike = {r.score for r in found if r.doc_id is None}
    assert len(alike) == 2 and len({r.held_out for r in found if r.doc_id is None}) == 1


def test_all_labelled_rows_are_learned_from(spark):
    """Only positive rows beyond the first 2000 of their class, by hashed identity, have the word that marks them."""
    ids = spark.range(8000).select(F.col("id").alias("doc_id"), (F.crc32(F.col("id").cast("string")) % 4 == 2).alias("out"))
    found = ids.where("doc_id % 2 = 1").orderBy(F.xxhash64("doc_id"), "doc_id").collect()
    late = {r.doc_id for r in [r for r in found if not r.out][2000:]} | {r.doc_id for r in found if r.out}
    rows = [(i, f"{prose(12)} {'zonk' if i in late else 'blarg' if i % 2 else ''} {prose(12)}") for i in range(8000)]
    labels = spark.createDataFrame([(i, i % 2, i % 2) for i in range(8000)], "doc_id long, quality int, toxic int")
    docs = frame(spark, rows).repartition(8)
    held = toxicity.toxicity_scores(docs, labels).where("held_out").collect()
    assert sum(r.predicted == r.doc_id % 2 for r in held) >= 0.95 * len(held) and len(held) > 1500


@pytest.mark.parametrize("name", SCORES)
def test_many_shards_hold_all_rows_and_do_not_depend_on_partitions(spark, monkeypatch, name):
    monkeypatch.setattr(learn, "SHARD_ROWS", 40)
    docs, labels = sample_of(spark, ["zonk", "zonky", "blarg"], name == "quality", 400)

    def as_they_are(batches):
        for batch in batches:
            yield batch.select(["doc_id", "label"])

    shards = learn.Shards(docs, labels, "toxic", as_they_are, "doc_id long, label int")
    trained = {r.doc_id for r in labels.where(F.crc32(F.col("doc_id").cast("string")) % 4 != 2).collect()}
    parts = [{r.doc_id for r in part.collect()} for part in (shards.training, shards.calibrating)]
    assert parts[0] | parts[1] == trained and not parts[0] & parts[1] and shards.training.select("shard").distinct().count() > 3
    found = SCORES[name](docs, labels)
    rows = sorted(tuple(r) for r in found.select("doc_id", "score", "predicted").collect())
    assert rows == sorted(tuple(r) for r in SCORES[name](docs.repartition(9), labels).select("doc_id", "score", "predicted").collect())
    mark = "quality" if name == "quality" else "toxic"
    held = found.join(labels, "doc_id").where("held_out").collect()
    assert sum(r.predicted == r[mark] for r in held) >= 0.9 * len(held)


def test_texts_of_labelled_rows_are_shuffled_once_at_most(spark, monkeypatch):
    """Doc_ids meet their labels without texts and features; bitmaps so small that most rows share a bit change no row."""
    docs, labels = sample_of(spark, ["zonk"], False, 300)
    labels = labels.where("doc_id % 3 = 0").select("doc_id", "toxic")
    known = learn._known(labels, "toxic")
    docs = docs.union(frame(spark, [(None, "zonk"), (3, "another"), (3, "another")]))

    def sizes(batches):
        for batch in batches:
            yield type(batch).from_arrays([batch.column("doc_id"), batch.column("label"), batch.column("text")], ["doc_id", "label", "features"])

    monkeypatch.setattr(learn, "MARKS", 64)
    found = learn._labelled(docs, known, sizes, "doc_id long, label int, features string", 4)
    expected = docs.join(known, "doc_id").select("doc_id", "label", "text")
    rows = sorted(tuple(r)[:3] for r in found.collect())
    assert rows == sorted(tuple(r) for r in expected.collect()) and len(rows) > 60
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = learn._labelled(docs, known, sizes, "doc_id long, label int, features string", 4)
        plan = found._jdf.queryExecution().explainString(found.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    moved = [part for part in plan.split("\n\n") if re.match(r"\(\d+\) Exchange", part.strip())]
    assert sum("features#" in part or "text#" in part for part in moved) == 1


def test_sums_of_gradients_by_bucket():
    """As adding them up one by one."""
    m, texts = quality_model(), [prose(n).encode() for n in (0, 3, 64, 200)]
    bag, labels = quality.passages(texts), np.array([0, 1, 0, 1])
    found = quality.gradients(m, bag, labels, 0.0)["embedding"]
    step = 1e-4
    f = quality.forward(m, *bag)
    for bucket in set(bag[3][:5].tolist()) | {next(b for b in range(quality.BUCKETS) if b not in bag[3])}:
        moved = m | {"embedding": m["embedding"].copy()}
        moved["embedding"][bucket, 2] += step
        logits = quality.forward(moved, *bag)["logit"]
        loss = [(np.logaddexp(0, x) - labels * x).sum() / 4 for x in (f["logit"], logits)]
        assert (loss[1] - loss[0]) / step == pytest.approx(found[bucket, 2], abs=1e-4)
