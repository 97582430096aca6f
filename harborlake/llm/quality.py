"""Quality by attention-based multiple-instance learning.

A document is a bag of passages of 64 words. Each passage is encoded from what can be seen in it
(letter case, digits, signs, lengths, repeated words) and from a trained embedding of its hashed
words; a gated attention, learned from labels of whole documents, weights the passages, and the
weighted sum is scored. All labelled rows outside the held-out fold are learned from, in shards whose changes are averaged
(``learn.rounds``); all whole texts are scored.

A document without words is a single passage of zeros, and gets a score like any other. Without labels of
both classes there is nothing to learn: every score is then 0.5. Repeated rows and null doc_ids keep a row each; an empty table gives
none. Of several labels of a doc_id the largest counts. Sums are taken in one order, so a score depends on the text and the
model alone. Columns besides doc_id and text are never read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from harborlake.llm.common import encoded, fold, slices, texts
from harborlake.llm.learn import FOLDS, HELD_OUT, LOGIT_STEPS, ROUNDS, Shards, best_threshold, logit_counts, logit_steps, product, rounds, sigmoid, train

PASSAGE_WORDS = 64
BUCKETS = 1 << 12
HIDDEN, GATE = 16, 8
THRESHOLD = 0.7
FEATURES = 11
EPOCHS = 12
MOMENT_STEPS = 1 << 20  # of a feature's unit, in sums of whole numbers

# Kinds of bytes: white space, lower case, upper case, digit, sign, part of a character beyond ASCII.
_KINDS = np.array(
    [0 if bytes([b]).isspace() else 5 if b > 127 else 1 if chr(b).islower() else 2 if chr(b).isupper() else 3 if chr(b).isdigit() else 4 for b in range(256)],
    dtype=np.uint8,
)


def passages(found: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of each passage: features, words before it, and of each document, passages before it; buckets of all words."""
    words_of = [t.split() for t in found]
    counts = np.array([len(w) for w in words_of], dtype=np.int64)
    per_doc = np.maximum(1, -(-counts // PASSAGE_WORDS))
    doc_start = np.cumsum(per_doc) - per_doc
    total = int(per_doc.sum())
    words = [w for own in words_of for w in own]
    features = np.zeros((total, FEATURES), dtype=np.float32)
    # passage of each word, and the first word of each passage
    within = np.arange(len(words)) - np.repeat(np.cumsum(counts) - counts, counts)
    passage = np.repeat(doc_start, counts) + within // PASSAGE_WORDS
    size = np.bincount(passage, minlength=total)
    first = np.cumsum(size) - size
    hashes = np.fromiter(map(zlib.crc32, words), dtype=np.int64, count=len(words))
    if words:
        lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        kinds = _KINDS[np.frombuffer(b"".join(words), dtype=np.uint8)]
        starts = np.cumsum(lengths) - lengths
        some = size > 0
        at = starts[first[some]]
        chars = np.add.reduceat(lengths, first[some])
        for k in range(1, 6):
            features[some, k - 1] = np.add.reduceat((kinds == k).astype(np.int32), at) / chars
        ends = kinds[starts + lengths - 1] == 4
        same = np.concatenate([[False], (hashes[1:] == hashes[:-1]) & (passage[1:] == passage[:-1])])
        keys = np.sort(passage << 32 | hashes)
        fresh = np.concatenate([[True], keys[1:] != keys[:-1]])
        n = size[some]
        features[some, 5] = np.bincount((keys >> 32)[fresh], minlength=total)[some] / n
        features[some, 6] = np.add.reduceat(same.astype(np.int32), first[some]) / n
        features[some, 7] = np.add.reduceat(ends.astype(np.int32), first[some]) / n
        features[some, 8] = np.minimum(chars / n, 40) / 10
        features[some, 9] = np.add.reduceat((lengths > 25).astype(np.int32), first[some]) / n
        features[some, 10] = np.log1p(n) / np.log1p(PASSAGE_WORDS)
    return features, size, doc_start, (hashes % BUCKETS).astype(np.int32)


def _sums(values: np.ndarray, size: np.ndarray) -> np.ndarray:
    out = np.zeros((len(size), values.shape[1]))
    some = size > 0
    if some.any():
        out[some] = np.add.reduceat(values, (np.cumsum(size) - size)[some], axis=0)
    return out


def forward(m: dict, features, size, doc_start, buckets, times=np.matmul) -> dict:
    """``times`` multiplies matrices: fast ones in training, ones whose rows don't depend on each other in scoring."""
    mean = _sums(m["embedding"][buckets], size) / np.maximum(size, 1)[:, None]
    x = (features - m["centre"]) / m["spread"]
    h = np.tanh(times(x, m["encode"]) + mean + m["encode_bias"])
    left, right = np.tanh(times(h, m["gate_tanh"])), sigmoid(times(h, m["gate_sigmoid"]))
    raw = times(left * right, m["attend"][:, None])[:, 0]
    docs = np.repeat(np.arange(len(doc_start)), np.diff(np.append(doc_start, len(raw))))
    e = np.exp(raw - np.maximum.reduceat(raw, doc_start)[docs])
    a = e / np.add.reduceat(e, doc_start)[docs]
    z = np.add.reduceat(a[:, None] * h, doc_start, axis=0)
    return {"x": x, "h": h, "left": left, "right": right, "a": a, "z": z, "docs": docs, "logit": times(z, m["score"][:, None])[:, 0] + m["score_bias"][0]}


def gradients(m: dict, bag: tuple, labels: np.ndarray, decay: float) -> dict:
    features, size, doc_start, buckets = bag
    f = forward(m, *bag)
    weight = np.where(labels == 1, 0.5 / max(1, (labels == 1).sum()), 0.5 / max(1, (labels == 0).sum()))
    d = (sigmoid(f["logit"]) - labels) * weight
    a, h, docs = f["a"], f["h"], f["docs"]
    dz = np.outer(d, m["score"])[docs]
    da = (dz * h).sum(axis=1)
    ds = a * (da - np.add.reduceat(a * da, doc_start)[docs])
    dg = np.outer(ds, m["attend"])
    dl, dr = dg * f["right"] * (1 - f["left"] ** 2), dg * f["left"] * f["right"] * (1 - f["right"])
    dh = a[:, None] * dz + dl @ m["gate_tanh"].T + dr @ m["gate_sigmoid"].T
    dp = dh * (1 - h * h)
    shares = np.repeat(np.ascontiguousarray((dp / np.maximum(size, 1)[:, None]).T), size, axis=1)
    at = buckets.astype(np.intp)
    de = np.stack([np.bincount(at, own, len(m["embedding"])) for own in shares], axis=1)
    return {
        "score": f["z"].T @ d + decay * m["score"],
        "score_bias": np.array([d.sum()]),
        "attend": (f["left"] * f["right"]).T @ ds,
        "gate_tanh": h.T @ dl,
        "gate_sigmoid": h.T @ dr,
        "encode": f["x"].T @ dp + decay * m["encode"],
        "encode_bias": dp.sum(axis=0),
        "embedding": de + decay * m["embedding"],
    }


def _moments(rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Mean and spread of each feature over the passages of all rows, from sums of whole numbers."""

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.concatenate([np.zeros((0, FEATURES)), *(b[0] for b in _bags(batch))])
            sums = [np.rint(v * MOMENT_STEPS).astype(np.int64).sum(axis=0) for v in (x, x * x)]
            yield pa.RecordBatch.from_arrays([pa.array([len(x)], pa.int64()), *(pa.array([v]) for v in np.concatenate(sums))], ["n", *names])

    names = [f"s{k}" for k in range(2 * FEATURES)]
    found = rows.mapInArrow(summed, "n long, " + ", ".join(f"{c} long" for c in names)).agg(F.sum("n"), *[F.sum(c) for c in names]).first()
    mean, square = np.array(found[1:], dtype=np.float64).reshape(2, FEATURES) / MOMENT_STEPS / found[0]
    return mean, np.sqrt(np.maximum(0, square - mean * mean))


def _bags(rows: pa.RecordBatch | pa.Table) -> list[tuple]:
    columns = [rows.column(c).to_pylist() for c in ("features", "size", "buckets")]
    return [
        (np.frombuffer(f, "<f4").reshape(-1, FEATURES), np.frombuffer(n, "<i4").astype(np.int64), np.zeros(1, dtype=np.int64), np.frombuffer(b, "<i4"))
        for f, n, b in zip(*columns)
    ]


def fit(shards: Shards, *, seed: int = 7) -> dict:
    """A model; the calibrating rows give the threshold."""
    rng = np.random.default_rng(seed)
    mean, spread = _moments(shards.training)
    scale = {"centre": mean, "spread": spread + 1e-3}
    m = {
        "embedding": np.zeros((BUCKETS, HIDDEN)),
        "encode": rng.normal(0, FEATURES**-0.5, (FEATURES, HIDDEN)),
        "encode_bias": np.zeros(HIDDEN),
        "gate_tanh": rng.normal(0, HIDDEN**-0.5, (HIDDEN, GATE)),
        "gate_sigmoid": rng.normal(0, HIDDEN**-0.5, (HIDDEN, GATE)),
        "attend": rng.normal(0, GATE**-0.5, GATE),
        "score": rng.normal(0, HIDDEN**-0.5, HIDDEN),
        "score_bias": np.zeros(1),
    }

    def local(common: dict, table: pa.Table, seed: list[int]) -> tuple[np.ndarray, dict]:
        bags, labels = _bags(table), table.column("label").to_numpy()
        m = {k: v.copy() for k, v in common.items()}

        def grads_of(numbers):
            return gradients(m | scale, together([bags[i] for i in numbers]), labels[numbers], 1e-5)

        train(m, grads_of, len(bags), rate=0.01, epochs=-(-EPOCHS // ROUNDS), batch=64, seed=seed)
        return np.arange(BUCKETS), m

    m = rounds(shards, m, local, seed=seed) | scale
    model = shards.rows.sparkSession.sparkContext.broadcast(m)

    def steps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, 64):
                part = batch.slice(a, 64)
                values = logit_steps(forward(model.value, *together(_bags(part)), times=product)["logit"])
                yield pa.RecordBatch.from_arrays([values, part.column("label")], ["step", "label"])

    found = logit_counts(shards, steps, "step int, label int")
    m["threshold"] = best_threshold(found.column("step").to_numpy() / LOGIT_STEPS, found.column("label").to_numpy(), found.column("n").to_numpy())
    return m


def together(bags: list[tuple]) -> tuple:
    features, sizes, starts, buckets = zip(*bags)
    before = np.cumsum([0, *map(len, sizes)])
    return np.concatenate(features), np.concatenate(sizes), np.concatenate([s + b for s, b in zip(starts, before)]), np.concatenate(buckets)


def _learned(docs: DataFrame, labels: DataFrame, label: str) -> dict | None:
    def featurised(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            bags = [passages([t]) for t in encoded(batch.column("text"))]
            columns = [batch.column("doc_id"), batch.column("label")]
            columns += [pa.array([b[k].astype(t).tobytes() for b in bags], pa.binary()) for k, t in ((0, "<f4"), (1, "<i4"), (3, "<i4"))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "label", "features", "size", "buckets"])

    shards = Shards(docs, labels, label, featurised, "doc_id long, label int, features binary, size binary, buckets binary")
    return fit(shards) if shards.known else None


def quality_scores(docs: DataFrame, labels: DataFrame, *, label: str = "quality", threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted, passages, attention (share of the weightiest passage)."""
    model = docs.sparkSession.sparkContext.broadcast(_learned(docs, labels, label))
    shift = float(np.log(threshold / (1 - threshold)))

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model.value
        for batch in slices(batches):
            bag = passages(encoded(batch.column("text")))
            per_doc = np.diff(np.append(bag[2], len(bag[1])))
            score, share = np.full(len(per_doc), 0.5), 1 / per_doc
            if m is not None:
                f = forward(m, *bag, times=product)
                score = sigmoid(f["logit"] - m["threshold"] + shift)
                share = np.maximum.reduceat(f["a"], bag[2])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(score), pa.array(per_doc.astype(np.int64)), pa.array(share)],
                ["doc_id", "score", "passages", "attention"],
            )

    rows = texts(docs).withColumn("doc_id", F.col("doc_id").cast("long"))
    return rows.mapInArrow(scored, "doc_id long, score double, passages long, attention double").select(
        "doc_id",
        (fold("doc_id", FOLDS) == HELD_OUT).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
        "passages",
        "attention",
    )
