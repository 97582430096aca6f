"""What the two trained classifiers share: all labelled rows in shards, training by rounds over the shards, Adam, calibration.

Every labelled row outside the held-out fold is used: four fifths of them to train, a fifth to calibrate. The rows are written once, in
shards of about SHARD_ROWS by a hash of their identity. In a round each shard goes on by itself from the common model, and the
changes are averaged into the next one; they are added up as whole numbers, so the model doesn't depend on partitions or on
tasks that run again. A task holds one shard at a time, the driver a model, whatever the number of rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from harborlake.llm.common import fold, texts
from harborlake.sinks import scratch_path

FOLDS, HELD_OUT = 4, 2
SHARD_ROWS = 2048
ROUNDS = 3
CALIBRATING = 5  # one in so many rows calibrates
MARKS, MAP_BITS = 1 << 24, 1 << 15  # of hashed doc_ids: all bits, bits of one bitmap
WIDE = 16  # numbers in a row of a model's parameters
EXACT = 1 << 20  # changes are added up in whole numbers of a part in so many
LOGIT_STEPS = 4096  # thresholds lie between steps of logits


def _candidates(docs: DataFrame, known: DataFrame) -> DataFrame:
    """(doc_id, text, label) of rows whose doc_id has a hash that a doc_id with that label has: 512 bitmaps of 4 KB a label at most are broadcast.

    All labelled rows are among them, and a few others, so that texts need no shuffle to find out.
    """
    rows = texts(docs).withColumn("doc_id", F.col("doc_id").cast("long")).where(fold("doc_id", FOLDS) != HELD_OUT)
    number = F.pmod(F.xxhash64("doc_id"), F.lit(MARKS))
    numbers = known.select((number / MAP_BITS).cast("int").alias("__map"), "label", (number % MAP_BITS).alias("at"))
    maps = numbers.groupBy("__map", "label").agg(F.bitmap_construct_agg("at").alias("__bits"))
    byte = F.substring("__bits", F.floor(number % MAP_BITS / 8).cast("int") + 1, F.lit(1))
    marked = F.getbit(F.conv(F.hex(byte), 16, 10).cast("int"), (number % 8).cast("int")) == 1
    return rows.withColumn("__map", (number / MAP_BITS).cast("int")).join(F.broadcast(maps), "__map").where(marked).select("doc_id", "text", "label")


def _labelled(docs: DataFrame, known: DataFrame, featurised: Callable, kind: str, count: int) -> DataFrame:
    """Features (columns ``kind``) of all rows with a known label, and their shard out of ``count``; rows of a shard are in one partition.

    Features are shuffled once, to their shards. The doc_ids that do have the label they are thought to have are found beside that,
    without the features, and meet them there.
    """
    rows = _candidates(docs, known).mapInArrow(featurised, kind)
    values = [F.xxhash64(F.lit(what), *[F.col(c) for c in rows.columns]) for what in ("part", "shard")]
    number = F.pmod(values[1], F.lit(count)).cast("int")
    rows = rows.withColumn("shard", F.when(F.pmod(values[0], F.lit(CALIBRATING)) == 0, -1 - number).otherwise(number))
    pair = [F.col("doc_id").alias("id"), F.col("label").alias("is")]
    true = rows.select(F.col("shard").alias("of"), *pair).join(known.select(*pair), ["id", "is"], "left_semi")

    def confirmed(own: pa.Table, told: pa.Table) -> pa.Table:
        pairs = set(zip(told.column("id").to_pylist(), told.column("is").to_pylist()))
        return own.filter(pa.array([p in pairs for p in zip(own.column("doc_id").to_pylist(), own.column("label").to_pylist())], pa.bool_()))

    return rows.groupBy("shard").cogroup(true.groupBy("of")).applyInArrow(confirmed, rows.schema)


def _known(labels: DataFrame, label: str) -> DataFrame:
    rows = labels.where(F.col(label).isin(0, 1)).select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label"))
    rows = rows.where(F.col("doc_id").isNotNull() & (fold("doc_id", FOLDS) != HELD_OUT))
    return rows.groupBy("doc_id").agg(F.max("label").alias("label"))


class Shards:
    """Rows of ``featurised`` (mapInArrow of doc_id, text and label, to columns ``kind``) in stored shards; ``known`` if both classes occur."""

    def __init__(self, docs: DataFrame, labels: DataFrame, label: str, featurised: Callable, kind: str):
        spark = docs.sparkSession
        known = _known(labels, label)
        count = max(1, round(known.count() / SHARD_ROWS))
        rows = _labelled(docs, known, featurised, kind, count)
        path = scratch_path(spark, "shards")
        rows.write.partitionBy("shard").parquet(path)  # a file for each shard
        self.rows = spark.read.schema(rows.schema).parquet(path)
        sizes = {(r["label"], r["trains"]): r["count"] for r in self.rows.groupBy("label", (F.col("shard") >= 0).alias("trains")).count().collect()}
        self.known = all(any((y, t) in sizes for t in (True, False)) for y in (0, 1))
        # A part without one of the classes says nothing: few rows do both.
        self.training, self.calibrating = (self.rows.where(F.col("shard") >= 0 if t else F.col("shard") < 0) if all((y, t) in sizes for y in (0, 1)) else self.rows for t in (True, False))
        self.size = sum(n for (_, t), n in sizes.items() if t) if self.training is not self.rows else sum(sizes.values())


def by_shard(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.Table]]:
    """Shards of a task, one after the other, each sorted by all its columns."""

    def whole() -> tuple[int, pa.Table]:
        found = pa.Table.from_batches(held).combine_chunks()
        return at, found.sort_by([(c, "ascending") for c in found.column_names])

    held, at = [], None
    for batch in batches:
        numbers = batch.column("shard").to_numpy()
        cuts = [0, *(np.flatnonzero(np.diff(numbers)) + 1).tolist(), len(numbers)]
        for a, b in zip(cuts, cuts[1:]):
            if a == b:
                continue
            if held and int(numbers[a]) != at:
                yield whole()
                held = []
            at = int(numbers[a])
            held.append(batch.slice(a, b - a))
    if held:
        yield whole()


def _packed(m: dict[str, np.ndarray], names: list[str]) -> np.ndarray:
    """All but the embedding, in rows of WIDE numbers."""
    flat = np.concatenate([m[k].ravel() for k in names])
    return np.concatenate([flat, np.zeros(-len(flat) % WIDE)]).reshape(-1, WIDE)


def rounds(shards: Shards, m: dict[str, np.ndarray], local: Callable, *, seed: int) -> dict[str, np.ndarray]:
    """Train ``m``: ``local(m, table, seed)`` gives the rows of the embedding that a shard changes, and what it makes of the parameters.

    Changes of the embedding's rows are averaged over the shards that change them, those of the other parameters over all.
    """
    spark, names = shards.rows.sparkSession, sorted(k for k in m if k != "embedding")
    size = len(m["embedding"])
    columns = [f"v{k}" for k in range(WIDE)]
    schema = "row int, n long, " + ", ".join(f"{c} long" for c in columns)
    for turn in range(ROUNDS):
        common = spark.sparkContext.broadcast(m)

        def changes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            known = common.value
            before = _packed(known, names)
            total = np.zeros((size + len(before), WIDE), dtype=np.int64)
            times = np.zeros(len(total), dtype=np.int64)
            for number, table in by_shard(batches):
                own, after = local(known, table, [seed, turn, number & 0xFFFFFFFF])
                total[own] += np.rint((after["embedding"] - known["embedding"][own]) * EXACT).astype(np.int64)
                total[size:] += np.rint((_packed(after, names) - before) * EXACT).astype(np.int64)
                times[own] += 1
                times[size:] += 1
            some = np.flatnonzero(times)
            arrays = [pa.array(some.astype(np.int32)), pa.array(times[some]), *(pa.array(total[some, k]) for k in range(WIDE))]
            yield pa.RecordBatch.from_arrays(arrays, ["row", "n", *columns])

        summed = shards.training.mapInArrow(changes, schema).groupBy("row").agg(F.sum("n").alias("n"), *[F.sum(c).alias(c) for c in columns])
        found = summed.toArrow()
        common.destroy()
        at = found.column("row").to_numpy()
        change = np.zeros((size + len(_packed(m, names)), WIDE))
        change[at] = np.stack([found.column(c).to_numpy() for c in columns], axis=1) / EXACT / found.column("n").to_numpy()[:, None]
        after, flat, offset = {"embedding": m["embedding"] + change[:size]}, (_packed(m, names) + change[size:]).ravel(), 0
        for k in names:
            after[k] = flat[offset : offset + m[k].size].reshape(m[k].shape)
            offset += m[k].size
        m = after
    return m


def logit_counts(shards: Shards, logits: Callable, schema: str) -> pa.Table:
    """Number ``n`` of calibrating rows by ``step`` of their logits and the other columns of ``schema``; ``logits`` works on Arrow batches."""
    found = shards.calibrating.mapInArrow(logits, schema)
    return found.groupBy(*found.columns).agg(F.count(F.lit(1)).alias("n")).toArrow()


def logit_steps(values: np.ndarray) -> pa.Array:
    return pa.array(np.rint(np.clip(values, -1e5, 1e5) * LOGIT_STEPS).astype(np.int32))


class Adam:
    """Gradients are arrays, or (rows, their gradients) where all other rows stay as they are."""

    def __init__(self, params: dict[str, np.ndarray], rate: float):
        self.params, self.rate, self.step = params, rate, 0
        self.first = {k: np.zeros_like(v) for k, v in params.items()}
        self.second = {k: np.zeros_like(v) for k, v in params.items()}

    def update(self, grads: dict[str, np.ndarray]) -> None:
        self.step += 1
        scale = self.rate * np.sqrt(1 - 0.999**self.step) / (1 - 0.9**self.step)
        for k, g in grads.items():
            at, g = g if isinstance(g, tuple) else (..., g)
            self.first[k][at] += 0.1 * (g - self.first[k][at])
            self.second[k][at] += 0.001 * (g * g - self.second[k][at])
            self.params[k][at] -= scale * self.first[k][at] / (np.sqrt(self.second[k][at]) + 1e-7)


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def product(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    """x @ w with the terms of every row added up in the same order, so that a row's result doesn't depend on the other rows."""
    out = x[:, :1] * w[0]
    for k in range(1, len(w)):
        out += x[:, k : k + 1] * w[k]
    return out


def best_threshold(logits: np.ndarray, labels: np.ndarray, counts: np.ndarray) -> float:
    """The middle of the gap between two logits that gives the highest mean of both classes' accuracy; a logit occurs ``counts`` times."""
    order = np.lexsort((labels, logits))
    x, y, n = logits[order], labels[order], counts[order]
    below_bad = np.concatenate([[0], np.cumsum(n * (y == 0))]) / max(1, n[y == 0].sum())
    above_good = 1 - np.concatenate([[0], np.cumsum(n * (y == 1))]) / max(1, n[y == 1].sum())
    gain = below_bad + above_good
    edges = np.concatenate([[x[0] - 1], (x[1:] + x[:-1]) / 2, [x[-1] + 1]])
    allowed = np.concatenate([[True], x[1:] > x[:-1], [True]])
    best = np.flatnonzero(allowed & (gain >= gain[allowed].max() - 1e-12))
    return float(edges[best[len(best) // 2]])


def train(params: dict[str, np.ndarray], grads_of: Callable, count: int, *, rate: float, epochs: int, batch: int, seed: list[int]) -> None:
    """Shuffled minibatches; ``grads_of(numbers)`` gives the mean gradients of those documents."""
    rng, optimizer = np.random.default_rng(seed), Adam(params, rate)
    for _ in range(epochs):
        order = rng.permutation(count)
        for at in range(0, count, batch):
            optimizer.update(grads_of(order[at : at + batch]))
