"""Toxicity by a convolutional classifier of hashed words.

Words are hashed to trained embeddings; filters of several widths slide over all of them and the
strongest response of each filter anywhere in the text is kept (max pooling) and scored. All labelled
rows outside the held-out fold are learned from, in shards whose changes are averaged (``learn.rounds``). Thresholds are calibrated by language, where the language
is told from the words of the text: the stated ``lang`` is not read. A score is shifted so that its
language's threshold is THRESHOLD.

A trained model is rounded to whole numbers so small that all their sums are exact, and scores are added up in one order, so
a document's score doesn't depend on the documents beside it, the partitions or a task that runs again.

A document without words has the responses of padding alone. Without labels of both classes every score
is 0.5 - nothing was learned - and nothing is predicted or removed. Repeated rows and null doc_ids keep a row each; an empty table
gives none. Of several labels of a doc_id the largest counts. Told languages are German, English, Spanish and French; all others
share a threshold, and scripts without blanks have one word a sentence. Columns besides doc_id and text are never read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from harborlake.llm.common import encoded, fold, plain_words, slices, texts
from harborlake.llm.learn import FOLDS, HELD_OUT, LOGIT_STEPS, ROUNDS, Shards, best_threshold, by_shard, logit_counts, logit_steps, product, rounds, sigmoid, train

BUCKETS = 1 << 17
DIMENSIONS = 16
FILTERS = 12
WIDTHS = (1, 2, 3)
THRESHOLD = 0.3
PADS = max(WIDTHS)
PLACES = 1 << 13  # of windows that responses are held of
CHANCE = 2.5
BATCH, EPOCHS, LEAST_STEPS = 64, 6, 60  # few rows are gone through more often
ORDINARY = 4096  # rows; standard errors of more are as large as of so many, so that a model's numbers stay in their range
BEGINNING = 4  # bytes of a word
STEPS, LARGEST = 1 << 14, 1 << 21  # of a rounded model: whole numbers to one, and their bound, so that sums stay below 2**53

# Frequent short words by which a language is told.
FUNCTION_WORDS = {
    "de": "der die und das ist mit von dem den nicht ein eine zu auf im",
    "en": "the of and to in is that it was for on are as with by",
    "es": "el los las que una por del con para se su como al lo y",
    "fr": "le les des et une est pour dans au ce qui sur avec du pas",
}
LANGUAGES = sorted(FUNCTION_WORDS)


def _telling() -> dict[bytes, int]:
    return {w.encode(): n for n, lang in enumerate(LANGUAGES) for w in FUNCTION_WORDS[lang].split()}


def word_ids(words: list[bytes]) -> np.ndarray:
    """Two buckets a word: of the whole word and of its beginning, which unseen forms share with known ones."""
    whole = np.fromiter(map(zlib.crc32, words), dtype=np.int64, count=len(words))
    beginning = np.fromiter((zlib.crc32(w[:BEGINNING], 1) for w in words), dtype=np.int64, count=len(words))
    return np.stack([whole, beginning], axis=1) % BUCKETS


def language(words: list[bytes], telling: dict[bytes, int]) -> int:
    """Number of the language most of whose frequent words occur; one past the last for none."""
    votes = [0] * (len(LANGUAGES) + 1)
    for w in words:
        if w in telling:
            votes[telling[w]] += 1
    best = max(votes)
    return votes.index(best) if best else len(LANGUAGES)


def responses(m: dict, ids: np.ndarray) -> dict[int, np.ndarray]:
    """Of each width, the responses of its filters at every place of padded buckets."""
    x = (m["embedding"][ids[:, 0]] + m["embedding"][ids[:, 1]]).astype(np.float64)
    out = {}
    for w in WIDTHS:
        n = len(ids) - w + 1
        kernel = m[f"filters{w}"]
        out[w] = x[:n] @ kernel[0]
        for k in range(1, w):
            out[w] += x[k : k + n] @ kernel[k]
        out[w] += m[f"bias{w}"]
    return out


def logits(m: dict, docs: list[np.ndarray]) -> np.ndarray:
    """By a rounded model, of documents given as their words' buckets; each is followed by padding, so that no window holds words of two.

    Responses are made of PLACES places at a time and their maxima merged, so memory doesn't follow the number of documents or their length.
    """
    pads = np.full((PADS, 2), BUCKETS)
    ids = np.concatenate([part for d in docs for part in (d, pads)])
    counts = np.array([len(d) for d in docs])
    starts = np.cumsum(counts + PADS) - counts - PADS
    stops = starts + counts + 1
    pooled = np.full((len(docs), FILTERS * len(WIDTHS)), -np.inf)
    for low in range(0, len(ids), PLACES):
        high = low + PLACES
        a, b = np.searchsorted(stops, low, side="right"), np.searchsorted(starts, high)
        if a == b:
            continue  # padding alone
        spans = np.stack([np.maximum(starts[a:b], low), np.minimum(stops[a:b], high)], axis=1).ravel() - low
        found = [np.maximum.reduceat(r[: spans[-1]], spans[:-1], axis=0)[::2] for r in responses(m, ids[low : high + PADS - 1]).values()]
        pooled[a:b] = np.maximum(pooled[a:b], np.hstack(found))
    z = np.maximum(pooled, 0) / STEPS**2
    return product(z, m["score"][:, None])[:, 0] + m["score_bias"][0]


def rounded(m: dict) -> dict:
    """The model in whole numbers: its embedding and filters in steps, its biases in squares of steps."""

    def whole(values: np.ndarray, steps: int, largest: int) -> np.ndarray:
        return np.clip(np.rint(values * steps), -largest, largest)

    out = {"embedding": whole(m["embedding"], STEPS, LARGEST).astype(np.int32), "score": m["score"], "score_bias": m["score_bias"]}
    for w in WIDTHS:
        out[f"filters{w}"] = whole(m[f"filters{w}"], STEPS, LARGEST)
        out[f"bias{w}"] = whole(m[f"bias{w}"], STEPS**2, LARGEST**2)
    return out


def _gradients(m: dict, docs: list[np.ndarray], labels: np.ndarray, decay: float) -> dict:
    """Mean gradients of some documents; of the embedding (rows, gradients), where a filter's strongest response lies."""
    embedding, padding = m["embedding"], len(m["embedding"]) - 1
    weight = np.where(labels == 1, 0.5 / max(1, (labels == 1).sum()), 0.5 / max(1, (labels == 0).sum()))
    pads = np.full((PADS, 2), padding)
    ids = np.concatenate([part for d in docs for part in (d, pads)])
    ends = np.cumsum([len(d) + PADS for d in docs])
    spans = [(end - len(d) - PADS, end - PADS + 1) for d, end in zip(docs, ends.tolist())]
    x = embedding[ids[:, 0]] + embedding[ids[:, 1]]
    single = np.concatenate([m[f"filters{w}"][k].T for w in WIDTHS for k in range(w)]) @ x.T
    places, z, at = {}, [], 0
    for w in WIDTHS:
        n = len(ids) - w + 1
        r = sum(single[at + k * FILTERS : at + (k + 1) * FILTERS, k : k + n] for k in range(w)) + m[f"bias{w}"][:, None]
        at += w * FILTERS
        places[w] = np.stack([start + r[:, start:end].argmax(axis=1) for start, end in spans])
        z.append(r[np.arange(FILTERS), places[w]])
    z = np.maximum(np.hstack(z), 0)
    d = ((sigmoid(z @ m["score"] + m["score_bias"][0]) - labels) * weight).astype(z.dtype)
    grads = {"score": decay * m["score"] + d @ z, "score_bias": np.array([d.sum()])}
    dz = np.where(z > 0, d[:, None] * m["score"], 0)
    rows, steps = [], []
    for n, w in enumerate(WIDTHS):
        g = dz[:, n * FILTERS : (n + 1) * FILTERS]
        grads[f"bias{w}"] = decay * m[f"bias{w}"] + g.sum(axis=0)
        grads[f"filters{w}"] = decay * m[f"filters{w}"]
        doc, column = np.nonzero(g)
        for k in range(w):
            grads[f"filters{w}"][k] += np.einsum("bfd,bf->df", x[places[w] + k], g)
            own = ids[places[w][doc, column] + k]
            rows += [own[:, 0], own[:, 1]]
            steps += [g[doc, column][:, None] * m[f"filters{w}"][k].T[column]] * 2
    rows, steps = np.concatenate(rows), np.concatenate(steps)
    order = np.argsort(rows, kind="stable")
    order = order[: np.searchsorted(rows[order], padding)]  # padding stays zero
    changed, first = np.unique(rows[order], return_index=True)
    sums = np.add.reduceat(steps[order], first, axis=0) if len(first) else steps[:0]
    grads["embedding"] = changed, sums + decay * embedding[changed]
    return grads


def _distinct(numbers: np.ndarray) -> np.ndarray:
    """Different ones of some numbers from 0, sorted; here faster than ``np.unique``."""
    found = np.sort(numbers, axis=None)
    return found[np.diff(found, prepend=-1) > 0]


def _standard_errors(size: np.ndarray, present: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Between the classes, of words that ``present`` documents of each have: log odds by ``low`` witnesses of class 0 and ``high`` ones of class 1."""
    without = size[:, None] - present + 0.5  # documents with the word never count as ones without it
    odds = np.log((low[0] + 0.5) / without[0]), np.log((high[1] + 0.5) / without[1])
    return (odds[1] - odds[0]) / np.sqrt((1 / (np.maximum(low, high) + 0.5) + 1 / without).sum(axis=0))


def telling_words(rows: DataFrame) -> np.ndarray:
    """Where the first dimension of each word starts: its log odds between the classes in standard errors.

    A word counts once in each document, but no oftener than the words it follows differ: copies of
    one text, however many, are one witness. Only what exceeds CHANCE counts, so that words of one
    document start at nothing; words of none are not a number. The words before are counted of those
    words only that could exceed CHANCE by some number of witnesses.
    """

    def occurrences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, BUCKETS + 1), dtype=np.int64)
        for batch in batches:
            for own, y in zip(_ids(batch.column("ids")), batch.column("label").to_pylist()):
                total[y, _distinct(own)] += 1
        y, word = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(y.astype(np.int32)), pa.array(word.astype(np.int32)), pa.array(total[y, word])], ["label", "word", "n"])

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chosen = candidates.value
        for _, table in by_shard(batches):
            keys = [np.zeros(0, dtype=np.int64)]
            for own, y in zip(_ids(table.column("ids")), table.column("label").to_pylist()):
                before = np.concatenate([[BUCKETS], own[:-1, 0]])[: len(own)].astype(np.int64)
                keys.append((y << 50 | own.astype(np.int64) << 25 | before[:, None])[chosen[own]])
            yield pa.RecordBatch.from_arrays([pa.array(_distinct(np.concatenate(keys)))], ["key"])

    def by_word(counted: pa.Table) -> np.ndarray:
        out = np.zeros((2, BUCKETS + 1))
        out[counted.column("label").to_numpy(), counted.column("word").to_numpy()] = counted.column("n").to_numpy()
        return out

    size = np.zeros(2)
    for r in rows.groupBy("label").count().collect():
        size[r["label"]] = r["count"]
    present = by_word(rows.mapInArrow(occurrences, "label int, word int, n long").groupBy("label", "word").agg(F.sum("n").alias("n")).toArrow())
    least = np.minimum(present, 1)
    most = [_standard_errors(size, present, *ends) for ends in ((least, present), (present, least))]
    candidates = rows.sparkSession.sparkContext.broadcast(np.maximum(most[0], -most[1]) > CHANCE)
    word = F.shiftright("key", 25).bitwiseAND(F.lit((1 << 25) - 1)).cast("int")
    different = rows.mapInArrow(pairs, "key long").distinct()
    witnesses = np.minimum(present, by_word(different.groupBy(F.shiftright("key", 50).cast("int").alias("label"), word.alias("word")).agg(F.count("*").alias("n")).toArrow()))
    z = _standard_errors(size, present, witnesses, witnesses)
    z = np.where(candidates.value, np.sign(z) * np.maximum(0, np.abs(z) - CHANCE), 0) / np.sqrt(max(1, size.sum() / ORDINARY))
    return np.where(present.sum(axis=0) > 0, z, np.nan)


def _ids(column: pa.Array) -> list[np.ndarray]:
    return [np.frombuffer(i, "<i4").reshape(-1, 2) for i in column.to_pylist()]


def fit(shards: Shards, *, seed: int = 11) -> dict:
    """A model; the calibrating rows give a threshold for each language."""
    rng = np.random.default_rng(seed)
    telling = telling_words(shards.training)
    m = {"embedding": rng.normal(0, 0.02, (BUCKETS + 1, DIMENSIONS))}
    m["embedding"][:, 0] = telling
    m["embedding"][np.isnan(telling)] = 0
    for w in WIDTHS:
        m[f"filters{w}"] = rng.normal(0, (w * DIMENSIONS) ** -0.5, (w, DIMENSIONS, FILTERS))
        m[f"bias{w}"] = np.zeros(FILTERS)
    # A filter starts as a witness for the class whose telling words it answers.
    toward = np.concatenate([np.sign(m[f"filters{w}"][:, 0].sum(axis=0)) for w in WIDTHS])
    m["score"] = toward * np.abs(rng.normal(0, 0.3, FILTERS * len(WIDTHS)))
    m["score_bias"] = np.zeros(1)

    def local(common: dict, table: pa.Table, seed: list[int]) -> tuple[np.ndarray, dict]:
        docs, labels = _ids(table.column("ids")), table.column("label").to_numpy()
        own, places = np.unique(np.concatenate(docs), return_inverse=True)
        docs = np.split(places.reshape(-1, 2), np.cumsum([len(d) for d in docs])[:-1])
        m = {k: v.astype(np.float32) for k, v in common.items() if k != "embedding"}
        m["embedding"] = np.vstack([common["embedding"][own], np.zeros((1, DIMENSIONS))]).astype(np.float32)
        changed = np.zeros(len(own) + 1, dtype=bool)

        def grads_of(numbers):
            grads = _gradients(m, [docs[i] for i in numbers], labels[numbers], 1e-6)
            changed[grads["embedding"][0]] = True
            return grads

        epochs = max(EPOCHS, -(-LEAST_STEPS * BATCH // len(docs)))
        train(m, grads_of, len(docs), rate=0.01, epochs=-(-epochs // ROUNDS), batch=BATCH, seed=seed)
        return own[changed[:-1]], m | {"embedding": m["embedding"][changed]}

    m = rounded(rounds(shards, m, local, seed=seed))
    model = shards.rows.sparkSession.sparkContext.broadcast(m)

    def steps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, 64):
                part = batch.slice(a, 64)
                values = logit_steps(logits(model.value, _ids(part.column("ids"))))
                yield pa.RecordBatch.from_arrays([values, part.column("label"), part.column("language")], ["step", "label", "language"])

    found = logit_counts(shards, steps, "step int, label int, language int")
    scores, y, of, n = (found.column(c).to_numpy() for c in ("step", "label", "language", "n"))
    scores = scores / LOGIT_STEPS
    overall = best_threshold(scores, y, n)
    m["thresholds"] = np.full(len(LANGUAGES) + 1, overall)
    for k in range(len(LANGUAGES)):
        own = of == k
        positives = int(n[own & (y == 1)].sum())
        if positives and positives < n[own].sum():  # drawn to the common one where few rows speak for the language
            m["thresholds"][k] = (positives * best_threshold(scores[own], y[own], n[own]) + 20 * overall) / (positives + 20)
    return m


def _learned(docs: DataFrame, labels: DataFrame, label: str) -> dict | None:
    def featurised(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        telling = _telling()
        for batch in slices(batches):
            words = [plain_words(t) for t in encoded(batch.column("text"))]
            columns = [batch.column("doc_id"), batch.column("label")]
            columns.append(pa.array([word_ids(w).astype("<i4").tobytes() for w in words], pa.binary()))
            columns.append(pa.array([language(w, telling) for w in words], pa.int32()))
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "label", "ids", "language"])

    shards = Shards(docs, labels, label, featurised, "doc_id long, label int, ids binary, language int")
    return fit(shards) if shards.known else None


def toxicity_scores(docs: DataFrame, labels: DataFrame, *, label: str = "toxic", threshold: float = THRESHOLD, keep: list[str] | None = None) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted, language (as told from the text).

    ``keep`` names columns of ``docs`` to hand through instead of doc_id alone, for filtering without a join.
    """
    model = docs.sparkSession.sparkContext.broadcast(_learned(docs, labels, label))
    shift = float(np.log(threshold / (1 - threshold)))

    held = [n for n, f in enumerate(docs.select(*[F.col(f"`{c}`") for c in keep or []]).schema) if (f.name.lower(), f.dataType.simpleString()) == ("text", "string")]

    def with_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = batch.column(0).flatten()[held[0]]
            yield batch.append_column("text", text.fill_null("") if text.null_count else text)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, telling = model.value, _telling()
        for batch in slices(with_texts(batches) if held else batches):
            words = [plain_words(t) for t in encoded(batch.column("text"))]
            of = np.array([language(w, telling) for w in words])
            score = np.full(len(words), 0.5)
            if m is not None:
                raw = logits(m, [word_ids(w) for w in words])
                score = sigmoid(raw - m["thresholds"][of] + shift)
            predicted = (score >= threshold).astype(np.int32) if m is not None else np.zeros(len(words), np.int32)
            names = [*LANGUAGES, None]
            batch = batch.drop_columns(["text"])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(score), pa.array(predicted), pa.array([names[n] for n in of], pa.string())],
                [*batch.schema.names, "_score", "_predicted", "_language"],
            )

    if keep is None:
        rows = texts(docs)
    else:
        # rows that hold the text bring it themselves, so that it isn't sent twice
        rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("_row"), *([] if held else [F.coalesce("text", F.lit("")).alias("text")]))
    kind = rows.schema[0].dataType.simpleString()
    out = rows.mapInArrow(scored, f"{rows.columns[0]} {kind}, _score double, _predicted int, _language string")
    if keep is not None:
        return out
    return out.select(
        "doc_id",
        (fold("doc_id", FOLDS) == HELD_OUT).alias("held_out"),
        F.col("_score").alias("score"),
        F.col("_predicted").alias("predicted"),
        F.col("_language").alias("language"),
    )
