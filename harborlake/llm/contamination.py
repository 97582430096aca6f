"""Benchmark decontamination with a positional inverted index of the training documents.

The index is a table of segments. A segment holds some documents: the words of each, and for each
term of the segment, in order of the terms, the positions where it stands (stored as gaps). Positions
count on through the documents of a segment with one left out between two of them, so no phrase
crosses into the next. A phrase is searched from its rarest term of the segment: its positions, less
its place in the phrase, are intersected with those of the next rarest, until none is left.

Terms, counts and gaps of a segment are one packed value, which Spark passes on as it is; what makes or
searches the segments unpacks one at a time. A row group of the stored index holds a few segments, so
a task has neither all its segments at hand when it writes them nor when it reads them.

Words are runs of ASCII letters (A-Z in lower case), digits and all characters beyond ASCII. A missing
or empty text has no words; an item without words has no window; rows of the benchmark without an
item_id are left out. Every row of ``docs`` gives one row, repeated rows and null doc_ids included; an empty table gives none, an
empty benchmark hits nothing. A document of any length lies in one segment. Columns besides the ids and texts are never read.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from harborlake.llm.common import encoded, plain_words, slices, stored, texts

WINDOW = 13
QUERY_CHARS = 8 << 20  # characters of benchmark text that are searched in one pass over the index

GROUP_SEGMENTS = 4  # segments in a row group of the stored index: what is written or read at once

_INDEX = "segment long, doc_ids array<long>, doc_words array<int>, postings binary"
_KINDS = (pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.binary())
_POSTINGS = pa.schema([("terms", pa.list_(pa.binary())), ("term_counts", pa.list_(pa.int32())), ("gaps", pa.list_(pa.int32()))])


def packed(terms: list[bytes], counts: np.ndarray, gaps: np.ndarray) -> bytes:
    """Terms of a segment, how often each occurs and the gaps between its positions, as one compressed Arrow stream."""
    row = pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip((terms, counts, gaps), _POSTINGS.types)], schema=_POSTINGS)
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, _POSTINGS, options=pa.ipc.IpcWriteOptions(compression="zstd", use_threads=False)) as stream:
        stream.write_batch(row)
    return sink.getvalue().to_pybytes()


def unpacked(postings: pa.Buffer) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """What ``packed`` was given."""
    row = pa.ipc.open_stream(postings, options=pa.ipc.IpcReadOptions(use_threads=False)).read_next_batch()
    terms, counts, gaps = (column.flatten() for column in row.columns)
    return terms, np.asarray(counts), np.asarray(gaps)


def build_index(docs: DataFrame) -> DataFrame:
    """Segments of the positional index; a document of any length is in one segment."""

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 32
        for number, batch in enumerate(slices(batches)):
            known: defaultdict[bytes, int] = defaultdict()
            known.default_factory = known.__len__
            ids, counts = [], []
            for text in encoded(batch.column("text")):
                words = plain_words(text)
                counts.append(len(words))
                ids.append(np.fromiter(map(known.__getitem__, words), dtype=np.int32, count=len(words)))
            terms = sorted(known)
            rank = np.empty(len(terms), dtype=np.int32)
            rank[np.fromiter(map(known.__getitem__, terms), dtype=np.int64, count=len(terms))] = np.arange(len(terms), dtype=np.int32)
            ids = rank[np.concatenate(ids)]
            places = np.arange(len(ids)) + np.repeat(np.arange(len(counts)), counts)
            places = np.sort(ids.astype(np.int64) << 32 | places) & 0xFFFFFFFF  # by term, then place
            per_term = np.bincount(ids, minlength=len(terms))
            gaps = np.diff(places, prepend=0)
            starts = (np.cumsum(per_term) - per_term).astype(np.int64)
            gaps[starts] = places[starts]
            row = [first + number, batch.column("doc_id").to_pylist(), counts, packed(terms, per_term, gaps)]
            names = ["segment", "doc_ids", "doc_words", "postings"]
            yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, _KINDS)], names)

    return texts(docs).withColumn("doc_id", F.col("doc_id").cast("long")).mapInArrow(segments, _INDEX)


def stored_index(docs: DataFrame) -> DataFrame:
    """The index, written in row groups of GROUP_SEGMENTS segments."""
    return stored(build_index(docs), "positional_index", **{"parquet.block.row.count.limit": GROUP_SEGMENTS})


class Phrases:
    """Windows of a block of items, ready to be looked up: term numbers by window, padded with -1."""

    def __init__(self, items: list[tuple[object, bytes]], window: int):
        known: dict[bytes, int] = {}
        rows, lengths, owners = [], [], []
        for item, text in items:
            words = [known.setdefault(w, len(known)) for w in plain_words(text)]
            for at in range(max(1, len(words) - window + 1) if words else 0):
                row = words[at : at + window]
                lengths.append(len(row))
                rows.append(row + [-1] * (window - len(row)))
                owners.append(item)
        self.terms = list(known)
        self.rows = np.array(rows, dtype=np.int32).reshape(-1, window)
        self.lengths, self.owners = lengths, owners

    @classmethod
    def of(cls, state: dict) -> Phrases:
        made = cls.__new__(cls)
        made.__dict__.update(state)
        return made

    def find(self, terms: pa.Array, counts: np.ndarray, gaps: np.ndarray, slop: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(window, first places, last places) in a segment, for windows that occur in it.

        With ``slop`` each word may stand up to so many words from where the phrase has it.
        """
        if not len(terms) or not len(self.rows):
            return
        at = pc.index_in(pa.array(self.terms, terms.type), value_set=terms).fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
        at = np.append(at, -2)
        ends = np.cumsum(counts)
        many = np.where(at >= 0, counts[at], 0)
        many[-1] = np.iinfo(np.int32).max  # the padding of short windows
        frequency = many[self.rows]
        total = np.cumsum(gaps)
        known: dict[int, np.ndarray] = {}

        def places(term: int) -> np.ndarray:
            if term not in known:
                start, end = ends[term] - counts[term], ends[term]
                known[term] = total[start:end] - (total[start - 1] if start else 0)
            return known[term]

        some = np.flatnonzero(frequency.min(axis=1) > 0)
        orders = np.argsort(frequency[some], axis=1, kind="stable")
        term_of = at[np.take_along_axis(self.rows[some], orders, axis=1)]
        for w, order, term in zip(some.tolist(), orders.tolist(), term_of.tolist()):
            order = order[: self.lengths[w]]
            rare = places(term[0]) - order[0]
            low = high = rare + order[0]
            for k, t in zip(order[1:], term[1:]):
                other = places(t)
                i = other.searchsorted(rare + k)
                after = other[np.minimum(i, len(other) - 1)] - k
                if slop:
                    before = other[np.maximum(i - 1, 0)] - k
                    best = np.where(abs(after - rare) <= abs(before - rare), after, before)
                    near = abs(best - rare) <= slop
                else:
                    best, near = after, after == rare
                rare, low, high, best = rare[near], low[near], high[near], best[near]
                if not len(rare):
                    break
                low, high = np.minimum(low, best + k), np.maximum(high, best + k)
            if len(rare):
                yield w, low, high


_MATCHES = "segment long, ordinal int, item_id string, start int, stop int"


def matches(index: DataFrame, items: DataFrame, *, window: int = WINDOW, slop: int = 0) -> DataFrame:
    """Where windows of ``items`` (item_id, text) stand in the documents of the index.

    Rows (segment, ordinal, item_id, start, stop): the document by its place in the segment and the
    words from start up to stop; adjoining and overlapping occurrences of an item are put together. The
    items are searched in blocks of about QUERY_CHARS characters, each sent to all segments.
    """
    spark = index.sparkSession
    items = items.where("item_id is not null").select(F.col("item_id").cast("string").alias("item_id"), F.coalesce("text", F.lit("")).alias("text"))
    chars = items.agg(F.sum(F.char_length("text"))).first()[0] or 0
    blocks = -(-chars // QUERY_CHARS) or 1
    found = None
    for block in range(blocks):
        rows = items.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == block).collect()
        sent = spark.sparkContext.broadcast(vars(Phrases([(r.item_id, r.text.encode()) for r in rows], window)))

        def search(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            phrases = Phrases.of(sent.value)
            for batch in batches:
                for i in range(batch.num_rows):
                    yield pa.RecordBatch.from_pylist(_in_segment(batch.slice(i, 1), phrases, slop), _ARROW)

        part = index.select("segment", "doc_words", "postings").mapInArrow(search, _MATCHES)
        found = part if found is None else found.union(part)
    return found


_ARROW = pa.schema([("segment", pa.int64()), ("ordinal", pa.int32()), ("item_id", pa.string()), ("start", pa.int32()), ("stop", pa.int32())])


def _in_segment(row: pa.RecordBatch, phrases: Phrases, slop: int) -> list[dict]:
    words = np.asarray(row.column("doc_words").flatten())
    terms, counts, gaps = unpacked(row.column("postings")[0].as_buffer())
    starts = np.cumsum(words) - words + np.arange(len(words))
    spans: dict[tuple[int, str], list[tuple[int, int]]] = {}
    for w, low, high in phrases.find(terms, counts, gaps, slop):
        docs = np.searchsorted(starts, low, side="right") - 1
        inside = high < starts[docs] + words[docs]
        for doc, a, b in zip(docs[inside].tolist(), low[inside].tolist(), high[inside].tolist()):
            spans.setdefault((doc, phrases.owners[w]), []).append((a - int(starts[doc]), b + 1 - int(starts[doc])))
    out = []
    for (doc, item), own in spans.items():
        merged: list[list[int]] = []
        for a, b in sorted(own):
            if merged and a <= merged[-1][1]:
                merged[-1][1] = max(b, merged[-1][1])
            else:
                merged.append([a, b])
        segment = row.column("segment")[0].as_py()
        out.extend({"segment": segment, "ordinal": doc, "item_id": item, "start": a, "stop": b} for a, b in merged)
    return out


def contamination(docs: DataFrame, benchmark: DataFrame, *, window: int = WINDOW) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated.

    A word inside any occurrence of a window of an item is hit; a document is contaminated if at
    least a twentieth of its words are.
    """
    index = stored_index(docs)
    hits = (
        matches(index, benchmark, window=window)
        .groupBy("segment", "ordinal")
        .agg(
            F.array_sort(F.collect_set(F.struct("start", "stop"))).alias("spans"),
            F.array_sort(F.collect_set("item_id")).alias("items"),
        )
    )
    covered = F.aggregate(
        "spans",
        F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")),
        lambda a, s: F.struct(
            (a.n + F.greatest(F.lit(0), s.stop - F.greatest(s.start, a.end))).alias("n"),
            F.greatest(a.end, s.stop).alias("end"),
        ),
        lambda a: a.n,
    )
    hits = hits.select("segment", "ordinal", covered.alias("n_hit"), "items")
    rows = index.select("segment", F.posexplode(F.arrays_zip("doc_ids", "doc_words")).alias("ordinal", "doc"))
    n_hit = F.coalesce(F.col("n_hit").cast("long"), F.lit(0).cast("long"))
    n_words = F.col("doc.doc_words").cast("long")
    items = F.coalesce("items", F.array().cast("array<string>"))
    return rows.join(hits, ["segment", "ordinal"], "left").select(
        F.col("doc.doc_ids").alias("doc_id"),
        n_words.alias("n_words"),
        n_hit.alias("n_hit"),
        F.size(items).cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", items), 256).alias("items_sha256"),
        ((n_hit > 0) & (n_hit * 20 >= n_words)).alias("contaminated"),
    )
