"""Runs: stretches of words that repeat themselves at a distance, found with tiles scaled to the period.

A run is a stretch of consecutive words whose smallest period q (words q apart are identical) is contained in it at least
``EXPONENT`` times, of ``LEAST`` words or more, that cannot be extended on either side. Periods are taken in octaves
[P, 2P). In the octave of P a boundary lies at every P-th word, and from what a boundary sees, every run of the octave follows:

* the words of a run that equal the word q further on are at least 3q, so at one boundary c, at most P words behind the first of
  them, 2P words or more equal those q further on. Fingerprints of windows of 2P words tell at which boundaries that may be so,
  for all boundaries and periods of an octave in one pass over the words;
* if it is so for two periods, both are multiples of a smaller one and neither is a smallest period;
* the surroundings of boundaries that are left are tiles, P words before to 5P words behind. Each tile is solved by itself,
  wherever Spark puts it: the Z-function from the boundary on gives the period (or shows that it is a multiple of a smaller one) and
  how far words equal those a period further on, up to 3P; the Z-function of what lies before gives how far they did before, up to P;
* these fragments are dealt out by document and period and stitched where they meet. Since a fragment goes beyond the next boundary
  or ends for good, the stitched stretch is the run.

A document of any length is tiled in one pass, linear in its words for each octave; its tiles spread over the cluster. Fingerprints
only choose tiles, Z-functions compare words, so a collision costs time and no run. A missing or empty text has no
words and no runs. Rows with the same doc_id and text give equal rows, every row gives one; rows without a doc_id are
documents like any other. An empty table gives no rows; columns besides doc_id and text are never read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from harborlake.llm.common import encoded, slices, stored, texts

EXPONENT, LEAST = 4, 6
SPAN = 256  # words whose boundaries share a tile, so that small periods do not give a row each
BASE = np.uint64(0x9E3779B97F4A7C15)

Rewrite = Callable[[int | None, list[bytes]], list[bytes]]

_SCANNED = "key binary, doc_id long, n_words long, sha256 string, words binary, octave int, first long, boundaries array<int>, ids binary"
_RUN = "struct<start: long, length: long, period: long>"


def z_function(x: list) -> list[int]:
    """For each place, how many items from there on equal those from the start on."""
    n = len(x)
    z, left, right = [0] * n, 0, 0
    if n:
        z[0] = n
    for i in range(1, n):
        k = min(right - i, z[i - left]) if i < right else 0
        while i + k < n and x[k] == x[i + k]:
            k += 1
        z[i] = k
        if i + k > right:
            left, right = i, i + k
    return z


def boundaries(ids: np.ndarray, counts: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(P, boundaries as places in ``ids``) for each octave, of documents with ``counts`` words that follow each other in ``ids``."""
    n = len(ids)
    mixed = (ids.astype(np.uint64) + np.uint64(1)) * np.uint64(0xBF58476D1CE4E5B9)
    mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    power = np.cumprod(np.concatenate([[np.uint64(1)], np.full(n, BASE)]), dtype=np.uint64)
    sums = np.concatenate([[np.uint64(0)], np.cumsum((mixed ^ (mixed >> np.uint64(32))) * power[:-1], dtype=np.uint64)])
    of = np.repeat(np.arange(len(counts)), counts)
    starts = np.cumsum(counts) - counts
    places, octave = np.arange(n), 1
    while True:
        places = places[counts[of[places]] >= max(LEAST, EXPONENT * octave)]
        if not len(places):
            return
        window, within = 2 * octave, places - starts[of[places]]
        there = places[(within >= octave) & (within + window <= counts[of[places]])]
        first = starts[of[there]]
        here = first + ((there - first) // octave - 1) * octave
        same = sums[there + window] - sums[there] == (sums[here + window] - sums[here]) * power[there - here]
        here, there = here[same], there[same]
        found, at, hits = np.unique(here, return_index=True, return_counts=True)
        keep = hits == 1
        for i in np.flatnonzero(~keep):  # two periods that really hold are no smallest ones
            c = found[i]
            keep[i] = any(not np.array_equal(ids[c : c + window], ids[j : j + window]) for j in there[at[i] : at[i] + 2])
        yield octave, found[keep]
        octave *= 2


def fragments(x: list[int], octave: int, at: list[int]) -> list[tuple[int, int, int]]:
    """(period, start, end) of stretches of a tile in which words equal those a period further on, seen from the boundaries ``at``."""
    found: list[tuple[int, int, int]] = []
    for c in at:
        z = z_function(x[c : c + 5 * octave])
        q = next((q for q in range(octave, min(2 * octave, len(z))) if z[q] >= 2 * octave), None)
        if q is None or any(z[p] + p >= q + 2 * octave for p in range(1, q)):
            continue
        before = x[max(0, c - octave) : c][::-1]
        z_before = z_function([*before, None, *x[max(0, c - octave) : c + q][::-1]])
        start, end = c - (z_before[len(before) + 1] if before else 0), c + min(z[q], 3 * octave)
        if found and found[-1][0] == q and found[-1][2] >= start:
            found[-1] = (q, min(start, found[-1][1]), max(end, found[-1][2]))
        else:
            found.append((q, start, end))
    return found


def _scan(rewrite: Rewrite | None) -> Callable:
    names = [part.split()[0] for part in _SCANNED.split(", ")]
    kinds = [pa.binary(), pa.int64(), pa.int64(), pa.string(), pa.binary(), pa.int32(), pa.int64(), pa.list_(pa.int32()), pa.binary()]

    def rows_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            doc_ids, keys, per_doc, words = batch.column("doc_id").to_pylist(), [], [], []
            for doc_id, text in zip(doc_ids, encoded(batch.column("text"))):
                own = text.split()
                keys.append(hashlib.blake2b(b"%s %s" % (str(doc_id).encode(), text), digest_size=16).digest())
                own = rewrite(doc_id, own) if rewrite else own
                per_doc.append(own)
                words.extend(own)
            counts = np.array([len(own) for own in per_doc], dtype=np.int64)
            starts = np.cumsum(counts) - counts
            ids = pa.array(words, pa.binary()).dictionary_encode().indices.to_numpy(zero_copy_only=False)
            tiled, rows = set(), []
            for octave, found in boundaries(ids, counts):
                documents = np.searchsorted(starts, found, side="right") - 1
                within = found - starts[documents]
                spans = within // max(SPAN, octave)
                cuts = np.flatnonzero((np.diff(documents) != 0) | (np.diff(spans) != 0)) + 1 if len(found) else []
                for at, number in zip(np.split(within, cuts), documents[np.concatenate([[0], cuts]).astype(int)] if len(found) else ()):
                    first, end = max(0, at[0] - octave), min(counts[number], at[-1] + 5 * octave)
                    tile = ids[starts[number] + first : starts[number] + end]
                    rows.append((keys[number], None, None, None, None, octave, first, at - first, tile.astype("<i4").tobytes()))
                    tiled.add(int(number))
                    if len(rows) == 4096:
                        yield rows_of(rows)
                        rows = []
            for number, own in enumerate(per_doc):
                plain = b" ".join(own)
                sha = hashlib.sha256(plain).hexdigest()
                rows.append((keys[number], doc_ids[number], len(own), sha, plain if number in tiled else None, None, None, None, None))
            if rows:
                yield rows_of(rows)

    return scan


def _solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [
            (key, q, first + start, first + end)
            for key, octave, first, at, ids in zip(*(batch.column(c).to_pylist() for c in ("key", "octave", "first", "boundaries", "ids")))
            for q, start, end in fragments(np.frombuffer(ids, "<i4").tolist(), octave, at)
        ]
        columns = [pa.array([f[i] for f in found], pa.binary() if i == 0 else pa.int64()) for i in range(4)]
        yield pa.RecordBatch.from_arrays(columns, ["key", "period", "first", "end"])


def _collapse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices([batch.rename_columns(["text" if n == "words" else n for n in batch.schema.names])]):
            out = []
            for text, runs in zip(encoded(part.column("text")), part.column("runs").to_pylist()):
                words = text.split()
                stays = np.ones(len(words), dtype=bool)
                for run in runs:
                    stays[run["start"] + run["period"] : run["start"] + run["length"]] = False
                out.append(b" ".join(words[i] for i in np.flatnonzero(stays)))
            collapsed = pa.array([t.decode() for t in out], pa.string())
            sha = pa.array([hashlib.sha256(t).hexdigest() for t in out], pa.string())
            same = [part.column(n) for n in ("doc_id", "n_words", "runs")]
            yield pa.RecordBatch.from_arrays([*same, collapsed, sha], ["doc_id", "n_words", "runs", "collapsed", "collapsed_sha256"])


def stitched(pieces: DataFrame) -> DataFrame:
    """(key, start, length, period): fragments (key, period, first, end) that meet made one, and those kept that are long enough."""
    order = Window.partitionBy("key", "period").orderBy("first", "end")
    before = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    marked = pieces.withColumn("gap", F.when(F.col("first") <= before, 0).otherwise(1))
    numbered = marked.withColumn("stretch", F.sum("gap").over(order))
    whole = numbered.groupBy("key", "period", "stretch").agg(F.min("first").alias("start"), F.max("end").alias("end"))
    length = F.col("end") - F.col("start") + F.col("period")
    runs = whole.select("key", "start", length.alias("length"), "period")
    return runs.where(F.col("length") >= F.greatest(F.lit(LEAST), EXPONENT * F.col("period")))


def periodic_runs(docs: DataFrame, *, rewrite: Rewrite | None = None) -> DataFrame:
    """Per row: doc_id, n_words, runs (start, length, period; by start, then period), collapsed, collapsed_sha256.

    ``collapsed`` is the text less all words of a run after its first period, joined by one blank; it is
    null for texts without a run, which stay as they are, and its digest is always there. ``rewrite`` may change the
    words of a document before they are searched, given its doc_id.
    """
    rows = texts(docs).withColumn("doc_id", F.col("doc_id").cast("long"))
    scanned = stored(rows.mapInArrow(_scan(rewrite), _SCANNED), "tiles")
    tiles = scanned.where("ids is not null").select("key", "octave", "first", "boundaries", "ids").repartition("key", "octave", "first")
    runs = stitched(tiles.mapInArrow(_solve, "key binary, period long, first long, end long"))
    runs = runs.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("start", "period", "length"))).alias("sorted"))
    in_order = F.transform("sorted", lambda r: F.struct(r.start.alias("start"), r.length.alias("length"), r.period.alias("period")))

    whole = scanned.where("sha256 is not null")
    clean = whole.where("words is null").select("doc_id", "n_words", "sha256")
    found = whole.where("words is not null").join(runs.select("key", in_order.alias("runs")), "key", "left")
    clean = clean.unionByName(found.where("runs is null").select("doc_id", "n_words", "sha256"))
    clean = clean.select("doc_id", "n_words", F.array().cast(f"array<{_RUN}>").alias("runs"), F.lit(None).cast("string").alias("collapsed"), F.col("sha256").alias("collapsed_sha256"))
    found = found.where("runs is not null").select("doc_id", "n_words", "words", "runs")
    return clean.unionByName(found.mapInArrow(_collapse, f"doc_id long, n_words long, runs array<{_RUN}>, collapsed string, collapsed_sha256 string"))


def digests(found: DataFrame) -> DataFrame:
    """The columns of the contract: the run of the greatest exact exponent, and digests."""
    first = F.get("runs", F.lit(0))
    best = F.aggregate("runs", first, lambda a, b: F.when(b.length * a.period > a.length * b.period, b).otherwise(a))
    lines = F.transform("runs", lambda r: F.format_string("%d,%d,%d\n", r.start, r.length, r.period))
    return found.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        "collapsed_sha256",
    )
