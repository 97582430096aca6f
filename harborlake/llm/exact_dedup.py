"""Exact duplicates by composable polynomial fingerprints.

A text is normalised (every run of white space becomes one blank) and cut into chunks whose
polynomial hashes are computed independently; the fingerprint of a whole is put together from those
of its parts by shifting the left one by the length of the right one. A part is a value of a small
monoid (length, hashes, blank at either end), so a huge document is cut into pieces that are hashed
by different tasks, and a run of white space across a cut still counts as one blank. Documents with
equal fingerprints are then compared chunk by chunk, so the result is exact whatever the hashes do.

Empty and missing texts are equal to each other. Every row gives a row of the result, repeated ones (same doc_id and text) too; of
those one stays at most. A row without a doc_id stays only if no equal text has one. Inside, such rows have the number
``NO_ID``, which is therefore no doc_id. An empty table gives no rows; columns besides doc_id and text are never read.
No task gets a whole hot group: groups that hold more than a fixed share of all rows meet their representative by broadcast.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from harborlake.llm.common import encoded, join_spread, slices, stored, texts

WHITE = rb"[\x20\x09-\x0D]+"
WHITE_SQL = r"[\x20\x09-\x0D]+"

# Two primes below 2**31, so that products fit 64 bits, and a base for each.
PRIMES = ((1 << 31) - 1, (1 << 31) - 19)
BASES = (1_000_003, 998_244_353)
NO_ID = -(1 << 63)
TOGETHER = 64  # members of a group whose chunks meet one copy of their representative's
CHUNK_BYTES = 1024
PIECE_CHARS = 1 << 20
COMPARED_CHARS = 1 << 16
FILTER_BITS = 24  # of the bitmap that keeps most texts without copies out of the comparison: 2 MB


class Part(NamedTuple):
    """A normalised stretch of text: bytes, one hash per prime, whether it begins and ends with a blank."""

    length: int
    hashes: tuple[int, ...]
    lead: bool
    trail: bool


NOTHING = Part(0, (0,) * len(PRIMES), False, False)
_BLANK = 33  # a byte counts one more than its value, so that no text is the prefix of zero


def combine(a: Part, b: Part, primes=PRIMES, bases=BASES) -> Part:
    """The part made of ``a`` followed by ``b``: associative, with NOTHING on either side."""
    if not a.length or not b.length:
        return b if not a.length else a
    length, hashes = b.length, b.hashes
    if a.trail and b.lead:  # the blank that ends a stands for both
        length -= 1
        hashes = tuple((h - _BLANK * pow(q, length, p)) % p for h, p, q in zip(hashes, primes, bases))
        if not length:
            return a
    shifted = ((h * pow(q, length, p) + g) % p for h, g, p, q in zip(a.hashes, hashes, primes, bases))
    return Part(a.length + length, tuple(shifted), a.lead, b.trail)


def normalised(text: bytes) -> bytes:
    words = text.split()
    if not words:
        return b" " if text else b""
    lead, trail = text[:1].isspace(), text[-1:].isspace()
    return b" " * lead + b" ".join(words) + b" " * trail


def _powers(primes, bases) -> list[np.ndarray]:
    out = []
    for p, q in zip(primes, bases):
        row = [1]
        for _ in range(CHUNK_BYTES - 1):
            row.append(row[-1] * q % p)
        out.append(np.array(row, dtype=np.float64))
    return out


def parts(plain: list[bytes], primes=PRIMES, bases=BASES, powers=None) -> list[Part]:
    """Parts of normalised texts; all their chunks are hashed at once."""
    powers = powers or _powers(primes, bases)
    sizes = np.array([len(t) for t in plain], dtype=np.int64)
    counts = -(-sizes // CHUNK_BYTES)
    owner = np.repeat(np.arange(len(plain)), counts)
    number = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
    lengths = np.minimum(CHUNK_BYTES, sizes[owner] - number * CHUNK_BYTES)
    chunks = []
    if len(owner):
        data = np.frombuffer(b"".join(plain), dtype=np.uint8).astype(np.float64) + 1
        ends = np.cumsum(lengths)
        exponent = np.repeat(ends, lengths) - 1 - np.arange(len(data))
        # 1024 products below 2**39 add up to less than 2**53: exact in doubles
        chunks = [np.add.reduceat(data * w[exponent], ends - lengths).astype(np.int64).tolist() for w in powers]
    shift = {n: [pow(q, n, p) for p, q in zip(primes, bases)] for n in set(lengths.tolist())}
    hashes = [[0] * len(primes) for _ in plain]
    for i, (doc, n) in enumerate(zip(owner.tolist(), lengths.tolist())):
        h, by = hashes[doc], shift[n]
        for k, p in enumerate(primes):
            h[k] = (h[k] * by[k] + chunks[k][i]) % p
    return [Part(len(t), tuple(h), t[:1] == b" ", t[-1:] == b" ") for t, h in zip(plain, hashes)]


_FINGERPRINTS = "doc_id long, length long, fingerprint long, text_sha256 string"


def _joined(hashes) -> int:
    value = 0
    for h in hashes:
        value = (value << 31 | h) & ((1 << 63) - 1)
    return value


def fingerprints(docs: DataFrame, *, primes=PRIMES, bases=BASES, piece_chars: int = PIECE_CHARS) -> DataFrame:
    """(doc_id, length, fingerprint, text_sha256) of each row of ``docs``.

    Documents of more than ``piece_chars`` characters are cut and their pieces spread over the cluster.
    """
    rows = numbered_texts(docs)
    long = F.char_length("text") > piece_chars

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = _powers(primes, bases)
        for batch in slices(batches):
            plain = [normalised(t) for t in encoded(batch.column("text"))]
            found = parts(plain, primes, bases, powers)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([f.length for f in found], pa.int64()),
                    pa.array([_joined(f.hashes) for f in found], pa.int64()),
                    pa.array([hashlib.sha256(t).hexdigest() for t in plain], pa.string()),
                ],
                ["doc_id", "length", "fingerprint", "text_sha256"],
            )

    def of_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = _powers(primes, bases)
        for batch in slices(batches):
            plain = [re.sub(WHITE, b" ", t) for t in encoded(batch.column("text"))]
            found = parts(plain, primes, bases, powers)
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c) for c in ("row", "doc_id", "piece", "text_sha256")),
                    pa.array([f.length for f in found], pa.int64()),
                    pa.array([list(f.hashes) for f in found], pa.list_(pa.int64())),
                    pa.array([f.lead for f in found], pa.bool_()),
                    pa.array([f.trail for f in found], pa.bool_()),
                ],
                ["row", "doc_id", "piece", "text_sha256", "length", "hashes", "lead", "trail"],
            )

    def put_together(group):
        """One row for each piece of a document, without its text."""
        group = group.sort_values("piece")
        total = NOTHING
        for n, h, lead, trail in zip(group["length"], group["hashes"], group["lead"], group["trail"]):
            total = combine(total, Part(int(n), tuple(int(x) for x in h), bool(lead), bool(trail)), primes, bases)
        out = group[["doc_id", "text_sha256"]].iloc[:1].copy()
        out["length"], out["fingerprint"] = total.length, _joined(total.hashes)
        return out[["doc_id", "length", "fingerprint", "text_sha256"]]

    pieces = (
        rows.where(long)
        .withColumn("row", F.monotonically_increasing_id())
        .withColumn("text_sha256", F.sha2(F.regexp_replace("text", WHITE_SQL, " "), 256))
        .select(
            "row",
            "doc_id",
            "text_sha256",
            F.posexplode(
                F.transform(
                    F.sequence(F.lit(0), F.floor((F.char_length("text") - 1) / piece_chars).cast("int")),
                    lambda i: F.substring("text", i * piece_chars + 1, F.lit(piece_chars)),
                )
            ).alias("piece", "text"),
        )
        .repartition("row", "piece")
        .mapInArrow(
            of_pieces,
            "row long, doc_id long, piece int, text_sha256 string, length long, hashes array<long>, lead boolean, trail boolean",
        )
    )
    return (
        rows.where(~long)
        .mapInArrow(whole, _FINGERPRINTS)
        .union(pieces.groupBy("row").applyInPandas(put_together, _FINGERPRINTS))
    )


def _likely(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """Rows of ``docs`` whose hashed doc_id is marked in a bitmap of all ``wanted``: these and few others.

    The bitmap has 2**FILTER_BITS bits however many are wanted, and is sent to every task.
    """

    def marks(doc_id: str) -> list[Column]:
        h = F.pmod(F.xxhash64(doc_id), F.lit(1 << FILTER_BITS))
        return [F.floor(h / 32768).alias("_part"), (h % 32768).alias("_bit")]

    bitmap = wanted.select(*marks("doc_id")).groupBy("_part").agg(F.bitmap_construct_agg("_bit").alias("_map"))
    byte = F.conv(F.hex(F.substring("_map", (F.floor(F.col("_bit") / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("long")
    marked = docs.select("*", *marks("doc_id")).join(F.broadcast(bitmap), "_part")
    bit = F.pow(F.lit(2.0), F.col("_bit") % 8).cast("long")
    return marked.where(F.floor(byte / bit) % 2 == 1).select(*docs.columns)


def _unequal(docs: DataFrame, pairs: DataFrame) -> DataFrame:
    """Those of ``pairs`` (doc_id, text_sha256, rep, rep_sha256, salts) whose texts differ in a chunk.

    The chunks of a document meet those of its representative in a join on the representative and the chunk's number, and on one of
    ``salts`` numbers, for each of which the representative's chunks are there once more: no task gets more than about
    ``TOGETHER`` members of a group.
    """
    wanted = pairs.select("doc_id").union(pairs.select("rep")).distinct()
    # merge joins at every size, so that what is shuffled follows the input and not a switch of plans
    chunks = (
        _likely(numbered_texts(docs), wanted)
        .join(wanted.hint("merge"), "doc_id")  # inner: a semi join would be pushed below the bitmap
        .withColumn("text", F.regexp_replace("text", WHITE_SQL, " "))
        .withColumn("text_sha256", F.sha2("text", 256))
        .withColumn("chunks", F.floor(F.char_length("text") / COMPARED_CHARS).cast("int"))
        .select(
            "doc_id",
            "text_sha256",
            "chunks",
            F.posexplode(
                F.transform(
                    F.sequence(F.lit(0), F.col("chunks")),
                    lambda i: F.substring("text", i * COMPARED_CHARS + 1, F.lit(COMPARED_CHARS)),
                )
            ).alias("at", "chunk"),
        )
    )
    chunks = stored(chunks, "compared_chunks")
    salt = F.pmod(F.xxhash64("doc_id", "text_sha256"), F.col("salts")).cast("int").alias("salt")
    own = chunks.join(pairs.select("doc_id", "text_sha256", "rep", "rep_sha256", salt).hint("merge"), ["doc_id", "text_sha256"])
    reps = pairs.groupBy(F.col("rep").alias("doc_id"), F.col("rep_sha256").alias("text_sha256")).agg(F.max("salts").alias("salts"))
    reps = reps.withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)))
    # a row with the doc_id and text of a representative may be there more than once
    once = chunks.dropDuplicates(["doc_id", "text_sha256", "at"]).join(reps, ["doc_id", "text_sha256"])
    kept = once.select(F.col("doc_id").alias("rep"), F.col("text_sha256").alias("rep_sha256"), "at", "salt", F.col("chunks").alias("rep_chunks"), F.col("chunk").alias("rep_chunk"))
    same = F.coalesce(F.col("chunk") == F.col("rep_chunk"), F.lit(False)) & (F.col("chunks") == F.col("rep_chunks"))
    return (
        own.join(kept, ["rep", "rep_sha256", "at", "salt"], "left")
        .groupBy("doc_id", "text_sha256")
        .agg(F.min(F.coalesce(same, F.lit(False))).alias("equal"))
        .where("not equal")
        .select("doc_id", "text_sha256")
    )


def numbered_texts(docs: DataFrame) -> DataFrame:
    """doc_id, NO_ID where it is missing, and text of each row."""
    return texts(docs).withColumn("doc_id", F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)))


def exact_groups(docs: DataFrame, *, primes=PRIMES, bases=BASES, piece_chars: int = PIECE_CHARS) -> DataFrame:
    """One row per row: doc_id, keep_id, group_size, kept, text_sha256, fingerprint, length.

    The row with the smallest doc_id of equal texts stays. Where a fingerprint is shared by texts
    that turn out to differ, those that are unlike its smallest document are grouped again among
    themselves, until every document equals the one that stands for it.
    """
    marks = fingerprints(docs, primes=primes, bases=bases, piece_chars=piece_chars)
    marks = stored(
        marks.groupBy("doc_id", "length", "fingerprint", "text_sha256").agg(F.count("*").alias("copies")),
        "fingerprints",
    )
    key, total = ["length", "fingerprint"], marks.count()
    pending, settled = marks, None
    order = F.struct((F.col("doc_id") == NO_ID).alias("without"), "doc_id", "text_sha256")
    while True:
        first = stored(pending.groupBy(*key).agg(F.min(order).alias("rep"), F.count("*").alias("members")), "representatives")
        first = first.select(*key, F.col("rep.doc_id").alias("rep"), F.col("rep.text_sha256").alias("rep_sha256"), "members")
        salts = F.ceil(F.col("members") / TOGETHER).cast("int").alias("salts")
        pairs = join_spread(pending, first.where("members > 1").select("*", salts), key, "members", total)
        pairs = stored(pairs.where("doc_id <> rep or text_sha256 <> rep_sha256"), "equal_fingerprints")
        failed = stored(_unequal(docs, pairs.select("doc_id", "text_sha256", "rep", "rep_sha256", "salts")), "unequal")
        anti = pending.join(failed, ["doc_id", "text_sha256"], "left_anti")
        done = join_spread(anti, first.withColumnsRenamed({"rep": "keep_id", "rep_sha256": "keep_sha256"}), key, "members", total)
        settled = done if settled is None else settled.unionByName(done)
        if failed.isEmpty():
            break
        pending = stored(pending.join(failed, ["doc_id", "text_sha256"], "left_semi"), "pending")
    settled = stored(settled, "groups")
    sizes = settled.groupBy("keep_id", "keep_sha256").agg(F.sum("copies").alias("group_size"), F.count("*").alias("members"))
    found = join_spread(settled, stored(sizes, "sizes"), ["keep_id", "keep_sha256"], "members", total)
    stands = (F.col("doc_id") == F.col("keep_id")) & (F.col("text_sha256") == F.col("keep_sha256"))
    found = found.withColumn("stands", stands).withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    given = [F.nullif(F.col(c), F.lit(NO_ID)).alias(c) for c in ("doc_id", "keep_id")]
    return found.select(*given, "group_size", (F.col("stands") & (F.col("copy") == 1)).alias("kept"), "text_sha256", *key[::-1])
