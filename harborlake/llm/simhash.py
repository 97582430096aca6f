"""SimHash near-duplicates: fingerprints, pigeonhole blocks, Hamming verification, components.

A fingerprint is cut into ``max_bits + 2`` blocks of bits. Two fingerprints that differ in at most
``max_bits`` bits agree in two blocks at least, so all links are found among fingerprints with equal
bits in some pair of blocks. Each bucket of equal blocks gives a spanning forest of its links, not
all of its pairs: a fingerprint that is already reached is not compared again. Buckets above
``members`` fingerprints are cut into parts that meet two at a time, in a group each.

Equal fingerprints are one node; documents without words have fingerprint zero and are linked like
any other. Every row of the input gives one row; rows without a doc_id get a fingerprint and the
smallest doc_id of the others they are linked to, null if there is none. A bit that half of the shingles set is zero. An empty
table gives no rows, a text is read whole by one task, and columns besides doc_id and text are never read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from harborlake.llm.common import encoded, slices, smallest_reachable, spaced_words, stored, texts

SEED = 42
BITS = 64
BUCKET_MEMBERS = 8192
_STEP = 1 << 16


def fingerprint(text: bytes, shingle_words: int) -> int:
    """Majority of the bits of the hashes of all word shingles, repeats included."""
    words = spaced_words(text)
    if not words:
        return 0
    joined = b" ".join(words)
    ends = list(accumulate((len(w) + 1 for w in words)))
    starts = [0, *ends[:-1]]
    last = ends[min(shingle_words, len(words)) - 1 :]
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a : b - 1], SEED) for a, b in zip(starts, last)], dtype=">u8")
    votes = np.zeros(BITS, dtype=np.int64)
    for at in range(0, len(hashes), _STEP):
        some = hashes[at : at + _STEP]
        votes += np.unpackbits(some.view(np.uint8).reshape(len(some), 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(votes * 2 > len(hashes)).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle_words: int = 3) -> DataFrame:
    """(doc_id, bits): the fingerprint as a signed 64-bit number."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = [fingerprint(t, shingle_words) for t in encoded(batch.column("text"))]
            bits = np.array(found, dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(bits)], ["doc_id", "bits"])

    rows = texts(docs).withColumn("doc_id", F.col("doc_id").cast("long"))
    return rows.mapInArrow(of, "doc_id long, bits long")


def _block_keys(max_bits: int) -> list[Column]:
    """For each pair of blocks, the bits of both."""
    edges = [BITS * i // (max_bits + 2) for i in range(max_bits + 3)]
    masks = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(edges, edges[1:])]
    signed = [int(np.array([a | b], dtype=np.uint64).view(np.int64)[0]) for a, b in combinations(masks, 2)]
    return [F.struct(F.lit(n).alias("blocks"), F.col("bits").bitwiseAND(F.lit(m)).alias("key")) for n, m in enumerate(signed)]


def forest(members: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """Links that connect all of ``members`` (unsigned) that chains of links of at most ``max_bits`` connect."""
    edges, rest = [], members
    while len(rest) > 1:
        reached, rest = [rest[0]], rest[1:]
        while reached and len(rest):
            x = reached.pop()
            near = np.bitwise_count(rest ^ x) <= max_bits
            found = rest[near]
            edges.extend((x, y) for y in found)
            reached.extend(found)
            rest = rest[~near]
    return edges


def links(bits: DataFrame, max_bits: int = 3, members: int = BUCKET_MEMBERS) -> DataFrame:
    """Links (a, b) between distinct fingerprints ``bits`` that keep everything connected that is within ``max_bits``."""
    rows = bits.select("bits", F.inline(F.array(*_block_keys(max_bits))))
    sizes = rows.groupBy("blocks", "key").agg(F.count("*").alias("size")).where("size > 1")
    rows = rows.join(sizes, ["blocks", "key"]).withColumn("parts", F.ceil(F.col("size") / members).cast("int"))
    own = F.pmod(F.xxhash64("bits"), F.col("parts")).cast("int")
    others = F.transform(F.sequence(F.lit(0), F.col("parts") - 1), lambda i: F.struct(F.least(i, own).alias("i"), F.greatest(i, own).alias("j")))
    one = F.array(F.struct(F.lit(0).alias("i"), F.lit(0).alias("j")))
    buckets = (
        rows.select("blocks", "key", "bits", F.inline(F.when(F.col("parts") == 1, one).otherwise(others)))
        .groupBy("blocks", "key", "i", "j")
        .agg(F.collect_list("bits").alias("members"))
        .select("members")
    )

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column, pairs = batch.column("members"), []
            values = np.asarray(column.flatten()).view(np.uint64)
            ends = np.cumsum(np.asarray(pa.compute.list_value_length(column)))
            for a, b in zip([0, *ends[:-1]], ends):
                if b - a == 2:
                    if int(values[a] ^ values[a + 1]).bit_count() <= max_bits:
                        pairs.append((values[a], values[a + 1]))
                else:
                    pairs.extend(forest(values[a:b], max_bits))
            found = np.array(pairs, dtype=np.uint64).reshape(-1, 2).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(found[:, 0]), pa.array(found[:, 1])], ["a", "b"])

    return buckets.mapInArrow(compared, "a long, b long").distinct()


def near_groups(docs: DataFrame, *, shingle_words: int = 3, max_bits: int = 3, members: int = BUCKET_MEMBERS) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id (smallest doc_id reachable)."""
    marks = stored(fingerprints(docs, shingle_words), "simhashes")
    nodes = stored(marks.groupBy("bits").agg(F.min("doc_id").alias("first")), "nodes")
    edges = links(nodes.select("bits"), max_bits, members)
    groups = smallest_reachable(edges).withColumnRenamed("node", "bits")
    labels = nodes.join(groups, "bits", "left").withColumn("component", F.coalesce("component", "bits"))
    first = labels.groupBy("component").agg(F.min("first").alias("component_id"))
    labels = labels.join(first, "component").select("bits", "component_id")
    return marks.join(labels, "bits").select(
        "doc_id", F.lpad(F.lower(F.hex("bits")), 16, "0").alias("fingerprint"), "component_id"
    )
