"""What the operators on texts share: reading, folds, slicing of Arrow batches, stored tables, components."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from harborlake.sinks import scratch_path

SLICE_BYTES = 2 << 20

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# Letters become lower case, bytes that are neither letters, digits nor part of a longer UTF-8 character a blank.
PLAIN_WORDS = bytes(
    ord(chr(b).lower()) if chr(b).isalnum() and b < 128 else b if b >= 128 else 32 for b in range(256)
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(docs: DataFrame) -> DataFrame:
    """Identity and text of each document; other columns are never read, a missing text is empty."""
    return docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"))


IDENTITY = ("doc_id", "t", "u")


def identity() -> list[Column]:
    """What tells rows of ``texts`` apart: doc_id and a hash of the text, 128 bits. Rows that are alike in it have equal results."""
    return [F.col("doc_id"), F.xxhash64("text").alias("t"), F.xxhash64(F.lit("text"), F.col("text")).alias("u")]


def same_text(left: str = "l", right: str = "r") -> Column:
    """Join condition of two tables with the columns of ``identity``, null doc_ids included."""
    pairs = [(F.col(f"{left}.{c}"), F.col(f"{right}.{c}")) for c in IDENTITY]
    return pairs[0][0].eqNullSafe(pairs[0][1]) & (pairs[1][0] == pairs[1][1]) & (pairs[2][0] == pairs[2][1])


def fold(doc_id: Column | str, folds: int) -> Column:
    """crc32 of the identity as text, modulo ``folds``; a missing identity counts as an empty text."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return (F.crc32(F.coalesce(column.cast("string"), F.lit(""))) % folds).cast("int")


def stored(df: DataFrame, name: str, **options: object) -> DataFrame:
    """Write to the shared folder and read again: later jobs start there, whatever executors are lost."""
    path = scratch_path(df.sparkSession, name)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


HEAVY = 4096  # keys that are broadcast: each holds more than 1/4096 of the rows, so there are not more of them


def join_spread(rows: DataFrame, side: DataFrame, key: list[str], weight: str, total: int) -> DataFrame:
    """Inner join with a table of one row per key, whose ``weight`` says how many of the ``total`` rows have that key.

    Keys with more than 1/HEAVY of all rows are broadcast, so no task gets all rows of a hot key; the others are joined as usual.
    ``rows`` and ``side`` are read twice. The weight is dropped.
    """
    hot = F.broadcast(side.where(F.col(weight) > total / HEAVY).drop(weight))
    rest = rows.join(hot.select(*key), key, "left_anti").join(side.where(F.col(weight) <= total / HEAVY).drop(weight), key)
    return rows.join(hot, key).unionByName(rest)


class Rows:
    """Rows told apart by a number, so that decisions on them reach those without a doc_id and those that share one.

    A doc_id that one row has is its number. Rows without a doc_id and rows that share one get a number for each different pair of doc_id
    and text, below all doc_ids; only these pairs are written. Rows that are alike in both have one number.
    """

    def __init__(self, docs: DataFrame):
        self.columns = docs.columns
        row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
        rows = docs.select(row, F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
        ids = rows.groupBy("doc_id").agg(F.count("*").alias("n"))
        shared = stored(ids.where("doc_id is not null and n > 1").select("doc_id"), "shared_ids")
        least = rows.agg(F.min("doc_id")).first()[0] or 0
        self.known = rows.where("doc_id is not null").join(shared, "doc_id", "left_anti")
        odd = rows.where("doc_id is null").unionByName(rows.join(shared, "doc_id", "left_semi"))
        self.odd = odd.select("row", "text", *identity())
        numbers = self.odd.select(*IDENTITY).distinct().withColumn("number", F.lit(least - 1) - F.monotonically_increasing_id())
        self.numbers = stored(numbers, "numbers")

    def _numbered(self, once: bool) -> DataFrame:
        odd = self.odd.dropDuplicates(list(IDENTITY)) if once else self.odd
        return odd.alias("l").join(self.numbers.alias("r"), same_text()).select("l.row", "l.text", "r.number")

    def documents(self) -> DataFrame:
        """(doc_id: the number, text), one row for each number."""
        return self.known.select("doc_id", "text").union(self._numbered(True).select("number", "text"))

    def first_of_each(self, groups: DataFrame) -> DataFrame:
        """(number): of each of ``groups`` (doc_id: a number, group), the row with the smallest doc_id, one without if there is no other."""
        own = self.numbers.select("number", F.col("doc_id").alias("own"))
        named = groups.join(own, groups["doc_id"] == own["number"], "left")
        true = F.when(F.col("number").isNull(), groups["doc_id"]).otherwise(F.col("own"))
        order = F.struct(true.isNull().alias("without"), true.alias("id"), groups["doc_id"].alias("number"))
        return named.groupBy("group").agg(F.min(order).alias("first")).select("first.number")

    def kept(self, numbers: DataFrame, *, once: bool) -> DataFrame:
        """The rows with these numbers, of rows that share one all or just one (``once``)."""
        chosen = numbers.select(F.col("number").alias("chosen"))
        known = self.known.join(chosen, F.col("doc_id") == F.col("chosen"), "left_semi").select("row.*")
        return known.union(self._numbered(once).join(chosen, F.col("number") == F.col("chosen"), "left_semi").select("row.*"))

    def without(self, numbers: DataFrame) -> DataFrame:
        """The rows with other numbers than these."""
        gone = numbers.select(F.col("number").alias("gone"))
        known = self.known.join(gone, F.col("doc_id") == F.col("gone"), "left_anti").select("row.*")
        return known.union(self._numbered(False).join(gone, F.col("number") == F.col("gone"), "left_anti").select("row.*"))


def slices(batches: Iterator[pa.RecordBatch], limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut record batches with a ``text`` column so that each slice has about ``limit`` bytes of text, one row at least."""
    for batch in batches:
        offset, size = 0, 0
        for at, n in enumerate(pa.compute.binary_length(batch.column("text")).to_pylist()):
            if size and size + n > limit:
                yield batch.slice(offset, at - offset)
                offset, size = at, 0
            size += n
        if offset < batch.num_rows:
            yield batch.slice(offset)


def encoded(column: pa.Array) -> list[bytes]:
    return column.cast(pa.binary()).to_pylist()


def plain_words(text: bytes) -> list[bytes]:
    """Words of ASCII letters and digits in lower case and of all other characters beyond ASCII."""
    return text.translate(PLAIN_WORDS).split()


def spaced_words(text: bytes) -> list[bytes]:
    """Words between white space, A-Z in lower case."""
    return text.lower().split()


def smallest_reachable(edges: DataFrame) -> DataFrame:
    """(node, component) for all nodes of the edges (a, b): the smallest node that can be reached.

    Alternates the two star operations: each node's larger neighbours, then its smaller ones, are
    linked to its smallest neighbour, until the edges no longer change. Every round is one
    aggregation and one join per operation on the edges alone and is stored.
    """
    links = stored(
        edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links"
    )
    before = None
    while True:
        both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("low"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("low").alias("v"))
        large = large.where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("low"))
        small = large.join(low, "u")
        small = small.select("u", F.col("low").alias("v")).union(
            small.where("v <> low").select(F.col("v").alias("u"), F.col("low").alias("v"))
        )
        links = stored(small.distinct(), "links")
        state = links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    return links.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        links.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
