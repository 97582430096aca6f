"""Lines that many documents share, dropped from all of them; DataFrame functions only.

A line's key is the line without white space at both ends, A-Z in lower case. Texts are split at line feeds, keys hashed
to 128 bits, and each hash is counted in how many different documents it stands. Keys of at least ``min_chars`` code
points that stand in ``min_docs`` documents or more lose all their lines everywhere; what is left of a text is put
together again in order of position.

What is shuffled:

* hashes with their document, after each task has made one row of what it holds of both: a line that a third of all
  rows share is spread by document before it is counted, and is one row per task when it is;
* hashes again, to meet the shared ones. The few hashes that hold more than 1/``HEAVY`` of all lines (so at most
  ``HEAVY`` of them, whatever the corpus) are broadcast, the others are joined, and none of those is a hot key;
* positions of dropped lines, per document, and texts once, to meet them.

A missing or empty text is one empty line. Rows of one doc_id count as one document, each with its own lines;
rows without a doc_id count as a document for each different text. Every row gives a row of the result. Very long
texts are one row each, of which shuffles hold 16 bytes a line. An empty table gives no rows; columns besides
doc_id and text are never read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from harborlake.llm.common import IDENTITY, LOWER, UPPER, identity, join_spread, same_text, stored, texts

# What is stripped from a line, and what ends it.
WHITE, LINE_END = " \t\n\x0b\x0c\r", "\n"

_HASH = ["a", "b"]


def keyed_lines(docs: DataFrame, min_chars: int = 1) -> DataFrame:
    """One row per text: its identity (doc_id, and t, u: a hash of the text), and for each line (at, a, b), null where the key is too short."""
    plain = F.translate("text", UPPER, LOWER)

    def keyed(line: Column, at: Column) -> Column:
        key = F.btrim(line, F.lit(WHITE))
        return F.when(
            F.char_length(key) >= min_chars,
            F.struct(at.alias("at"), F.xxhash64(key).alias("a"), F.xxhash64(F.lit("line"), key).alias("b")),
        )

    return texts(docs).select(*identity(), F.transform(F.split(plain, LINE_END), keyed).alias("lines"))


def shared_keys(lines: DataFrame, min_docs: int) -> DataFrame:
    """(a, b, rows): hashes that stand in at least ``min_docs`` documents, and in how many lines."""
    document = [F.col("doc_id"), *[F.when(F.col("doc_id").isNull(), F.col(c)).alias(c) for c in ("t", "u")]]
    once = lines.groupBy(*_HASH, *document).agg(F.count("*").alias("rows"))
    counted = once.groupBy(*_HASH).agg(F.count("*").alias("docs"), F.sum("rows").alias("rows"))
    return counted.where(F.col("docs") >= min_docs).select(*_HASH, "rows")


def dropped_lines(docs: DataFrame, *, min_docs: int = 10, min_chars: int = 1) -> DataFrame:
    """(doc_id, t, u, dropped): the sorted positions of dropped lines, for texts that have any."""
    keyed = stored(keyed_lines(docs, min_chars), "lines")
    lines = keyed.select(*IDENTITY, F.explode("lines").alias("line")).where("line is not null").select(*IDENTITY, "line.*")
    shared = stored(shared_keys(lines, min_docs), "shared_lines")
    total = lines.count()
    found = join_spread(lines, shared, _HASH, "rows", total)
    return found.groupBy(*IDENTITY).agg(F.array_sort(F.collect_set("at")).alias("dropped"))


def without_shared_lines(docs: DataFrame, *, min_docs: int = 10, min_chars: int = 1) -> DataFrame:
    """(doc_id, n_lines, n_dropped, text) per row: the text without lines whose key stands in ``min_docs`` documents or more."""
    whole = texts(docs).select(*identity(), F.split("text", LINE_END).alias("lines"))
    gone = dropped_lines(docs, min_docs=min_docs, min_chars=min_chars)
    met = whole.alias("l").join(gone.alias("r"), same_text(), "left").select("l.doc_id", "lines", "dropped")

    # What stays lies between two dropped lines, or between one and an end of the text: linear in the lines.
    ends = F.concat(F.array(F.lit(-1)), "dropped", F.array(F.size("lines")))
    spans = F.zip_with(
        F.slice(ends, 1, F.size("dropped") + 1),
        F.slice(ends, 2, F.size("dropped") + 1),
        lambda before, after: F.struct((before + 2).alias("first"), (after - before - 1).alias("n")),
    )
    spans = F.filter(spans, lambda span: span.n > 0)
    kept = F.flatten(F.transform(spans, lambda span: F.slice("lines", span.first, span.n)))
    return met.select(
        "doc_id",
        F.size("lines").cast("long").alias("n_lines"),
        F.when(F.col("dropped").isNull(), F.lit(0)).otherwise(F.size("dropped")).cast("long").alias("n_dropped"),
        F.array_join(F.when(F.col("dropped").isNull(), F.col("lines")).otherwise(kept), LINE_END).alias("text"),
    )


def digests(cleaned: DataFrame) -> DataFrame:
    """The columns of the contract."""
    return cleaned.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))
