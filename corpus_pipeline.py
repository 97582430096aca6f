"""A corpus from documents: toxic ones go, then copies, near copies and benchmark passages; the rest is encoded.

Each stage takes (spark, docs, sf_dir) and gives a DataFrame; all but the last keep the columns of
``docs``, whatever they are called. Stages that compare documents tell rows apart by numbers (``Rows``), so their decisions
reach rows without a doc_id and rows that share one. Of a group of copies the row with the smallest doc_id stays, one
without a doc_id if there is no other. Empty tables go through all stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from harborlake.llm import bpe
from harborlake.llm.common import Rows, stored, table
from harborlake.llm.contamination import contamination
from harborlake.llm.exact_dedup import exact_groups
from harborlake.llm.queries import TOKENIZER
from harborlake.llm.simhash import near_groups
from harborlake.llm.toxicity import toxicity_scores


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier doesn't reject."""
    scored = toxicity_scores(docs, table(spark, sf_dir, "labels"), keep=docs.columns)
    return scored.where("_predicted = 0").select("_row.*")


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts: the one with the smallest doc_id."""
    rows = Rows(docs)
    groups = exact_groups(rows.documents()).select("doc_id", F.col("keep_id").alias("group"))
    return rows.kept(rows.first_of_each(groups), once=True)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one with the smallest doc_id."""
    rows = Rows(docs)
    groups = near_groups(rows.documents(), shingle_words=3, max_bits=3).select("doc_id", F.col("component_id").alias("group"))
    return rows.kept(rows.first_of_each(groups), once=True)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth are windows of benchmark items."""
    rows = Rows(docs)
    found = contamination(rows.documents(), table(spark, sf_dir, "benchmark"), window=13)
    return rows.without(found.where("contaminated").select(F.col("doc_id").alias("number")))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Numbers of tokens, and digests of the ids and of the text that they decode to."""
    return bpe.digests(bpe.encode_and_decode(docs, TOKENIZER))


STAGES = [
    ("toxicity", toxicity),
    ("exact_dedup", exact_dedup),
    ("simhash_dedup", simhash_dedup),
    ("decontamination", decontamination),
    ("bpe", encoding),
]

# Classifier, fingerprints, components and merges are beyond SQL; tests compare with plain Python instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; each one's result is written and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
