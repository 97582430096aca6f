"""The operators on the driver's tables, one query each, with the columns their contracts name."""

from __future__ import annotations

import zlib

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from harborlake.llm import bpe, line_dedup, periods, pii, prefix_trie
from harborlake.llm.common import table
from harborlake.llm.contamination import contamination
from harborlake.llm.exact_dedup import exact_groups
from harborlake.llm.licences import licence_labels
from harborlake.llm.mixing import model_scores
from harborlake.llm.quality import quality_scores
from harborlake.llm.secrets import secret_spans
from harborlake.llm.simhash import near_groups
from harborlake.llm.toxicity import toxicity_scores

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def op1_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return model_scores(table(spark, sf_dir, "documents"))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), threshold=0.7)


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(bpe.encode_and_decode(table(spark, sf_dir, "documents"), TOKENIZER))


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digests(pii.personal_data(table(spark, sf_dir, "documents")))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_groups(table(spark, sf_dir, "documents"), shingle_words=3, max_bits=3)


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), window=13)


def op7_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licence_labels(table(spark, sf_dir, "documents"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), threshold=0.3)


def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_spans(table(spark, sf_dir, "documents"))


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(table(spark, sf_dir, "documents")).select(
        "doc_id", "keep_id", "group_size", "kept", "text_sha256"
    )


def op11_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.digests(line_dedup.without_shared_lines(table(spark, sf_dir, "documents"), min_docs=10, min_chars=1))


def repeating_tail(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """What the contract of op12 makes of the words of a document: in a tenth of them, the last words repeat some of them."""
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is None or h % 10 or not words:
        return words
    n, g = len(words), h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


def op12_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periods.digests(periods.periodic_runs(table(spark, sf_dir, "documents"), rewrite=repeating_tail))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    shared = F.crc32(F.col("conv_id").cast("string")) % 6
    return prefix_trie.prefix_trie(prefix_trie.sequences(table(spark, sf_dir, "conversations"), shared_turns=shared))


QUERIES = {
    "op1_lm_score": op1_lm_score,
    "op2_quality": op2_quality,
    "op3_bpe": op3_bpe,
    "op4_pii": op4_pii,
    "op5_simhash": op5_simhash,
    "op6_decontamination": op6_decontamination,
    "op7_licences": op7_licences,
    "op8_toxicity": op8_toxicity,
    "op9_secrets": op9_secrets,
    "op10_exact_dedup": op10_exact_dedup,
    "op11_line_dedup": op11_line_dedup,
    "op12_periods": op12_periods,
    "op13_prefix_trie": op13_prefix_trie,
}
