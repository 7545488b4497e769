"""From raw documents to packed sequences: each stage works on all that the one before it kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from martlet.llm import decontaminate, line_dedup, packing, quality_rules, simhash
from martlet.llm.common import land
from martlet.sources.tables import read_table

def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules. A text that is null, empty or without words has too few words and goes; each row is rated by itself,
    so repeated rows and other columns do not matter. No documents give none."""
    return quality_rules.keep_good(docs)


def line_deduped(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the later copies of repeated runs of lines and of repeated lines of 20 words and more.

    No row is lost: a text all of whose lines are later copies goes on as an empty one, a null stays null, and `n_chars` counts what is left.
    """
    return line_dedup.without_repeats(docs, line_words=20)


def near_deduped(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: the one with the smallest id, null last, ties by the whole row; of repeated rows one
    stays. Null, empty and emptied texts share fingerprint zero, so one of them stays."""
    return simhash.simhash_dedup(docs, shingle=3, distance=2)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no window of the benchmark occurs. A null or empty text has no words and stays; so does everything if the benchmark
    is empty or has no words."""
    return decontaminate.keep_clean(docs, read_table(spark, sf_dir, "benchmark"), width=10)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of documents in sequences of at most 1024 tokens, as rows of `op8_packing`. A null or empty text is its end id alone."""
    return packing.packing_digest(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality rules", good),
    ("line dedup", line_deduped),
    ("simhash near-dedup", near_deduped),
    ("benchmark decontamination", decontaminated),
    ("packing", packed),
]
# Fingerprints and token ids are beyond DuckDB SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number + 1 < len(STAGES):
            docs = land(docs, f"pipeline-{number}")
    return docs
