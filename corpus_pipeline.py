"""Corpus pipeline: quality classifier, exact dedup, SimHash near-dedup, benchmark decontamination, BPE.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as Parquet and read again as the
next stage's documents. All but the last return the columns of `documents`. Each stage keeps every column and all
rows that its operator does not reject; the last adds the token ids and the check of their decoding.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanlight.llm import bpe, decontaminate, exact_dedup, quality, simhash
from spanlight.llm.common import small_batches, table, written

KEPT_PIECES = 300_000  # a worker of the last stage holds some 100 MB of pieces less than by default


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return exact_dedup.dedup(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return simhash.near_dedup(docs)


def without_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids (packed, little-endian), round_trip: whether decoding gives back the text."""
    small_batches(spark)
    ranks = bpe.rank_file(spark)
    return docs.select("doc_id", bpe.encode(F.col("text"), ranks, checked=True, kept=KEPT_PIECES).alias("e")).select(
        "doc_id", "e.n_tokens", "e.ids", "e.round_trip")


STAGES = [
    ("quality classifier", good_quality),
    ("exact dedup", without_copies),
    ("SimHash near-dedup", without_near_copies),
    ("benchmark decontamination", without_benchmarks),
    ("byte-level BPE", encoded),
]

# The classifier and the tokenizer cannot be stated in SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
