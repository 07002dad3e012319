"""The registered queries of the corpus operators, each over its whole table, and their checking SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (bpe, decontaminate, exact_dedup, hard_negatives, language_id, license_scan, lm_score, packing, prefix_trie,
               quality, simhash, url_filter, warc)
from .common import crc_mod, small_batches, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def _query(name: str, sql: str | None = None):
    def keep(build):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            small_batches(spark)
            return build(spark, sf_dir)

        QUERIES[name] = run
        if sql is not None:
            ORACLE_SQL[name] = sql
        return build

    return keep


@_query("op1_simhash_near_dedup")
def _op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_groups(table(spark, sf_dir, "documents"))


@_query("op2_token_packing")
def _op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    packs = packing.pack(table(spark, sf_dir, "documents"), bpe.rank_file(spark))
    return packs.select("pack_id", "n_tokens", "doc_ids", "starts", "cu_seqlens", F.sha2("ids", 256).alias("ids_sha256"),
                        F.sha2("position_ids", 256).alias("positions_sha256"))


@_query("op3_language_id")
def _op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = crc_mod(F.col("doc_id"), 4) == 2
    found = language_id.identify(table(spark, sf_dir, "documents"), ~held_out)
    return found.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), F.col("prediction.lang").alias("lang_pred"),
                        F.col("prediction.score").alias("score"))


@_query("op4_license_scan", license_scan.sql())
def _op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(table(spark, sf_dir, "documents"))


@_query("op5_url_filter", url_filter.sql())
def _op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages"))


@_query("op6_benchmark_decontamination", decontaminate.sql())
def _op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@_query("op7_quality_classifier")
def _op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@_query("op8_byte_bpe")
def _op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = bpe.rank_file(spark)
    encoded = table(spark, sf_dir, "documents").select("doc_id", bpe.encode(F.col("text"), ranks).alias("e"))
    decoded = encoded.select("doc_id", "e", bpe.decode(F.col("e.ids"), ranks).alias("decoded"))
    return decoded.select("doc_id", F.col("e.n_tokens").alias("n_tokens"), F.sha2("e.ids", 256).alias("ids_sha256"),
                          F.sha2("decoded", 256).alias("decoded_sha256"))


@_query("op9_lm_score")
def _op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score.score(table(spark, sf_dir, "documents"), crc_mod(F.col("doc_id"), 7) == 2)


EXACT_SQL = r"""
WITH t AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents)
SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
  row_number() OVER (PARTITION BY text_sha256 ORDER BY doc_id) = 1 AS kept, text_sha256
FROM t WINDOW g AS (PARTITION BY text_sha256)"""


@_query("op10_exact_dedup", EXACT_SQL)
def _op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"))


@_query("op11_hard_negatives", hard_negatives.sql())
def _op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.col("label").cast("long")
    label = F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)
    return hard_negatives.mine(hard_negatives.stored(table(spark, sf_dir, "embeddings"), label=label), F.col("id") % 100 == 0)


@_query("op12_prefix_trie", prefix_trie.sql())
def _op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.shared_trie(table(spark, sf_dir, "conversations"))


@_query("op13_warc", warc.sql())
def _op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    back = warc.archived(table(spark, sf_dir, "pages"))
    return back.select(warc.identifier(F.col("record_id")).alias("page_id"), "payload_bytes", "payload_digest", "record_type",
                       warc.identifier(F.col("refers_to")).alias("refers_to"))
