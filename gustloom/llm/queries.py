"""The thin queries of the llm operators over the driver's tables, and their DuckDB forms."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers

from gustloom.llm import brown_lm, exact_dedup, filter_audit, html_render, imatch, importance, language_id, minhash_join, packing, prefix_bpe, sharding, token_counts, topk


#: The shard limit of op5's query: small enough that the small tables split too.
QUERY_SHARD = 256 << 10


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_render.visible_text(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(_documents(spark, sf_dir)).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op3_imatch_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return imatch.edited_fingerprints(_documents(spark, sf_dir))


def op4_prefix_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_bpe.digests(prefix_bpe.round_trip(_documents(spark, sf_dir), public_tokenizers.path("byte_bpe_multi_50k.tiktoken")))


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.extendible_shards(_documents(spark, sf_dir), shard_bytes=QUERY_SHARD)


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify_pages(spark.read.parquet(f"{sf_dir}/pages.parquet"), _documents(spark, sf_dir))


def op7_brown_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return brown_lm.score(_documents(spark, sf_dir))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(_documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))


def op9_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_join.near_duplicates(_documents(spark, sf_dir))


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"), carry={"ids_crc32": F.crc32("token_ids")})


def op11_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resample(_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


QUERIES = {
    f.__name__: f
    for f in (op1_html_extraction, op2_exact_dedup, op3_imatch_fingerprints, op4_prefix_bpe, op5_sharding, op6_language_id, op7_brown_lm, op8_token_counts, op9_minhash_near_dedup, op10_best_fit_packing, op11_topk_search, op12_importance_resampling, op13_filter_audit)
}

ORACLE_SQL = {
    "op2_exact_dedup": """
    SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = max(doc_id) OVER w AS kept, sha256(coalesce(text, '')) AS text_sha256
    FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))""",
    "op5_sharding": sharding.oracle_sql(QUERY_SHARD),
    "op11_topk_search": topk.ORACLE_SQL,
    "op12_importance_resampling": importance.ORACLE_SQL,
    "op13_filter_audit": filter_audit.ORACLE_SQL,
}
