"""From raw documents to packed sequences: language ID, exact dedup, near-duplicate removal, best-fit packing.

Each stage takes (spark, docs, sf_dir), works on all that the one before kept, and returns a DataFrame; all but
the last return the columns of ``documents``. Between stages the rows are written as Parquet and read again.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gustloom.llm import exact_dedup, language_id, minhash_join, packing
from gustloom.llm.common import Workspace, text_of

#: Dropped rows (16 bytes each) that may be broadcast; beyond it, a shuffle drops them.
BROADCAST_DROPPED = 1_000_000


def _without(docs: DataFrame, dropped: DataFrame, work: Workspace, **key: Column) -> DataFrame:
    """The rows of ``docs`` whose key isn't in ``dropped``; its columns are named as the key's, its values null-safe."""
    gone = work.table("dropped", dropped.distinct())
    gone = F.broadcast(gone) if gone.count() <= BROADCAST_DROPPED else gone
    same = F.lit(True)
    for name, column in key.items():
        same = same & column.eqNullSafe(gone[name])
    return docs.join(gone, same, "left_anti")


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose language is known: text likelihood and the source's prior; rows without letters or without a clear language go.

    Null and empty texts have no letters. A null source is a source of its own. Repeated rows share their fate; null ids
    are told apart by text and source. An empty table gives no rows. Other columns pass through under their own names.
    """
    rows = docs.select("doc_id", "source", "text", F.xxhash64(text_of()).alias("h"))
    found = language_id.identify(rows, language_id.train(docs), ["doc_id", "h", "source"], "text", F.col("source"), F.lit(None).cast("string"))
    dropped = found.where("rejected").select(F.col("doc_id").alias("d"), "h", F.col("source").alias("s"))
    return _without(docs, dropped, Workspace(spark, "stage-language"), d=docs["doc_id"], h=F.xxhash64(F.coalesce(docs["text"], F.lit(""))), s=docs["source"])


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each text: the one with the largest doc_id. Of rows that repeat both, any one.

    Null counts as empty, so that all rows without text leave one. A null id is less than any other. An empty table
    gives no rows. Other columns pass through.
    """
    work = Workspace(spark, "stage-exact")
    marks = work.table("marks", exact_dedup.exact_dedup(docs).select(F.col("doc_id").alias("d"), F.unhex("text_sha256").alias("h"), "kept"))
    pairs = marks.groupBy("d", "h").agg(F.max("kept").alias("kept"), F.count(F.lit(1)).alias("rows"))
    pairs = work.table("pairs", pairs.where("not kept or rows > 1"))
    text_key = F.unhex(F.sha2(F.coalesce(docs["text"], F.lit("")), 256))
    out = _without(docs, pairs.where("not kept").select("d", "h"), work, d=docs["doc_id"], h=text_key)
    repeated = pairs.where("kept").select("d", "h")
    if repeated.isEmpty():
        return out
    same = docs["doc_id"].eqNullSafe(repeated["d"]) & (text_key == repeated["h"])
    twice = docs.join(repeated, same, "left_semi").dropDuplicates(["doc_id", "text"])
    return out.join(repeated, same, "left_anti").unionByName(twice)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near-duplicates: the one with the least doc_id.

    Rows without words are linked with nothing and stay. A row with a null id stays only if no row of its group has an
    id. Rows that repeat id and text share their fate. An empty table gives no rows. Other columns pass through.
    """
    marks = minhash_join.near_duplicates(docs)
    lost = marks.where("not kept").select(F.col("doc_id").alias("d"), F.col("text_hash").alias("h"))
    return _without(docs, lost, Workspace(spark, "stage-near"), d=docs["doc_id"], h=F.xxhash64(F.coalesce(docs["text"], F.lit(""))))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in sequences, with a checksum of each piece's ids.

    A null or empty text is one piece, its end token. Rows with null or repeated ids are packed each. Only documents
    longer than a sequence are cut. An empty table gives no rows. Other columns aren't read.
    """
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), carry={"ids_crc32": F.crc32("token_ids")})


STAGES = [("language_id", identify_language), ("exact_dedup", drop_exact_copies), ("near_dedup", drop_near_copies), ("packing", pack_sequences)]

#: SQL can't express the text model, the genetic packing or the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    work = Workspace(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = work.table(name, stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
