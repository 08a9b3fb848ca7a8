"""Sharding by extendible hashing.

A directory is indexed by the leading bits of a key's hash. A bucket that holds more bytes than a shard
may have splits on its next bit, and only such buckets do; the leaves are the shards.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gustloom.llm.common import Workspace, text_of

#: Hash bits of a key; rows that still share a bucket after these go on with bits of a hash of their own.
KEY_BITS = 60
#: Most bits that one round looks at: its directory has at most so many entries.
ROUND_BITS = 20
#: Directory entries that may be broadcast (a few MB).
BROADCAST_ENTRIES = 1 << 16
SHARD_BYTES = 64 << 20


def key_hash(key: Column) -> Column:
    """The first 60 bits of the key's MD5; a null key hashes as the empty string."""
    return F.conv(F.substring(F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary")), 1, 15), 16, 10).cast("long")


def prefix(hashed: Column, bits: int | Column) -> Column:
    """The leading ``bits`` of a 60-bit hash."""
    return F.call_function("shiftright", hashed, F.lit(KEY_BITS) - (F.lit(bits) if isinstance(bits, int) else bits))


def extendible_shards(docs: DataFrame, key_col: str = "doc_id", text_col: str = "text", shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """One row per input row: key, n_bytes, shard (the bucket's bits, '' for the root), depth, shard_bytes, shard_docs, oversize.

    n_bytes is the text's UTF-8 length; a null text has 0. Rows with the same key share a bucket until the key's
    60 bits are used up; then a hash of key and row splits them. A single text over the limit is a shard of its
    own, marked oversize. An empty table gives no rows.
    """
    spark = docs.sparkSession
    work = Workspace(spark, "shards")
    rows = docs.select(F.col(key_col).alias("key"), F.octet_length(text_of(text_col)).cast("long").alias("n_bytes")).withColumn("h", key_hash(F.col("key")))
    # The texts are read once, for their sizes; all rounds work on these slim rows.
    rows = work.table("rows", rows.withColumn("head", F.lit("")))
    done, used = [], 0
    total = rows.agg(F.sum("n_bytes")).first()[0] or 0
    while True:
        bits = min(ROUND_BITS, KEY_BITS - used, max(4, math.ceil(math.log2(max(1, total / shard_bytes))) + 4))
        entries = _directory(rows, used, bits, shard_bytes)
        directory = work.table(f"directory{len(done)}", entries)
        n, open_bytes = directory.agg(F.count(F.lit(1)), F.sum(F.when(~F.col("closed"), F.col("shard_bytes")))).first()
        small = F.broadcast if n <= BROADCAST_ENTRIES else (lambda x: x)
        marked = rows.withColumn("entry", _entry(used, bits)).join(small(directory), ["head", "entry"])
        done.append(marked.where("closed"))
        if not open_bytes:
            break
        rows, total, used = marked.where("not closed").select("key", "n_bytes", "h", F.concat("head", "bits").alias("head")), open_bytes, used + bits
        if used >= KEY_BITS:
            # The key's own bits are used up: from here on every row has a hash of its own, fixed by the written table.
            unique = F.concat_ws(":", F.coalesce(F.col("key").cast("string"), F.lit("")), F.monotonically_increasing_id())
            rows, used = work.table(f"rows{len(done)}", rows.withColumn("h", key_hash(unique))), 0
            done.append(_alone(rows, shard_bytes))
            rows = rows.where(F.col("n_bytes") <= shard_bytes)
    out = done[0].select(*_columns())
    for part in done[1:]:
        out = out.unionByName(part.select(*_columns()))
    return out.withColumnRenamed("key", key_col)


def _columns() -> list:
    shard = F.concat("head", "bits")
    return ["key", "n_bytes", shard.alias("shard"), F.length(shard).alias("depth"), "shard_bytes", "shard_docs", "oversize"]


def _entry(used: int, bits: int) -> Column:
    return prefix(F.col("h"), used + bits).bitwiseAND(F.lit((1 << bits) - 1))


def _directory(rows: DataFrame, used: int, bits: int, limit: int) -> DataFrame:
    """For each entry of ``bits`` more bits under each open bucket: the shallowest bucket above it that fits, or the entry itself, not closed."""
    cells = rows.groupBy("head", _entry(used, bits).alias("entry")).agg(F.sum("n_bytes").alias("b"), F.count(F.lit(1)).alias("c"), F.max("n_bytes").alias("m"))
    above = F.call_function("shiftright", F.col("entry"), F.lit(bits) - F.col("depth"))
    levels = cells.select("*", F.explode(F.sequence(F.lit(0), F.lit(bits))).alias("depth")).withColumn("bucket", above)
    totals = levels.groupBy("head", "depth", "bucket").agg(F.sum("b").alias("shard_bytes"), F.sum("c").alias("shard_docs"))
    fits = levels.select("head", "entry", "depth", "bucket").join(totals, ["head", "depth", "bucket"]).where((F.col("shard_bytes") <= limit) | (F.col("shard_docs") == 1) | (F.col("depth") == bits))
    best = fits.groupBy("head", "entry").agg(F.min(F.struct("depth", "bucket", "shard_bytes", "shard_docs")).alias("x")).select("head", "entry", "x.*")
    text = F.when(F.col("depth") == 0, "").otherwise(F.expr("lpad(bin(bucket), depth, '0')"))
    closed = (F.col("shard_bytes") <= limit) | (F.col("shard_docs") == 1)
    return best.select("head", "entry", text.alias("bits"), "shard_bytes", "shard_docs", closed.alias("closed"), (F.col("shard_bytes") > limit).alias("oversize"))


def _alone(rows: DataFrame, limit: int) -> DataFrame:
    """Texts over the limit under a key whose bits are used up: each is a shard by its own hash."""
    over = rows.where(F.col("n_bytes") > limit)
    return over.withColumn("bits", F.expr("lpad(bin(h), 60, '0')")).withColumns({"shard_bytes": F.col("n_bytes"), "shard_docs": F.lit(1).cast("long"), "oversize": F.lit(True)})


def oracle_sql(shard_bytes: int = SHARD_BYTES, depths: int = 16) -> str:
    """The same directory in DuckDB, level by level, for tables that ``depths`` bits split far enough."""
    return f"""
    WITH d AS (SELECT doc_id, strlen(coalesce(text, '')) AS n_bytes, ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS h FROM documents),
    l AS (SELECT d.*, x.depth, h >> (60 - x.depth) AS bucket FROM d, (SELECT unnest(range({depths + 1}))::INT AS depth) x),
    t AS (SELECT depth, bucket, sum(n_bytes)::BIGINT AS shard_bytes, count(*) AS shard_docs FROM l GROUP BY ALL),
    f AS (SELECT doc_id, n_bytes, t.* FROM l JOIN t USING (depth, bucket) WHERE shard_bytes <= {shard_bytes} OR shard_docs = 1)
    SELECT doc_id, n_bytes::BIGINT AS n_bytes, CASE WHEN depth = 0 THEN '' ELSE right(lpad(bin(bucket), 60, '0'), depth) END AS shard, depth::INT AS depth,
           shard_bytes, shard_docs, shard_bytes > {shard_bytes} AS oversize
    FROM f QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY depth) = 1"""
