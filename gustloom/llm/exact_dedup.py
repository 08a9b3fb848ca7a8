"""Exact deduplication with disk-backed streaming state.

A log of (digest, stable identifier, content locator), one slim row per document, is streamed into a
keyed state in RocksDB. The state has no expiry: each digest keeps its largest identifier, that row's
locator and the number of rows. Digests that were hit more than once are then checked on their full
bytes; texts that differ under one digest are grouped by their bytes instead.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gustloom.llm.common import Workspace, settings, text_of

#: Digests with hits that the byte check may broadcast (32 bytes each); beyond it, a shuffle of all rows' digests finds their texts.
BROADCAST_HITS = 200_000
#: Log rows for each state partition: an instance of RocksDB takes several MB of disk however little it holds.
STATE_ROWS = 50_000


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def _locator(docs: DataFrame) -> Column | None:
    """File and row of a Parquet scan; None where the rows come from elsewhere."""
    try:
        docs.select("_metadata.file_path", "_metadata.row_index")
    except Exception as error:  # analysis only: the scan has no such columns
        if "UNRESOLVED" not in str(error) and "FIELD_NOT_FOUND" not in str(error):
            raise
        return None
    return F.concat(F.col("_metadata.file_path"), F.lit("#"), F.col("_metadata.row_index"))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", digest=sha256, files_per_batch: int = 1000) -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, text_sha256, digest, locator, keep_locator.

    Texts are equal when their bytes are; null counts as empty. The row with the largest id stays. Null ids
    sort below all others. Of rows with the same id and text, one stays: exactly one ``kept`` per group.
    An empty table gives no rows. Other columns are not read, so their names can't clash.
    """
    spark = docs.sparkSession
    work = Workspace(spark, "exact")
    text = text_of(text_col)
    row = F.monotonically_increasing_id()
    place = _locator(docs)
    log = work.table("log", docs.select(F.col(id_col).alias("id"), row.alias("row"), digest(text).alias("digest"), (F.concat(F.lit("row#"), row) if place is None else place).alias("locator")))
    state = _stream_state(log, work, files_per_batch)

    hits = state.where("group_size > 1").select("digest")
    texts = docs.select(digest(text).alias("digest"), text.alias("text"))
    texts = texts.join(F.broadcast(hits) if hits.count() <= BROADCAST_HITS else hits, "digest", "left_semi")
    # Equal bytes under a digest: its least text is its greatest. Partial aggregates combine a hot group before the shuffle.
    unequal = work.table("unequal", texts.groupBy("digest").agg(F.min("text").alias("least"), F.max("text").alias("most")).where("least <> most").select("digest"))
    if unequal.isEmpty():
        marked = log.join(state, "digest").select("id", "row", "digest", "locator", "keeper", "group_size")
    else:
        marked = log.join(unequal, "digest", "left_anti").join(state, "digest").select("id", "row", "digest", "locator", "keeper", "group_size").unionByName(_by_bytes(docs, log, unequal, id_col, text, digest))
    kept = F.col("row") == F.col("keeper.row")
    return marked.select(
        F.col("id").alias(id_col), F.col("keeper.id").alias("keep_id"), "group_size", kept.alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"), "locator", F.col("keeper.locator").alias("keep_locator"),
    )


def _stream_state(log: DataFrame, work: Workspace, files_per_batch: int) -> DataFrame:
    """Stream the log into the keyed state; the last update of each digest is its state."""
    spark, updates = log.sparkSession, work.path("updates")
    keeper = F.max(F.struct("id", "row", "locator")).alias("keeper")

    def save(batch: DataFrame, number: int) -> None:  # by number: a batch run again replaces itself
        batch.write.mode("overwrite").parquet(f"{updates}/batch={number}")

    schema = log.groupBy("digest").agg(keeper, F.count(F.lit(1)).alias("group_size")).schema
    partitions = max(1, min(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-log.count() // STATE_ROWS)))
    with settings(
        spark,
        spark__sql__streaming__internal__stateStore__partitions=partitions,
        spark__sql__streaming__stateStore__providerClass="org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        spark__sql__streaming__stateStore__rocksdb__changelogCheckpointing__enabled="true",
        spark__sql__streaming__stateStore__rocksdb__boundedMemoryUsage="true",
        spark__sql__streaming__stateStore__rocksdb__maxMemoryUsageMB="200",
    ):
        query = (
            spark.readStream.schema(log.schema).option("maxFilesPerTrigger", files_per_batch).parquet(work.path("log"))
            .groupBy("digest").agg(keeper, F.count(F.lit(1)).alias("group_size"))
            .writeStream.outputMode("update").option("checkpointLocation", work.path("state"))
            .trigger(availableNow=True).foreachBatch(save).start()
        )
        query.awaitTermination()
    spark.createDataFrame([], schema).write.mode("overwrite").parquet(f"{updates}/batch=-1")
    work.drop("state")
    last = spark.read.schema(schema).parquet(updates).groupBy("digest").agg(F.max("keeper").alias("keeper"), F.max("group_size").alias("group_size"))
    table = work.table("last", last)  # as a table: a join with it can split the rows of a hot digest
    work.drop("updates")
    return table


def _by_bytes(docs: DataFrame, log: DataFrame, unequal: DataFrame, id_col: str, text: Column, digest) -> DataFrame:
    """The exact way for digests that different texts share: group their rows by the bytes themselves."""
    texts = docs.select(F.col(id_col).alias("id"), digest(text).alias("digest"), text.alias("text")).join(unequal, "digest", "left_semi")
    pairs = texts.groupBy("digest", "text", "id").agg(F.count(F.lit(1)).alias("copies"))
    groups = pairs.groupBy("digest", "text").agg(F.max("id").alias("keep"), F.sum("copies").alias("group_size"))
    copies = pairs.join(groups, ["digest", "text"]).withColumn("row", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    places = log.join(unequal, "digest", "left_semi").groupBy("digest", F.col("id").alias("at")).agg(F.min("locator").alias("locator"))
    keeper = F.struct(F.col("keep").alias("id"), F.when(F.col("id").eqNullSafe(F.col("keep")), 1).otherwise(0).cast("long").alias("row"), F.lit(None).cast("string").alias("locator"))
    return copies.join(places.withColumnRenamed("digest", "of"), (F.col("digest") == F.col("of")) & F.col("id").eqNullSafe(F.col("at"))).select("id", "row", "digest", "locator", keeper.alias("keeper"), "group_size")
