"""Streams over landing folders: arriving bundles are audited once, observations keep the newest row of each key."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from gustloom.functions import variants as V


def audit_stream(spark: SparkSession, landing: str, checkpoint: str, audit: Callable[[DataFrame], DataFrame], out: str, files_per_batch: int = 1000) -> StreamingQuery:
    """Audit every bundle that has arrived since the checkpoint; each batch's issues replace themselves if it runs again."""
    files = spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary").option("maxFilesPerTrigger", files_per_batch).load(landing)
    bundles = files.select(F.regexp_extract("path", r"[^/]+$", 0).alias("path"), F.lit(True).alias("present"), F.sha2("content", 256).alias("sha256"), F.octet_length("content").alias("n_bytes"), F.try_parse_json(F.expr("try_validate_utf8(content)")).alias("payload"))

    def write(batch: DataFrame, number: int) -> None:
        audit(batch).write.mode("overwrite").parquet(f"{out}/batch={number}")

    return bundles.writeStream.trigger(availableNow=True).option("checkpointLocation", checkpoint).foreachBatch(write).start()


def latest_state(stream: DataFrame, key: list[str], time: str, checkpoint: str, out: str) -> StreamingQuery:
    """The newest row of each key as keyed state without expiry: a pointer that only moves forward. Ties keep the greater row."""
    rest = [c for c in stream.columns if c not in (*key, time)]
    newest = stream.groupBy(*key).agg(F.max(F.struct(time, *rest)).alias("x")).select(*key, "x.*")

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch={number}")

    return newest.writeStream.outputMode("update").trigger(availableNow=True).option("checkpointLocation", checkpoint).foreachBatch(write).start()


def window_counts(stream: DataFrame, time: str, lateness: str, size: str, key: list[str]) -> DataFrame:
    """Counts by tumbling window with a watermark for late rows."""
    return stream.withWatermark(time, lateness).groupBy(F.window(time, size), *key).agg(F.count(F.lit(1)).alias("n"))


def observation_stream(bundles: DataFrame) -> DataFrame:
    """Rows of arriving station bundles, future ones marked by the caller's clock, not by this one."""
    return bundles.select("path", F.posexplode(V.items("payload", "$.observations")).alias("pos", "row")).select("path", "pos", V.aware_instant("row", "$.time_utc").alias("time"), V.number("row", "$.wind_speed_ms").alias("wind_speed_ms"))
