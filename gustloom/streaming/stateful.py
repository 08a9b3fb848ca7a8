"""Keyed state over streams: bounded retries with a timer, and first-wins writes that detect conflicts.

Both keep one small value a key in RocksDB and are independent of how rows are dealt into batches, of restarts, and (as
said below) of their order.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery
from pyspark.sql.types import LongType, StructField, StructType

from gustloom.operators.gate import RETRY_DELAY_H, RETRY_MOST
from gustloom.streaming.folders import settings

_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _ddl(schema: StructType, columns: list[str]) -> str:
    return ", ".join(f"`{c}` {schema[c].dataType.simpleString()}" for c in columns)


class _Retry(StatefulProcessor):
    """What next_retry() gives over all attempts of a key in order of time, whatever order they arrive in."""

    def __init__(self, key: list[str], most: int, delay_us: int):
        self.row, self.most, self.delay_us = Row(*key, "kind", "state", "attempts", "not_before_us", "at_us"), most, delay_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("retry", "attempts int, at_us long, missing int, timer_ms long")

    def _word(self, attempts: int, missing: int) -> str:
        if not missing:
            return "complete" if attempts else "not_needed"
        return "exhausted" if attempts >= self.most else "pending"

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        attempts, at, missing, timer = self.state.get() or (0, None, 0, None)
        for r in rows:  # the count and the newest row are all that counts, so that a late row fits in
            attempts += bool(r["tried"])
            if at is None or (r["at_us"], r["missing"]) > (at, missing):
                at, missing = r["at_us"], r["missing"]
        if timer is not None:
            self.handle.deleteTimer(timer)
            timer = None
        word, due = self._word(attempts, missing), False
        not_before = at + self.delay_us if word == "pending" else None
        if not_before is not None:
            timer = -(-not_before // 1000)
            due = timer <= timerValues.getCurrentWatermarkInMs()
            if due:
                timer = None
            else:
                self.handle.registerTimer(timer)
        self.state.update((attempts, at, missing, timer))
        yield self.row(*key, "state", word, attempts, not_before, at)
        if due:
            yield self.row(*key, "due", word, attempts, not_before, at)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        attempts, at, missing, _ = self.state.get()
        self.state.update((attempts, at, missing, None))
        yield self.row(*key, "due", "pending", attempts, at + self.delay_us, at)

    def close(self) -> None:
        pass


def retries(attempts: DataFrame, key: list[str], time: str = "at", lateness: str = "6 hours", most: int = RETRY_MOST, delay_hours: int = RETRY_DELAY_H) -> DataFrame:
    """A stream of attempts (key, ``time``, missing, tried) as a stream of (key, kind, state, attempts, not_before, at).

    Rows of kind ``state`` say how a key stands after a batch; the newest is its state. It equals the fold of
    next_retry() over the key's attempts in order of time; of attempts at one time the one that misses most is the last.
    A row of kind ``due`` comes once the watermark has reached not_before and nothing was tried since: the supplement may
    be tried again. Rows later than the watermark are dropped by Spark: ``lateness`` bounds how late one may be.
    """
    rows = attempts.withWatermark(time, lateness)
    timed = rows.select(*key, F.col(time), F.unix_micros(F.col(time).cast("timestamp")).alias("at_us"), F.coalesce(F.col("missing").cast("int"), F.lit(0)).alias("missing"), F.coalesce("tried", F.lit(False)).alias("tried"))
    out = _ddl(attempts.schema, key) + ", kind string, state string, attempts int, not_before_us long, at_us long"
    states = timed.groupBy(*key).transformWithState(_Retry(key, most, delay_hours * 3_600_000_000), out, "Update", "EventTime")
    return states.select(*key, "kind", "state", "attempts", F.timestamp_micros("not_before_us").alias("not_before"), F.timestamp_micros("at_us").alias("at"))


class _First(StatefulProcessor):
    row = Row("path", "outcome", "sha256", "kept_sha256", "at_us")

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.kept = handle.getValueState("kept", "sha256 string")
        self.refused = handle.getMapState("refused", "sha256 string", "at_us long")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        first: dict[str, int] = {}  # of each content, however many rows bring it
        for r in rows:
            at = first.get(r["sha256"])
            if at is None or r["at_us"] < at:
                first[r["sha256"]] = r["at_us"]
        kept = self.kept.get()
        order = sorted((at, sha) for sha, at in first.items())
        if kept is None:
            at, sha = order[0]
            kept = (sha,)
            self.kept.update(kept)
            yield self.row(*key, "written", sha, sha, at)
        for at, sha in order:
            if sha != kept[0] and not self.refused.containsKey((sha,)):
                self.refused.updateValue((sha,), (at,))
                yield self.row(*key, "conflict", sha, kept[0], at)

    def close(self) -> None:
        pass


def first_writes(writes: DataFrame, path: str = "path", time: str = "at") -> DataFrame:
    """A stream of writes (path, sha256, time) to immutable paths as a stream of (path, outcome, sha256, kept_sha256, at).

    The first content that arrives at a path is ``written`` (within a batch: the one of the least time, then hash). The
    same bytes again pass silently, however often; other bytes come out once as a ``conflict`` that names what was kept.
    The state has no expiry: a path never changes. It holds a hash a path, and one for each conflict.
    """
    rows = writes.select(F.col(path).alias("path"), "sha256", F.unix_micros(F.col(time).cast("timestamp")).alias("at_us"))
    out = "path string, outcome string, sha256 string, kept_sha256 string, at_us long"
    found = rows.groupBy("path").transformWithState(_First(), out, "Update", "None")
    return found.select("path", "outcome", "sha256", "kept_sha256", F.timestamp_micros("at_us").alias("at"))


def run(stream: DataFrame, checkpoint: str, out: str) -> StreamingQuery:
    """Run a stream over all that is there; each batch's rows are in a folder of its own, which a batch run again replaces."""

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch={number}")

    with settings(stream.sparkSession, spark__sql__streaming__stateStore__providerClass=_ROCKS):
        return stream.writeStream.outputMode("update").trigger(availableNow=True).option("checkpointLocation", checkpoint).foreachBatch(write).start()


def written(spark: SparkSession, out: str, schema: StructType) -> DataFrame:
    """What run() has written, with the number of its batch."""
    return spark.read.schema(StructType([*schema.fields, StructField("batch", LongType())])).parquet(out)
