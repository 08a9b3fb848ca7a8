"""Shared-folder tables, scoped settings and Arrow helpers of the llm operators."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type


def shared_dir(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``; a temporary one only on a local master where it is unset."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if base:
        return base.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    base = "file://" + tempfile.mkdtemp(prefix="gustloom-")
    spark.conf.set("spark.checkpoint.dir", base)
    spark.sparkContext.setCheckpointDir(base)
    return base


class Workspace:
    """Tables of one operator run in the shared folder. A written table cuts lineage and survives lost executors."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{shared_dir(spark)}/gustloom-{name}-{uuid.uuid4().hex}"
        atexit.register(self.drop)

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def table(self, name: str, df: DataFrame) -> DataFrame:
        """Write ``df`` as Parquet and read it again."""
        df.write.mode("overwrite").parquet(self.path(name))
        return self.spark.read.schema(df.schema).parquet(self.path(name))

    def drop(self, *names: str) -> None:
        """Delete tables that no later result reads, or all of them; a stopped session leaves the folder to its owner."""
        if self.spark._jsc is None or self.spark.sparkContext._jsc is None:
            return
        for place in map(self.path, names) if names else (self.root,):
            path = self.spark._jvm.org.apache.hadoop.fs.Path(place)
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def settings(spark: SparkSession, **conf: str) -> Iterator[None]:
    """Set SQL settings for a block; ``__`` stands for dots."""
    keys = {k.replace("__", "."): str(v) for k, v in conf.items()}
    before = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def text_of(column: str = "text"):
    """The text, with null as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def arrow_type(df: DataFrame, column: str) -> pa.DataType:
    """The Arrow type of a column of any type, for batches that carry its values back."""
    return to_arrow_type(df.schema[column].dataType)


def chunks(texts: list[str], limit: int = 1_000_000) -> Iterator[tuple[int, int]]:
    """Ranges of a batch's rows that hold about ``limit`` characters; a longer text is a range of its own."""
    start, size = 0, 0
    for i, text in enumerate(texts):
        if size and size + len(text) > limit:
            yield start, i
            start, size = i, 0
        size += len(text)
    if start < len(texts):
        yield start, len(texts)


def map_arrow(df: DataFrame, function, schema: str) -> DataFrame:
    """mapInArrow() over small batches. The settings stay with the session: the plan reads them when it runs.

    A worker holds a batch as Arrow and as Python objects, and the next one while it lets go of the last.
    """
    for key, value in (("spark.sql.execution.arrow.maxRecordsPerBatch", "1000"), ("spark.sql.execution.arrow.maxBytesPerBatch", "8m")):
        df.sparkSession.conf.set(key, value)
    return df.mapInArrow(function, schema)


def rows_of(batches: Iterable[pa.RecordBatch], *columns: str, limit: int = 1_000_000) -> Iterator[tuple[list, ...]]:
    """The named columns of Arrow batches as lists, dealt in ranges of bounded text; the last column is the text."""
    for batch in batches:
        lists = [batch.column(batch.schema.get_field_index(c)).to_pylist() for c in columns]
        lists[-1] = [t or "" for t in lists[-1]]
        for start, end in chunks(lists[-1], limit):
            yield tuple(x[start:end] for x in lists)


class Lately:
    """What a worker has worked out, by key, in two generations: keys that were met lately outlive those that weren't."""

    def __init__(self, limit: int):
        self.young, self.old, self.half = {}, {}, max(1, limit // 2)

    def of(self, keys: list, learn: Callable[[list], list]) -> list:
        """The values of distinct keys; ``learn`` gives those of keys that aren't known."""
        out = list(map(self.young.get, keys))
        missed = [k for k, v in zip(keys, out) if v is None]
        if not missed:
            return out
        found = {k: v for k in missed if (v := self.old.get(k)) is not None}
        new = [k for k in missed if k not in found]
        if new:
            found.update(zip(new, learn(new)))
        for i, v in enumerate(out):
            if v is None:
                out[i] = found[keys[i]]
        if new:
            for k in new:
                if len(k) > 64:
                    del found[k]
        self.young.update(found)
        if len(self.young) > self.half:
            self.old, self.young = self.young, {}
        return out
