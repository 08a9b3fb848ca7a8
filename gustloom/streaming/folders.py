"""Folders that the driver and all executors share, for the input and the state of a stream that a query runs to its end."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


class Folder:
    """A new folder below ``spark.checkpoint.dir``; a temporary one only on a local master where that is unset. It goes when the driver ends."""

    def __init__(self, spark: SparkSession, name: str):
        base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
        if not base:
            if not spark.sparkContext.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
            base = "file://" + tempfile.mkdtemp(prefix="gustloom-")
            spark.conf.set("spark.checkpoint.dir", base)
        self.spark, self.root = spark, f"{base.rstrip('/')}/gustloom-{name}-{uuid.uuid4().hex}"
        atexit.register(self.drop)

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def table(self, name: str, df: DataFrame) -> DataFrame:
        """Write ``df`` as Parquet and read it again."""
        df.write.mode("overwrite").parquet(self.path(name))
        return self.spark.read.schema(df.schema).parquet(self.path(name))

    def drop(self) -> None:
        if self.spark._jsc is not None and self.spark.sparkContext._jsc is not None:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(self.root)
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def settings(spark: SparkSession, **conf: str) -> Iterator[None]:
    """Set SQL settings for a block; ``__`` stands for dots. A query keeps those that it was started with."""
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
