"""Bundles assembled from batches of cells, in any order: only the bundles that a batch touches are written again.

A cell is one field of one lead of a model. Its newest value and its newest error are kept, each with its time, so that
merging is a maximum: batches may come in any order, more than once, and again after a failure. What a merge will write is
first written beside the table. Partitions are then replaced from there; if that is cut short, the next merge or reader
that calls recover() finishes it.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gustloom.sinks.publish import Store
from gustloom.streaming.folders import settings

CELLS = "model string, lead int, field string, received struct<at: timestamp, value: double>, failed struct<at: timestamp, error: string>, path string"
COVERAGE = "model string, leads array<int>, n_leads int, max_lead int, n_received long, n_failed long, complete boolean, path string"
_KEY = ("path", "model", "lead", "field")


def cells(batch: DataFrame) -> DataFrame:
    """(path, model, lead, field, at, value, error) as cells. A row without a value is a failure, whatever its error says; of one time the greater value or text counts. Rows without a time or a name are left out."""
    rows = batch.where("path is not null and model is not null and lead is not null and field is not null and at is not null")
    got = F.when(F.col("value").isNotNull(), F.struct(F.col("at").cast("timestamp").alias("at"), F.col("value").cast("double").alias("value")))
    lost = F.when(F.col("value").isNull(), F.struct(F.col("at").cast("timestamp").alias("at"), F.coalesce("error", F.lit("no value")).alias("error")))
    return rows.select(*_KEY, got.alias("received"), lost.alias("failed"))


def _merged(rows: DataFrame) -> DataFrame:
    return rows.groupBy(*_KEY).agg(F.max("received").alias("received"), F.max("failed").alias("failed"))


def coverage(rows: DataFrame, required: list[str]) -> DataFrame:
    """Per path and model: the leads that have all required fields, how many there are, and whether all leads of the model have."""
    has = lambda f: F.max(F.when((F.col("field") == f) & F.col("received").isNotNull(), 1).otherwise(0)) == 1
    whole = F.lit(True)
    for f in required:
        whole = whole & has(f)
    by_lead = rows.groupBy("path", "model", "lead").agg(whole.alias("whole"), F.count("received").alias("r"), F.count_if(F.col("received").isNull()).alias("f"))
    leads = F.array_sort(F.collect_set(F.when(F.col("whole"), F.col("lead"))))  # a model has some hundred leads at most
    found = by_lead.groupBy("path", "model").agg(leads.alias("leads"), F.sum("r").alias("n_received"), F.sum("f").alias("n_failed"), F.bool_and("whole").alias("complete"))
    return found.select("model", "leads", F.size("leads").alias("n_leads"), F.array_max("leads").alias("max_lead"), "n_received", "n_failed", "complete", "path")


def _read(spark: SparkSession, store: Store, name: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).parquet(f"{store.root}/{name}") if store.listed(name) else spark.createDataFrame([], schema)


def merge(spark: SparkSession, out: str, batch: DataFrame, required: list[str]) -> None:
    """Merge a batch into the bundles below ``out``. One merge at a time."""
    store = Store(spark, out)
    recover(spark, out)
    pending = f"pending/{uuid.uuid4().hex}"
    new = cells(batch)
    touched = new.select("path").distinct()
    old = _read(spark, store, "cells", CELLS).join(touched, "path", "left_semi").select(*_KEY, "received", "failed")
    _merged(old.unionByName(new)).select("model", "lead", "field", "received", "failed", "path").write.parquet(f"{store.root}/{pending}/cells")
    held = spark.read.schema(CELLS).parquet(f"{store.root}/{pending}/cells")
    coverage(held, required).write.parquet(f"{store.root}/{pending}/coverage")
    store.create(f"{pending}/whole.json", {"cells": "cells"})
    recover(spark, out)


def recover(spark: SparkSession, out: str) -> int:
    """Replace the partitions of merges that were written whole and not yet put in place; forget those that weren't. How many were put in place."""
    store, done = Store(spark, out), 0
    for name, _ in store.listed("pending"):
        at = f"pending/{name}"
        if store.fs.exists(store.path(f"{at}/whole.json")):
            for table, schema in (("cells", CELLS), ("coverage", COVERAGE)):
                _replace(spark, f"{store.root}/{table}", spark.read.schema(schema).parquet(f"{store.root}/{at}/{table}"))
            done += 1
        store.fs.delete(store.path(at), True)
    return done


def _replace(spark: SparkSession, table: str, rows: DataFrame) -> None:
    """Overwrite the partitions (paths) that rows are in, and no others; a large one is written by several tasks."""
    with settings(spark, spark__sql__sources__partitionOverwriteMode="dynamic"):
        rows.hint("rebalance", "path").write.mode("overwrite").partitionBy("path").parquet(table)


def records(spark: SparkSession, out: str) -> DataFrame:
    """(path, model, lead, values, errors): the newest value of each field, and of fields that failed since, or never came, the error."""
    rows = _read(spark, Store(spark, out), "cells", CELLS)
    now_failed = F.col("failed").isNotNull() & (F.col("received").isNull() | (F.col("failed.at") > F.col("received.at")))
    pairs = lambda when, v: F.map_from_entries(F.array_sort(F.collect_list(F.when(when, F.struct("field", v)))))
    return rows.groupBy("path", "model", "lead").agg(pairs(F.col("received").isNotNull(), "received.value").alias("values"), pairs(now_failed, "failed.error").alias("errors"))


def read_coverage(spark: SparkSession, out: str) -> DataFrame:
    return _read(spark, Store(spark, out), "coverage", COVERAGE)
