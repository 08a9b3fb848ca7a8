"""Records of model cycles: from messages to leads, base and extension, carried metadata, small summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gustloom.functions import columns as C
from gustloom.operators import leads as L


def batch_records(messages: DataFrame, key: list[str]) -> DataFrame:
    """One record per run and lead of a file that holds many: values by short name, in message order."""
    m = messages.withColumn("lead", C.integral("step_end")).where("lead is not null")
    named = m.groupBy(*key, "run", "lead", "short_name").agg(F.array_sort(F.collect_list(F.struct("pos", "value"))).alias("held"))
    entry = F.struct(F.col("short_name").alias("key"), F.transform("held", lambda x: F.struct(x["value"].alias("value"))).alias("value"))
    out = named.groupBy(*key, "run", "lead").agg(F.map_from_entries(F.array_sort(F.collect_list(entry))).alias("values"))
    return out.withColumn("valid", C.valid_time("run", "lead"))


def one_cycle(records: DataFrame, key: list[str], run: str = "run") -> DataFrame:
    """(key, run, reject): the single cycle of each source, or why there is none."""
    held = records.groupBy(*key).agg(F.count_distinct(run).alias("n"), F.min(run).alias("one"))
    return held.select(*key, F.when(F.col("n") == 1, F.col("one")).alias("run"), F.when(F.col("n") != 1, F.concat(F.lit("expected one cycle, found "), F.col("n").cast("string"))).alias("reject"))


def extend_base(base: DataFrame, extension: DataFrame, lead: str = "lead", most: int = 48) -> DataFrame:
    """Base records up to ``most`` hours and the extension after them."""
    return base.where(F.col(lead) <= most).unionByName(extension.where(F.col(lead) > most))


def expected_leads(records: DataFrame, key: list[str]) -> DataFrame:
    """Grid leads within the compatibility horizon of each source's first record. Key must have ``model``."""
    first = records.groupBy(*key).agg(F.min_by("run", "pos").alias("run"))
    hour = F.hour("run")
    most = L.compatibility_max("model", hour)
    return first.select(*key, "run", F.filter(L.grid("model", hour), lambda x: x <= most).alias("expected"))


def max_leads(files: DataFrame, key: list[str], fields: list[str]) -> DataFrame:
    """The largest lead of each field of a cycle, one column a field. ``files``: key, field, lead."""
    return files.groupBy(*key).agg(*(F.max(F.when(F.col("field") == f, F.col("lead"))).alias(f) for f in fields))


def leads_with_error(records: DataFrame, key: list[str], product: str) -> DataFrame:
    """Leads of records whose errors (array of structs with ``product``) name a product."""
    bad = F.exists("errors", lambda e: e["product"] == product)
    return records.where(bad).groupBy(*key).agg(F.array_sort(F.collect_set("lead")).alias("leads"))


def rebound(records: DataFrame, contract: Column) -> DataFrame:
    """Carried records with the contract's fields in place of their own."""
    return records.withColumn("contract", contract)


def filter_lead_lists(sources: DataFrame, lists: list[str], allowed: str) -> DataFrame:
    """Arrays of leads cut to the allowed ones."""
    return sources.withColumns({c: F.filter(c, lambda x: F.array_contains(F.col(allowed), x)) for c in lists})


def ensemble_metadata(meta: DataFrame, keys: tuple[str, ...] = ("last_run_initialisation_time", "last_run_availability_time")) -> DataFrame:
    """Epoch seconds of a provider's metadata as instants; ``reject`` names what is missing."""
    lacking = F.filter(F.array(*(F.when(F.col(k).try_cast("long").isNull(), F.lit(k)) for k in keys)), lambda x: x.isNotNull())
    return meta.withColumns({f"{k}_utc": F.timestamp_seconds(F.col(k).try_cast("long")) for k in keys} | {"reject": F.when(F.size(lacking) > 0, F.concat(F.lit("metadata lacks "), F.array_join(lacking, ",")))})


def state_pointers(kinds: tuple[str, ...] = ("models", "svg", "wunstorf", "etnw", "secondary")) -> list[tuple[str, str, str]]:
    """(kind, pointer path, the field that has its time). Each kind has its own pointer; the batch of secondary ones has its newest receipt."""
    batch = ("transfer_receipts/secondary/latest.json", "source_generated_at_utc")
    return [(k, f"data/inbox/public_collector/{path}", field) for k in kinds for path, field in [batch if k == "secondary" else (f"integrity/{k}/latest_success.json", "generated_at_utc")]]


def older_than_latest(attempts: DataFrame, latest: DataFrame, kind: str = "kind", time: str = "generated_at") -> DataFrame:
    """Attempts with whether they are older than the pointer of their kind; without a pointer they aren't."""
    p = latest.select(F.col(kind), F.col(time).alias("_latest"))
    return attempts.join(p, kind, "left").withColumn("older_than_latest", F.coalesce(F.col(time) < F.col("_latest"), F.lit(False))).drop("_latest")


def consolidated(quality: DataFrame) -> DataFrame:
    """(path, markdown): a line per model with derived and all records, and whether all models are complete."""
    line = F.concat(F.lit("- "), "model", F.lit(": "), F.col("derived_records").cast("string"), F.lit("/"), F.col("records").cast("string"))
    lines = quality.groupBy("path").agg(F.array_sort(F.collect_list(F.struct("model", line.alias("line")))).alias("x"), F.bool_and("complete").alias("all"))
    return lines.select("path", F.concat(F.array_join(F.transform("x", lambda i: i["line"]), "\n"), F.lit("\n\nAll complete: "), F.col("all").cast("string")).alias("markdown"))
