"""Which cycles need work, what may be carried over, and the bounded retry of a supplement."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gustloom.functions.columns import hours_between

RETRY_DELAY_H, RETRY_MOST = 3, 1


#: The model whose supplement may be tried again.
SUPPLEMENTED = "GEFS-control"


def rows_match(seed: DataFrame) -> DataFrame:
    """(model, run): the one run that all of a model's seed rows have; models with several or unparseable runs are left out."""
    held = seed.groupBy("model").agg(F.min("run").alias("run"), F.max("run").alias("high"), F.bool_or(F.col("run").isNull()).alias("broken"))
    return held.where((F.col("run") == F.col("high")) & ~F.col("broken")).select("model", "run")


def plan(discovered: DataFrame, archived: DataFrame, latest: DataFrame, seed: DataFrame, retries: DataFrame, now: Column) -> DataFrame:
    """(model, run, action, reason). Inputs: discovered (model, run, and maybe probe_error), archived (model, run), latest (model, run, complete), seed rows (model, run), retries (model, run, state, attempts, not_before, and maybe maximum_attempts).

    A cycle with all three proofs is carried over, or its supplement tried again where the model has one and it's due.
    Anything less is fetched, and the reason lists the proofs that are missing; so is a model whose probe failed.
    """
    a = archived.select("model", "run").distinct().withColumn("archived", F.lit(True))
    b = latest.where("complete").select("model", "run").distinct().withColumn("current", F.lit(True))
    c = rows_match(seed).withColumn("seeded", F.lit(True))
    d = retries.where(F.col("model").cast("string") == SUPPLEMENTED).select("model", "run", due(F.col("state"), F.col("attempts"), F.col("not_before"), now, F.col("maximum_attempts") if "maximum_attempts" in retries.columns else RETRY_MOST).alias("retry"))
    keys = ["model", "run"]
    joined = discovered.join(a, keys, "left").join(b, keys, "left").join(c, keys, "left").join(d, keys, "left").na.fill(False, ["archived", "current", "seeded", "retry"])
    failed = F.col("probe_error").isNotNull() if "probe_error" in discovered.columns else F.lit(False)
    missing = F.concat_ws("_", *(F.when(~F.col(c), n) for c, n in (("archived", "private_cycle_evidence"), ("current", "latest_success_source"), ("seeded", "seed_payload_rows"))))
    reason = (
        F.when(failed, "provider_cycle_probe_failed_fail_open").when(F.col("run").isNull(), "probe_not_run_fail_open").when(missing != "", F.concat(F.lit("fetch_fail_open_missing_"), missing))
        .when(F.col("retry"), "archived_cycle_has_due_bounded_pgrb2b_retry").otherwise("selected_cycle_already_archived")
    )
    action = F.when(reason == "selected_cycle_already_archived", "carry_forward").when(reason == "archived_cycle_has_due_bounded_pgrb2b_retry", "supplemental_retry").otherwise("fetch")
    return joined.select("model", "run", action.alias("action"), reason.alias("reason"))


def due(state: Column, attempts: Column, not_before: Column, now: Column, most: Column | int = RETRY_MOST) -> Column:
    """Whether a supplement may be tried again; ``most``: the attempts that its own state allows, RETRY_MOST where it says nothing."""
    return F.coalesce((state == "pending") & (attempts < F.coalesce(most if isinstance(most, Column) else F.lit(most), F.lit(RETRY_MOST))) & (now >= not_before), F.lit(False))


def next_retry(state: Column, attempts: Column, missing: Column, tried: Column, now: Column) -> Column:
    """(state, attempts, not_before) after a run: not_needed, pending (three hours on), complete or exhausted."""
    count = F.coalesce(attempts, F.lit(0)) + F.when(tried, 1).otherwise(0)
    word = F.when(missing == 0, F.when(count > 0, "complete").otherwise("not_needed")).when(count >= RETRY_MOST, "exhausted").otherwise("pending")
    return F.struct(word.alias("state"), count.alias("attempts"), F.when(word == "pending", now + F.make_dt_interval(hours=F.lit(RETRY_DELAY_H))).alias("not_before"))


def has_work(plans: DataFrame) -> DataFrame:
    """Whether a plan leaves anything to transfer."""
    return plans.agg(F.coalesce(F.bool_or(F.col("action") != "carry_forward"), F.lit(False)).alias("work"))


def settled(available: Column, run: Column, now: Column, seconds: int = 600) -> Column:
    """A provider's run is old enough to be read, and begins on a three-hour mark."""
    return (hours_between(available, now) * 3600 >= seconds) & (F.hour(run) % 3 == 0)


def stable(before: Column, after: Column, keys: list[str]) -> Column:
    out = F.lit(True)
    for k in keys:
        out = out & before[k].eqNullSafe(after[k])
    return out
