"""Expected against received, relational division, roll-ups and gates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def missing(expected: DataFrame, received: DataFrame, key: list[str]) -> DataFrame:
    return expected.join(received.select(*key), key, "left_anti")


def compare(expected: DataFrame, received: DataFrame, key: list[str]) -> DataFrame:
    """Full outer: each key with whether it was expected and received."""
    e = expected.select(*key).distinct().withColumn("expected", F.lit(True))
    r = received.select(*key).distinct().withColumn("received", F.lit(True))
    return e.join(r, key, "full_outer").na.fill(False, ["expected", "received"])


def set_views(left: DataFrame, right: DataFrame, key: list[str]) -> DataFrame:
    """(op, key): distinct keys of both, of the left alone, and of either; nulls count as equal. One shuffle of distinct keys serves all three."""
    tag = lambda df, c: df.select(*key).distinct().withColumn(c, F.lit(True))
    merged = tag(left, "_l").withColumn("_r", F.lit(False)).unionByName(tag(right, "_r").withColumn("_l", F.lit(False))).groupBy(*key).agg(F.bool_or("_l").alias("_l"), F.bool_or("_r").alias("_r"))
    ops = F.array(F.lit("either"), F.when(F.col("_l") & F.col("_r"), "both"), F.when(F.col("_l") & ~F.col("_r"), "left_only"))
    return merged.select(F.explode(F.filter(ops, lambda x: x.isNotNull())).alias("op"), *key)


def distinct_points(rows: DataFrame, key: list[str], *coordinates: str, places: int = 6) -> DataFrame:
    """How many grid points each key's rows have, and whether there is more than one."""
    n = F.count_distinct(*(F.round(c, places) for c in coordinates))
    return rows.groupBy(*key).agg(n.alias("points")).withColumn("moved", F.col("points") > 1)


def newest_with_all(rows: DataFrame, group: list[str], cycle: str, part: str, parts: int, where: Column) -> DataFrame:
    """The newest cycle of each group that has all of so many distinct parts."""
    whole = rows.where(where).groupBy(*group, cycle).agg(F.countDistinct(part).alias("n")).where(F.col("n") == parts)
    return whole.groupBy(*group).agg(F.max(cycle).alias("newest")) if group else whole.agg(F.max(cycle).alias("newest"))


def severity(issues: DataFrame, key: list[str], severity_col: str = "severity") -> DataFrame:
    """Counts by severity and the status that follows."""
    n = lambda s: F.count_if(F.col(severity_col) == s)
    counted = issues.groupBy(*key).agg(n("ERROR").alias("error_count"), n("WARN").alias("warning_count"), n("INFO").alias("info_count"))
    return counted.withColumn("status", status(F.col("error_count"), F.col("warning_count")))


def status(errors: Column, warnings: Column) -> Column:
    return F.when(errors > 0, "FAIL").when(warnings > 0, "PASS_WITH_WARNINGS").otherwise("PASS")


def families(rows: DataFrame, key: list[str], family: str, good: Column, least: int = 2) -> DataFrame:
    """Distinct families with a good member, and whether they are enough."""
    n = F.count_distinct(F.when(good, F.col(family)))
    return rows.groupBy(*key).agg(n.alias("families")).withColumn("met", F.col("families") >= least)


def two_model_rules(rows: DataFrame, key: list[str], model: str, good: Column) -> DataFrame:
    """The three other counts of independent models: models, families without GEFS, families with GEFS as GFS."""
    from gustloom.functions.columns import family

    m, f = F.col(model), family(model)
    count = lambda c: F.count_distinct(F.when(good, c))
    return rows.groupBy(*key).agg((count(m) >= 2).alias("two_models"), (count(F.when(m != "GEFS-control", f)) >= 2).alias("two_families_without_gefs"), (count(f) >= 2).alias("two_families_with_gefs"))


def stage_recovery(attempts: DataFrame, key: list[str], status_col: str = "status") -> DataFrame:
    """Of each stage: recovered (a failure and a success), failed (failures only) or clean. Success in another stage masks nothing."""
    bad = F.bool_or(F.col(status_col).isin("failed", "failed_external"))
    good = F.bool_or(F.col(status_col) == "success")
    return attempts.groupBy(*key).agg(F.when(bad & good, "recovered").when(bad, "failed").otherwise("clean").alias("outcome"))


def quality(records: DataFrame, key: list[str], derived: Column, expected: Column) -> DataFrame:
    """Records and derived records; success with any derived one, completeness against an expected number."""
    return records.groupBy(*key).agg(F.count(F.lit(1)).alias("records"), F.count_if(derived).alias("derived_records")).withColumns({"success": F.col("derived_records") > 0, "complete": F.col("derived_records") >= expected})


def field_summary(fields: DataFrame, key: list[str], model: str, parameter: str, status: str, size: str, seconds: str) -> DataFrame:
    """Requested, received, missing, bytes, seconds and counts by status, by model and by parameter, in one shuffle.

    Rows are counted by model, parameter and status before the shuffle; of the few counts that are left both levels are made.
    """
    fine = fields.groupBy(*key, model, parameter, F.col(status).alias("_s")).agg(F.count(F.lit(1)).alias("_n"), F.sum(size).alias("_b"), F.sum(seconds).alias("_t"))
    level = F.explode(F.array(F.struct(F.lit(0).alias("by_model"), F.col(parameter).alias("_p")), F.struct(F.lit(1).alias("by_model"), F.lit(None).alias("_p")))).alias("_l")
    both = fine.select(*key, model, "_s", "_n", "_b", "_t", level).select(*key, model, "_l.by_model", F.col("_l._p").alias(parameter), "_s", "_n", "_b", "_t")
    got = F.coalesce(F.sum(F.when(F.col("_s") == "received", F.col("_n"))), F.lit(0)).alias("received")
    merged = both.groupBy(*key, model, parameter, "by_model", "_s").agg(F.sum("_n").alias("_n"), F.sum("_b").alias("_b"), F.sum("_t").alias("_t"))
    counts = F.map_from_entries(F.array_sort(F.collect_list(F.when(F.col("_s").isNotNull(), F.struct("_s", "_n"))))).alias("status_counts")  # an entry a status
    out = merged.groupBy(*key, model, parameter, "by_model").agg(F.sum("_n").alias("requested"), got, F.sum("_b").alias("bytes"), F.sum("_t").alias("seconds"), counts)
    return out.withColumn("missing", F.col("requested") - F.col("received"))


def probe_summary(fields: DataFrame, key: list[str], parameter: str, status: str) -> DataFrame:
    """Of each probe: how many parameters were received and weren't, and which, by name. A probe asks for a few parameters."""
    got = F.coalesce(F.col(status) == "received", F.lit(False))
    listed = lambda c: F.array_sort(F.collect_list(F.when(c, F.col(parameter))))
    return fields.groupBy(*key).agg(F.count_if(got).alias("received_count"), F.count_if(~got).alias("missing_count"), listed(got).alias("received_parameters"), listed(~got).alias("missing_parameters"))


def upsert(base: DataFrame, patch: DataFrame, key: list[str]) -> DataFrame:
    """Rows of ``base`` with those of ``patch`` in their place; new ones are added."""
    return base.join(patch.select(*key), key, "left_anti").unionByName(patch.select(*base.columns))


def merge_products(parts: DataFrame, key: list[str], point: str, values: str) -> DataFrame:
    """Products of one lead as one record: values joined in their own order, a conflict where the points differ. A lead has a few products."""
    return parts.groupBy(*key).agg(F.flatten(F.array_sort(F.collect_list(values))).alias(values), (F.count_distinct(point) > 1).alias("conflict"))
