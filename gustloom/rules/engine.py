"""Rules as conditional structs: all rules of a source are one array expression over its row, exploded once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ISSUE = "code string, severity string, source string, scope string, details string"


def rule(code: str | Column, severity: str | Column, source: str | Column, scope: str | Column, when: Column, **details: Column) -> Column:
    """An issue where ``when`` holds, null elsewhere."""
    lit = lambda x: x if isinstance(x, Column) else F.lit(x)
    body = F.to_json(F.struct(*(v.alias(k) for k, v in details.items()))) if details else F.lit("{}")
    return F.when(F.coalesce(when, F.lit(False)), F.struct(lit(code).alias("code"), lit(severity).alias("severity"), lit(source).alias("source"), lit(scope).alias("scope"), body.alias("details")))


def issues(rows: DataFrame, key: list[str], *rules: Column, more: list[Column] | None = None) -> DataFrame:
    """(key..., code, severity, source, scope, details). ``more``: arrays of issues."""
    found = F.filter(F.array(*rules), lambda x: x.isNotNull())
    for extra in more or []:
        found = F.concat(found, F.filter(extra, lambda x: x.isNotNull()))
    return rows.select(*key, F.explode(found).alias("i")).select(*key, "i.*")


def bundle_rules(prefix: str, source: str, bundle: str = "BUNDLE", absent: str = "_FILE_NOT_CREATED") -> list[Column]:
    """Absent, not readable (present, but without a size) and not JSON."""
    p = f"{prefix}_{bundle}"
    out = [rule(p + absent, "ERROR", source, "bundle", ~F.col("present"), path=F.col("path"))]
    if absent == "_FILE_NOT_CREATED":
        out.append(rule(p + "_FILE_READ_FAILED", "ERROR", source, "bundle", F.col("present") & F.col("n_bytes").isNull(), path=F.col("path")))
    return [*out, rule(p + "_JSON_INVALID", "ERROR", source, "bundle", F.col("present") & F.col("n_bytes").isNotNull() & F.col("payload").isNull(), path=F.col("path"), sha256=F.col("sha256"))]


def report(bundles: DataFrame, found: DataFrame, usable: DataFrame | None = None) -> DataFrame:
    """One row per bundle: counts, status, ready. ``usable`` (path, usable) also has a say in ready; without it, no errors suffice."""
    from gustloom.operators.coverage import status

    n = lambda s: F.count_if(F.col("severity") == s)
    counts = found.groupBy("path").agg(n("ERROR").alias("error_count"), n("WARN").alias("warning_count"), n("INFO").alias("info_count"))
    out = bundles.select("path", "present", "sha256", "n_bytes").join(counts, "path", "left").na.fill(0, ["error_count", "warning_count", "info_count"])
    out = out.withColumn("status", status(F.col("error_count"), F.col("warning_count")))
    if usable is None:
        return out.withColumn("ready", F.col("error_count") == 0)
    return out.join(usable, "path", "left").withColumn("ready", F.coalesce(F.col("usable"), F.lit(False)) & (F.col("error_count") == 0)).drop("usable")
