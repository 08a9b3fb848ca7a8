"""The full-horizon archive: coverage of each source, and every reason why one is refused."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gustloom.functions import columns as C
from gustloom.functions import variants as V
from gustloom.operators import leads as L
from gustloom.operators.coverage import distinct_points
from gustloom.rules.engine import issues, rule
from gustloom.sources import bundles as B
from gustloom.sources.requests import SPOT

VERSION = "full-horizon-archive-v1"


def validate(bundles: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(coverage, rejects). Coverage: (path, model, status, horizon_complete, complete, missing leads, ...) of each source
    that isn't refused. Rejects: (path, model, rank, reason), all reasons; the least rank is the one that a validator
    which stops at the first would report.
    """
    held = bundles.where(V.is_object("payload", "$.full_horizon_archive"))
    models = F.array(*map(F.lit, sorted(L.MODELS)))
    top = held.select(
        "path", F.when(F.coalesce(V.text("payload", "$.full_horizon_archive.method_version") != VERSION, F.lit(True)), "unknown full-horizon archive version")
        .when(F.array_sort(F.map_keys(V.entries("payload", "$.full_horizon_archive.sources"))) != models, "full-horizon source inventory mismatch").alias("reason"),
    )
    sources = held.join(top.where("reason is null").select("path"), "path", "left_semi").select("path", F.explode(V.entries("payload", "$.full_horizon_archive.sources")).alias("model", "source"))
    core = B.records(held).groupBy("path", "model").agg(
        F.collect_set(V.aware_instant("rec", "$.run_time_utc")).alias("runs"), F.collect_set(F.when(V.truth("rec", "$.derived"), V.strict_int("rec", "$.forecast_lead_hours"))).alias("core_leads"),
    )
    s = sources.join(core, ["path", "model"], "left").withColumn("run", F.when(F.size("runs") == 1, F.get("runs", 0))).withColumn("hour", F.hour("run"))
    s = s.withColumns({"most": L.native_max("model", "hour"), "policy": L.policy("model", "hour"), "states": F.map_entries(V.entries("source", "$.lead_status"))})
    state = lambda e: F.coalesce(V.text(e["value"], "$.status"), V.text(e["value"]))
    differs = lambda key, want: F.coalesce(V.number("source", f"$.{key}") != want, F.lit(False))
    requested = F.to_json(V.part("source", "$.requested_extension_leads"))
    checks = [
        (F.col("runs").isNull() & (F.size(V.items("source", "$.records")) > 0), "archive lacks parent cycle"),
        (F.size("runs") > 1, "mixed parent cycles"),
        (F.coalesce((V.aware_instant("source", "$.run_time_utc") != F.col("run")) | (V.number("source", "$.target_max_hours") != F.col("most")), F.col("run").isNotNull()), "archive parent/target mismatch"),
        (differs("expected_max_lead_for_cycle", F.col("most")), "archive expected-max mismatch"),
        (differs("provider_native_horizon_hours", F.col("most")), "provider-native horizon mismatch"),
        (differs("compatibility_horizon_hours", F.col("policy.compatibility_horizon_hours")), "compatibility horizon mismatch"),
        (F.coalesce(V.text("source", "$.acquisition_grid_version") != L.GRID_VERSION, F.lit(False)), "acquisition-grid version mismatch"),
        (differs("acquisition_max_lead_hours", F.col("policy.acquisition_max_lead_hours")), "acquisition maximum mismatch"),
        (F.coalesce(requested != F.to_json("policy.extension_leads"), F.lit(False)), "requested extension leads differ from the acquisition grid"),
        (F.exists("states", lambda e: e["key"].try_cast("int").isNull()), "invalid lead_status key"),
        (F.exists("states", lambda e: F.coalesce(~state(e).isin(*C.LEAD_STATUS), F.lit(True))), "invalid retrieval status"),
        (F.exists("states", lambda e: F.array_contains("policy.extension_leads", e["key"].try_cast("int")) & (state(e) == "not_expected_for_cycle")), "expected lead marked not_expected_for_cycle"),
        ((F.col("model") == "GEFS-control") & F.exists("states", lambda e: (e["key"].try_cast("int") > F.col("most")) & (state(e) != "not_expected_for_cycle")), "lead beyond cycle maximum lacks not_expected marker"),
    ]

    r = B.archive_records(held).join(s.select("path", "model", "run", "policy", "states"), ["path", "model"])
    typed = r.select(
        "path", "model", "pos", "run", "policy", "states", "rec", V.strict_int("rec", "$.forecast_lead_hours").alias("lead"), V.number("rec", "$.forecast_coordinate_or_grid_point.latitude").alias("lat"),
        V.number("rec", "$.forecast_coordinate_or_grid_point.longitude").alias("lon"), V.text("rec", "$.provider_product").alias("product"), V.number("rec", "$.derived.wind_speed_ms").alias("wind"), V.number("rec", "$.derived.gust_ms").alias("gust"),
        V.kind("rec", "$.derived.gust_ms").isNull().alias("gust_absent"), V.aware_instant("rec", "$.valid_time_utc").alias("valid"), V.aware_instant("rec", "$.retrieved_at_utc").alias("retrieved"),
    )
    nth = F.row_number().over(Window.partitionBy("path", "model", "lead").orderBy("pos"))
    points = distinct_points(typed, ["path", "model", "product"], "lat", "lon").drop("moved")
    typed = typed.withColumn("nth", nth).join(points, ["path", "model", "product"], "left")
    far = lambda c, want: F.abs(F.col(c) - want) > 0.30
    excused = (F.col("model") == "GEFS-control") & (F.col("lead") > 240) & (V.kind("rec", "$.field_availability.gust") == "boolean") & ~V.true("rec", "$.field_availability.gust")
    marked = F.filter("states", lambda e: e["key"] == F.col("lead").cast("string"))
    per_row = [
        (F.col("lead").isNull() | ~F.array_contains("policy.extension_leads", F.col("lead")) | (F.col("nth") > 1), "duplicate/unexpected archive lead"),
        (F.coalesce((V.text("rec", "$.model") != F.col("model")) | (V.aware_instant("rec", "$.run_time_utc") != F.col("run")), F.lit(True)), "archive model/run mismatch"),
        (F.coalesce(F.unix_micros("valid") - F.unix_micros("run") != F.col("lead").cast("long") * 3_600_000_000, F.lit(True)), "archive validity mismatch"),
        (F.coalesce(F.col("retrieved") < F.col("run"), F.lit(True)), "retrieval precedes run"),
        (F.col("lat").isNull() | F.col("lon").isNull(), "invalid coordinates"), (far("lat", SPOT[0]) | far("lon", SPOT[1]), "wrong extraction location"),
        (F.coalesce(F.length("product") == 0, F.lit(True)), "product identity missing"), (F.col("points") > 1, "grid changed within product"),
        (F.coalesce(F.col("wind") < 0, F.lit(True)), "invalid wind_speed_ms"), (F.col("gust_absent") & ~F.coalesce(excused, F.lit(False)), "gust missing without explicit provider-unavailable marker"),
        (~F.col("gust_absent") & F.coalesce(F.col("gust") < 0, F.lit(True)), "invalid gust_ms"),
        (F.exists(marked, lambda e: state(e) != "published"), "received lead is not marked published"),
    ]

    def reasons(frame: DataFrame, rules: list, start: int) -> DataFrame:
        found = F.filter(F.array(*(F.when(F.coalesce(c, F.lit(False)), F.struct(F.lit(start + i).alias("rank"), F.lit(t).alias("reason"))) for i, (c, t) in enumerate(rules))), lambda x: x.isNotNull())
        return frame.select("path", "model", F.explode(found).alias("x")).select("path", "model", "x.rank", "x.reason").distinct()

    rows = typed.groupBy("path", "model").agg(F.array_sort(F.collect_set("lead")).alias("seen"), F.array_sort(F.collect_set(F.when(F.col("gust_absent"), F.col("lead")))).alias("missing_gust"))
    none = F.array().cast("array<int>")
    c = s.join(rows, ["path", "model"], "left").withColumns({"seen": F.coalesce("seen", none), "missing_gust": F.coalesce("missing_gust", none), "core_leads": F.coalesce("core_leads", none)})
    c = c.withColumns({"missing": F.array_except(F.array_except("policy.acquisition_leads", "core_leads"), "seen"), "actual_max": F.array_max(F.array_union("core_leads", "seen"))})
    late = [(F.coalesce(V.number("source", "$.actual_max_lead") != F.col("actual_max"), F.lit(False)), "archive actual-max mismatch")]
    rejects = top.where("reason is not null").select("path", F.lit(None).cast("string").alias("model"), F.lit(0).alias("rank"), "reason")
    rejects = rejects.unionByName(reasons(s, checks, 1)).unionByName(reasons(typed, per_row, 50)).unionByName(reasons(c, late, 90))
    parent = F.col("runs").isNotNull()
    horizon, gust = parent & (F.size("missing") == 0), parent & (F.size("missing_gust") == 0)
    counts = F.transform(F.array_sort(F.array_distinct(F.transform("states", state))), lambda v: F.struct(v.alias("key"), F.size(F.filter("states", lambda e: state(e) == v)).alias("value")))
    coverage = c.join(rejects.select("path").distinct(), "path", "left_anti").select(
        "path", "model", F.when(~parent, "parent_missing").when(horizon & gust, "complete").when(horizon, "partial_optional_fields").otherwise("partial").alias("status"),
        horizon.alias("horizon_complete"), gust.alias("gust_complete"), (horizon & gust).alias("complete"), F.when(parent, F.col("missing")).otherwise(none).alias("missing_leads"),
        F.col("missing_gust").alias("missing_gust_leads"), F.col("seen").alias("received_extension_leads"), F.col("actual_max").alias("actual_max_lead"), F.map_from_entries(counts).alias("retrieval_status_counts"),
    )
    return coverage, rejects


def totals(coverage: DataFrame) -> DataFrame:
    """(path, status, horizon_status): complete only if every source is."""
    word = lambda c: F.when(F.bool_and(c), "complete").otherwise("partial")
    return coverage.groupBy("path").agg(word("complete").alias("status"), word("horizon_complete").alias("horizon_status"))


def coverage_issues(coverage: DataFrame, rejects: DataFrame, full_validation: bool) -> DataFrame:
    whole = totals(coverage)
    gap = (F.col("horizon_status") != "complete") & F.lit(full_validation)
    found = issues(
        whole, ["path"], rule("FULL_HORIZON_REQUIRED_COVERAGE_INCOMPLETE", "ERROR", "archive", "coverage", gap),
        rule("FULL_HORIZON_ARCHIVE_PARTIAL", "WARN", "archive", "coverage", ~gap & (F.col("status") != "complete")),
    )
    first = rejects.groupBy("path").agg(F.min(F.struct("rank", "model", "reason")).alias("x"))
    return found.unionByName(issues(first, ["path"], rule("FULL_HORIZON_ARCHIVE_INVALID", "ERROR", "archive", "integrity", F.lit(True), reason=F.col("x.reason"), model=F.col("x.model"))))


def exit_code(whole: DataFrame) -> DataFrame:
    return whole.select("path", F.when(F.col("horizon_status") == "complete", 0).otherwise(1).alias("exit_code"))


def carry_forward(prior: DataFrame, hour_col: str = "hour") -> tuple[DataFrame, DataFrame]:
    """Prior archive rows (model, hour, lead, ...) that the grid still has, and those that it drops."""
    allowed = prior.withColumn("_keep", F.array_contains(L.extension("model", hour_col), F.col("lead")))
    return allowed.where("_keep").drop("_keep"), allowed.where("not _keep").drop("_keep")
