"""The audit of model bundles: records against the cycle that they come from."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gustloom.functions import columns as C
from gustloom.functions import variants as V
from gustloom.operators import leads as L
from gustloom.rules import archive
from gustloom.rules.engine import bundle_rules, issues, report, rule
from gustloom.sources import bundles as B
from gustloom.sources.requests import SPOT

# Fixed values of the policy: ages in hours, tolerances, optional fields, the ensemble's identity.
MAX_RUN_AGE = {"ICON-D2": 9, "ICON-D2-EPS": 9, "ICON-EU": 9, "ECMWF-IFS": 14, "GFS": 12, "GEFS-control": 12}
RETRIEVAL_FUTURE_MIN, RUN_FUTURE_MIN, LEAD_TOLERANCE_H, POINT_TOLERANCE = 15, 90, 0.06, 0.30
OPTIONAL_FIELDS = ("tot_prec", "cape_ml", "tp", "mucape", "APCP", "cape", "precipitation", "cin_ml", "clct", "2t", "2d", "2r", "prmsl", "sp", "tcc", "cin", "dswrf")
MEMBERS, SETTLING_S, EPS = 20, 600, "ICON-D2-EPS"
VERIFIED = "verified_stable_metadata_dwd_cycle_and_spatial_provenance"
IDENTITY_KEYS = ("verification_status", "run_time_utc", "metadata_before", "metadata_after", "settling_age_seconds_at_request", "minimum_settling_seconds", "dwd_cycle_confirmation_url", "expected_member_ids")
HOURLY_FIELDS = ("wind_speed_10m", "wind_direction_10m", "wind_gusts_10m")
_RETRIEVED = ("retrieved_at_utc", "horizon_extension_retrieved_at_utc", "dwd_additional_retrieved_at_utc", "extended_retrieved_at_utc")


def _off(v: Column, want: float, tolerance: float) -> Column:
    return v.isNull() | (F.abs(v - want) > tolerance)


def _either(rec: str, base: str, *names: str) -> Column:
    """A number under the first of the names that is there."""
    out = V.number(rec, f"{base}.{names[0]}")
    for n in names[1:]:
        out = F.when(V.kind(rec, f"{base}.{names[0]}").isNull(), V.number(rec, f"{base}.{n}")).otherwise(out)
    return out


def _errors(rec: str, in_scope: Column) -> Column:
    """Errors that a record carries: (lead, location, message, class)."""
    entry = lambda place, message, cls: F.struct(place.alias("location"), message.alias("message"), cls.alias("classification"))
    critical = F.when(in_scope, "critical").otherwise("outside")
    own = [
        F.when(V.truth(rec, "$.error"), entry(F.lit("record"), V.text(rec, "$.error"), critical)),
        F.when(V.truth(rec, "$.error_type") | V.truth(rec, "$.error_message"), entry(F.lit("record"), V.text(rec, "$.error_message"), critical)),
        F.when(V.truth(rec, "$.derive_error"), entry(F.lit("derive"), V.text(rec, "$.derive_error"), critical)),
        F.when(V.truth(rec, "$.derive_error_type") | V.truth(rec, "$.derive_error_message"), entry(F.lit("derive"), V.text(rec, "$.derive_error_message"), critical)),
    ]
    fields = F.map_entries(V.entries(rec, "$.values"))
    classed = lambda e: F.when(~in_scope, "outside").when(e["key"].isin(*OPTIONAL_FIELDS), "optional").otherwise("critical")
    bad = lambda e: V.truth(e["value"], "$.error") | V.truth(e["value"], "$.error_type") | V.truth(e["value"], "$.error_message")
    listed = F.transform(F.filter(fields, lambda e: V.is_object(e["value"]) & bad(e)), lambda e: entry(F.concat(F.lit("values."), e["key"]), F.coalesce(V.text(e["value"], "$.error"), V.text(e["value"], "$.error_message")), classed(e)))
    return F.concat(F.filter(F.array(*own), lambda x: x.isNotNull()), listed)


def lead_rows(recs: DataFrame) -> DataFrame:
    """Records typed, with the lead as int() has it and whether an earlier record has the lead (first wins)."""
    from pyspark.sql import Window

    typed = recs.select(
        "path", "model", "pos", "rec", V.lenient_int("rec", "$.forecast_lead_hours").alias("lead"), V.text("rec", "$.run_time_utc").alias("run_text"), V.instant("rec", "$.run_time_utc").alias("run"), V.instant("rec", "$.valid_time_utc").alias("valid"),
        _either("rec", "$.forecast_coordinate_or_grid_point", "latitude", "lat").alias("lat"), _either("rec", "$.forecast_coordinate_or_grid_point", "longitude", "lon").alias("lon"),
        V.number("rec", "$.derived.wind_speed_ms").alias("speed"), V.number("rec", "$.derived.gust_ms").alias("gust"), (F.coalesce(V.text("rec", "$.model"), F.lit("")) != F.col("model")).alias("foreign"),
    )
    order = F.row_number().over(Window.partitionBy("path", "model", "lead").orderBy("pos"))
    return typed.withColumn("nth", F.when(F.col("lead").isNotNull(), order))


def audit(bundles: DataFrame, now: Column, full_validation: bool = False, keep: Callable[[DataFrame], DataFrame] = lambda x: x) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(issues, source summaries, reports) of model bundles, all of them in one job. ``now`` is a timestamp.

    ``keep`` may persist a frame of a row a bundle and model, from which issues and summaries are both made.
    """
    good = bundles.where("payload is not null")
    models = bundles.sparkSession.createDataFrame([(m, float(h)) for m, h in MAX_RUN_AGE.items()], "model string, max_age double")
    envelope = good.select(
        "path", F.coalesce(V.text("payload", "$.mode"), F.lit("unknown")).alias("mode"), F.transform(V.items("payload", "$.quality.errors"), lambda x: V.text(x)).alias("quality_errors"),
        V.part("payload", "$.ensemble_hourly_source").alias("hourly_source"), V.part("payload", "$.provider_selection_evidence.GEFS-control").alias("evidence"),
    )
    rows = lead_rows(B.records(good))
    runs = rows.groupBy("path", "model").agg(
        F.count(F.lit(1)).alias("record_count"), F.array_sort(F.collect_set(F.when(F.length("run_text") > 0, F.col("run_text")))).alias("run_values"), F.count_if("foreign").alias("foreign"),
        F.count_if(F.col("lead").isNull()).alias("invalid_leads"), F.array_sort(F.collect_set(F.when(F.col("nth") > 1, F.col("lead")))).alias("duplicates"), F.array_sort(F.collect_set("lead")).alias("got"),
    )
    empty, full = F.array().cast("array<int>"), F.lit(full_validation)
    base = envelope.crossJoin(F.broadcast(models)).join(runs, ["path", "model"], "left").withColumns({
        "record_count": F.coalesce("record_count", F.lit(0)), "run_values": F.coalesce("run_values", F.array().cast("array<string>")), "foreign": F.coalesce("foreign", F.lit(0)),
        "invalid_leads": F.coalesce("invalid_leads", F.lit(0)), "duplicates": F.coalesce("duplicates", empty), "got": F.coalesce("got", empty),
    })
    run = F.when(F.size("run_values") == 1, C.lenient_utc(F.get("run_values", 0)))
    base = base.withColumn("bundle_run", run).withColumn("hour", F.hour("bundle_run")).withColumn("horizon", L.policy_max("model", "hour"))
    within = lambda keep: F.when(F.col("horizon").isNotNull(), F.filter(L.desired("model"), keep)).otherwise(empty)
    base = base.withColumn("expected", F.when(F.col("mode") == "test", L.base("model", True)).otherwise(within(lambda x: x <= F.col("horizon"))))
    base = base.withColumn("project_gap", F.when(F.col("mode") == "test", empty).otherwise(within(lambda x: x > F.col("horizon"))))

    scoped = rows.where("nth = 1").join(base.select("path", "model", "expected"), ["path", "model"])
    scoped = scoped.withColumn("in_scope", F.array_contains("expected", F.col("lead")))
    scope = F.col("in_scope")
    misplaced = scope & (_off(F.col("lat"), SPOT[0], POINT_TOLERANCE) | _off(F.col("lon"), SPOT[1], POINT_TOLERANCE))
    interval = C.hours_between(F.col("run"), F.col("valid"))
    mistimed = F.coalesce(F.abs(interval - F.col("lead")) > LEAD_TOLERANCE_H, F.lit(True))
    collect = lambda c: F.array_sort(F.collect_list(F.when(c, F.col("lead"))))
    point = F.when(scope & ~misplaced, F.struct(F.round("lat", 6).alias("latitude"), F.round("lon", 6).alias("longitude")))
    problems = scoped.withColumn("errors", _errors("rec", scope)).withColumn("errors", F.transform("errors", lambda e: F.struct(F.col("lead").alias("lead_hours"), e["location"].alias("location"), e["message"].alias("message"), e["classification"].alias("classification"))))
    checks = problems.groupBy("path", "model").agg(
        collect(scope & (F.col("speed").isNull() | F.col("gust").isNull())).alias("no_fields"), collect(misplaced).alias("misplaced"), F.collect_set(point).alias("points"),
        collect(mistimed).alias("mistimed"), F.flatten(F.collect_list("errors")).alias("errors"),
    )
    stages = _stages(good)
    audited = base.join(checks, ["path", "model"], "left").join(_ensemble(rows, scoped, base), ["path", "model"], "left").join(stages, ["path", "model"], "left")
    listed = lambda c, kind: F.coalesce(F.col(c), F.array().cast(kind))
    entry = "array<struct<lead_hours:int,location:string,message:string,classification:string>>"
    audited = audited.withColumns({c: listed(c, "array<int>") for c in ("no_fields", "misplaced", "mistimed")} | {"errors": listed("errors", entry), "points": listed("points", "array<struct<latitude:double,longitude:double>>"), "identity_failures": listed("identity_failures", "array<string>"), "member_failures": listed("member_failures", "array<int>"), "stages": listed("stages", "array<struct<stage:string,outcome:string>>")})
    audited = audited.withColumn("hourly_failures", F.when((F.col("model") == EPS) & (F.col("record_count") > 0) & (F.col("mode") == "production"), hourly_failures(F.col("hourly_source"), F.col("bundle_run"))).otherwise(F.array().cast("array<string>")))
    audited = audited.withColumns({
        "missing": F.array_except("expected", "got"), "extra": F.array_except("got", "expected"),
        "critical": F.filter("errors", lambda e: e["classification"] == "critical"), "optional": F.filter("errors", lambda e: e["classification"] == "optional"),
        "own_errors": F.filter("quality_errors", lambda e: e.startswith(F.concat(F.col("model"), F.lit(":")))),
        "run_age": C.hours_between(F.col("bundle_run"), now), "exception": F.when(F.col("model") == "GEFS-control", mature_exception(F.col("evidence"), F.col("bundle_run"), now, full)).otherwise("not_applicable"),
    })
    audited = keep(audited.drop("hourly_source", "evidence"))
    old = (F.col("run_age") >= -RUN_FUTURE_MIN / 60) & (F.col("run_age") > F.col("max_age"))
    some = lambda c: F.size(c) > 0
    m = F.col("model")
    found = issues(
        audited, ["path"],
        rule("MODEL_RUN_TIME_NOT_PRESENT", "ERROR", m, "run_identity", F.size("run_values") == 0, record_count=F.col("record_count")),
        rule("MULTIPLE_MODEL_RUNS_IN_ONE_SOURCE_BUNDLE", "ERROR", m, "run_identity", F.size("run_values") > 1, run_time_values=F.col("run_values")),
        rule("MODEL_RECORD_IDENTITY_MISMATCH", "ERROR", m, "record_identity", F.col("foreign") > 0, affected_records=F.col("foreign")),
        rule("FORECAST_LEAD_VALUE_INVALID", "ERROR", m, "coverage", F.col("invalid_leads") > 0, rows=F.col("invalid_leads")),
        rule("DUPLICATE_FORECAST_LEADS", "ERROR", m, "coverage", some("duplicates"), duplicate_leads_hours=F.col("duplicates")),
        rule("EXPECTED_PROVIDER_LEADS_NOT_RECEIVED", "ERROR", m, "coverage", some("missing"), expected_leads_hours=F.col("expected"), received_leads_hours=F.col("got"), missing_leads_hours=F.col("missing")),
        rule("PROJECT_LONG_RANGE_LEADS_NOT_PROVIDED_BY_SELECTED_CYCLE", "INFO", m, "coverage", some("project_gap"), leads_hours=F.col("project_gap")),
        rule("RECORDS_OUTSIDE_SELECTED_PROVIDER_CYCLE_HORIZON", "INFO", m, "coverage", some("extra"), extra_received_leads_hours=F.col("extra")),
        rule("REQUIRED_DERIVED_FIELDS_UNAVAILABLE", "ERROR", m, "fields", some("no_fields"), affected_leads=F.col("no_fields")),
        rule("MODEL_FORECAST_GRID_IDENTITY_INVALID", "ERROR", m, "grid_identity", some("misplaced") | (F.size("points") > 1), lead_hours=F.col("misplaced"), observed_points=F.col("points")),
        rule("FORECAST_TIMESTAMP_OR_LEAD_INCONSISTENCY", "ERROR", m, "timestamps", some("mistimed"), lead_hours=F.col("mistimed")),
        rule("SOURCE_FETCH_OR_DECODE_ERRORS_RECORDED", "ERROR", m, "provider_fetch", some("critical") | some("own_errors"), record_errors=F.col("critical"), quality_errors=F.col("own_errors")),
        rule("OPTIONAL_WEATHER_CONTEXT_FIELDS_UNAVAILABLE", "WARN", m, "optional_weather_context", some("optional"), affected_fields=F.col("optional")),
        rule("ENSEMBLE_RUN_IDENTITY_UNVERIFIED", "ERROR", m, "run_identity", some("identity_failures"), failures=F.col("identity_failures")),
        rule("ENSEMBLE_MEMBER_SET_INCOMPLETE", "ERROR", m, "ensemble_members", some("member_failures"), affected_leads=F.col("member_failures")),
        rule("ENSEMBLE_HOURLY_SOURCE_INVALID_FOR_V15", "ERROR", m, "hourly_ensemble_source", some("hourly_failures"), failures=F.col("hourly_failures")),
        rule("MODEL_RUN_TIME_IMPLAUSIBLY_FUTURE", "ERROR", m, "currentness", F.col("run_age") < -RUN_FUTURE_MIN / 60, run_age_hours=F.col("run_age")),
        rule("GEFS_NEWEST_MATURE_CYCLE_EXCEEDS_NOMINAL_CURRENTNESS", "WARN", m, "currentness", old & F.col("exception").isNull(), run_age_hours=F.col("run_age")),
        rule("MODEL_RUN_OLDER_THAN_CURRENTNESS_POLICY", "ERROR", m, "currentness", old & F.col("exception").isNotNull(), run_age_hours=F.col("run_age"), mature_cycle_exception=F.col("exception")),
        more=[F.transform("stages", lambda s: rule(F.when(s["outcome"] == "recovered", "PROVIDER_RETRY_RECOVERED").otherwise("PROVIDER_STAGE_ATTEMPTS_FAILED"), F.when(s["outcome"] == "recovered", "WARN").otherwise("ERROR"), m, "provider_attempts", s["outcome"] != "clean", stage=s["stage"]))],
    )
    failures = ("missing", "duplicates", "no_fields", "misplaced", "mistimed", "critical", "own_errors", "identity_failures", "member_failures", "hourly_failures")
    whole = F.col("bundle_run").isNotNull() & (F.col("invalid_leads") == 0) & (F.col("foreign") == 0) & (F.size("points") <= 1)
    for c in failures:
        whole = whole & (F.size(c) == 0)
    summary = audited.select(
        "path", "model", C.family("model").alias("family"), "record_count", F.col("bundle_run").alias("run_time"), "run_age", "horizon", F.col("expected").alias("expected_leads"), F.col("got").alias("received_leads"),
        F.col("missing").alias("missing_leads"), F.col("extra").alias("extra_leads"), F.coalesce(whole, F.lit(False)).alias("provider_cycle_complete"),
        F.coalesce((F.col("run_age") <= F.col("max_age")) & (F.col("run_age") >= -RUN_FUTURE_MIN / 60), F.lit(False)).alias("currentness_policy_pass"),
    )
    families = summary.groupBy("path").agg(F.array_sort(F.collect_set(F.when(F.col("provider_cycle_complete") & F.col("currentness_policy_pass"), F.col("family")))).alias("families"))
    coverage, invalid = archive.validate(good)
    gate = families.withColumn("usable", F.size("families") >= 2)
    found = found.unionByName(_bundle_issues(bundles, now)).unionByName(
        issues(gate, ["path"], rule("FEWER_THAN_TWO_COMPLETE_CURRENT_INDEPENDENT_MODEL_FAMILIES", "ERROR", "collector", "family_gate", ~F.col("usable"), complete_current_families=F.col("families")))
    ).unionByName(archive.coverage_issues(coverage, invalid, full_validation))
    usable = gate.join(invalid.select("path").distinct().withColumn("broken", F.lit(True)), "path", "left").select("path", (F.col("usable") & F.col("broken").isNull()).alias("usable"))
    return found, summary, report(bundles, found, usable)


def _bundle_issues(bundles: DataFrame, now: Column) -> DataFrame:
    there = F.col("payload").isNotNull()
    retrieved = F.coalesce(*(F.when(V.truth("payload", f"$.{k}"), V.text("payload", f"$.{k}")) for k in _RETRIEVED))
    at = C.lenient_utc(retrieved)
    off = _off(_either("payload", "$.spot", "lat", "latitude"), SPOT[0], 1e-6) | _off(_either("payload", "$.spot", "lon", "longitude"), SPOT[1], 1e-6)
    return issues(
        bundles, ["path"], *bundle_rules("MODEL", "collector"),
        rule("MODEL_SPOT_IDENTITY_MISMATCH", "ERROR", "collector", "spot_identity", there & off, observed_spot=F.to_json(V.part("payload", "$.spot"))),
        rule("RETRIEVAL_TIMESTAMP_INVALID", "ERROR", "collector", "bundle", there & at.isNull(), value=V.text("payload", "$.retrieved_at_utc")),
        rule("RETRIEVAL_TIMESTAMP_IN_FUTURE", "ERROR", "collector", "bundle", there & (C.hours_between(now, at) * 60 > RETRIEVAL_FUTURE_MIN), retrieved_at_utc=retrieved),
    )


def _stages(good: DataFrame) -> DataFrame:
    from gustloom.operators.coverage import stage_recovery

    outcomes = stage_recovery(B.attempts(good), ["path", "model", "stage"])
    return outcomes.groupBy("path", "model").agg(F.array_sort(F.collect_list(F.struct("stage", "outcome"))).alias("stages"))


def _ensemble(rows: DataFrame, scoped: DataFrame, base: DataFrame) -> DataFrame:
    """Identity and member failures of the ensemble's records."""
    ident = V.part("rec", "$.source_run_identity")
    held = rows.where(F.col("model") == EPS).withColumn("ident", F.when(V.is_object(ident), ident))
    first = lambda c: F.min_by(c, F.when(F.col("ident").isNotNull(), F.col("pos")))
    at = "ident"
    keys = F.array(*(F.coalesce(F.to_json(V.part(at, f"$.{k}")), F.lit("null")) for k in IDENTITY_KEYS))
    typed = held.withColumns({
        "has": F.col("ident").isNotNull(), "keys": F.when(F.col("ident").isNotNull(), keys), "status": V.text(at, "$.verification_status"), "id_run": V.text(at, "$.run_time_utc"),
        "mb": V.instant(at, "$.metadata_before.last_run_initialisation_time_utc"), "ma": V.instant(at, "$.metadata_after.last_run_initialisation_time_utc"),
        "settle": V.number(at, "$.settling_age_seconds_at_request"), "ids": F.to_json(V.part(at, "$.expected_member_ids")), "url": V.truth(at, "$.dwd_cycle_confirmation_url"),
    })
    agg = typed.groupBy("path", "model").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("has").alias("with_identity"), F.count_distinct("keys").alias("variants"), F.array_sort(F.collect_set("status")).alias("statuses"),
        F.array_sort(F.collect_set("id_run")).alias("id_runs"), first(F.struct("mb", "ma", "settle", "ids", "url")).alias("f"),
    ).join(base.select("path", "model", "bundle_run"), ["path", "model"])
    run, some = F.col("bundle_run"), F.col("with_identity") > 0
    same = lambda x: F.coalesce(x == run, run.isNull())
    want = "[" + ",".join(map(str, range(MEMBERS))) + "]"
    reasons = [
        F.when(F.col("with_identity") != F.col("n"), "source_run_identity_missing_on_some_records"), F.when(~some, "source_run_identity_missing"),
        F.when(some & (F.col("statuses") != F.array(F.lit(VERIFIED))), "verification_status_mismatch"),
        F.when(some & ((F.size("id_runs") != 1) | ~same(C.lenient_utc(F.get("id_runs", 0)))), "identity_run_time_mismatch"),
        F.when(some & (F.col("f.mb").isNull() | F.col("f.ma").isNull() | (F.col("f.mb") != F.col("f.ma")) | ~same(F.col("f.mb"))), "metadata_before_after_run_mismatch"),
        F.when(some & F.coalesce(F.col("f.settle") < SETTLING_S, F.lit(True)), "metadata_settling_period_not_met"),
        F.when(some & F.coalesce(F.col("f.ids") != want, F.lit(True)), "expected_member_identity_set_mismatch"),
        F.when(some & ~F.col("f.url"), "dwd_cycle_confirmation_missing"), F.when(F.col("variants") > 1, "source_run_identity_not_identical_across_leads"),
    ]
    identity = agg.select("path", "model", F.filter(F.array(*reasons), lambda x: x.isNotNull()).alias("identity_failures"))

    members = F.filter(V.items("rec", "$.members"), lambda x: V.is_object(x))
    ids = F.array_sort(F.filter(F.transform(members, lambda x: V.strict_int(x, "$.member")), lambda x: x.isNotNull()))
    lacking = F.exists(members, lambda x: V.number(x, "$.wind_speed_ms").isNull() | V.number(x, "$.wind_direction_deg").isNull() | V.number(x, "$.gust_ms").isNull())
    bad = (ids != F.sequence(F.lit(0), F.lit(MEMBERS - 1))) | F.coalesce(V.number("rec", "$.derived.ensemble_member_count") != MEMBERS, F.lit(True)) | F.coalesce(V.number("rec", "$.ensemble_statistics.member_count") != MEMBERS, F.lit(True)) | lacking
    sets = scoped.where((F.col("model") == EPS) & F.col("in_scope")).groupBy("path", "model").agg(F.array_sort(F.collect_list(F.when(bad, F.col("lead")))).alias("member_failures"))
    return identity.join(sets, ["path", "model"], "left")


def hourly_failures(source: Column, run: Column) -> Column:
    """Reasons why an hourly member source isn't a whole, verified one. Everything is one expression over the row."""
    there = V.is_object(source)
    times = F.transform(V.items(source, "$.times_utc"), lambda x: V.instant(x))
    valid_axis = (F.size(times) > 0) & ~F.exists(times, lambda x: x.isNull())
    whole = F.forall(times, lambda x: (F.minute(x) == 0) & (F.pmod(F.unix_micros(x), F.lit(60_000_000)) == 0))
    rising = (F.array_sort(times) == times) & (F.size(F.array_distinct(times)) == F.size(times))
    size = F.size(times)
    reasons = [
        F.when(F.coalesce(V.text(source, "$.model") != "dwd_icon_d2_eps", F.lit(True)), "hourly_source_model_mismatch"),
        F.when(F.coalesce(V.text(source, "$.cycle_evidence") != "stable_provider_metadata_association", F.lit(True)), "hourly_source_cycle_evidence_invalid"),
        F.when(F.coalesce(V.instant(source, "$.run_time_utc") != run, F.lit(True)), "hourly_source_run_time_mismatch"),
        F.when(~valid_axis, "hourly_source_time_axis_invalid").when(~whole, "hourly_source_non_hour_boundary").when(~rising, "hourly_source_time_axis_unordered_or_duplicate"),
    ]
    hours = F.filter(F.sequence(F.lit(0), F.lit(48)), lambda h: ~F.array_contains(times, run + F.make_dt_interval(hours=h)))
    wrong = F.lit(False)
    for field in HOURLY_FIELDS:
        columns = V.entries(source, f"$.columns.{field}")
        ids = F.array_sort(F.filter(F.transform(F.map_keys(columns), lambda k: k.try_cast("int")), lambda k: k.isNotNull()))
        reasons.append(F.when(ids != F.sequence(F.lit(0), F.lit(MEMBERS - 1)), F.lit(f"hourly_source_member_identity_mismatch:{field}")))
        reasons.append(F.when(valid_axis & F.exists(F.map_values(columns), lambda v: F.size(V.items(v)) != size), F.lit(f"hourly_source_column_length_mismatch:{field}")))
        top = 360.0 if "direction" in field else 1e300
        wrong = wrong | F.exists(F.map_values(columns), lambda v: F.exists(V.items(v), lambda x: F.coalesce(~V.number(x).between(0.0, top), F.lit(True))))
    point = lambda k: V.number(source, f"$.returned_coordinate.{k}")
    proof = V.true(source, "$.spatial_provenance_verified") & V.true(source, "$.spatial_provenance_evidence.verified")
    reasons += [
        F.when(valid_axis & run.isNotNull() & (F.size(hours) > 0), "hourly_source_required_hours_missing"), F.when(valid_axis & run.isNotNull() & wrong, "hourly_source_wind_core_values_invalid"),
        F.when(F.coalesce((V.number(source, "$.requested_coordinate.latitude") != SPOT[0]) | (V.number(source, "$.requested_coordinate.longitude") != SPOT[1]), F.lit(True)), "hourly_source_requested_coordinate_mismatch"),
        F.when(_off(point("latitude"), SPOT[0], 0.05) | _off(point("longitude"), SPOT[1], 0.08), "hourly_source_returned_coordinate_implausible"),
        F.when(~proof, "hourly_source_spatial_provenance_unverified"),
        F.when(~V.true(source, "$.dwd_eps_native_grid_identity_verified"), "hourly_source_dwd_eps_native_grid_identity_unverified"),
        F.when(~V.true(source, "$.dwd_regular_grid_coordinate_parity_verified"), "hourly_source_dwd_regular_grid_coordinate_parity_unverified"),
        F.when(~V.true(source, "$.response_bound_run_identity_verified") & F.coalesce(V.text(source, "$.response_run_binding.status") != "strong_indirect_bracketed_not_provider_embedded", F.lit(True)), "hourly_source_run_binding_evidence_missing"),
    ]
    return F.when(F.coalesce(there, F.lit(False)), F.filter(F.array(*reasons), lambda x: x.isNotNull())).otherwise(F.array(F.lit("ensemble_hourly_source_missing")))


def mature_exception(evidence: Column, run: Column, now: Column, full: Column) -> Column:
    """Why an old GEFS cycle isn't proven the newest mature one; null where it is. Only full validation can prove it.

    Every newer due cycle (six hours apart), one at least, must be probed at its own last lead and found unpublished;
    of several probes of a cycle the last counts.
    """
    hour = F.hour(run)
    most = L.native_max(F.lit("GEFS-control"), hour)
    tries = F.transform(V.items(evidence, "$.attempts"), lambda a: F.struct(V.instant(a, "$.cycle_run_time_utc").alias("cycle"), V.text(a, "$.status").alias("status"), V.number(a, "$.publication_probe_lead").alias("lead"), V.number(a, "$.expected_max_lead_for_cycle").alias("most")))
    last = lambda cycle: F.try_element_at(F.filter(tries, lambda a: a["cycle"] == cycle), F.lit(-1))
    step = F.expr("interval 6 hours")
    newer = F.when(run + step <= now, F.sequence(run + step, now, step)).otherwise(F.array().cast("array<timestamp>"))
    due = lambda c: L.native_max(F.lit("GEFS-control"), F.hour(c))
    own = last(run)
    return (
        F.when(~F.coalesce(full, F.lit(False)) | run.isNull(), "not_full_validation")
        .when(F.coalesce(~V.is_object(evidence), F.lit(True)), "selection_evidence_missing")
        .when(F.coalesce(V.text(evidence, "$.method_version") != "gefs-newest-mature-cycle-selection-v1", F.lit(True)), "method_version_mismatch")
        .when(~V.true(evidence, "$.full_horizon_publication_required"), "full_horizon_not_required")
        .when(F.coalesce(V.instant(evidence, "$.selected_cycle_run_time_utc") != run, F.lit(True)), "selected_cycle_mismatch")
        .when(F.coalesce((V.number(evidence, "$.selected_expected_max_lead_hours") != most) | (V.number(evidence, "$.selected_publication_probe_lead") != most), F.lit(True)), "selected_horizon_mismatch")
        .when(F.coalesce((own["status"] != "published") | (own["lead"] != most), F.lit(True)), "selected_cycle_not_proven_published")
        .when(F.size(newer) == 0, "no_newer_due_cycle_to_explain_age_excess")
        .when(F.exists(newer, lambda c: F.coalesce((last(c)["status"] != "not_published") | (last(c)["lead"] != due(c)), F.lit(True))), "newer_cycle_not_proven_unpublished")
    )
