"""Audits of the four station sources."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gustloom.functions import variants as V
from gustloom.operators import timeline as T
from gustloom.rules.engine import bundle_rules, issues, report, rule

SVG, SKM, DWD, ETNW = "SVG-42374", "SKM-898", "DWD-05715", "ETNW"
# Fixed values of the policy, in minutes.
SVG_POLICY = {"station": 42374, "fresh": 15.0, "oldest": 60.0, "cadence": 5.0, "future": 5.0, "edge": 10.0}
SKM_POLICY = {"station": 898, "fresh": 30.0, "oldest": 120.0, "future": 15.0, "apart": 20.0}
DWD_POLICY = {"station": "05715", "recent": 180.0, "oldest": 2880.0, "future": 15.0}
ETNW_POLICY = {"station": "ETNW", "fresh": 120.0, "oldest": 360.0, "future": 15.0}


def _age(now: Column, at: Column) -> Column:
    return (F.unix_micros(now) - F.unix_micros(at)) / 6e7


def audit_svg(bundles: DataFrame, now: Column) -> tuple[DataFrame, DataFrame]:
    """(issues, reports) of the operational station: requests, the current observation, the recent history."""
    p = SVG_POLICY
    there = F.col("payload").isNotNull()
    start, end = V.instant("payload", "$.requested_history_window.start_utc"), V.instant("payload", "$.requested_history_window.end_utc")
    late = lambda t: t > now + F.make_dt_interval(mins=F.lit(int(p["future"])))
    outside = lambda t: (t < F.col("start")) | (t > F.col("end"))
    history = F.transform(F.filter(V.items("payload", "$.recent_historic_observations"), lambda x: V.is_object(x)), lambda x: V.instant(x, "$.time_utc"))
    # A bundle's history is an array of its own row: nothing is joined, and no frame of times can be taken for a small one.
    rows = bundles.withColumns({"start": start, "end": end, "history": history}).withColumn("times", F.array_compact("history"))
    rows = rows.withColumn("apart", F.array_sort(F.array_distinct("times"))).withColumn("gap_list", T.array_cadence_gaps("apart", p["cadence"]))
    rows = rows.withColumns({
        "n": F.size("history"), "timed": F.size("times"), "unparsed": F.size("history") - F.size("times"), "distinct": F.size("apart"), "late": F.size(F.filter("times", late)), "outside": F.size(F.filter("times", outside)),
        "first": F.get("apart", F.lit(0)), "last": F.array_max("apart"), "gaps": F.size("gap_list"), "missing": F.aggregate("gap_list", F.lit(0), lambda a, x: a + x),
    })
    at = V.instant("payload", "$.latest_observation.time_utc")
    age = _age(now, at)
    bounded = F.col("end") > F.col("start")
    early_gap, late_gap = _age(F.col("first"), F.col("start")), _age(F.col("end"), F.col("last"))
    ok = lambda e: V.truth("payload", f"$.request_diagnostics.{e}.success")
    kind = lambda e: V.kind("payload", f"$.request_diagnostics.{e}")
    requests = []
    for e in ("current", "historic", "stations"):
        sev = "WARN" if e == "stations" else "ERROR"
        recorded = F.coalesce(kind(e) == "object", F.lit(False))
        requests.append(rule("SVG_REQUEST_DIAGNOSTIC_NOT_RECORDED", sev, SVG, e, there & ~recorded))
        requests.append(rule("WEATHERLINK_REQUEST_FAILED", sev, SVG, e, there & recorded & ~ok(e), http_status=V.text("payload", f"$.request_diagnostics.{e}.http_status")))
    found = issues(
        rows, ["path"], *bundle_rules("SVG", SVG), *requests,
        rule("SVG_STATION_ID_MISMATCH", "ERROR", SVG, "station_identity", there & F.coalesce(V.number("payload", "$.station.id") != p["station"], F.lit(True))),
        rule("SVG_OBSERVATION_TIMESTAMP_TOO_FAR_IN_FUTURE", "ERROR", SVG, "current_observation", age < -p["future"], age_minutes=age),
        rule("SVG_CURRENT_OBSERVATION_EXCEEDS_MAXIMUM_AGE", "ERROR", SVG, "current_observation", age > p["oldest"], age_minutes=age),
        rule("SVG_CURRENT_OBSERVATION_EXCEEDS_FRESH_TARGET", "WARN", SVG, "current_observation", (age > p["fresh"]) & (age <= p["oldest"]), age_minutes=age),
        rule("SVG_CURRENT_OBSERVATION_TIMESTAMP_UNAVAILABLE", "ERROR", SVG, "current_observation", there & at.isNull()),
        rule("SVG_HISTORIC_WINDOW_RETURNED_ZERO_RECORDS", "ERROR", SVG, "historic_window", there & (F.col("n") == 0)),
        rule("SVG_HISTORIC_TIMESTAMP_INVALID", "ERROR", SVG, "historic_window", F.col("unparsed") > 0, rows=F.col("unparsed")),
        rule("SVG_HISTORIC_TIMESTAMP_TOO_FAR_IN_FUTURE", "ERROR", SVG, "historic_window", F.col("late") > 0, rows=F.col("late")),
        rule("SVG_HISTORIC_TIMESTAMP_OUTSIDE_REQUEST_WINDOW", "ERROR", SVG, "historic_window", F.col("outside") > 0, rows=F.col("outside")),
        rule("SVG_HISTORIC_DUPLICATE_TIMESTAMPS", "WARN", SVG, "historic_window", F.col("timed") > F.col("distinct"), duplicate_record_count=F.col("timed") - F.col("distinct")),
        rule("SVG_HISTORIC_CADENCE_GAPS", "WARN", SVG, "historic_window", F.col("gaps") > 0, gaps=F.col("gaps"), total_estimated_missing_intervals=F.col("missing")),
        rule("SVG_HISTORIC_WINDOW_START_NOT_COVERED", "WARN", SVG, "historic_window", bounded & (early_gap > p["edge"]), uncovered_start_minutes=early_gap),
        rule("SVG_HISTORIC_WINDOW_END_NOT_COVERED", "WARN", SVG, "historic_window", bounded & (late_gap > p["edge"]), uncovered_end_minutes=late_gap),
    )
    usable = rows.select("path", F.coalesce(there & ok("current") & ok("historic") & age.between(-p["future"], p["oldest"]) & (F.col("n") > 0) & (F.col("unparsed") + F.col("late") + F.col("outside") == 0), F.lit(False)).alias("usable"))
    return found, report(bundles, found, usable)


def audit_skm(bundles: DataFrame, now: Column) -> tuple[DataFrame, DataFrame]:
    """(issues, reports) of the optional station; its reports never block."""
    p = SKM_POLICY
    there = F.col("payload").isNotNull()
    rules = [
        *bundle_rules("SKM", SKM),
        rule("SKM_STATION_ID_MISMATCH", "ERROR", SKM, "station_identity", there & F.coalesce(V.number("payload", "$.station.id") != p["station"], F.lit(True))),
        rule("SKM_TIMESTAMP_SEMANTICS_NOT_UTC", "ERROR", SKM, "timestamps", there & F.coalesce(V.text("payload", "$.source_timestamp_timezone") != "UTC", F.lit(True))),
    ]
    fine, times = there, []
    for e in ("wind", "gust"):
        s = f"$.endpoint_summary.{e}"
        at = V.instant("payload", f"{s}.last_time_utc")
        age, works = _age(now, at), V.truth("payload", f"{s}.success") & at.isNotNull()
        empty = V.truth("payload", f"{s}.http_requests_succeeded") & V.truth("payload", f"{s}.provider_returned_empty_measurement_series")
        rules += [
            rule(F.when(empty, "SKM_PROVIDER_SERIES_EMPTY_DESPITE_HTTP_SUCCESS").otherwise("SKM_REQUIRED_ENDPOINT_UNAVAILABLE"), "ERROR", SKM, e, there & ~works),
            rule("SKM_OBSERVATION_TIMESTAMP_TOO_FAR_IN_FUTURE", "ERROR", SKM, e, works & (age < -p["future"]), age_minutes=age),
            rule("SKM_OBSERVATION_OLDER_THAN_DIAGNOSTIC_TARGET", "WARN", SKM, e, works & (age > p["oldest"]), age_minutes=age),
            rule("SKM_OBSERVATION_EXCEEDS_FRESH_TARGET", "WARN", SKM, e, works & (age > p["fresh"]) & (age <= p["oldest"]), age_minutes=age),
        ]
        fine = fine & works & (age >= -p["future"])
        times.append(at)
    apart = F.abs(_age(times[0], times[1]))
    rules.append(rule("SKM_WIND_GUST_TIMESTAMP_MISALIGNMENT", "WARN", SKM, "timestamps", apart > p["apart"], absolute_difference_minutes=apart))
    works = F.map_from_arrays(F.lit(["wind", "gust"]), F.array(*(V.truth("payload", f"$.endpoint_summary.{e}.success") for e in ("wind", "gust"))))

    def failed(x: Column) -> Column:
        kind = V.text(x, "$.kind")
        severity = F.when(F.coalesce(~F.try_element_at(works, kind), F.lit(False)), "ERROR").otherwise("WARN")
        return rule("SKM_HTTP_OR_PARSE_ATTEMPT_FAILED", severity, SKM, F.coalesce(kind, F.lit("request")), V.is_object(x) & ~V.truth(x, "$.success"), http_status=V.text(x, "$.http_status"))

    found = issues(bundles, ["path"], *rules, more=[F.transform(F.when(there, V.items("payload", "$.requests")).otherwise(F.array().cast("array<variant>")), failed)])
    return found, report(bundles, found, bundles.select("path", F.coalesce(fine, F.lit(False)).alias("usable"))).withColumn("non_blocking", F.lit(True))


def _series(bundles: DataFrame, now: Column, future: float, gust: bool) -> DataFrame:
    """Bundles with the number of their rows, of bad ones, whether the axis rises, the last valid time in input order. All of it is read off the bundle's own array."""

    def marked(row: Column) -> Column:
        at, direction = V.aware_instant(row, "$.time_utc"), V.number(row, "$.wind_direction_deg")
        valid = V.is_object(row) & at.isNotNull() & (_age(at, now) <= future) & (V.number(row, "$.wind_speed_ms") >= 0)
        turned = direction.between(0, 360)
        if gust:
            turned = F.coalesce(turned, F.lit(False)) | V.true(row, "$.wind_direction_variable")
            valid = valid & (V.kind(row, "$.wind_gust_ms").isNull() | (V.number(row, "$.wind_gust_ms") >= 0))
        return F.when(valid & turned, at)

    rows = bundles.withColumn("valid", F.transform(V.items("payload", "$.observations"), marked)).withColumn("times", F.array_compact("valid"))
    back = F.filter(F.slice("times", 2, F.size("times")), lambda t, i: t <= F.get("times", i))
    return rows.withColumns({"n": F.size("valid"), "bad": F.size("valid") - F.size("times"), "axis_valid": F.size(back) == 0, "last": F.try_element_at("times", F.lit(-1))}).drop("valid", "times")


def _audit_series(bundles: DataFrame, now: Column, kind: str, source: str, identity: Column, future: float, gust: bool, fresh: list) -> tuple[DataFrame, DataFrame]:
    there = F.col("payload").isNotNull()
    rows = _series(bundles, now, future, gust)
    retrieved, latest, held = V.aware_instant("payload", "$.retrieved_at_utc"), V.aware_instant("payload", "$.latest_observation_time_utc"), V.aware_instant("payload", "$.latest_observation.time_utc")
    age = _age(now, latest)
    found = issues(
        rows, ["path"], *bundle_rules(kind, source, absent="_MISSING"),
        rule(f"{kind}_SOURCE_IDENTITY_MISMATCH", "ERROR", source, "station_identity", there & ~F.coalesce(identity, F.lit(False))),
        rule(f"{kind}_RETRIEVAL_TIMESTAMP_INVALID", "ERROR", source, "timestamps", there & retrieved.isNull()),
        rule(f"{kind}_RETRIEVAL_TIMESTAMP_TOO_FAR_IN_FUTURE", "ERROR", source, "timestamps", _age(retrieved, now) > future),
        rule(f"{kind}_OBSERVATIONS_MISSING", "ERROR", source, "observations", there & (F.col("n") == 0)),
        rule(f"{kind}_INVALID_OBSERVATION_ROWS", "ERROR", source, "observations", F.col("bad") > 0, invalid_row_count=F.col("bad"), total_rows=F.col("n")),
        rule(f"{kind}_TIME_AXIS_INVALID", "ERROR", source, "timestamps", ~F.col("axis_valid")),
        rule(f"{kind}_LATEST_POINTER_MISMATCH", "ERROR", source, "timestamps", there & F.coalesce((latest != F.col("last")) | (held != F.col("last")), F.lit(True))),
        *(rule(f"{kind}_{code}", severity, source, "freshness", (age > low) & (age <= high), age_minutes=age) for code, severity, low, high in fresh),
    )
    return found, report(bundles, found)


def audit_wunstorf(bundles: DataFrame, now: Column) -> tuple[DataFrame, DataFrame]:
    p = DWD_POLICY
    identity = (V.text("payload", "$.provider") == "DWD") & (V.text("payload", "$.station.id") == p["station"])
    return _audit_series(bundles, now, "WUNSTORF", DWD, identity, p["future"], False, [("ARCHIVE_UNUSUALLY_DELAYED", "WARN", p["oldest"], 1e18), ("ARCHIVE_PROVIDER_LAG", "INFO", p["recent"], p["oldest"])])


def audit_etnw(bundles: DataFrame, now: Column) -> tuple[DataFrame, DataFrame]:
    p = ETNW_POLICY
    identity = (V.text("payload", "$.provider") == "AviationWeather.gov") & (V.text("payload", "$.station.icao") == p["station"])
    return _audit_series(bundles, now, "ETNW", ETNW, identity, p["future"], True, [("OBSERVATION_TOO_OLD", "ERROR", p["oldest"], 1e18), ("OBSERVATION_EXCEEDS_FRESH_TARGET", "WARN", p["fresh"], p["oldest"])])
