"""Rules on both sides of their bounds. Each audit gets all its cases as one table of bundles.

A case is what is different from a sound bundle; expected are the codes found. The queries of the audits hold whole
tables against DuckDB; what is here are the exact bounds, and rules that those tables don't reach.
"""

import json
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from gustloom.operators import leads as L
from gustloom.rules import models as M
from gustloom.rules import stations as S
from gustloom.sources.bundles import from_text

CLOCK = datetime(2025, 1, 20, 13, 40, tzinfo=timezone.utc)


def at(minutes: float) -> str:
    """So many minutes before the clock."""
    return (CLOCK - timedelta(minutes=minutes)).strftime("%Y-%m-%dT%H:%M:%S.%fZ")


def audited(spark, audit, cases, **more):
    """Codes by case, and the reports."""
    rows = [(name, body if body is None or isinstance(body, str) else json.dumps(body)) for name, (body, _) in cases.items()]
    out = audit(from_text(spark.createDataFrame(rows, "bundle_id string, json string")), F.lit(CLOCK), **more)
    codes = {name: set() for name in cases}
    for r in out[0].collect():
        codes[r["path"]].add(r["code"])
    return codes, {r["path"]: r for r in out[-1].collect()}


def expect(spark, audit, cases, **more):
    codes, reports = audited(spark, audit, cases, **more)
    assert codes == {name: set(want) for name, (_, want) in cases.items()}
    return reports


# --- the operational station ---------------------------------------------------------------------------------


def svg(age=1, minutes=range(0, 181, 5), window=(180, 0), station=42374, **requests):
    answers = {"current": {"success": True}, "historic": {"success": True}, "stations": {"success": True}} | requests
    return {
        "station": {"id": station}, "latest_observation": {} if age is None else {"time_utc": at(age)}, "recent_historic_observations": [{"time_utc": m if isinstance(m, str) else at(m)} for m in minutes],
        "requested_history_window": {"start_utc": at(window[0]), "end_utc": at(window[1])}, "request_diagnostics": {k: v for k, v in answers.items() if v is not None},
    }


def test_svg_bounds(spark):
    whole = list(range(0, 181, 5))
    reports = expect(spark, S.audit_svg, {
        "sound": (svg(), ()), "as old as fresh may be": (svg(15), ()), "older": (svg(15.1), ["SVG_CURRENT_OBSERVATION_EXCEEDS_FRESH_TARGET"]),
        "as old as any may be": (svg(60), ["SVG_CURRENT_OBSERVATION_EXCEEDS_FRESH_TARGET"]), "too old": (svg(60.1), ["SVG_CURRENT_OBSERVATION_EXCEEDS_MAXIMUM_AGE"]),
        "a little ahead": (svg(-5), ()), "too far ahead": (svg(-5.1), ["SVG_OBSERVATION_TIMESTAMP_TOO_FAR_IN_FUTURE"]), "no time": (svg(None), ["SVG_CURRENT_OBSERVATION_TIMESTAMP_UNAVAILABLE"]),
        "begins ten minutes late": (svg(minutes=whole[:-2]), ()), "begins later": (svg(minutes=whole[:-3]), ["SVG_HISTORIC_WINDOW_START_NOT_COVERED"]),
        "ends ten minutes early": (svg(minutes=whole[2:]), ()), "ends earlier": (svg(minutes=whole[3:]), ["SVG_HISTORIC_WINDOW_END_NOT_COVERED"]),
        "within the slack of a step": (svg(minutes=[m + (0.1 if m >= 90 and m < 180 else 0) for m in whole]), ()), "beyond it": (svg(minutes=[m + (0.2 if m >= 90 and m < 180 else 0) for m in whole]), ["SVG_HISTORIC_CADENCE_GAPS"]),
        "outside by a second": (svg(minutes=[*whole, 180 + 1 / 60]), ["SVG_HISTORIC_TIMESTAMP_OUTSIDE_REQUEST_WINDOW"]), "ahead in the window": (svg(minutes=[*whole, -5], window=(180, -6)), ()),
        "too far ahead in the window": (svg(minutes=[*whole, -5, -5.5], window=(180, -6)), ["SVG_HISTORIC_TIMESTAMP_TOO_FAR_IN_FUTURE"]), "twice": (svg(minutes=[*whole, 40]), ["SVG_HISTORIC_DUPLICATE_TIMESTAMPS"]),
        "unreadable": (svg(minutes=[*whole, "?"]), ["SVG_HISTORIC_TIMESTAMP_INVALID"]), "empty": (svg(minutes=[]), ["SVG_HISTORIC_WINDOW_RETURNED_ZERO_RECORDS"]), "another station": (svg(station="42374"), ["SVG_STATION_ID_MISMATCH"]),
        "refused": (svg(historic={"success": False, "http_status": 500}), ["WEATHERLINK_REQUEST_FAILED"]), "unrecorded": (svg(current=None), ["SVG_REQUEST_DIAGNOSTIC_NOT_RECORDED"]), "no object": ("[1]", ["SVG_STATION_ID_MISMATCH", "SVG_REQUEST_DIAGNOSTIC_NOT_RECORDED", "SVG_CURRENT_OBSERVATION_TIMESTAMP_UNAVAILABLE", "SVG_HISTORIC_WINDOW_RETURNED_ZERO_RECORDS"]),
        "cut off": ('{"station"', ["SVG_BUNDLE_JSON_INVALID"]), "absent": (None, ["SVG_BUNDLE_FILE_NOT_CREATED"]),
    })
    assert {n for n, r in reports.items() if r["ready"]} == {"sound", "as old as fresh may be", "older", "as old as any may be", "a little ahead", "begins ten minutes late", "begins later", "ends ten minutes early", "ends earlier", "within the slack of a step", "beyond it", "ahead in the window", "twice"}


# --- the optional station ------------------------------------------------------------------------------------


def skm(wind=3, gust=3, requests=(), zone="UTC", station=898, **summary):
    held = {k: {"success": True, "last_time_utc": at(v)} for k, v in (("wind", wind), ("gust", gust))} | summary
    return {"station": {"id": station}, "source_timestamp_timezone": zone, "endpoint_summary": held, "requests": list(requests)}


def test_skm_bounds(spark):
    silent = {"success": False, "http_requests_succeeded": True, "provider_returned_empty_measurement_series": True}
    reports = expect(spark, S.audit_skm, {
        "sound": (skm(), ()), "fresh": (skm(30, 30), ()), "less fresh": (skm(30.5, 30), ["SKM_OBSERVATION_EXCEEDS_FRESH_TARGET"]), "aged": (skm(120, 120), ["SKM_OBSERVATION_EXCEEDS_FRESH_TARGET"]), "too aged": (skm(121, 121), ["SKM_OBSERVATION_OLDER_THAN_DIAGNOSTIC_TARGET"]),
        "ahead": (skm(-15, -15), ()), "too far ahead": (skm(-15.5, -15), ["SKM_OBSERVATION_TIMESTAMP_TOO_FAR_IN_FUTURE"]), "twenty apart": (skm(5, 25), ()), "further apart": (skm(5, 25.5), ["SKM_WIND_GUST_TIMESTAMP_MISALIGNMENT"]),
        "silent": (skm() | {"endpoint_summary": {"wind": silent, "gust": {"success": True, "last_time_utc": at(3)}}}, ["SKM_PROVIDER_SERIES_EMPTY_DESPITE_HTTP_SUCCESS"]),
        "unreachable": (skm() | {"endpoint_summary": {"wind": {"success": False}, "gust": {"success": True, "last_time_utc": at(3)}}}, ["SKM_REQUIRED_ENDPOINT_UNAVAILABLE"]), "zone": (skm(zone="UTC+1"), ["SKM_TIMESTAMP_SEMANTICS_NOT_UTC"]), "station": (skm(station=899), ["SKM_STATION_ID_MISMATCH"]),
        "an attempt failed": (skm(requests=[{"kind": "gust", "success": False}, {"kind": "gust", "success": True}, "note"]), ["SKM_HTTP_OR_PARSE_ATTEMPT_FAILED"]), "cut off": ("{", ["SKM_BUNDLE_JSON_INVALID"]), "absent": (None, ["SKM_BUNDLE_FILE_NOT_CREATED"]),
    })
    assert all(r["non_blocking"] for r in reports.values()) and reports["an attempt failed"]["ready"] and not reports["too far ahead"]["ready"]


# --- the two series ------------------------------------------------------------------------------------------


def series(kind, age=10, step=20, rows=3, retrieved=0, pointer=None, edit=None, **own):
    listed = [{"time_utc": at(age + step * (rows - 1 - i)), "wind_speed_ms": 2.5 + i, "wind_direction_deg": 90.0 * i} for i in range(rows)]
    if edit:
        listed = edit(listed)
    identity = {"wunstorf": {"provider": "DWD", "station": {"id": "05715"}}, "etnw": {"provider": "AviationWeather.gov", "station": {"icao": "ETNW"}}}[kind]
    last = at(age if pointer is None else pointer)
    return identity | {"retrieved_at_utc": retrieved if isinstance(retrieved, str) else at(retrieved), "observations": listed, "latest_observation_time_utc": last, "latest_observation": {"time_utc": last}} | own


def changed(row, **values):
    return lambda rows: [r | values if i == row else r for i, r in enumerate(rows)]


@pytest.mark.parametrize("kind", ["wunstorf", "etnw"])
def test_series_bounds(spark, kind):
    p, make = kind.upper() + "_", lambda **more: series(kind, **more)
    bad, off = [p + "INVALID_OBSERVATION_ROWS"], [p + "INVALID_OBSERVATION_ROWS", p + "LATEST_POINTER_MISMATCH"]
    cases = {
        "sound": (make(), ()), "retrieved ahead": (make(retrieved=-15), ()), "retrieved too far ahead": (make(retrieved=-15.1), [p + "RETRIEVAL_TIMESTAMP_TOO_FAR_IN_FUTURE"]), "without a zone": (make(retrieved="2025-01-20T13:40:00"), [p + "RETRIEVAL_TIMESTAMP_INVALID"]),
        "calm": (make(edit=changed(0, wind_speed_ms=0)), ()), "negative": (make(edit=changed(0, wind_speed_ms=-0.1)), bad), "full circle": (make(edit=changed(0, wind_direction_deg=360)), ()), "more than that": (make(edit=changed(0, wind_direction_deg=360.5)), bad),
        "last row bad": (make(edit=changed(2, wind_speed_ms="3")), off), "in step": (make(edit=changed(1, time_utc=at(50))), [p + "TIME_AXIS_INVALID"]), "pointer": (make(pointer=11), [p + "LATEST_POINTER_MISMATCH"]), "not an object": (make(edit=lambda rows: ["row", *rows]), bad),
        "ahead": (make(age=-15), ()), "too far ahead": (make(age=-15.5), off), "none": (make(rows=0), [p + "OBSERVATIONS_MISSING", p + "LATEST_POINTER_MISMATCH"]), "another": (make(provider="?"), [p + "SOURCE_IDENTITY_MISMATCH"]), "cut off": ("{", [p + "BUNDLE_JSON_INVALID"]), "absent": (None, [p + "BUNDLE_MISSING"]),
    }
    if kind == "etnw":
        vague = {"wind_direction_deg": None, "wind_direction_variable": True}
        cases |= {
            "variable": (make(edit=changed(1, **vague)), ()), "no direction": (make(edit=changed(1, wind_direction_deg=None)), bad), "gust": (make(edit=changed(1, wind_gust_ms=0)), ()), "negative gust": (make(edit=changed(1, wind_gust_ms=-1)), bad),
            "fresh": (make(age=120), ()), "less fresh": (make(age=120.5), ["ETNW_OBSERVATION_EXCEEDS_FRESH_TARGET"]), "aged": (make(age=360), ["ETNW_OBSERVATION_EXCEEDS_FRESH_TARGET"]), "too aged": (make(age=360.5), ["ETNW_OBSERVATION_TOO_OLD"]),
        }
    else:
        cases |= {"recent": (make(age=180), ()), "lagging": (make(age=180.5), ["WUNSTORF_ARCHIVE_PROVIDER_LAG"]), "at most": (make(age=2880), ["WUNSTORF_ARCHIVE_PROVIDER_LAG"]), "delayed": (make(age=2880.5), ["WUNSTORF_ARCHIVE_UNUSUALLY_DELAYED"])}
    expect(spark, S.audit_wunstorf if kind == "wunstorf" else S.audit_etnw, cases)


# --- bundles of models -----------------------------------------------------------------------------------------

START = datetime(2025, 1, 20, 12, tzinfo=timezone.utc)


def verified(start):
    t = start.isoformat()
    return {"verification_status": M.VERIFIED, "run_time_utc": t, "metadata_before": {"last_run_initialisation_time_utc": t}, "metadata_after": {"last_run_initialisation_time_utc": t}, "settling_age_seconds_at_request": 600, "expected_member_ids": list(range(20)), "dwd_cycle_confirmation_url": "u"}


def forecast(model, lead, start=START):
    out = {"model": model, "run_time_utc": start.isoformat(), "forecast_lead_hours": lead, "valid_time_utc": (start + timedelta(hours=lead)).isoformat(), "forecast_coordinate_or_grid_point": {"lat": 52.4, "lon": 9.4}, "derived": {"wind_speed_ms": 0.0, "gust_ms": 1.5}}
    if model == M.EPS:
        out |= {"members": [{"member": m, "wind_speed_ms": 1.0, "wind_direction_deg": 0.0, "gust_ms": 2.0} for m in reversed(range(20))], "ensemble_statistics": {"member_count": 20}, "source_run_identity": verified(start)}
        out["derived"]["ensemble_member_count"] = 20
    return out


def snapshot(edit=lambda r: [r], starts=None, **envelope):
    """All models at their test leads; ``edit`` makes any number of records of each."""
    held = {m: [e for h in (L.DENSE_TEST_LEADS if m in L.DENSE_MODELS else L.TEST_LEADS) for e in edit(forecast(m, h, (starts or {}).get(m, START)))] for m in L.MODELS}
    return {"mode": "test", "retrieved_at_utc": at(0), "spot": {"latitude": 52.4942, "longitude": 9.3418}, "models": held} | envelope


def only(model, lead, **values):
    """One record changed; a dotted name reaches into it, and None takes the field away."""

    def edit(r):
        if (r["model"], r["forecast_lead_hours"]) == (model, lead):
            for name, value in values.items():
                *way, last = name.split("__")
                spot = r
                for step in way:
                    spot = spot[step]
                spot[last] = value
                if value is None:
                    del spot[last]
        return [r]

    return edit


def test_model_bounds(spark):
    place = "forecast_coordinate_or_grid_point"
    hours = lambda h: START + timedelta(hours=h)
    move = lambda lat, lon: lambda r: [r | {place: {"lat": lat, "lon": lon}}]
    eps = lambda **values: snapshot(only(M.EPS, 24, **values))
    every = lambda **values: snapshot(lambda r: [r | {"source_run_identity": r["source_run_identity"] | values} if r["model"] == M.EPS else r])
    old, grid, member, unsure = "MODEL_RUN_OLDER_THAN_CURRENTNESS_POLICY", "MODEL_FORECAST_GRID_IDENTITY_INVALID", "ENSEMBLE_MEMBER_SET_INCOMPLETE", "ENSEMBLE_RUN_IDENTITY_UNVERIFIED"
    cases = {
        "sound": (snapshot(), ()), "retrieved ahead": (snapshot(retrieved_at_utc=at(-15)), ()), "too far ahead": (snapshot(retrieved_at_utc=at(-15.1)), ["RETRIEVAL_TIMESTAMP_IN_FUTURE"]),
        "at the edge of the place": (snapshot(move(52.79, 9.6)), ()), "beyond it": (snapshot(move(52.8, 9.6)), [grid, "FEWER_THAN_TWO_COMPLETE_CURRENT_INDEPENDENT_MODEL_FAMILIES"]), "two points": (snapshot(only("ICON-EU", 24, forecast_coordinate_or_grid_point={"lat": 52.41, "lon": 9.4})), [grid]),
        "nearly at its hour": (snapshot(only("GFS", 24, valid_time_utc=hours(24.05).isoformat())), ()), "off its hour": (snapshot(only("GFS", 24, valid_time_utc=hours(24.1).isoformat())), ["FORECAST_TIMESTAMP_OR_LEAD_INCONSISTENCY"]),
        "no gust": (snapshot(only("GFS", 24, derived__gust_ms=None)), ["REQUIRED_DERIVED_FIELDS_UNAVAILABLE"]), "a truth for a speed": (snapshot(only("GFS", 24, derived__wind_speed_ms=True)), ["REQUIRED_DERIVED_FIELDS_UNAVAILABLE"]),
        "a lead as text": (snapshot(only("GFS", 24, forecast_lead_hours=" 24")), ()), "half a lead more": (snapshot(only("GFS", 24, forecast_lead_hours=24.4)), ()), "no lead": (snapshot(only("GFS", 24, forecast_lead_hours=None)), ["FORECAST_LEAD_VALUE_INVALID", "EXPECTED_PROVIDER_LEADS_NOT_RECEIVED"]),
        "just old enough": (snapshot(starts={"ICON-D2": hours(-7)}), ()), "older": (snapshot(starts={"ICON-D2": hours(-8)}), [old]), "older of another model": (snapshot(starts={"ECMWF-IFS": hours(-12)}), ()), "older than that": (snapshot(starts={"ECMWF-IFS": hours(-13)}), [old]),
        "a coming run": (snapshot(starts={"ICON-D2": hours(3)}), ()), "a run too far off": (snapshot(starts={"ICON-D2": hours(4)}), ["MODEL_RUN_TIME_IMPLAUSIBLY_FUTURE"]),
        "settled": (every(settling_age_seconds_at_request=600), ()), "not settled": (every(settling_age_seconds_at_request=599), [unsure]), "identities differ": (eps(source_run_identity__dwd_cycle_confirmation_url="v"), [unsure]), "no url": (every(dwd_cycle_confirmation_url=""), [unsure]),
        "nineteen": (eps(ensemble_statistics__member_count=19), [member]), "a member twice": (eps(members=[{"member": m % 19, "wind_speed_ms": 1.0, "wind_direction_deg": 0.0, "gust_ms": 2.0} for m in range(20)]), [member]),
        "one family": (snapshot(starts={m: hours(-30) for m in ("GFS", "GEFS-control", "ECMWF-IFS")}), [old, "FEWER_THAN_TWO_COMPLETE_CURRENT_INDEPENDENT_MODEL_FAMILIES"]),
        "optional": (snapshot(only("GFS", 24, values={"cin": {"error_type": "absent"}})), ["OPTIONAL_WEATHER_CONTEXT_FIELDS_UNAVAILABLE"]), "needed": (snapshot(only("GFS", 24, values={"10u": {"error_type": "absent"}})), ["SOURCE_FETCH_OR_DECODE_ERRORS_RECORDED"]),
        "another's note": (snapshot(quality={"errors": ["ICON: late", "GFSX: late"]}), ()), "its own note": (snapshot(quality={"errors": ["GFS: late"]}), ["SOURCE_FETCH_OR_DECODE_ERRORS_RECORDED"]),
        "outside failed": (snapshot(provider_attempts=[{"model": "GFS", "stage": "x", "status": "failed_external"}, {"model": "GFS", "stage": "y", "status": "success"}]), ["PROVIDER_STAGE_ATTEMPTS_FAILED"]),
    }
    reports = expect(spark, M.audit, cases)
    assert reports["sound"]["status"] == "PASS" and reports["sound"]["ready"] and not reports["one family"]["ready"] and reports["optional"]["status"] == "PASS_WITH_WARNINGS"


def test_hourly_source(spark):
    hours = [START + timedelta(hours=h) for h in range(50)]

    def source(times=hours, fields=None, **more):
        held = {f: {str(m): [0.0 if "direction" in f else 3.0] * len(times) for m in range(20)} for f in M.HOURLY_FIELDS}
        for f, change in (fields or {}).items():
            change(held[f])
        marks = ("spatial_provenance_verified", "dwd_eps_native_grid_identity_verified", "dwd_regular_grid_coordinate_parity_verified", "response_bound_run_identity_verified")
        return {
            "model": "dwd_icon_d2_eps", "cycle_evidence": "stable_provider_metadata_association", "run_time_utc": START.isoformat(), "times_utc": [t.isoformat() for t in times], "columns": held,
            "requested_coordinate": {"latitude": 52.4942, "longitude": 9.3418}, "returned_coordinate": {"latitude": 52.51, "longitude": 9.3}, "spatial_provenance_evidence": {"verified": True}, **dict.fromkeys(marks, True),
        } | more

    put = lambda m, i, v: lambda c: c[m].__setitem__(i, v)
    near = lambda lat, lon: source(returned_coordinate={"latitude": lat, "longitude": lon})
    names, far = "hourly_source_", ["hourly_source_returned_coordinate_implausible"]
    cases = {
        "sound": (source(), []), "north": (near(52.54, 9.34), []), "too far north": (near(52.55, 9.34), far), "east": (near(52.5, 9.42), []), "too far east": (near(52.5, 9.43), far),
        "two days": (source(hours[:49]), []), "an hour less": (source(hours[:48]), [names + "required_hours_missing"]), "half an hour": (source([*hours, hours[-1] + timedelta(minutes=30)]), [names + "non_hour_boundary"]), "an hour twice": (source([*hours, hours[-1]]), [names + "time_axis_unordered_or_duplicate"]),
        "north wind": (source(fields={"wind_direction_10m": put("7", 9, 360.0)}), []), "past north": (source(fields={"wind_direction_10m": put("7", 9, 360.5)}), [names + "wind_core_values_invalid"]), "negative": (source(fields={"wind_speed_10m": put("0", 0, -0.5)}), [names + "wind_core_values_invalid"]),
        "a value less": (source(fields={"wind_gusts_10m": lambda c: c["3"].pop()}), [names + "column_length_mismatch:wind_gusts_10m"]), "a member less": (source(fields={"wind_speed_10m": lambda c: c.pop("11")}), [names + "member_identity_mismatch:wind_speed_10m"]),
        "bracketed": (source(response_bound_run_identity_verified=False, response_run_binding={"status": "strong_indirect_bracketed_not_provider_embedded"}), []), "unbound": (source(response_bound_run_identity_verified=False), [names + "run_binding_evidence_missing"]),
        "unproven": (source(spatial_provenance_evidence={}), [names + "spatial_provenance_unverified"]), "a model less": (source(model="icon"), [names + "model_mismatch"]), "another run": (source(run_time_utc=hours[1].isoformat()), [names + "run_time_mismatch"]), "nothing": (None, ["ensemble_hourly_source_missing"]),
    }
    rows = spark.createDataFrame([(k, json.dumps(v)) for k, (v, _) in cases.items()], "k string, j string").withColumn("s", F.try_parse_json("j"))
    assert {r["k"]: r["f"] for r in rows.select("k", M.hourly_failures(F.col("s"), F.lit(START)).alias("f")).collect()} == {k: want for k, (_, want) in cases.items()}


def test_station_audits_join_and_shuffle_nothing(spark):
    """A frame of a bundle's times, joined, was broadcast by its guessed size; each bundle is audited in its own row."""
    b = from_text(spark.range(3).select(F.col("id").alias("k"), F.lit("{}").alias("json")), "k", "json")
    for audit in (S.audit_svg, S.audit_wunstorf, S.audit_etnw):
        plan = audit(b, F.lit("2025-03-14T09:00:00Z").cast("timestamp"))[0]._jdf.queryExecution().executedPlan().toString()
        assert "Join" not in plan and "Exchange" not in plan and plan.count("Range (") == 1


def test_issues_and_summaries_can_be_made_of_one_kept_frame(spark):
    kept = []
    b = from_text(spark.range(2).select(F.col("id").alias("k"), F.lit("{}").alias("json")), "k", "json")
    M.audit(b, F.lit("2025-03-14T09:00:00Z").cast("timestamp"), keep=lambda x: kept.append(x) or x)
    assert len(kept) == 1 and not {"payload", "hourly_source", "evidence"} & set(kept[0].columns)
