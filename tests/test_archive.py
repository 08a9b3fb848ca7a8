"""The archive's refusals that its query doesn't reach, carry-forward, field availability."""

import json
from datetime import datetime, timedelta, timezone

from pyspark.sql import functions as F

from gustloom.operators import leads as L
from gustloom.rules import archive, availability
from gustloom.sources import bundles as B

BEGIN = datetime(2025, 2, 2, 18, tzinfo=timezone.utc)


def stored(spark, edit):
    """A parent and an archive of the 18 o'clock cycle, where only one model has leads beyond its horizon; ``edit`` changes (parent, archive)."""
    g = {r["m"]: r for r in spark.createDataFrame([(m,) for m in L.MODELS], "m string").select("m", L.grid("m", F.lit(18)).alias("all"), L.extension("m", F.lit(18)).alias("far"), L.native_max("m", F.lit(18)).alias("top")).collect()}

    def item(m, h):
        when = BEGIN + timedelta(hours=h)
        return {"model": m, "forecast_lead_hours": h, "run_time_utc": BEGIN.isoformat(), "valid_time_utc": when.isoformat(), "retrieved_at_utc": when.isoformat(), "forecast_coordinate_or_grid_point": {"longitude": 9.25, "latitude": 52.6}, "provider_product": "x", "derived": {"gust_ms": 0.0, "wind_speed_ms": 0.0}}

    parent = {m: [item(m, h) for h in r["all"] if h not in r["far"]] for m, r in g.items()}
    sources = {m: {"records": [item(m, h) for h in r["far"]], "target_max_hours": r["top"], "run_time_utc": BEGIN.isoformat()} for m, r in g.items()}
    if edit:
        edit(parent, sources, sources["ECMWF-IFS"]["records"])
    return {"models": parent, "full_horizon_archive": {"sources": sources, "method_version": archive.VERSION}}


def bundles(spark, cases):
    return B.from_text(spark.createDataFrame([(k, json.dumps(v)) for k, v in cases.items()], "bundle_id string, json string"))


def test_refusals(spark):
    def first(**values):
        def edit(parent, sources, far):
            far[0] |= values

        return edit

    ifs = lambda **values: lambda parent, sources, far: sources["ECMWF-IFS"].update(values)
    spot = lambda lat, lon: first(forecast_coordinate_or_grid_point={"latitude": lat, "longitude": lon})
    cases = {
        "sound": (None, None), "no parent": (lambda p, s, f: p.pop("ECMWF-IFS"), "archive lacks parent cycle"), "two parents": (lambda p, s, f: p["ECMWF-IFS"][0].update(run_time_utc=(BEGIN - timedelta(hours=6)).isoformat()), "mixed parent cycles"),
        "horizon": (ifs(provider_native_horizon_hours=360), "provider-native horizon mismatch"), "compatible": (ifs(compatibility_horizon_hours=120), "compatibility horizon mismatch"), "grid": (ifs(acquisition_grid_version="v1"), "acquisition-grid version mismatch"), "most": (ifs(acquisition_max_lead_hours=144), "acquisition maximum mismatch"),
        "asked": (ifs(requested_extension_leads=[96]), "requested extension leads differ from the acquisition grid"), "key": (ifs(lead_status={"far": "published"}), "invalid lead_status key"), "not expected": (ifs(lead_status={"96": "not_expected_for_cycle"}), "expected lead marked not_expected_for_cycle"),
        "unmarked": (lambda p, s, f: s["GEFS-control"].update(lead_status={"400": "pending"}), "lead beyond cycle maximum lacks not_expected marker"), "fraction": (first(forecast_lead_hours=96.5), "duplicate/unexpected archive lead"), "off the grid": (first(forecast_lead_hours=97), "duplicate/unexpected archive lead"),
        "of another": (first(model="GFS"), "archive model/run mismatch"), "as early as it may be": (first(retrieved_at_utc=BEGIN.isoformat()), None), "earlier": (first(retrieved_at_utc=(BEGIN - timedelta(seconds=1)).isoformat()), "retrieval precedes run"), "at the edge": (spot(52.79, 9.64), "grid changed within product"),
        "nowhere": (spot(None, 9.25), "invalid coordinates"), "beyond": (spot(52.8, 9.25), "wrong extraction location"), "nameless": (first(provider_product=""), "product identity missing"), "gust": (first(derived={"wind_speed_ms": 0.0, "gust_ms": -0.1}), "invalid gust_ms"),
        "no gust": (first(derived={"wind_speed_ms": 0.0}, field_availability={"gust": False}), "gust missing without explicit provider-unavailable marker"),
    }
    coverage, rejects = archive.validate(bundles(spark, {k: stored(spark, edit) for k, (edit, _) in cases.items()}))
    found = {r["path"]: r["x"]["reason"] for r in rejects.groupBy("path").agg(F.min(F.struct("rank", "reason")).alias("x")).collect()}
    assert {k: found.get(k) for k in cases} == {k: want for k, (_, want) in cases.items()}
    whole = {r["path"]: (r["status"], r["horizon_status"]) for r in archive.totals(coverage).collect()}
    assert whole == {"sound": ("complete", "complete"), "as early as it may be": ("complete", "complete")}
    assert {r["exit_code"] for r in archive.exit_code(archive.totals(coverage)).collect()} == {0}


def test_what_the_grid_still_has_is_carried_forward(spark):
    prior = spark.createDataFrame([("GFS", 0, 132), ("GFS", 0, 133), ("GFS", 6, 132), ("GEFS-control", 0, 840), ("GEFS-control", 12, 840), ("ICON-D2", 0, 48)], "model string, hour int, lead int")
    kept, dropped = archive.carry_forward(prior)
    assert sorted(map(tuple, kept.collect())) == [("GEFS-control", 0, 840), ("GFS", 0, 132)] and dropped.count() == 4


def test_problems_of_availability(spark):
    seen = "2025-02-02T20:00:00Z"
    field = lambda **v: {"availability_status": "received", "availability_observed_at_utc": seen, "field_available_at_utc": seen, "value": 1} | v
    state = lambda **v: {"availability_status": "not_requested_by_policy", "availability_observed_at_utc": seen, "parameter_native": "x", "namespace": "availability"} | v
    record = lambda **v: {"retrieved_at_utc": seen, "field_availability_states": [], "values": {}} | v
    cases = {
        "sound": (record(values={"t": [field(), field()]}, field_availability_states=[state()]), set()), "row": (record(retrieved_at_utc="", field_availability_states=None), {("", "missing retrieved_at_utc"), ("", "missing field_availability_states")}),
        "states": (record(field_availability_states={}), {("", "field_availability_states is not a list")}), "unseen": (record(values={"t": field(availability_observed_at_utc=None)}), {("t 0", "missing observed time")}), "late": (record(values={"t": [field(field_available_at_utc=None)]}), {("t 0", "received without field_available_at_utc")}),
        "carries": (record(values={"t": field(availability_status="fetch_error")}), {("t 0", "non-received carries value")}), "odd": (record(values={"t": field(availability_status="?")}), {("t 0", "invalid status")}), "declared": (record(field_availability_states=[state(namespace="other"), 7, state(value=None)]), {("declaration 0", "identity incomplete"), ("declaration 1", "is not an object"), ("declaration 2", "must not carry a value")}),
    }
    got = {k: set() for k in cases}
    for r in availability.problems(bundles(spark, {k: {"models": {"GFS": [v]}} for k, (v, _) in cases.items()})).collect():
        got[r["path"]].add((r["place"], r["problem"]))
    assert got == {k: want for k, (_, want) in cases.items()}


def test_declarations_and_times(spark):
    flags = {"provider_product": "p1", "field_availability": {"rain": True, "hail": False, "snow": 0}, "weather_context_availability": {"p2": {"TMP": False}}}
    recs = B.records(bundles(spark, {"a": {"models": {"GFS": [flags, {"retrieved_at_utc": "early"}]}}}))
    d = {(r["product"], r["parameter"]): (r["availability_status"], r["reject"], r["available_at"]) for r in availability.declarations(recs, F.lit("now")).collect()}
    none = "unsupported_by_provider_or_product"
    assert d == {("p1", "rain"): ("received", None, "now"), ("p1", "hail"): (none, None, None), ("p1", "snow"): (None, "field availability must be boolean", None), ("p2", "TMP"): (none, None, None)}
    times = lambda replace: [r["retrieved_at_utc"] for r in availability.row_times(recs, F.lit("now"), replace).orderBy("pos").collect()]
    assert times(False) == ["now", "early"] and times(True) == ["now", "now"]
