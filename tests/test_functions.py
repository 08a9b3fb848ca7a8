"""Column functions against values worked out by hand or by Python itself."""

import math
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from gustloom.functions import columns as C
from gustloom.operators import leads as L


def one(spark, *cols):
    return spark.range(1).select(*cols).first()


def test_time_rules(spark):
    r = one(spark, *(f(F.lit(s)).cast("string") for s in ("2026-09-25T06:00:00Z", "2026-09-25T08:00:00+02:00", "2026-09-25T06:00:00", "x") for f in (C.lenient_utc, C.aware_only)))
    at = "2026-09-25 06:00:00"
    assert list(r) == [at, at, at, at, at, None, None, None]
    r = one(spark, C.time_reject(F.lit("2026-09-25T06:00:00"), True), C.time_reject(F.lit("2026-09-25T06:00:00"), False), C.time_reject(F.lit("x"), True))
    assert list(r) == ["timezone_required", None, "unparseable_timestamp"]
    r = one(spark, *(C.epoch_or_iso(F.lit(v)).cast("string") for v in ("1790316000", "1790316000000", "2026-09-25T06:00:00Z", "no")))
    assert r[0] == r[1] and r[2] == at and r[3] is None
    r = one(spark, C.message_time(F.lit("20260920"), F.lit("600")), C.message_time(F.lit("2026092"), F.lit("600")), C.packed_time(F.lit("2026092506")))
    assert r[0] == datetime(2026, 9, 20, 6) and r[1] is None and r[2] == datetime(2026, 9, 25, 6)


def test_rounding_is_pythons(spark):
    values = [2.675, 0.125, 1.005, -2.5, 1234567.891, 0.5, 1e-9, 3.14159]
    for d in (0, 1, 2, 3):
        got = [r[0] for r in spark.createDataFrame([(v,) for v in values], "v double").select(C.py_round("v", d)).collect()]
        assert got == [float(round(v, d)) for v in values]


@pytest.mark.parametrize("u,v", [(3.0, 4.0), (-3.0, 0.0), (0.0, -5.0), (1.5, 2.5), (0.0, 0.1)])
def test_wind(spark, u, v):
    r = one(spark, C.wind_from_uv(F.lit(u), F.lit(v), F.lit(7.0)))[0]
    s = math.hypot(u, v)
    assert r["wind_speed_ms"] == round(s, 3) and r["wind_speed_kt"] == round(s * 1.943844, 2) and r["wind_direction_deg"] == round((270 - math.degrees(math.atan2(v, u))) % 360, 1)
    assert r["gust_factor"] == (round(7.0 / s, 2) if s > 0.2 else None)


def test_required_wind(spark):
    wind, error = C.required_wind(F.lit(1.0), F.lit(None).cast("double"), F.lit(None).cast("double"))
    r = one(spark, wind, error)
    assert r[0] is None and r[1] == "missing v,gust"


def test_steps(spark):
    cases = {"0m-15m": 0.25, "0m-90m": 1.5, "0-3": 3.0, "6": 6.0, "1d": 24.0, "": None, "90s": 0.025}
    rows = spark.createDataFrame([(k,) for k in cases], "s string").select("s", C.step_end_hours("s").alias("h"), C.step_end("s").alias("i")).collect()
    for r in rows:
        assert r["h"] == pytest.approx(cases[r["s"]]) if cases[r["s"]] is not None else r["h"] is None
    assert {r["s"]: r["i"] for r in rows}["0m-15m"] is None and {r["s"]: r["i"] for r in rows}["0-3"] == 3


def test_small_things(spark):
    r = one(
        spark, C.locale_number(F.lit(" 3,5 ")), C.locale_number(F.lit("-999")), C.sector_degrees(F.lit(4)), C.sector_degrees(F.lit(16)), C.circular_difference(F.lit(350.0), F.lit(10.0)), C.mph_to_ms(F.lit(10.0)), C.knots_to_ms(F.lit(10.0)),
        C.variable_direction(F.lit("ETNW VRB 02KT"), F.lit("1")), C.variable_direction(F.lit("x"), F.lit("VRB")), C.variable_direction(F.lit("x"), F.lit("120")), C.redact(F.lit("a k&y b k%26y ?API-KEY=abc&x=1 x-api-secret: d; token=e"), "k&y"), C.finite(F.lit(float("nan"))),
    )
    assert list(r) == [3.5, None, 90.0, None, 20.0, 4.4704, 5.144, True, True, False, "a ***REDACTED*** b ***REDACTED*** ?API-KEY=***REDACTED***&x=1 x-api-secret: ***REDACTED***; token=e", False]
    s, bad = C.availability_status(F.lit("not_offered"), F.lit(False)), C.availability_status(F.lit("odd"), F.lit(False))
    r = one(spark, s[0], s[1], bad[0], bad[1], C.availability_status(F.lit(None).cast("string"), F.lit(True))[0])
    assert r[0] == "not_yet_published" and r[1] is None and r[2] is None and r[3] and r[4] == "fetch_error"


def test_classes(spark):
    r = one(spark, *(C.archive_age_class(F.lit(x)) for x in (-16.0, 180.0, 2880.0, 2881.0)), *(C.report_age_class(F.lit(x)) for x in (120.0, 360.0, 361.0)), *(C.due(F.lit(x), 150.0) for x in (-16.0, -1.0, 149.9, 150.0)), C.due(F.lit(None).cast("double"), 150.0))
    assert list(r) == ["timestamp_validation_failure", "recent_historical_reference", "provider_archive_lag_plausible", "provider_archive_unusually_delayed", "fresh", "delayed", "stale", True, False, False, True, True]


def test_first_alias(spark):
    m = F.from_json(F.lit('{"10fg3": [{"value": 9.5}, {"value": 1.0}], "10fg6": [{"value": 2.0}]}'), "map<string, array<struct<value: double>>>")
    assert one(spark, C.first_alias(m, "10fg", "10fg3", "10fg6"))[0] == 9.5


def test_grid(spark):
    rows = spark.createDataFrame([(m, h) for m in L.MODELS for h in (0, 3, 6, 12)], "model string, hour int")
    got = {(r[0], r[1]): r for r in rows.select("model", "hour", L.grid("model", "hour"), L.native_max("model", "hour"), L.policy("model", "hour"), L.extension("model", "hour")).collect()}
    sizes = {("ICON-D2", 0): 17, ("ICON-D2-EPS", 0): 17, ("ICON-EU", 0): 33, ("ECMWF-IFS", 0): 48, ("GFS", 0): 49, ("GEFS-control", 0): 68, ("GFS", 6): 33, ("ECMWF-IFS", 6): 33, ("ICON-EU", 3): 17}
    assert {k: len(got[k][2]) for k in sizes} == sizes
    assert 126 not in got["GEFS-control", 0][2] and 246 not in got["GEFS-control", 0][2] and got["GEFS-control", 0][2][-1] == 840
    assert (got["ECMWF-IFS", 6][4]["provider_native_horizon_hours"], got["ECMWF-IFS", 6][4]["acquisition_max_lead_hours"], got["ECMWF-IFS", 6][4]["compatibility_horizon_hours"]) == (144, 120, 90)
    assert got["GFS", 6][5] == [] and got["ICON-D2", 0][5] == []


def test_contract(spark):
    r = one(spark, *(L.gefs_contract(F.lit(0), F.lit(x)) for x in (240, 246, 841, -1)), L.gefs_contract(F.lit(6), F.lit(400)))
    assert r[0]["wind_product"] == "gefs_0p25s" and r[0]["gust_required"] and r[1]["wind_product"] == "gefs_0p50a" and not r[1]["gust_required"] and r[1]["subset_padding_degrees"] == 0.75
    assert not r[2]["expected"] and r[3] is None and not r[4]["expected"] and r[4]["expected_max_hours"] == 384
    assert one(spark, L.batches(F.lit(list(range(14)))))[0] == [list(range(6)), list(range(6, 12)), [12, 13]]
    c = L.candidate_cycles(spark, "2026-09-25 07:00:00").orderBy("rank").collect()
    assert len(c) == 10 and c[0]["run"] == datetime(2026, 9, 25, 6)
