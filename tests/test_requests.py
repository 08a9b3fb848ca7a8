"""Requests of the archive, jobs from an inventory, and small functions that no query calls."""

from datetime import datetime, timedelta
from urllib.parse import parse_qs

from pyspark.sql import functions as F

from gustloom.functions import columns as C
from gustloom.operators import ensemble, gate, records
from gustloom.sinks import publish
from gustloom.sources import bundles, requests, stations

T0 = datetime(2026, 9, 25)


def test_archive_requests(spark):
    rows = [("GFS", T0, 144), ("GEFS-control", T0, 132), ("GEFS-control", T0, 264), ("GEFS-control", T0 + timedelta(hours=6), 408), ("GEFS-control", T0, 408), ("ICON-EU", T0, 3)]
    got = requests.archive_plan(spark.createDataFrame(rows, "model string, run timestamp, lead int")).collect()
    assert sorted((r["model"], r["run"].hour, r["lead"], r["product"], r["required"]) for r in got) == [
        ("GEFS-control", 0, 132, "gefs_0p25s", True), ("GEFS-control", 0, 264, "gefs_0p50a", True), ("GEFS-control", 0, 264, "gefs_0p50b", False),
        ("GEFS-control", 0, 408, "gefs_0p50a", True), ("GEFS-control", 0, 408, "gefs_0p50b", False), ("GFS", 0, 144, "gfs_0p25", True),
    ]
    q = {(r["product"], r["lead"]): parse_qs(r["query"], keep_blank_values=True) for r in got}
    gfs, a, b = q["gfs_0p25", 144], q["gefs_0p50a", 264], q["gefs_0p50b", 264]
    assert gfs["leftlon"] == ["9.0418"] and gfs["toplat"] == ["52.7942"] and a["leftlon"] == ["8.5918"] and gfs["file"] == ["gfs.t00z.pgrb2.0p25.f144"] and a["dir"] == ["/gefs.20260925/00/atmos/pgrb2ap5"]
    assert "var_APCP" in gfs and "var_APCP" in a and {"lev_10_m_above_ground", "lev_surface"} <= set(a) and "lev_10_m_above_ground" not in b and "var_UGRD" not in b and "var_APCP" not in b and {"var_DPT", "var_CAPE", "var_CIN"} <= set(b)


def test_jobs_from_an_inventory(spark):
    models = spark.createDataFrame([("d2",)], "model string")
    rows = spark.createDataFrame([("d2", T0, 3), ("d2", T0, 6), ("eu", T0, 3)], "model string, run timestamp, lead int")
    base = "https://x.example/d2/00/"
    urls = [f"{base}icon_regular-lat-lon_2026092500_003_2d_{p}.grib2.bz2" for p in ("t_2m", "td_2m")] + [f"{base}a_regular-lat-lon_2026092500_003_2d_t_2m.grib2.bz2", f"{base}icon_icosahedral_2026092500_006_2d_t_2m.grib2.bz2", f"{base}icon_regular-lat-lon_2026092418_006_2d_t_2m.grib2.bz2", f"{base}latest.txt"]
    inventory = spark.createDataFrame([("d2", u) for u in urls] + [("eu", urls[0])], "model string, url string")
    got = {(r["lead"], r["parameter"]): r["url"] for r in requests.jobs(models, rows, ["T_2M", "2m"], inventory).collect()}
    assert got == {(3, "T_2M"): urls[2], (6, "T_2M"): None, (3, "2m"): urls[2], (6, "2m"): None}
    assert {r["url"] for r in requests.jobs(models, rows, ["t_2m"], inventory, regular=False).where("lead = 6").collect()} == {urls[3]}


def test_small_functions(spark):
    row = spark.range(1).select(
        C.wind_from_speed(F.lit(5.0), F.lit(365.0), F.lit(7.5)).alias("a"), C.wind_from_speed(F.lit(None).cast("double"), F.lit(5.0), F.lit(7.5)).alias("b"), C.wind_from_members(F.lit(5.00049), F.lit(-10.0), F.lit(7.50051)).alias("c"),
        gate.settled(F.lit(T0), F.lit(T0 + timedelta(hours=3)), F.lit(T0 + timedelta(seconds=600))).alias("d"), gate.settled(F.lit(T0), F.lit(T0 + timedelta(hours=3)), F.lit(T0 + timedelta(seconds=599))).alias("e"), gate.settled(F.lit(T0), F.lit(T0 + timedelta(hours=4)), F.lit(T0 + timedelta(hours=1))).alias("f"),
    ).first()
    assert (row["a"]["wind_direction_deg"], row["a"]["gust_factor"], row["a"]["wind_speed_kt"]) == (5.0, 1.5, 9.72) and row["b"] is None
    assert (row["c"]["wind_speed_ms"], row["c"]["wind_direction_deg"], row["c"]["gust_ms"]) == (5.0, 350.0, 7.501)
    assert (row["d"], row["e"], row["f"]) == (True, False, False)
    axis = spark.createDataFrame([([T0, T0 + timedelta(hours=1)],), ([T0 + timedelta(hours=1), T0],), ([T0, T0],), ([T0 + timedelta(minutes=1)],)], "times array<timestamp>")
    assert [tuple(r)[1:] for r in ensemble.hourly_axis(axis).collect()] == [(True, True, True), (True, False, True), (True, True, False), (False, True, True)]
    long = spark.createDataFrame([("r", 0, T0, f, v) for f, v in (("wind_speed_10m", 5.0), ("wind_direction_10m", 90.0), ("wind_gusts_10m", 8.0), ("cape", 1.0))] + [("r", 1, T0, "wind_speed_10m", 5.0)], "k string, member int, time timestamp, field string, value double")
    assert [(r["member"], r["gust_ms"], r["cape"], r["precipitation"]) for r in ensemble.by_field(long, ["k"]).collect()] == [(0, 8.0, 1.0, None)]
    b = bundles.from_text(spark.createDataFrame([("a", "{}"), ("b", '{"mode":"test","schema_version":3,"models":{"GFS":[]},"quality":{"errors":[1]}}')], "k string, j string"), "k", "j")
    assert [(r["mode"], r["schema_version"], len(r["models"]), len(r["errors"])) for r in bundles.defaults(b).orderBy("path").collect()] == [("unknown", 1, 0, 0), ("test", 3, 1, 1)]
    asked = spark.createDataFrame([("x", True, 0), ("x", False, 5), ("y", True, 0), ("y", True, 2), ("z", False, 0)], "k string, success boolean, n int")
    assert {r["k"]: r["empty_despite_success"] for r in stations.series_empty(asked, ["k"]).collect()} == {"x": True, "y": False}
    assert records.rebound(asked.limit(1), F.lit("c")).first()["contract"] == "c" and publish.provenance(asked.limit(1), run="7").first()["run"] == "7"


def test_failures_of_a_process_outside(spark, tmp_path):
    for at in ("2026-09-25T00:00:00Z", "2026-09-25T01:00:00Z"):
        publish.append_failure(spark, str(tmp_path), "GFS", "fetch", at)
    got = spark.read.parquet(str(tmp_path / "attempts")).orderBy("at").collect()
    assert [(r["model"], r["status"], r["exception_type"], r["at"].hour) for r in got] == [("GFS", "failed_external", "timeout", 0), ("GFS", "failed_external", "timeout", 1)]
