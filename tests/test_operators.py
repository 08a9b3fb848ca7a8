"""Gate, publication, streaming, sources and small operators."""

import gzip
import hashlib
import json
import zipfile
from datetime import datetime, timedelta

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gustloom.functions import columns as C
from gustloom.operators import coverage, ensemble, gate, timeline
from gustloom.rules.engine import bundle_rules, issues
from gustloom.sinks import publish as P
from gustloom.sources import bundles as B
from gustloom.sources import grib_text, requests, stations
from gustloom.streaming import landing

T0 = datetime(2026, 9, 25, 0)


def test_gate(spark):
    run = "model string, run timestamp"
    found = spark.createDataFrame([("A", T0, None), ("B", T0, None), ("C", T0, None), ("GEFS-control", T0, None), ("E", None, None), ("F", T0, "timeout")], run + ", probe_error string")
    have = spark.createDataFrame([("A", T0), ("B", T0), ("GEFS-control", T0), ("F", T0)], run)
    latest = spark.createDataFrame([("A", T0, True), ("B", T0, False), ("GEFS-control", T0, True), ("F", T0, True)], run + ", complete boolean")
    seed = spark.createDataFrame([("A", T0), ("A", T0), ("B", T0), ("B", T0 + timedelta(hours=6)), ("GEFS-control", T0), ("F", T0)], run)
    later = T0 + timedelta(hours=3)
    retry = spark.createDataFrame([("GEFS-control", T0, "pending", 0, later), ("A", T0, "pending", 0, later)], run + ", state string, attempts int, not_before timestamp")
    plan = lambda h: {r["model"]: (r["action"], r["reason"]) for r in gate.plan(found, have, latest, seed, retry, F.lit(T0 + timedelta(hours=h))).collect()}
    assert plan(3) == {
        "A": ("carry_forward", "selected_cycle_already_archived"), "B": ("fetch", "fetch_fail_open_missing_latest_success_source_seed_payload_rows"), "C": ("fetch", "fetch_fail_open_missing_private_cycle_evidence_latest_success_source_seed_payload_rows"),
        "GEFS-control": ("supplemental_retry", "archived_cycle_has_due_bounded_pgrb2b_retry"), "E": ("fetch", "probe_not_run_fail_open"), "F": ("fetch", "provider_cycle_probe_failed_fail_open"),
    }
    assert plan(2.9)["GEFS-control"] == ("carry_forward", "selected_cycle_already_archived")
    states = spark.createDataFrame([(None, None, 0, False), (None, None, 2, False), ("pending", 0, 2, True), ("pending", 0, 0, True)], "s string, a int, m int, t boolean")
    assert [r[0] for r in states.select(gate.next_retry(F.col("s"), F.col("a"), F.col("m"), F.col("t"), F.lit(T0))["state"]).collect()] == ["not_needed", "pending", "exhausted", "complete"]


def contents(spark, *rows):
    return spark.createDataFrame([(kind, T0 + timedelta(hours=h), content) for kind, h, content in rows], "kind string, generated_at timestamp, content binary")


def test_publish(spark, tmp_path):
    root, now = str(tmp_path / "store"), F.lit(T0)
    first = P.publish(spark, root, contents(spark, ("models", 2, b"a"), ("svg", 1, b"b")), now)
    assert sorted(r["outcome"] for r in first.collect()) == ["written", "written"]
    before = P.objects(spark, root).select("path", "sha256")
    again = P.publish(spark, root, contents(spark, ("models", 2, b"a"), ("models", 1, b"old")), now)
    assert sorted(r["outcome"] for r in again.collect()) == ["same", "written"]
    assert {r["kind"]: r["generated_at"] for r in P.pointers(spark, root).collect()} == {"models": T0 + timedelta(hours=2), "svg": T0 + timedelta(hours=1)}
    assert P.preserved(spark, root, before).count() == 0 and P.receipts(spark, root).count() == 3 and P.Store(spark, root).version() == 2
    with pytest.raises(P.Conflict):
        P.publish(spark, root, contents(spark, ("models", 2, b"other")), now)
    third = P.publish(spark, root, contents(spark, ("models", 2, b"a")), now)
    assert [r["outcome"] for r in third.collect()] == ["same"] and P.Store(spark, root).version() == 2 and P.objects(spark, root).count() == 3
    held = P.objects(spark, root).where("kind = 'svg'").first()
    assert gzip.decompress(held["content"]) == b"b" and held["source_sha256"] == hashlib.sha256(b"b").hexdigest() and held["sha256"] == hashlib.sha256(gzip.compress(b"b", 9, mtime=0)).hexdigest()


def test_publish_behind_another_writer(spark, tmp_path, monkeypatch):
    """Who loses the race for a version looks again: a pointer that has moved on stays, and the objects go on top of the winner's."""
    root, now, waits = str(tmp_path / "store"), F.lit(T0), []
    claim, raced = P.Store.claim, []

    def late(store, version, commit, source=None):
        if not raced:
            raced.append(version)
            P.publish(spark, root, contents(spark, ("models", 5, b"theirs")), now)
        return claim(store, version, commit, source)

    monkeypatch.setattr(P.Store, "claim", late)
    ours = P.publish(spark, root, contents(spark, ("models", 3, b"ours"), ("svg", 3, b"ours too")), now, sleep=waits.append)
    assert sorted(r["outcome"] for r in ours.collect()) == ["written", "written"] and waits == [1] and raced == [1]
    assert {r["kind"]: r["generated_at"].hour for r in P.pointers(spark, root).collect()} == {"models": 5, "svg": 3}
    assert P.objects(spark, root).count() == 3 and P.Store(spark, root).version() == 2
    monkeypatch.setattr(P.Store, "claim", lambda *a: False)
    with pytest.raises(RuntimeError, match="another writer"):
        P.publish(spark, root, contents(spark, ("svg", 9, b"z")), now, sleep=waits.append)
    assert waits[1:] == [1, 2, 4, 8, 12, 16, 20] and P.objects(spark, root).count() == 3


def test_uncommitted_files_are_not_there(spark, tmp_path, monkeypatch):
    root, now = str(tmp_path / "store"), F.lit(T0)
    P.publish(spark, root, contents(spark, ("svg", 1, b"b")), now)

    def lost(*_):
        raise OSError("lost")

    with monkeypatch.context() as m:
        m.setattr(P.Store, "claim", lost)
        with pytest.raises(OSError):
            P.publish(spark, root, contents(spark, ("svg", 2, b"c")), now)
    assert P.objects(spark, root).count() == 1 and P.pointers(spark, root).first()["generated_at"].hour == 1
    assert [r["outcome"] for r in P.publish(spark, root, contents(spark, ("svg", 2, b"c")), now).collect()] == ["written"] and P.objects(spark, root).count() == 2


def test_publish_without_work(spark, tmp_path):
    root = str(tmp_path / "store")
    plan = spark.createDataFrame([("GFS", "carry_forward")], "model string, action string")
    out = P.publish(spark, root, contents(spark, ("models", 1, b"a"), ("svg", 1, b"b")), F.lit(T0), plan=plan)
    assert {r["kind"]: r["outcome"] for r in out.collect()} == {"models": "suppressed_noop", "svg": "written"} and P.objects(spark, root).count() == 1


def test_snapshot_replaces_what_it_is_made_of(spark, tmp_path):
    out = str(tmp_path / "snap")
    rows = spark.createDataFrame([("p", 6, 1.0), ("p", 3, 2.0), ("q", 0, 3.0)], "path string, lead int, v double")
    P.snapshot(spark, rows, out, F.lit(T0))
    P.snapshot(spark, P.read_snapshot(spark, out).where("lead > 0"), out, F.lit(T0 + timedelta(hours=1)))
    got = P.read_snapshot(spark, out).orderBy("path", "lead").collect()
    assert [(r["path"], r["lead"], r["leads_hours"], r["retrieved_at"]) for r in got] == [("p", 3, [3, 6], T0 + timedelta(hours=1)), ("p", 6, [3, 6], T0 + timedelta(hours=1))]


def test_batch(spark):
    good = [("b", k, T0 + timedelta(minutes=i), "s", 0, True) for i, k in enumerate(("wunstorf", "etnw"))]
    reports = spark.createDataFrame([*good, ("c", "etnw", T0, "s", 0, True)], "batch string, kind string, generated_at timestamp, sha256 string, error_count int, ready boolean")
    method = "private-transfer-readback-v2"
    receipts = spark.createDataFrame([(g[1], g[2], "s", True, method) for g in good], "kind string, generated_at timestamp, sha256 string, readback_verified boolean, method_version string")
    whole, faults = P.batch_receipts(reports, receipts)
    assert [(r["batch"], r["generated_at"]) for r in whole.collect()] == [("b", T0 + timedelta(minutes=1))]
    assert {(r["batch"], r["fault"]) for r in faults.collect()} >= {("c", "receipt_missing")}


def test_reports_as_json(spark):
    reports = spark.createDataFrame([("a", "FAIL", 1), ("b", "PASS", 0)], "path string, status string, error_count int")
    found = spark.createDataFrame([("a", "C2", "WARN", "s", "x", "{}"), ("a", "C1", "ERROR", "t", "y", '{"n":1}')], "path string, code string, severity string, source string, scope string, details string")
    got = {r["path"]: json.loads(r["json"]) for r in P.report_json(reports, found).collect()}
    assert got["b"] == {"path": "b", "status": "PASS", "error_count": 0, "issues": []} and [i["code"] for i in got["a"]["issues"]] == ["C1", "C2"] and got["a"]["issues"][0]["details"] == '{"n":1}'


def test_streams(spark, tmp_path):
    land, out = tmp_path / "land", str(tmp_path / "out")
    land.mkdir()
    (land / "a.json").write_text(json.dumps({"observations": [{"time_utc": "2026-09-25T00:00:00Z", "wind_speed_ms": 2.0}]}))
    (land / "b.json").write_text("{broken")
    audit = lambda b: b.select("path", F.col("payload").isNotNull().alias("ok"))
    for _ in range(2):
        landing.audit_stream(spark, str(land), str(tmp_path / "c1"), audit, out).awaitTermination()
    assert {r["path"]: r["ok"] for r in spark.read.parquet(out).collect()} == {"a.json": True, "b.json": False}
    src = str(tmp_path / "src")
    schema = "k string, t timestamp, v int"
    spark.createDataFrame([("x", T0, 1), ("x", T0 + timedelta(hours=2), 2)], schema).write.parquet(src)
    new = str(tmp_path / "new")
    for _ in range(2):
        landing.latest_state(spark.readStream.schema(schema).parquet(src), ["k"], "t", str(tmp_path / "c2"), new).awaitTermination()
        spark.createDataFrame([("x", T0 + timedelta(hours=1), 3)], schema).write.mode("append").parquet(src)
    assert [r["v"] for r in spark.read.parquet(new).orderBy("batch").collect()] == [2, 2]


def test_bundle_files(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"models": {"GFS": [{"values": {"t": {"value": 1}, "u": [{"value": 2}, {"value": 3}], "w": {"error": "x"}}}, 5]}}')
    (tmp_path / "b.json").write_bytes(b"\xff{")
    manifest = spark.createDataFrame([("a.json",), ("b.json",), ("c.json",)], "path string")
    b = B.read_bundles(spark, str(tmp_path), manifest)
    got = {r["path"]: (r["present"], r["n_bytes"] is not None, r["p"]) for r in b.select("path", "present", "n_bytes", F.col("payload").isNotNull().alias("p")).collect()}
    assert got == {"a.json": (True, True, True), "b.json": (True, True, False), "c.json": (False, False, False)}
    (tmp_path / ".a.json.crc").write_bytes(b"crc\0\0\0\2\0wrong sums")  # the file system finds other bytes than were written
    broken = B.read_bundles(spark, str(tmp_path), manifest)
    got = {r["path"]: (r["present"], r["n_bytes"]) for r in broken.select("path", "present", "n_bytes").collect()}
    assert got["a.json"] == (True, None) and got["b.json"][1] == 2
    codes = {(r["path"], r["code"]) for r in issues(broken, ["path"], *bundle_rules("MODEL", "collector")).collect()}
    assert codes == {("a.json", "MODEL_BUNDLE_FILE_READ_FAILED"), ("b.json", "MODEL_BUNDLE_JSON_INVALID"), ("c.json", "MODEL_BUNDLE_FILE_NOT_CREATED")}
    (tmp_path / ".a.json.crc").unlink()
    values = {(r["parameter"], r["message"]): (r["value"], r["error"]) for r in B.native_values(B.records(b)).collect()}
    assert values == {("t", 0): (1.0, None), ("u", 0): (2.0, None), ("u", 1): (3.0, None), ("w", 0): (None, "x")}


def test_station_csv(spark, tmp_path):
    """Members named as products come before others; of several the one with the most usable rows; old rows go where a clock is given."""
    row = lambda *cells: ";".join(cells) + ";eor\n"
    head = row("STATIONS_ID", " mess_datum_woz", "  F", "   D")
    files = {
        "a.zip": {"meta.txt": head + row("1", "2025010100", "1", "10") * 9, "Produkt_x.txt": head + row("1", "2025010100", " 3,5", "240") + row("1", "2025010101", "-999", "240") + row("1", "2025010102", "4.0", "250"), "produkt_y.txt": head + row("1", "2025010100", "9", "1"), "produkt.csv": head},
        "b.zip": {"one.txt": "a;b\n1;2\n", "two.txt": row("MESS_DATUM", "FF", "DD") + row("202412010030", "2", "0") + row("2024120101", "2", "") + row("2025010100", "2", "5")}, "c.zip": {"notes.md": head},
    }
    for name, members in files.items():
        with zipfile.ZipFile(tmp_path / name, "w") as f:
            for member, text in members.items():
                f.writestr(member, text.encode("latin-1"))
    day = datetime(2025, 1, 1)
    got = lambda now: sorted((r["path"], r["member"], r["time"], r["wind_speed_ms"]) for r in stations.station_csv(spark, str(tmp_path), now).collect())
    kept = [("a.zip", "Produkt_x.txt", day, 3.5), ("a.zip", "Produkt_x.txt", day + timedelta(hours=2), 4.0), ("b.zip", "two.txt", day, 2.0)]
    assert got(None) == sorted([*kept, ("b.zip", "two.txt", datetime(2024, 12, 1, 0, 30), 2.0)]) and got(F.lit(day)) == kept


def test_sensors(spark):
    wanted = lambda kind, *rows: {"sensor_type": 48, "data_structure_type": kind, "data": list(rows)}
    now = wanted(2, {"ts": 10, "wind_speed_10_min_avg": 1}, "x", {"ts": "20", "wind_speed_10_min_avg": "20", "wind_speed": 5, "wind_gust_10_min": None, "wind_dir": 90}, {"wind_speed": 7})
    then = wanted(4, {"ts": 90, "wind_speed_avg": 2, "wind_dir_of_prevail": 4, "wind_dir_of_hi": 16, "wind_num_samples": 40}, {"wind_speed_avg": 3}, {"ts": 30, "wind_dir_of_hi": 15})
    p = B.from_text(spark.createDataFrame([("s", json.dumps({"sensors": [{"sensor_type": 1, "data_structure_type": 2, "data": [{"ts": 99}]}, now, then, wanted(2, {"ts": 50})]})), ("t", "[]")], "bundle_id string, json string"))
    assert [tuple(r)[2:] for r in stations.current_observation(p).collect()] == [(8.9408, 2.2352, None, 90.0)]
    series = stations.historic_series(p).first()["observations"]
    assert [(x["time"].timestamp(), x["wind_speed_ms"], x["wind_direction_deg"], x["wind_gust_direction_deg"], x["wind_samples"]) for x in series] == [(30, None, None, 337.5, None), (90, 0.8941, 90.0, None, 40)]


def test_grib_text(spark):
    lines = spark.createDataFrame([("f", "10u 20250314 600 3 20250314 900"), ("f", " 10v  20250314 600 0-6 20250314 1200 x"), ("g", "10u 20250314 600 3 20250314 900"), ("g", "  "), ("h", "10u 20250314 600 3")], "file string, line string")
    m = grib_text.identities(lines)
    run, valid = F.lit(datetime(2025, 3, 14, 6)), F.lit(datetime(2025, 3, 14, 9))
    assert [(r["file"], r["reject"]) for r in m.where("reject is not null").collect()] == [("h", "incomplete_identity_row")] and m.count() == 4
    assert {r["file"]: r["reason"] for r in grib_text.identity_reject(m.where("reject is null"), ["file"], run, valid).collect()} == {"f": "valid_time_mismatch", "g": None}
    assert grib_text.exact(m, run, valid).count() == 2
    b = {r["file"]: (r["leads"], [tuple(x) for x in r["failures"]]) for r in grib_text.batch_leads(m.where("reject is null"), ["file"], run, F.lit([3, 6])).collect()}
    assert b == {"f": ([3, 6], []), "g": ([3], [("expected_leads_missing_from_grib_batch", None, 6)])}
    out = [("a", i, x) for i, x in enumerate(["edition 2", "tcc 0-3 20250314 0.75", "2t 3 x 281.5", "2t 3 missing", "Grid Point chosen #2 index=4 latitude=-52.5 longitude=9.25 distance=1 (Km)"])] + [("b", 0, "2t 3 1.5"), ("c", 0, "Grid Point chosen latitude=1 longitude=2")]
    tool = spark.createDataFrame(out, "f string, pos int, line string")
    assert [tuple(r) for r in grib_text.nearest(tool, ["f"]).orderBy("pos").collect()] == [("a", 0, "tcc", "0-3", 0.75, -52.5, 9.25), ("a", 1, "2t", "3", 281.5, -52.5, 9.25)]
    assert {r["f"]: r["reject"] for r in grib_text.nearest_reject(tool, ["f"]).collect()} == {"b": "no_grid_point", "c": "no_values"}
    meta = spark.createDataFrame([("a", 0, "tcc"), ("a", 1, "2d")], "f string, pos int, short_name string")
    assert [r["mismatch"] for r in grib_text.with_metadata(meta, grib_text.nearest(tool, ["f"]), ["f"]).orderBy("pos").collect()] == [False, True]
    short = spark.createDataFrame([("a", 0, "tcc"), ("a", 1, "2t"), ("a", 2, "2d"), ("z", 0, "2t")], "f string, pos int, short_name string")
    assert grib_text.with_metadata(short, grib_text.nearest(tool, ["f"]), ["f"]).count() == 0
    assert sorted(map(tuple, grib_text.metadata_reject(short, grib_text.nearest(tool, ["f"]), ["f"]).collect())) == [("a", 3, 2, "metadata_value_count_mismatch"), ("z", 1, 0, "metadata_value_count_mismatch")]
    assert [tuple(r) for r in grib_text.metadata_reject(meta, grib_text.nearest(tool, ["f"]), ["f"]).collect()] == [("a", 2, 2, "metadata_value_name_mismatch")]
    plan = requests.plan(spark.createDataFrame([("GFS", T0, 3)], "model string, run timestamp, lead int"), {"gfs_0p25": 0.3}, probe=True).first()["query"]
    assert "f003" in plan and "leftlon=9.042" in plan and "var_UGRD=on" in plan and "APCP" not in plan and "TMP" not in plan
    cols = spark.createDataFrame([("a", [1, 2], ["x", "y"]), ("b", [1], ["x", "y"])], "f string, p array<int>, q array<string>")
    assert grib_text.zipped(cols, ["f"], ["p", "q"]).count() == 2 and grib_text.zip_reject(cols, ["f"], ["p", "q"]).first()["f"] == "b"


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from("ab"), st.integers(-5, 40)), min_size=1, max_size=60), st.integers(1, 9))
def test_lag_over_ranges_by_brute_force(spark, rows, ranges):
    df = spark.createDataFrame([(i, k if k == "a" else None, v) for i, (k, v) in enumerate(rows)], "i int, k string, v int")
    got = {r["i"]: r["before"] for r in timeline.lagged(df, ["k"], "i", "v", "before", ranges).collect()}
    last, want = {}, {}
    for i, (k, v) in enumerate(rows):
        want[i] = last.get(k)
        last[k] = v
    assert got == want


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from("ab"), st.one_of(st.none(), st.integers(-3, 3).map(float), st.floats(-1e6, 1e6))), min_size=1, max_size=80), st.integers(2, 9))
def test_large_percentiles_by_brute_force(spark, rows, bins):
    df = spark.createDataFrame([(k if k == "a" else None, v) for k, v in rows], "k string, v double")
    shares = [0.0, 0.1, 0.5, 0.9, 1.0]
    runs = []
    for few in (0, 10**6):  # both plans
        with pytest.MonkeyPatch.context() as m:
            m.setattr(ensemble, "FEW_VALUES", few)
            runs.append({r["k"]: tuple(r)[1:] for r in ensemble.large_percentiles(df, ["k"], "v", shares, bins).collect()})
    want = {}
    for key in {k if k == "a" else None for k, v in rows if v is not None}:
        vs = [v for k, v in rows if (k if k == "a" else None) == key and v is not None]
        want[key] = (len(vs), *(pytest.approx(float(np.quantile(vs, s)), abs=1e-6) for s in shares))
    assert runs == [want, want]


def test_large_percentiles_never_deal_rows_by_the_key_alone(spark, sf, monkeypatch):
    """What is shuffled by key is counted by value before; all joins are broadcast, also where the session would broadcast nothing by itself."""
    monkeypatch.setattr(ensemble, "FEW_VALUES", 0)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = ensemble.large_percentiles(spark.read.parquet(f"{sf}/lineitem.parquet"), ["l_returnflag"], "l_extendedprice", [0.5])._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "SortMergeJoin" not in plan and "ShuffledHashJoin" not in plan and "BroadcastHashJoin" in plan
    assert "hashpartitioning(l_returnflag" in plan and all("_v" in x or "_bin" in x or "_bin" in plan for x in plan.split("Exchange hashpartitioning(")[1:])


def test_first_wins_and_top(spark):
    rows = spark.createDataFrame([("a", 2, "x"), ("a", None, "y"), ("a", 1, None), ("b", None, "z")], "k string, o int, v string")
    assert sorted(map(tuple, timeline.first_wins(rows, ["k"], ["o"]).collect())) == [("a", 1, None), ("b", None, "z")]
    assert sorted((r["k"], r["n"]) for r in timeline.top(rows, ["k"], ["o", "v"], 2).collect()) == [("a", 1), ("a", 2), ("b", 1)]
    cycles = spark.createDataFrame([("a", 1, True), ("a", 2, False), ("a", 3, False), ("b", 1, False)], "k string, c int, p boolean")
    assert [tuple(r) for r in timeline.newest_eligible(cycles, ["k"], "c", "p").collect()] == [("a", 1, 3)]
    assert [[x["cycle"] for x in r["trail"]] for r in timeline.newest_eligible(cycles, ["k"], "c", "p", most=2).collect()] == [[3, 2]]


def test_ensemble(spark):
    rows = spark.createDataFrame([("k", ["2026-09-25T00:00:00Z", "2026-09-25T01:00:00Z"], {"wind_speed_10m": {"0": [1.0, 2.0], "1": [3.0, 4.0]}})], "k string, times array<string>, columns map<string, map<string, array<double>>>")
    long = ensemble.unpivot_hourly(rows, ["k"])
    assert long.count() == 4 and long.where("member = 1 and value = 4.0").count() == 1
    names = spark.createDataFrame([("w",), ("w_member07",), ("x",)], "n string")
    assert [r[0] for r in names.select(ensemble.member_of("n", "w")).collect()] == [0, 7, None]
    assert spark.createDataFrame([(0.0,), (180.0,)], "d double").agg(ensemble.circular_mean("d")).first()[0] is None
    assert spark.createDataFrame([(350.0,), (10.0,)], "d double").agg(F.round(ensemble.circular_mean("d"), 6) % 360).first()[0] == 0.0


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(0, 200), min_size=1, max_size=12), st.lists(st.integers(0, 200), min_size=1, max_size=12))
def test_nearest_by_brute_force(spark, left, right):
    make = lambda xs: spark.createDataFrame([(i, T0 + timedelta(minutes=m)) for i, m in enumerate(xs)], "id int, t timestamp")
    got = {r["left_id"]: r["right_id"] for r in timeline.nearest(make(left), make(right), "id", "t", "id", "t", 1800).collect()}
    want = {}
    for i, a in enumerate(left):
        near = [(abs(b - a), b, j) for j, b in enumerate(right) if abs(b - a) <= 30]
        if near:
            want[i] = min(near)[2]
    assert got == want


def test_two_model_rules(spark):
    rows = spark.createDataFrame([("a", "GFS", True), ("a", "GEFS-control", True), ("b", "GFS", True), ("b", "ICON-D2", True)], "k string, m string, ok boolean")
    got = {r["k"]: tuple(r)[1:] for r in coverage.two_model_rules(rows, ["k"], "m", F.col("ok")).collect()}
    assert got == {"a": (True, False, False), "b": (True, True, True)}


def test_merge_products(spark):
    rows = spark.createDataFrame([(3, "p", [1]), (3, "p", [2]), (6, "p", [1]), (6, "q", [2])], "lead int, point string, v array<int>")
    got = {r["lead"]: (sorted(r["v"]), r["conflict"]) for r in coverage.merge_products(rows, ["lead"], "point", "v").collect()}
    assert got == {3: ([1, 2], False), 6: ([1, 2], True)}


def test_gzip_payloads_read_as_json(spark, tmp_path):
    (tmp_path / "a.json.gz").write_bytes(gzip.compress(b'{"a": 1}'))
    assert spark.read.json(str(tmp_path)).first()["a"] == 1


def test_identity_failures(spark):
    """All of a file's failures; files without messages and leads that are no whole hours have one of their own."""
    hour = lambda h: T0 + timedelta(hours=h)
    files = spark.createDataFrame([("ok", T0, hour(3)), ("bad", T0, hour(3)), ("none", T0, hour(3)), ("half", T0, hour(2.5)), ("past", T0, hour(-1))], "f string, expected_run timestamp, expected_valid timestamp")
    lines = [("ok", "10u 20260925 0 3 20260925 300"), ("bad", "10u 20260925 0 3 20260925 300"), ("bad", "10v 20260924 2100 0-360m 20260925 600"), ("bad", "gust 20260925 0 x 20260925 300"), ("half", "10u 20260925 0 3 20260925 300"), ("half", "10v 20260925 0 3 20260925 300")]
    got = grib_text.identity_failures(files, grib_text.identities(spark.createDataFrame(lines, "f string, line string")), ["f"])
    assert sorted((r["f"], r["reason"], r["short_name"]) for r in got.collect()) == [
        ("bad", "run_time_mismatch", "10v"), ("bad", "step_end_mismatch", "10v"), ("bad", "step_end_mismatch", "gust"), ("bad", "valid_time_mismatch", "10v"),
        ("half", "expected_lead_not_whole_hours", None), ("none", "no_messages", None), ("past", "expected_lead_not_whole_hours", None),
    ]


def test_grid_provenance(spark):
    lines = [("a", "unstructured_grid 101 47 a1b2 542040"), ("b", " unstructured 101 47 a1b2 542040 "), ("c", "regular_ll 0 47 a1b2 9"), ("d", "unstructured_grid 101 48 a1b2 9"), ("e", "unstructured_grid 101 47"), ("f", "unstructured_grid 47 101 a1b2 9")]
    natives = grib_text.grid_identity(spark.createDataFrame(lines, "k string, line string"))
    one = natives.where("k = 'a'").first()
    assert (one["template_number"], one["grid_number"], one["uuid"], one["n_points"], one["reject"]) == (101, 47, "a1b2", 542040, None)
    assert [r["k"] for r in natives.where("reject = 'grid_identity_incomplete'").collect()] == ["e"]
    tool = [(k, i, x) for k in "abcdefh" for i, x in enumerate(["10u 3 1.5", f"Grid Point chosen #1 index=1 latitude={52.5 if k != 'b' else 52.52} longitude=9.34 distance=1"])]
    points = grib_text.nearest(spark.createDataFrame(tool, "k string, pos int, line string"), ["k"])
    returned = spark.createDataFrame([(k, 52.505, 9.345) for k in "abcdefgh"], "k string, latitude double, longitude double")
    got = {r["k"]: (r["native_verified"], r["parity_verified"], r["verified"]) for r in grib_text.provenance(natives, points, returned, ["k"]).collect()}
    yes, no = True, False
    assert got == {"a": (yes, yes, yes), "b": (yes, no, no), "c": (no, yes, no), "d": (no, yes, no), "e": (no, yes, no), "f": (no, yes, no), "g": (no, no, no), "h": (no, yes, no)}


def test_damaged_archives_are_rejected(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "good.zip", "w") as z:
        z.writestr("produkt_x.txt", "MESS_DATUM;F;D\n202609250000;3;90\n")
    whole = (tmp_path / "good.zip").read_bytes()
    (tmp_path / "page.zip").write_bytes(b"<html>not found</html>")
    (tmp_path / "cut.zip").write_bytes(whole[: len(whole) // 2])
    (tmp_path / "rot.zip").write_bytes(whole.replace(b"202609250000;3", b"202609250000;4"))
    assert [(r["path"], r["wind_speed_ms"]) for r in stations.station_csv(spark, str(tmp_path)).collect()] == [("good.zip", 3.0)]
    assert sorted(r["path"] for r in stations.station_csv_rejects(spark, str(tmp_path)).collect()) == ["cut.zip", "page.zip", "rot.zip"]


def test_times_steps_and_links(spark):
    row = spark.range(1).select(
        *(C.message_time(F.lit("20260925"), F.lit(t)).alias(f"t{i}") for i, t in enumerate(["120000", "12000", "1200", "0", " 600 ", "12:0"])), *(C.step_end_hours(F.lit(t)).alias(f"s{i}") for i, t in enumerate(["0-30M", "0m-90m", "1D", "0-3600S", "3-6", "6H", "x", "0-1.5h", "12 h"])),
        stations.hrefs(F.lit("<A HREF='a.grib2.bz2'>x</A><a href=\"b.GRIB2.BZ2\">y</a><a href='c.html'>")).alias("all"), stations.hrefs(F.lit("<A HREF='a.grib2.bz2'>x</A><a href=\"b.GRIB2.BZ2\">y</a><a href='c.html'>"), ending=".grib2.bz2").alias("some"),
    ).first()
    assert [row[f"t{i}"] and row[f"t{i}"].hour for i in range(6)] == [None, None, 12, 0, 6, None]
    assert [row[f"s{i}"] for i in range(9)] == [0.5, 1.5, 24.0, 1.0, 6.0, 6.0, None, 1.5, 12.0]
    assert row["all"] == ["a.grib2.bz2", "b.GRIB2.BZ2", "c.html"] and row["some"] == ["a.grib2.bz2", "b.GRIB2.BZ2"]


def test_batch_receipt_faults(spark):
    """Each field of a receipt that differs from its report comes out by itself."""
    at = lambda m: T0 + timedelta(minutes=m)
    stamp = "20260925T000000000000Z"
    good = ("wunstorf", T0, "s", True, "private-transfer-readback-v2", stamp, "s", "c0ffee")
    cases = {"ok": {}, "payload_sha256": {2: "other"}, "stamp": {5: "x"}, "audit_input_payload_sha256": {6: None}, "verified_data_commit_sha": {7: ""}, "readback_verified": {3: False}, "method_version": {4: None}}
    reports = spark.createDataFrame([(name, f"wunstorf:{name}", T0, "s", 0, True) for name in cases], "batch string, kind string, generated_at timestamp, sha256 string, error_count int, ready boolean")
    rows = [(f"wunstorf:{name}", *[change.get(i, v) for i, v in enumerate(good)][1:]) for name, change in cases.items()]
    found = spark.createDataFrame(rows, "kind string, generated_at timestamp, sha256 string, readback_verified boolean, method_version string, stamp string, audit_sha256 string, commit_sha string")
    whole, faults = P.batch_receipts(reports, found, kinds=("wunstorf",))
    assert [r["batch"] for r in whole.collect()] == ["ok"] and {r["batch"]: r["fault"] for r in faults.collect()} == {name: name for name in cases if name != "ok"} and at(0) == T0


def test_first_and_last_keep_a_column_of_the_rank_s_name(spark):
    rows = spark.createDataFrame([("a", 3, 1), ("a", 3, 2), ("a", 7, 5)], "k string, n int, o int")
    assert sorted(map(tuple, timeline.first_wins(rows, ["k", "n"], ["o"]).collect())) == [("a", 3, 1), ("a", 7, 5)]
    assert sorted((r["k"], r["n"], r["o"]) for r in timeline.last_wins(rows, ["k", "n"], "o").collect()) == [("a", 3, 2), ("a", 7, 5)]


def test_gaps_of_an_array_are_those_of_its_rows(spark):
    minutes = [0, 5, 5.1, 16, 40]
    times = spark.createDataFrame([("a", m) for m in minutes], "k string, m double").select("k", F.timestamp_seconds(F.col("m") * 60).alias("t"))
    rows = sorted(r["missing"] for r in timeline.cadence_gaps(times, ["k"], "t", 5.0).collect())
    held = times.groupBy("k").agg(F.array_sort(F.collect_set("t")).alias("ts"))
    assert sorted(held.select(timeline.array_cadence_gaps("ts", 5.0).alias("g")).first()["g"]) == rows == [1, 4]
    assert held.select(F.slice("ts", 1, 1).alias("ts")).select(timeline.array_cadence_gaps("ts", 5.0).alias("g")).first()["g"] == []


def test_the_grid_works_out_a_model_s_horizon_once_a_row(spark):
    from gustloom.operators import leads as L

    rows = spark.createDataFrame([("GFS", 12), ("ICON-EU", 3), ("GEFS-control", 0), ("other", 6), ("GFS", None)], "model string, hour int")
    got = {(r["model"], r["hour"]): (r["g"], r["e"]) for r in rows.select("model", "hour", L.grid("model", "hour").alias("g"), L.extension("model", "hour").alias("e")).collect()}
    assert [len(got[k][0]) for k in (("GFS", 12), ("ICON-EU", 3), ("GEFS-control", 0))] == [49, 17, 68] and got[("GFS", 12)][1] == [*range(132, 241, 12), *range(264, 385, 24)]
    assert not got[("other", 6)][0] and not got[("GFS", None)][0]
    assert "<= CASE WHEN" not in rows.select(L.grid("model", "hour"))._jdf.queryExecution().analyzed().toString()
