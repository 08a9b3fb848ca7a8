"""Bundles assembled in any order and across failures; carried sources; the choice between days."""

import datetime as dt
import itertools
import json

import pytest
from pyspark.sql import functions as F

from gustloom.rules import carry
from gustloom.sinks import assembly
from gustloom.sources import bundles as B
from gustloom.sources import stations

T0 = dt.datetime(2026, 9, 25)
CELL = "path string, model string, lead int, field string, at timestamp, value double, error string"


def hour(h):
    return T0 + dt.timedelta(hours=h)


BATCHES = [
    [("p", "GFS", 0, "wind", hour(1), 5.0, None), ("p", "GFS", 0, "gust", hour(1), None, "timeout"), ("q", "GFS", 0, "wind", hour(1), 1.0, None)],
    [("p", "GFS", 0, "gust", hour(2), 9.0, None), ("p", "GFS", 3, "wind", hour(2), 6.0, None), ("p", "GFS", 0, "wind", hour(0), 4.0, None)],
    [("p", "GFS", 0, "wind", hour(3), None, "decode"), ("p", "GFS", 3, "gust", hour(3), None, None), ("r", "IFS", 6, "wind", hour(3), 2.0, None), (None, "IFS", 6, "wind", hour(3), 2.0, None)],
]


def snapshot(spark, out):
    r = sorted((x["path"], x["model"], x["lead"], tuple(sorted(x["values"].items())), tuple(sorted(x["errors"].items()))) for x in assembly.records(spark, out).collect())
    c = sorted((x["path"], x["model"], x["leads"], x["n_leads"], x["max_lead"], x["n_received"], x["n_failed"], x["complete"]) for x in assembly.read_coverage(spark, out).collect())
    return r, c


WANT = (
    [("p", "GFS", 0, (("gust", 9.0), ("wind", 5.0)), (("wind", "decode"),)), ("p", "GFS", 3, (("wind", 6.0),), (("gust", "no value"),)), ("q", "GFS", 0, (("wind", 1.0),), ()), ("r", "IFS", 6, (("wind", 2.0),), ())],
    [("p", "GFS", [0], 1, 0, 3, 1, False), ("q", "GFS", [], 0, None, 1, 0, False), ("r", "IFS", [], 0, None, 1, 0, False)],
)


@pytest.mark.parametrize("order", list(itertools.permutations(range(3)))[::2])
def test_any_order_of_batches_gives_one_snapshot(spark, tmp_path, order):
    out = str(tmp_path / "out")
    for i in (*order, order[0]):  # the first one twice
        assembly.merge(spark, out, spark.createDataFrame(BATCHES[i], CELL), ["wind", "gust"])
    assert snapshot(spark, out) == WANT


def test_a_merge_that_was_cut_short_is_finished(spark, tmp_path, monkeypatch):
    out = str(tmp_path / "out")
    for i in (0, 1):
        assembly.merge(spark, out, spark.createDataFrame(BATCHES[i], CELL), ["wind", "gust"])
    untouched = {p.name: p.stat().st_mtime_ns for p in (tmp_path / "out/cells/path=q").iterdir()}
    before = snapshot(spark, out)

    def stop(*_):
        raise OSError("stopped")

    for step in ("create", "_replace"):
        with monkeypatch.context() as m:
            m.setattr(*((assembly.Store, step) if step == "create" else (assembly, step)), stop)
            with pytest.raises(OSError):
                assembly.merge(spark, out, spark.createDataFrame(BATCHES[2], CELL), ["wind", "gust"])
        assert snapshot(spark, out) == before
        assert assembly.recover(spark, out) == (step == "_replace")
    assert snapshot(spark, out) == WANT
    assert {p.name: p.stat().st_mtime_ns for p in (tmp_path / "out/cells/path=q").iterdir()} == untouched


def test_carried_sources(spark):
    run, now = "2026-09-25T00:00:00Z", F.lit("2026-09-26T00:00:00Z").cast("timestamp")
    lead = lambda h: {"forecast_lead_hours": h, "v": [1, {"a": None}]}
    cases = {
        "plain": {"records": [lead(132), lead(126), lead(144)], "lead_status": {"132": {"status": "received"}, "126": 1, "0132": 2}, "errors": [{"leads": [126, 144, True], "x": 1}, {"leads": [126]}, "text", {"leads": "126"}], "keep": {"n": 1.5}},
        "bare": {}, "list": {"records": {"a": 1}}, "text": {"records": ["x"]}, "bool": {"records": [lead(True)]}, "half": {"records": [lead(1.5)]}, "odd": {"errors": {"a": 1}, "lead_status": [1]},
    }
    payloads = [(k, json.dumps({"full_horizon_archive": {"sources": {"GFS": {"run_time_utc": run, **v}}}})) for k, v in cases.items()]
    out = carry.carried(carry.archive_sources(B.from_text(spark.createDataFrame(payloads, "k string, json string"), "k", "json")), now)
    rows = {r["path"]: r for r in out.select("path", F.to_json("source").alias("json"), "dropped_leads", "reconciled", "reject").collect()}
    assert {k: r["reject"] for k, r in rows.items() if r["reject"]} == {"list": "records_are_no_list", "text": "record_is_no_object", "bool": "record_lead_is_no_whole_number", "half": "record_lead_is_no_whole_number"}
    assert rows["list"]["json"] is None
    got = json.loads(rows["plain"]["json"])
    assert got["records"] == [lead(132), lead(144)] and got["lead_status"] == {"132": {"status": "received"}} and got["keep"] == {"n": 1.5}
    assert got["errors"] == [{"leads": [144], "x": 1}, "text", {"leads": "126"}] and rows["plain"]["dropped_leads"] == [126]
    noted = got["carry_forward_contract_reconciliation"]
    assert noted["dropped_obsolete_extension_leads"] == [126] and noted["previous_contract"] == dict.fromkeys(carry.FORMER) and noted["reconciled_at_utc"] == "2026-09-26T00:00:00+00:00"
    assert got["run_time_utc"] == "2026-09-25T00:00:00+00:00" and got["target_max_hours"] == 384 and got["requested_extension_leads"][:2] == [132, 144]
    odd = json.loads(rows["odd"]["json"])
    assert odd["errors"] == {"a": 1} and odd["lead_status"] == {} and odd["records"] == []

    # Carried again under the same contract, a source stays as it is, its note included.
    again = carry.carried(out.where("reject is null").select("path", "model", "run", "source"), F.lit("2027-01-01T00:00:00Z").cast("timestamp"))
    for r in again.select("path", F.to_json("source").alias("json"), "reconciled").collect():
        assert not r["reconciled"] and json.loads(r["json"]) == json.loads(rows[r["path"]]["json"])


def test_newest_day(spark):
    now = F.lit(T0 + dt.timedelta(hours=12))
    points = [("wind", 25, hour(3), 1.0, False), ("wind", 25, hour(20), 9.0, True), ("wind", 24, hour(-2), 2.0, False), ("gust", 24, hour(-1), 3.0, False), ("gust", 25, hour(20), 9.0, True), ("tie", 24, hour(1), 4.0, False), ("tie", 25, hour(1), 5.0, False)]
    asked = [("wind", 25, True, 2), ("gust", 25, True, 1), ("empty", 25, True, 0), ("empty", 24, False, None), ("lost", 25, False, None)]
    p = spark.createDataFrame(points, "kind string, day int, time timestamp, value double, future boolean")
    q = spark.createDataFrame(asked, "kind string, day int, success boolean, n int")
    got = {r["kind"]: r for r in stations.newest_day(p, q, ["kind"], now).collect()}
    assert {k: (r["availability"], r["source_day"], r["n"], r["latest_value"], r["future_count"], r["answered"]) for k, r in got.items()} == {
        "wind": ("received", 25, 1, 1.0, 1, True), "gust": ("received", 24, 1, 3.0, 0, True), "tie": ("received", 25, 1, 5.0, 0, False), "empty": ("empty_despite_success", None, 0, None, None, True), "lost": ("request_or_parse_failure", None, 0, None, None, False),
    }
    assert got["wind"]["age_minutes"] == 540.0
    today = stations.newest_day(p.where("day = 25"), q.where("day = 25"), ["kind"], now).withColumn("station", F.lit("s"))
    due = lambda *kinds: sorted(r["kind"] for r in stations.fallback_days(today, ["station"], "kind", list(kinds)).collect())
    assert due("wind", "gust") == ["gust", "wind"] and due("wind", "tie") == []
