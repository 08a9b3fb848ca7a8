"""Records of cycles, verified payloads, JSON metadata, canonical hashes."""

import base64
import gzip
import hashlib
import json
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from gustloom.functions import variants as V
from gustloom.operators import records as R
from gustloom.sources import bundles as B
from gustloom.sources import grib_text

T0 = datetime(2026, 9, 25, 0)


def test_batch_records(spark):
    m = spark.createDataFrame([("f", 0, "10u", T0, 3.0, 1.0), ("f", 1, "10v", T0, 3.0, 2.0), ("f", 2, "10u", T0, 6.0, 3.0), ("f", 3, "10u", T0, 0.25, 9.0)], "file string, pos int, short_name string, run timestamp, step_end double, value double")
    got = {r["lead"]: ({k: [x["value"] for x in v] for k, v in r["values"].items()}, r["valid"]) for r in R.batch_records(m, ["file"]).collect()}
    assert got == {3: ({"10u": [1.0], "10v": [2.0]}, T0 + timedelta(hours=3)), 6: ({"10u": [3.0]}, T0 + timedelta(hours=6))}


def test_cycles(spark):
    r = spark.createDataFrame([("GFS", 0, T0, 0), ("GFS", 1, T0, 54), ("ICON-EU", 0, T0 + timedelta(hours=3), 0), ("ICON-EU", 1, T0, 3)], "model string, pos int, run timestamp, lead int")
    one = {x["model"]: (x["run"], x["reject"]) for x in R.one_cycle(r, ["model"]).collect()}
    assert one == {"GFS": (T0, None), "ICON-EU": (None, "expected one cycle, found 2")}
    want = {x["model"]: len(x["expected"]) for x in R.expected_leads(r, ["model"]).collect()}
    assert want == {"GFS": 33, "ICON-EU": 17}
    assert sorted(x["lead"] for x in R.extend_base(r, r).where("model = 'GFS'").collect()) == [0, 54]


def test_summaries(spark):
    f = spark.createDataFrame([("c", "u", 3), ("c", "u", 9), ("c", "v", 6)], "cycle string, field string, lead int")
    assert tuple(R.max_leads(f, ["cycle"], ["u", "v", "g"]).first()) == ("c", 9, 6, None)
    e = spark.createDataFrame([("m", 6, [("p",)]), ("m", 3, [("p",), ("q",)]), ("m", 9, [("q",)])], "model string, lead int, errors array<struct<product: string>>")
    assert R.leads_with_error(e, ["model"], "p").first()["leads"] == [3, 6]
    m = spark.createDataFrame([("1790294400", "x"), ("1790294400", "1790298000")], "last_run_initialisation_time string, last_run_availability_time string")
    got = R.ensemble_metadata(m).collect()
    assert got[0]["reject"] == "metadata lacks last_run_availability_time" and got[1]["reject"] is None and got[1]["last_run_initialisation_time_utc"] == datetime.fromtimestamp(1790294400)
    q = spark.createDataFrame([("p", "B", 2, 3, False), ("p", "A", 3, 3, True)], "path string, model string, derived_records int, records int, complete boolean")
    assert R.consolidated(q).first()["markdown"] == "- A: 3/3\n- B: 2/3\n\nAll complete: false"
    a = spark.createDataFrame([("k", T0), ("n", T0)], "kind string, generated_at timestamp")
    late = spark.createDataFrame([("k", T0 + timedelta(hours=1))], "kind string, generated_at timestamp")
    assert {r["kind"]: r["older_than_latest"] for r in R.older_than_latest(a, late).collect()} == {"k": True, "n": False}
    s = spark.createDataFrame([([3, 6, 9], [3, 9])], "got array<int>, ok array<int>")
    assert R.filter_lead_lists(s, ["got"], "ok").first()["got"] == [3, 9]
    own = {k: (p.split("/", 3)[3], f) for k, p, f in R.state_pointers()}
    assert own["etnw"] == ("integrity/etnw/latest_success.json", "generated_at_utc") and own["secondary"] == ("transfer_receipts/secondary/latest.json", "source_generated_at_utc")


def test_verified_payloads(spark, tmp_path):
    raw = b'{"a": 1}'
    (tmp_path / "a.json.gz").write_bytes(gzip.compress(raw))
    (tmp_path / "b.json.gz").write_bytes(gzip.compress(b'{"b": 1}'))
    (tmp_path / "c.json.gz").write_bytes(b"no gzip")
    sha = hashlib.sha256(raw).hexdigest()
    want = spark.createDataFrame([(x, sha) for x in ("a.json.gz", "b.json.gz", "c.json.gz", "d.json.gz")], "path string, sha256 string")
    got = {r["path"][0]: (r["reject"], r["a"]) for r in B.verified_payloads(spark, str(tmp_path), want).select("path", "reject", V.number("payload", "$.a").alias("a")).collect()}
    assert got == {"a": (None, 1.0), "b": ("sha256_mismatch", None), "c": ("absent_or_not_gzip", None), "d": ("absent_or_not_gzip", None)}


def test_json_metadata(spark):
    flat = {"messages": [{"shortName": "tcc", "level": 0, "stepRange": "0-3", "dataDate": 20260925, "dataTime": 600, "validityDate": 20260925, "validityTime": 900}]}
    pairs = {"messages": [[{"key": "shortName", "value": "cape"}, {"key": "level", "value": 18000}, {"key": "paramId", "value": 59}]]}
    rows = {r["f"]: r for r in grib_text.json_metadata(spark.createDataFrame([("a", json.dumps(flat)), ("b", json.dumps(pairs)), ("c", "{")], "f string, text string")).collect()}
    assert set(rows) == {"a", "b"} and rows["a"]["short_name"] == "tcc" and rows["a"]["run"] == datetime(2026, 9, 25, 6) and rows["a"]["valid"] == datetime(2026, 9, 25, 9)
    assert (rows["b"]["level"], rows["b"]["param_id"]) == (18000, 59)


def test_canonical_sha(spark):
    d = spark.createDataFrame([('{"b": 1, "a": {"d": null, "c": [1, 2]}}',)], "j string").select(V.canonical_sha(F.parse_json("j")).alias("h")).first()["h"]
    assert d == hashlib.sha256(b'{"a":{"c":[1,2],"d":null},"b":1}').hexdigest()


def test_request_diagnostics(spark):
    p = {"request_diagnostics": {"current": {"success": True, "http_status": 200, "response_bytes": 70}}, "requests": [{"kind": "wind", "success": False, "exception_type": "Timeout"}, {"kind": "gust", "success": True, "provider_error": 7, "response_bytes": 5}, {"kind": "rain", "success": True, "provider_error": "0"}]}
    d = B.request_diagnostics(B.from_text(spark.createDataFrame([("a", json.dumps(p))], "bundle_id string, json string")))
    rows = {r["endpoint"]: (r["success"], r["http_status"], r["exception_type"], r["provider_error"]) for r in d.collect()}
    assert rows == {"current": (True, 200, None, None), "wind": (False, None, "Timeout", None), "gust": (False, None, None, "7"), "rain": (True, None, None, None)}
    assert tuple(B.response_bytes(d).first()) == ("a", 4, 75)


def test_pointers_from_base64(spark):
    text = base64.b64encode(b'{"generated_at_utc": "2025-01-01T00:00:00Z"}').decode()
    rows = [("a", text[:9] + "\n" + text[9:] + "\n"), ("b", None), ("c", "***"), ("d", base64.b64encode(b"{").decode())]
    got = {r["k"]: r["t"] for r in B.pointer_json(spark.createDataFrame(rows, "k string, content string")).select("k", V.text("pointer", "$.generated_at_utc").alias("t")).collect()}
    assert got == {"a": "2025-01-01T00:00:00Z", "b": None, "c": None, "d": None}
