"""The data source of requests over a transport that serves a folder's files, with failures."""

import hashlib
import importlib
import json
import os
import sys

import pytest

from gustloom.sources import fetching

TRANSPORT = '''
import json, os
ROOT = {root!r}

def get(url, timeout):
    """Each answer of a url's script in turn; which one is next is kept beside it."""
    folder = os.path.join(ROOT, url)
    at = len([x for x in os.listdir(folder) if x.startswith("asked")])
    open(os.path.join(folder, f"asked{{at}}"), "w").close()
    script = json.load(open(os.path.join(folder, "script.json")))
    step = script[min(at, len(script) - 1)]
    if step == "raise":
        raise TimeoutError("no answer within " + str(timeout))
    status, name = step
    return status, open(os.path.join(folder, name), "rb").read() if name else b""

def planned():
    return open(os.path.join(ROOT, "plan.json")).read()
'''


@pytest.fixture(scope="module")
def served(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("served")
    name = f"transport_{root.name}"
    (root / f"{name}.py").write_text(TRANSPORT.format(root=str(root)))
    env = spark.sparkContext.environment
    env["PYTHONPATH"] = os.pathsep.join(x for x in (str(root), env.get("PYTHONPATH") or os.environ.get("PYTHONPATH")) if x)
    sys.path.insert(0, str(root))
    importlib.import_module(name)
    spark.dataSource.register(fetching.RequestSource)

    def add(url, *script):
        folder = root / url
        folder.mkdir()
        (folder / "script.json").write_text(json.dumps(script))
        (folder / "good").write_bytes(b"GRIB" + url.encode())
        (folder / "page").write_bytes(b"<html>busy</html>")
        return {"key": url, "url": url}

    return root, name, add


def test_attempts_as_rows(spark, served):
    root, name, add = served
    plan = [
        add("good", [200, "good"]), add("later", "raise", [503, "page"], [200, "page"], [200, "good"]), add("never", "raise"), add("gone", [404, None]), add("denied", [403, "page"]), add("nothing", [200, None], [200, "good"]),
    ]
    rows = spark.read.format("requests").options(plan=json.dumps(plan), transport=f"{name}:get", delays="0,0,0", magic="47524942,425a68", timeout="7").load()
    assert rows.rdd.getNumPartitions() == len(plan)
    got = rows.collect()
    seen = {p["key"]: [r["status"] for r in sorted((r for r in got if r["key"] == p["key"]), key=lambda r: r["attempt"])] for p in plan}
    assert seen == {"good": ["received"], "later": ["transport_error", "http_error", "not_the_format", "received"], "never": ["transport_error"] * 4, "gone": ["not_found"], "denied": ["http_error"], "nothing": ["empty", "received"]}
    assert all(r["last"] == (r["attempt"] == len(seen[r["key"]])) for r in got)
    held = spark.createDataFrame(got, rows.schema)
    files = {r["key"]: r for r in fetching.received(held).collect()}
    assert set(files) == {"good", "later", "nothing"} and all(r["sha256"] == hashlib.sha256(r["content"]).hexdigest() and r["content"].startswith(b"GRIB") for r in files.values())
    how = {r["key"]: (r["success"], r["attempts"], r["status"], r["http_status"], r["exceptions"]) for r in fetching.diagnostics(held).collect()}
    assert how["never"] == (False, 4, "transport_error", None, ["TimeoutError"]) and how["later"] == (True, 4, "received", 200, ["TimeoutError"]) and how["gone"] == (False, 1, "not_found", 404, [])
    assert next(r for r in got if r["key"] == "never")["exception_message"] == "no answer within 7.0"


def test_a_stream_asks_each_request_once(spark, served, tmp_path):
    root, name, add = served
    plan = [add(f"s{i}", [200, "good"]) for i in range(5)]

    def run():
        stream = spark.readStream.format("requests").options(planner=f"{name}:planned", transport=f"{name}:get", delays="", maxRequestsPerTrigger="10").load()
        out = str(tmp_path / "out")
        query = stream.writeStream.trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "check")).format("parquet").start(out)
        assert query.awaitTermination(120)
        return sorted(r["key"] for r in spark.read.parquet(out).collect())

    (root / "plan.json").write_text(json.dumps(plan[:3]))
    assert run() == ["s0", "s1", "s2"]
    (root / "plan.json").write_text(json.dumps(plan))
    assert run() == ["s0", "s1", "s2", "s3", "s4"]
    assert all(len(list((root / p["key"]).glob("asked*"))) == 1 for p in plan)


def test_pauses_follow_the_schedule():
    waited, calls = [], iter([OSError("a"), (500, b"x"), (200, b"GRIB")])

    def transport(url, timeout):
        x = next(calls)
        if isinstance(x, Exception):
            raise x
        return x

    rows = list(fetching.attempts(fetching.Request("k", "u"), transport, [1, 5, 9], [b"GRIB"], 3, waited.append))
    assert waited == [1, 5] and [r["status"] for r in rows] == ["transport_error", "http_error", "received"]
