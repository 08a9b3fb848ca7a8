"""Streams with keyed state against folds over all rows, for any dealing into batches and with restarts."""

import datetime as dt
import itertools
import random

import pytest
from pyspark.sql import functions as F

from gustloom.streaming import stateful

T0 = dt.datetime(2026, 3, 1)
ATTEMPT = "model string, run int, at timestamp, missing int, tried boolean"


def feed(spark, tmp_path, batches, schema, build, restart=True):
    """Run a stream over batches in order; with restarts each is a run of its own from the checkpoint."""
    source, out, check = (str(tmp_path / x) for x in ("in", "out", "check"))
    stream = build(spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(source + "/*")) if not restart else None
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{source}/b={i}")
        if restart:
            stream = build(spark.readStream.schema(schema).parquet(source + "/*"))
            stateful.run(stream, check, out).awaitTermination()
    if not restart:
        stateful.run(stream, check, out).awaitTermination()
    return stateful.written(spark, out, stream.schema).collect()


def folded(rows, most=1, hours=3):
    """next_retry() row by row in order of time."""
    out = {}
    for model, run, at, missing, tried in sorted(rows, key=lambda r: (r[2], r[3])):
        attempts = out.get((model, run), (None, 0))[1] + tried
        word = ("complete" if attempts else "not_needed") if not missing else "exhausted" if attempts >= most else "pending"
        out[model, run] = (word, attempts, at + dt.timedelta(hours=hours) if word == "pending" else None)
    return out


@pytest.mark.parametrize("restart", [True, False])
def test_retries_equal_the_fold(spark, tmp_path, restart):
    rnd = random.Random(3)
    rows = [(f"m{rnd.randrange(3)}", rnd.randrange(4), T0 + dt.timedelta(minutes=rnd.randrange(600)), rnd.choice([0, 0, 1, 5]), rnd.random() < 0.3) for _ in range(90)]
    rnd.shuffle(rows)  # late rows: up to ten hours
    got = feed(spark, tmp_path, [rows[:30], rows[30:31], rows[31:70], rows[70:]], ATTEMPT, lambda s: stateful.retries(s, ["model", "run"], lateness="11 hours"), restart)
    last = {}
    for r in sorted((r for r in got if r["kind"] == "state"), key=lambda r: r["batch"]):
        last[r["model"], r["run"]] = (r["state"], r["attempts"], r["not_before"])
    assert last == folded(rows)


def test_a_retry_is_due_once_and_only_after_its_time(spark, tmp_path):
    hour = lambda h: T0 + dt.timedelta(hours=h)
    batches = [
        [("a", 1, hour(0), 4, False), ("b", 1, hour(0), 0, False)],
        [("x", 9, hour(2.5), 0, False)],  # the watermark is still before hour 3
        [("x", 9, hour(4), 0, False)],
        [("x", 9, hour(4.2), 0, False)],  # the watermark of the batch before has passed hour 3
        [("a", 1, hour(5), 4, True)], [("x", 9, hour(20), 0, False)], [("x", 9, hour(21), 0, False)],
    ]
    got = feed(spark, tmp_path, batches, ATTEMPT, lambda s: stateful.retries(s, ["model", "run"], lateness="10 minutes"))
    due = [(r["model"], r["not_before"], r["attempts"], r["batch"]) for r in got if r["kind"] == "due"]
    assert [d[:3] for d in due] == [("a", hour(3), 0)] and due[0][3] >= 2
    assert {r["state"] for r in got if r["model"] == "a"} == {"pending", "exhausted"}


WRITE = "path string, sha256 string, at timestamp"


def test_first_write_wins_in_any_order_of_arrival(spark, tmp_path):
    arrivals = [[("p", "A", T0), ("q", "X", T0)], [("p", "B", T0), ("p", "A", T0 + dt.timedelta(hours=1))], [("p", "C", T0), ("p", "B", T0), ("q", "X", T0)]]
    for k, order in enumerate(itertools.permutations(range(3))):
        batches = [arrivals[i] for i in order]
        got = feed(spark, tmp_path / str(k), batches, WRITE, stateful.first_writes)
        want, kept, refused = set(), {}, set()
        for batch in batches:
            for path, sha, at in sorted(batch, key=lambda r: (r[2], r[1])):
                if kept.setdefault(path, sha) == sha:
                    want.add((path, "written", sha, sha))
                elif (path, sha) not in refused:
                    refused.add((path, sha))
                    want.add((path, "conflict", sha, kept[path]))
        assert sorted((r["path"], r["outcome"], r["sha256"], r["kept_sha256"]) for r in got) == sorted(want), order


def test_a_batch_run_again_changes_nothing(spark, tmp_path):
    rows = [("p", "A", T0), ("p", "B", T0)] * 50
    got = feed(spark, tmp_path, [rows, rows, []], WRITE, stateful.first_writes)
    assert [(r["outcome"], r["sha256"], r["batch"]) for r in sorted(got, key=lambda r: r["sha256"])] == [("written", "A", 0), ("conflict", "B", 0)]
