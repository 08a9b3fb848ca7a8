"""The publication's log: checkpoints, reads at a version, streams that commit each batch once, tidying, damage."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from gustloom.sinks import publish as P

T0 = datetime(2026, 9, 25, 0)
now = lambda: F.lit(T0)
FAR = 1 << 60  # milliseconds: everything is old by then


def contents(spark, *rows):
    return spark.createDataFrame([(kind, T0 + timedelta(hours=h), content) for kind, h, content in rows], "kind string, generated_at timestamp, content binary")


def state(spark, root, version=None):
    """Pointers, objects and receipts at a version."""
    return (
        {r["kind"]: r["generated_at"].hour for r in P.pointers(spark, root, version).collect()},
        sorted(r["path"] for r in P.index(spark, root, version).collect()), sorted(r["path"] for r in P.receipts(spark, root, version).collect()), sorted(r["path"] for r in P.objects(spark, root, version).select("path").collect()),
    )


def test_checkpoints_change_nothing_but_what_is_read(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(P, "CHECKPOINT_EVERY", 3)
    root, held = str(tmp_path / "store"), {}
    store = P.Store(spark, root)
    for v in range(1, 6):
        P.publish(spark, root, contents(spark, ("svg", v, b"%d" % v), *([("models", 9 - v, b"m%d" % v)] if v % 2 else [])), now())
        held[v] = state(spark, root)
    assert store.markers("checkpoints") == [3] and store.version() == 5
    assert held[5][0] == {"svg": 5, "models": 8} and all(len(x) == 8 for x in held[5][1:])
    assert {v: state(spark, root, v) for v in held} == held

    # A reader of the newest version opens the checkpoint's files and those of commits 4 and 5.
    read = P.Store(spark, root).table(P.POINTERS, P.POINTER, None, P.POINTERS).inputFiles()
    recent = [c["commit"] for c in store.commits(3)]
    assert all("checkpointed/3-" in f or any(c in f for c in recent) for f in read) and len(recent) == 2

    P.checkpoint(spark, root)
    removed = P.tidy(spark, root, FAR, 0)
    assert {v: state(spark, root, v) for v in (5,)} == {5: held[5]} and state(spark, root) == held[5]
    assert sum(n.startswith("log/") for n in removed) == 5 and not any(n.startswith("objects") for n in removed)
    with pytest.raises(ValueError, match="no longer"):
        P.pointers(spark, root, 2).count()
    assert not store.claim(4, "stale") and store.version() == 5
    P.publish(spark, root, contents(spark, ("svg", 7, b"7"), ("svg", 2, b"2")), now())
    assert state(spark, root)[0]["svg"] == 7 and store.version() == 6


def test_tidy_keeps_what_is_young_or_live(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "store")
    P.publish(spark, root, contents(spark, ("svg", 1, b"a")), now())

    def lost(*_):
        raise OSError("lost")

    with monkeypatch.context() as m:
        m.setattr(P.Store, "claim", lost)
        with pytest.raises(OSError):
            P.publish(spark, root, contents(spark, ("svg", 2, b"b")), now())
    before = state(spark, root)
    assert P.tidy(spark, root, 0, 0) == []
    removed = P.tidy(spark, root, FAR, 1000)
    assert {n.partition("/")[0] for n in removed} == {"objects", "receipts", "pointers", "outcomes"} and state(spark, root) == before


STEPS = ["_stage", "move 3", "claim", "after"]


@pytest.mark.parametrize("step", STEPS)
def test_a_stream_commits_each_batch_once(spark, tmp_path, monkeypatch, step):
    """A run that ends anywhere between its first file and its checkpoint is made good by the next one."""
    root, source, check = (str(tmp_path / x) for x in ("store", "in", "check"))
    contents(spark, ("svg", 1, b"a"), ("models", 1, b"m")).coalesce(1).write.parquet(source)
    stream = lambda: spark.readStream.schema("kind string, generated_at timestamp, content binary").parquet(source)
    with monkeypatch.context() as m:
        moved, move, publish = [], P.Store.move, P.publish

        def stop(*_, **__):
            raise OSError("stopped")

        def some(store, a, b):
            if len(moved) == int(step[-1]):
                stop()
            moved.append(b)
            move(store, a, b)

        def then_stop(*a, **k):
            publish(*a, **k)
            stop()

        if step.startswith("move"):
            m.setattr(P.Store, "move", some)
        elif step == "claim":
            m.setattr(P.Store, "claim", stop)
        else:
            m.setattr(P, "publish" if step == "after" else step, then_stop if step == "after" else stop)
        with pytest.raises(Exception, match="stopped"):
            P.publish_stream(stream(), root, "landing", check, now()).awaitTermination()
    assert P.Store(spark, root).version() == (step == "after")
    P.publish_stream(stream(), root, "landing", check, now()).awaitTermination()
    assert P.Store(spark, root).version() == 1
    log = P.Store(spark, root).log().collect()
    assert [(r["version"], r["query"], r["batch"]) for r in log] == [(1, "landing", 0)]
    pointers, index, receipts, objects = state(spark, root)
    assert pointers == {"svg": 1, "models": 1} and len(index) == len(receipts) == len(objects) == 2
    if step == "claim":
        contents(spark, ("svg", 3, b"c")).coalesce(1).write.mode("append").parquet(source)
        P.publish_stream(stream(), root, "landing", check, now()).awaitTermination()
        assert sorted(r["batch"] for r in P.Store(spark, root).log().collect()) == [0, 1] and state(spark, root)[0]["svg"] == 3


def test_equal_times_damage_and_receipts(spark, tmp_path):
    root = str(tmp_path / "store")
    store = P.Store(spark, root)
    P.publish(spark, root, contents(spark, ("svg", 1, b"a")), now())
    # A pointer of equal time that names something else is repaired.
    bad = P.pointers(spark, root).withColumn("path", F.lit("elsewhere")).drop("commit")
    bad.write.parquet(f"{root}/pointers/commit=x")
    assert store.claim(2, "x") and P.pointers(spark, root).first()["path"] == "elsewhere"
    P.publish(spark, root, contents(spark, ("svg", 1, b"a")), now())
    assert store.version() == 3 and P.pointers(spark, root).first()["path"] != "elsewhere"
    assert [r["outcome"] for r in P.publish(spark, root, contents(spark, ("svg", 1, b"a")), now()).collect()] == ["same"] and store.version() == 3

    # A receipt that names other bytes.
    P.publish(spark, root, contents(spark, ("etnw", 1, b"z")), now())
    path = P.index(spark, root).where("kind = 'etnw'").first()["path"]
    P.receipts(spark, root).where("kind = 'etnw'").withColumn("sha256", F.lit("0" * 64)).drop("commit").write.parquet(f"{root}/receipts/commit=y")
    assert store.claim(5, "y")
    with pytest.raises(P.Conflict, match=path):
        P.publish(spark, root, contents(spark, ("etnw", 1, b"z")), now())

    # Stored bytes that aren't those recorded.
    first = store.log().where("version = 1").first()["commit"]
    P.objects(spark, root).where("kind = 'svg'").withColumn("content", F.lit(b"rot")).drop("commit", "kind", "day").toPandas().to_parquet(tmp_path / "rot.parquet")
    folder = next((tmp_path / "store/objects" / f"commit={first}").glob("kind=svg/day=*"))
    for f in folder.iterdir():
        f.unlink()
    (tmp_path / "rot.parquet").rename(folder / "part-0.parquet")
    with pytest.raises(P.Damaged):
        P.publish(spark, root, contents(spark, ("svg", 1, b"a")), now())
