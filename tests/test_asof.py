"""As-of joins and reads on two axes of time against brute force, with any number of ranges."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from gustloom.operators import asof

T0 = dt.datetime(2026, 9, 26)
hour = lambda h: None if h is None else T0 + dt.timedelta(hours=h)


@pytest.mark.parametrize("ranges", [1, 3, 16])
def test_as_of_by_brute_force(spark, ranges):
    """A hot key, null keys and times, ties, rows before all others, and columns of one name on both sides."""
    rnd = random.Random(ranges)
    some = lambda n: [(rnd.choice(["hot"] * 6 + ["b", None]), rnd.choice([None, *range(40)]) if rnd.random() < 0.1 else rnd.randrange(40), i) for i in range(n)]
    left, right = some(200) + [("c", 5, 900)], some(150) + [("d", 1, 901)]
    frame = lambda rows, t: spark.createDataFrame([(k, hour(h), i) for k, h, i in rows], f"k string, {t} timestamp, id int")
    got = asof.as_of(frame(left, "at"), frame(right, "since").withColumnRenamed("id", "rid").withColumn("v", F.col("rid") * 2), ["k"], "at", "since", ["rid", "v"], ranges)
    want = []
    for k, h, i in left:
        met = [(rh, ri) for rk, rh, ri in right if rk == k and rh is not None and h is not None and rh <= h]
        best = max(met)[1] if met else None
        want.append((k, hour(h), i, best, None if best is None else 2 * best))
    assert sorted(map(str, (tuple(r) for r in got.select("k", "at", "id", "rid", "v").collect()))) == sorted(map(str, want))


FACT = "field string, valid timestamp, revision timestamp, available timestamp, value double"


def test_a_later_revision_leaves_earlier_times(spark):
    """A row that is retrieved again for one more field: the first field was known from its own time on."""
    rows = [("wind", 12, 5, 5, 1.0), ("wind", 12, 6, 5, 1.0), ("cape", 12, 6, 6, 700.0), ("gust", 12, 5, None, None), ("gust", 12, 7, 8, 9.0), ("late", 12, 1, 10, 1.0), ("late", 12, 2, 3, 2.0), ("gone", 12, 1, None, None)]
    facts = spark.createDataFrame([(f, hour(v), hour(r), hour(a), x) for f, v, r, a, x in rows], FACT)
    asked = [("wind", 4.9), ("wind", 5), ("wind", 5.5), ("wind", 9), ("cape", 5.5), ("cape", 6), ("gust", 7.5), ("gust", 8), ("late", 2.5), ("late", 4), ("late", 11), ("gone", 9), ("none", 9), ("wind", None)]
    requests = spark.createDataFrame([(i, f, hour(12), hour(t)) for i, (f, t) in enumerate(asked)], "n int, field string, valid timestamp, at timestamp")
    got = {r["n"]: (r["value"], r["revision"], r["status"]) for r in asof.known(requests, facts, ["field", "valid"], "at", ["value"]).collect()}
    unknown = lambda s: (None, None, s)
    assert [got[i] for i in range(len(asked))] == [
        unknown("not_yet_known"), (1.0, hour(5), "received"), (1.0, hour(5), "received"), (1.0, hour(6), "received"), unknown("not_yet_known"), (700.0, hour(6), "received"), unknown("not_yet_known"), (9.0, hour(7), "received"),
        unknown("not_yet_known"), (2.0, hour(2), "received"), (2.0, hour(2), "received"), unknown("never_known"), unknown("never_known"), unknown("not_yet_known"),
    ]
    spans = {(r["field"], r["revision"]): (r["known_from"], r["known_to"]) for r in asof.intervals(facts, ["field", "valid"]).collect()}
    assert spans[("wind", hour(5))] == (hour(5), hour(6)) and ("late", hour(1)) not in spans and spans[("late", hour(2))] == (hour(3), None)


@pytest.mark.parametrize("ranges", [1, 5])
def test_running_minimum(spark, ranges):
    rnd = random.Random(8)
    rows = [("hot" if rnd.random() < 0.8 else rnd.choice("ab"), i, rnd.choice([None, rnd.randrange(1000)])) for i in range(120)]
    rnd.shuffle(rows)
    got = asof.before(spark.createDataFrame(rows, "k string, o int, v int"), ["k"], "o", "v", "least", F.min, ranges)
    want = {(k, o): min((v2 for k2, o2, v2 in rows if k2 == k and o2 < o and v2 is not None), default=None) for k, o, _ in rows}
    assert {(r["k"], r["o"]): r["least"] for r in got.collect()} == want


def test_empty_sides(spark):
    facts = spark.createDataFrame([], FACT)
    requests = spark.createDataFrame([(1, "x", T0, T0)], "n int, field string, valid timestamp, at timestamp")
    assert [r["status"] for r in asof.known(requests, facts, ["field", "valid"], "at", ["value"]).collect()] == ["never_known"]
    assert asof.known(requests.limit(0), facts, ["field", "valid"], "at", ["value"]).count() == 0
