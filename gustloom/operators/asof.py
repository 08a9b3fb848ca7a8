"""What was known when: the last row before a time, and reads on two axes of time, for keys of any size."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gustloom.operators.timeline import range_of


def _same(left: list[str], right: list[str]) -> Column:
    out = F.lit(True)
    for a, b in zip(left, right):
        out = out & F.col(a).eqNullSafe(F.col(b))
    return out


def as_of(left: DataFrame, right: DataFrame, key: list[str], at: str, since: str, take: list[str], ranges: int = 0) -> DataFrame:
    """Each left row with the ``take`` columns of the newest right row of its key whose ``since`` is at most ``at``; nulls if there is none.

    Of right rows with one key and ``since``, the one with the greatest ``take`` columns counts. A null ``at`` meets
    nothing, a null ``since`` is never met; null keys are keys. A key may hold most of all rows: times are dealt into
    ranges, each a task of its own, and only each range's last right row of a key goes on to the ranges after it.
    """
    names = [f"_k{i}" for i in range(len(key))]
    held = lambda df: [F.col(k).alias(n) for k, n in zip(key, names)]
    l = left.withColumn("_id", F.monotonically_increasing_id())
    payload = F.struct(*left.columns)
    given = right.where(F.col(since).isNotNull()).groupBy(*key, since).agg(F.max(F.struct(*take)).alias("_v"))
    rows = l.select(*held(l), F.col(at).alias("_t"), F.lit(1).alias("_side"), payload.alias("_l"), F.lit(None).cast(given.schema["_v"].dataType).alias("_v")).unionByName(
        given.select(*held(given), F.col(since).alias("_t"), F.lit(0).alias("_side"), F.lit(None).cast(l.select(payload.alias("x")).schema["x"].dataType).alias("_l"), "_v")
    )
    dealt = rows.withColumn("_r", range_of(rows, "_t", ranges))
    here = Window.partitionBy(*names, "_r").orderBy("_t", "_side").rowsBetween(Window.unboundedPreceding, 0)
    own = dealt.withColumn("_own", F.last("_v", ignorenulls=True).over(here)).where("_side = 1")
    last = dealt.where("_side = 0").groupBy(*names, "_r").agg(F.max_by("_v", "_t").alias("_last"))
    places = dealt.where("_side = 1").select(*names, "_r").distinct()
    both = places.unionByName(last.select(*names, "_r")).distinct()
    b = [f"_b{i}" for i in range(len(key))]
    joined = both.join(last.select(*(F.col(n).alias(x) for n, x in zip(names, b)), F.col("_r").alias("_br"), "_last"), _same(names, b) & (F.col("_r") == F.col("_br")), "left")
    carried = F.last("_last", ignorenulls=True).over(Window.partitionBy(*names).orderBy("_r").rowsBetween(Window.unboundedPreceding, -1))  # a row a range
    border = joined.select(*(F.col(n).alias(x) for n, x in zip(names, b)), F.col("_r").alias("_br"), carried.alias("_before"))
    met = own.join(border, _same(names, b) & (F.col("_r") == F.col("_br")), "left")
    found = F.when(F.col("_t").isNotNull(), F.coalesce("_own", "_before"))
    return met.select("_l.*", *(found[c].alias(c) for c in take))


def before(rows: DataFrame, key: list[str], order: str, value: str, name: str, how: Callable[[Column | str], Column], ranges: int = 0) -> DataFrame:
    """Each row with ``how`` (an aggregate that can be taken of itself, such as min or max) of ``value`` over the rows of its key with a smaller ``order``.

    ``order`` tells the key's rows apart. As in as_of(), a key's ranges are tasks of their own.
    """
    dealt = rows.withColumn("_r", range_of(rows, order, ranges))
    own = how(value).over(Window.partitionBy(*key, "_r").orderBy(order).rowsBetween(Window.unboundedPreceding, -1))
    sums = dealt.groupBy(*key, "_r").agg(how(value).alias("_s"))
    b = [f"_b{i}" for i in range(len(key))]
    carried = how("_s").over(Window.partitionBy(*key).orderBy("_r").rowsBetween(Window.unboundedPreceding, -1))
    border = sums.select(*(F.col(k).alias(x) for k, x in zip(key, b)), F.col("_r").alias("_br"), carried.alias("_s"))
    joined = dealt.withColumn(name, own).join(border, _same(key, b) & (F.col("_r") == F.col("_br")), "left")
    return joined.select(*rows.columns, _of_two(how, name, "_s").alias(name))


def _of_two(how: Callable, a: str, b: str) -> Column:
    """The aggregate of two values, of which either may be null."""
    return F.array_min(F.array(a, b)) if how is F.min else F.array_max(F.array(a, b))


def intervals(facts: DataFrame, key: list[str], revision: str = "revision", available: str = "available") -> DataFrame:
    """Facts with the interval [known_from, known_to) in which each is the answer for its key; those that never are, are left out.

    ``revision``: when a row was retrieved; ``available``: when its field was, null where it wasn't received. A fact is
    known from the later of the two. It stops to be the answer when a later revision is known: a revision that comes
    late leaves the times of earlier ones as they are. known_to is null where nothing follows. Revisions tell a key's
    facts apart; a null one is left out.
    """
    known = facts.where(F.col(revision).isNotNull() & F.col(available).isNotNull()).withColumn("known_from", F.greatest(revision, available))
    backwards = known.withColumn("_order", -F.unix_micros(F.col(revision).cast("timestamp")))
    found = before(backwards, key, "_order", "known_from", "known_to", F.min).drop("_order")
    return found.where("known_to is null or known_from < known_to")


def known(requests: DataFrame, facts: DataFrame, key: list[str], at: str, values: list[str], revision: str = "revision", available: str = "available") -> DataFrame:
    """What was known at a time: each request with the ``values`` of the newest revision of its key that was there at ``at``, its times, and a status.

    The status is ``received``, ``not_yet_known`` where the key's facts came later, or ``never_known`` where there are
    none. The key includes what the fact is about, such as its valid time.
    """
    spans = intervals(facts, key, revision, available)
    take = [c for c in spans.columns if c in (revision, available, "known_from", "known_to") or c in values]
    first = ["known_from", *(c for c in take if c != "known_from")]
    found = as_of(requests, spans.withColumn("_since", F.col("known_from")), key, at, "_since", first)
    ever = facts.where(F.col(revision).isNotNull() & F.col(available).isNotNull()).select(*(F.col(k).alias(f"_e{i}") for i, k in enumerate(key))).distinct().withColumn("_ever", F.lit(True))
    marked = found.join(ever, _same(key, [f"_e{i}" for i in range(len(key))]), "left")
    status = F.when(F.col("known_from").isNotNull(), "received").when(F.col("_ever"), "not_yet_known").otherwise("never_known")
    return marked.select(*requests.columns, *take, status.alias("status"))
