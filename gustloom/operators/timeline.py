"""Ordered operators: gaps, coverage, axis checks, first and last wins, nearest-time joins, newest eligible cycle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _seconds(at: str | Column) -> Column:
    return F.unix_micros(F.col(at) if isinstance(at, str) else at) / 1e6


def gaps(rows: DataFrame, key: list[str], time: str) -> DataFrame:
    """Each distinct time of a key with the one before it and the minutes between; the first time has none."""
    times = rows.where(F.col(time).isNotNull()).select(*key, time).distinct()
    before = F.lag(time).over(Window.partitionBy(*key).orderBy(time))
    return times.withColumn("after", before).where("after is not null").withColumn("gap_minutes", (_seconds(time) - _seconds("after")) / 60)


def cadence_gaps(rows: DataFrame, key: list[str], time: str, cadence: float, slack: float = 0.1) -> DataFrame:
    """Gaps over the cadence, with the estimated number of missing times."""
    found = gaps(rows, key, time).where(F.col("gap_minutes") > cadence + slack)
    return found.withColumn("missing", F.greatest(F.lit(0), F.rint(F.col("gap_minutes") / cadence).cast("int") - 1))


def array_cadence_gaps(times: str, cadence: float, slack: float = 0.1) -> Column:
    """cadence_gaps() of a sorted array of distinct times: the estimated number of missing times of each gap."""
    minutes = F.transform(F.slice(times, 2, F.size(times)), lambda t, i: (_seconds(t) - _seconds(F.get(F.col(times), i))) / 60)
    return F.transform(F.filter(minutes, lambda m: m > cadence + slack), lambda m: F.greatest(F.lit(0), F.rint(m / cadence).cast("int") - 1))


def edge_coverage(rows: DataFrame, key: list[str], time: str, start: Column, end: Column, cadence: float) -> DataFrame:
    """Distinct times of a key against a requested window: uncovered minutes at both edges, expected slots, ratio."""
    agg = rows.groupBy(*key).agg(F.min(time).alias("first_time"), F.max(time).alias("last_time"), F.countDistinct(time).alias("n"))
    slots = F.greatest(F.lit(1), F.floor((_seconds(end) - _seconds(start)) / (cadence * 60)).cast("int"))
    return agg.select(
        *key, "n", slots.alias("expected_slots"), F.greatest(F.lit(0.0), (_seconds("first_time") - _seconds(start)) / 60).alias("start_gap"),
        F.greatest(F.lit(0.0), (_seconds(end) - _seconds("last_time")) / 60).alias("end_gap"), F.least(F.lit(1.0), F.col("n") / slots).alias("coverage_ratio"),
    )


def range_of(rows: DataFrame, order: str, ranges: int = 0) -> Column:
    """The number of a row's range of ``order`` (numbers or instants), by cuts that deal the rows about evenly; nulls are in range 0.

    The cuts, fewer than the ranges, are all that comes to the driver. Equal values share a range.
    """
    ranges = ranges or 2 * int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    key = F.unix_micros(F.col(order).cast("timestamp")) if dict(rows.dtypes)[order].startswith("timestamp") else F.col(order)
    cuts = rows.agg(F.percentile_approx(key, [i / ranges for i in range(1, ranges)], 20 * ranges)).first()[0] if ranges > 1 else []
    cuts = sorted(set(cuts or []))
    if not cuts:
        return F.lit(0)
    # Halving: how many cuts are at most the key.
    step = lambda at, p: F.when((at + p <= len(cuts)) & (F.get(F.lit(cuts), at + p - 1) <= key), at + p).otherwise(at)
    return F.coalesce(F.aggregate(F.lit([1 << i for i in reversed(range(len(cuts).bit_length()))]), F.lit(0), step), F.lit(0))


def lagged(rows: DataFrame, key: list[str], order: str, value: str, name: str, ranges: int = 0) -> DataFrame:
    """Each row with ``value`` of the row before it in its key by ``order``, which tells the key's rows apart.

    A key may hold most of all rows: every range of the order is a task of its own, and only each range's last row of a
    key goes on to the next ranges.
    """
    dealt = rows.withColumn("_r", range_of(rows, order, ranges))
    here = Window.partitionBy(*key, "_r").orderBy(order)
    own = dealt.withColumn(name, F.lag(value).over(here)).withColumn("_first", F.row_number().over(here) == 1)
    last = dealt.groupBy(*key, "_r").agg(F.max_by(F.struct(F.col(value).alias("v")), order).alias("_last"))
    carried = F.lag("_last").over(Window.partitionBy(*key).orderBy("_r"))  # a row a range
    border = last.select(*(F.col(k).alias(f"_k{i}") for i, k in enumerate(key)), F.col("_r").alias("_b"), carried.alias("_before"))
    same = F.col("_r") == F.col("_b")
    for i, k in enumerate(key):
        same = same & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    return own.join(border, same, "left").withColumn(name, F.when(F.col("_first"), F.col("_before.v")).otherwise(F.col(name))).select(*rows.columns, name)


def continuity(attempts: DataFrame, kind: str, order: str, time: str, nominal: Column) -> DataFrame:
    """Each attempt against the one before it in input order: the gap in minutes, whether it's over 1.5 times nominal, estimated missed ones, and whether it's older than that one."""
    gap = (_seconds(time) - _seconds("_at")) / 60
    out = lagged(attempts, [kind], order, time, "_at").withColumn("gap_minutes", gap).withColumn("nominal", nominal)
    over = F.coalesce(F.col("gap_minutes") > 1.5 * F.col("nominal"), F.lit(False))
    missed = F.coalesce(F.greatest(F.lit(0), F.floor(F.greatest(F.col("gap_minutes"), F.lit(0.0)) / F.col("nominal")).cast("int") - 1), F.lit(0))
    older = F.coalesce(F.col("gap_minutes") < 0, F.lit(False))
    return out.drop("_at").withColumns({"continuity_gap": over, "missed": missed, "older_than_latest": older})


def axis_valid(rows: DataFrame, key: list[str], position: str, time: str) -> DataFrame:
    """Whether times rise strictly in input order."""
    before = F.lag(time).over(Window.partitionBy(*key).orderBy(position))
    return rows.withColumn("_ok", before.isNull() | (before < F.col(time))).groupBy(*key).agg(F.bool_and("_ok").alias("axis_valid"))


def first_wins(rows: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """The first row of each key by a total order of columns; nulls come last. Each task keeps its own first rows before the shuffle."""
    return _first(rows, key, [F.col(c).asc_nulls_last() for c in order]).select(*rows.columns)


def last_wins(rows: DataFrame, key: list[str], order: str) -> DataFrame:
    """The last row of each key; of rows of one order any. Each task keeps its own last rows before the shuffle; rows without an order come after all others."""
    return _first(rows, key, [F.col(order).desc_nulls_last()]).select(*key, *(c for c in rows.columns if c not in key))


def _first(rows: DataFrame, key: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key, under a number that takes no column's name."""
    return rows.withColumn("_nth", F.row_number().over(Window.partitionBy(*key).orderBy(*order))).where("_nth = 1")


def top(rows: DataFrame, key: list[str], order: list[str], most: int) -> DataFrame:
    """The first ``most`` rows of each key by a total order, numbered from 1 (``n``). Each task ranks what it has before the shuffle."""
    ranked = rows.withColumn("n", F.row_number().over(Window.partitionBy(*key).orderBy(*order))).where(F.col("n") <= most)
    return ranked.withColumn("n", F.col("n").cast("long"))


def repeats(rows: DataFrame, key: list[str]) -> DataFrame:
    return rows.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def nearest(left: DataFrame, right: DataFrame, left_id: str, left_time: str, right_id: str, right_time: str, within_seconds: int, key: list[str] | None = None) -> DataFrame:
    """The right row nearest in time to each left row, before or after, within a distance; ties go to the earlier time, then the lower id.

    Times are dealt into buckets as wide as the distance; a right row is posted in its own bucket and both neighbours,
    which makes the range join an equi-join. Candidates are reduced by a partial aggregate.
    """
    key = key or []
    width = F.lit(within_seconds * 1_000_000)
    l = left.select(*key, F.col(left_id).alias("left_id"), F.col(left_time).alias("left_time"), F.floor(F.unix_micros(left_time) / width).alias("_b"))
    own = F.floor(F.unix_micros(right_time) / width)
    r = right.select(*key, F.col(right_id).alias("right_id"), F.col(right_time).alias("right_time"), F.explode(F.array(own - 1, own, own + 1)).alias("_b"))
    micros = F.abs(F.unix_micros("right_time") - F.unix_micros("left_time"))
    near = l.join(r, [*key, "_b"]).withColumn("distance_us", micros).where(F.col("distance_us") <= width)
    best = near.groupBy(*key, "left_id", "left_time").agg(F.min(F.struct("distance_us", "right_time", "right_id")).alias("x"))
    return best.select(*key, "left_id", "left_time", "x.right_id", "x.right_time", "x.distance_us")


def newest_eligible(cycles: DataFrame, key: list[str], cycle: str, published: str, most: int = 0) -> DataFrame:
    """The newest cycle that is published, and how many probes led to it: all cycles from it on. With ``most``, the newest so many of them as a trail, newest first."""
    chosen = cycles.where(published).groupBy(*key).agg(F.max(cycle).alias("selected"))
    probed = cycles.join(chosen, key).where(F.col(cycle) >= F.col("selected"))
    counted = probed.groupBy(*key, "selected").agg(F.count(F.lit(1)).alias("probes"))
    if not most:
        return counted
    newest = probed.withColumn("_n", F.row_number().over(Window.partitionBy(*key).orderBy(F.desc(cycle)))).where(F.col("_n") <= most)
    trail = newest.groupBy(*key).agg(F.sort_array(F.collect_list(F.struct(F.col(cycle).alias("cycle"), F.col(published).alias("published"))), asc=False).alias("trail"))
    return counted.join(trail, key)
