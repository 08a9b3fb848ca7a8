"""Ensembles: unpivoting member columns, exact quantiles, circular means, member-set equality."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MEMBERS = 20
#: Keys whose bin edges (8 KB each) the driver holds.
LARGE_KEYS = 2000
#: Distinct values, over all keys, whose counts are put in order a key at a time.
FEW_VALUES = 200_000


def circular_mean(degrees: Column | str) -> Column:
    """An aggregate: mean direction in [0, 360); null for no rows or where the directions cancel out."""
    x = F.radians(F.col(degrees) if isinstance(degrees, str) else degrees)
    s, c = F.sum(F.sin(x)), F.sum(F.cos(x))
    return F.when((F.abs(s) >= 1e-12) | (F.abs(c) >= 1e-12), F.pmod(F.degrees(F.atan2(s, c)), F.lit(360.0)))


def statistics(rows: DataFrame, key: list[str], speed: str = "wind_speed_ms", direction: str = "wind_direction_deg", gust: str = "gust_ms") -> DataFrame:
    """Exact statistics of each ensemble in one aggregate; gusts have a median and a p90 only. A group is bounded by its members: of large ones, see large_percentiles()."""
    q = F.percentile(speed, F.array(*map(F.lit, (0.1, 0.25, 0.75, 0.9))))
    return rows.groupBy(*key).agg(
        F.count(speed).alias("member_count"), F.median(speed).alias("median"), q[0].alias("p10"), q[1].alias("p25"), q[2].alias("p75"), q[3].alias("p90"),
        F.stddev_pop(speed).alias("spread"), circular_mean(direction).alias("direction_mean"), F.median(gust).alias("gust_median"), F.percentile(gust, F.lit(0.9)).alias("gust_p90"),
    )


def large_percentiles(rows: DataFrame, key: list[str], value: str, shares: list[float], bins: int = 1024) -> DataFrame:
    """(key, n, one column p0, p1, ... a share): exact percentiles, interpolated, of up to LARGE_KEYS keys that may hold any number of rows.

    Rows are first counted by key and value, combined before the shuffle. If FEW_VALUES counts are left at most, they are
    all that is put in order. Otherwise a sketch gives each key's bin edges, with about as many rows in each bin; the counts of the bins tell in which of them the wanted ranks are, and only those bins'
    values are put in order. What is joined has a few rows a key and is broadcast: the edges (8 KB a key) are a table of
    the driver's, so that every use of them is the same. Null values are left out.
    """
    names = [f"_k{i}" for i in range(len(key))]
    counted = rows.where(F.col(value).isNotNull()).groupBy(*key, F.col(value).cast("double").alias("_v")).agg(F.count(F.lit(1)).alias("_c"))
    if counted.limit(FEW_VALUES + 1).count() <= FEW_VALUES:
        some = counted.groupBy(*key).agg(F.sum("_c").alias("n"), F.percentile("_v", F.array(*map(F.lit, shares)), F.col("_c")).alias("_p"))
        return some.select(*key, "n", *(F.get("_p", i).alias(f"p{i}") for i in range(len(shares))))
    # Edges only balance the bins, so that a coarse sketch will do.
    sketch = F.array_distinct(F.percentile_approx(F.col(value).cast("double"), [i / bins for i in range(1, bins)], 4 * bins))
    held = rows.where(F.col(value).isNotNull()).groupBy(*key).agg(F.count(F.lit(1)).alias("n"), sketch.alias("_edges")).limit(LARGE_KEYS + 1)
    schema, held = held.schema, held.collect()
    if len(held) > LARGE_KEYS:
        raise ValueError(f"more than {LARGE_KEYS} keys: their groups are small enough for percentile()")
    edges = rows.sparkSession.createDataFrame(held, schema)

    def joined(left: DataFrame, right: DataFrame, *on: str) -> DataFrame:
        """Null-safe on the key; ``right`` has as many rows a key as there are shares, at most twice as many."""
        r = right.select(*(F.col(k).alias(n) for k, n in zip(key, names)), *(F.col(c).alias(f"_{c}_r") if c in on else F.col(c) for c in right.columns if c not in key))
        same = F.lit(True)
        for k, n in zip(key, names):
            same = same & F.col(k).eqNullSafe(F.col(n))
        for c in on:
            same = same & (F.col(c) == F.col(f"_{c}_r"))
        return left.join(F.broadcast(r), same).drop(*names, *(f"_{c}_r" for c in on))

    powers = F.lit([1 << i for i in reversed(range(bins.bit_length()))])
    step = lambda at, p: F.when((at + p <= F.size("_edges")) & (F.get("_edges", at + p - 1) <= F.col("_v")), at + p).otherwise(at)
    binned = joined(counted, edges).withColumn("_bin", F.aggregate(powers, F.lit(0), step))
    totals = binned.groupBy(*key, "_bin").agg(F.sum("_c").alias("_t"))  # a row a bin
    upto = F.sum("_t").over(Window.partitionBy(*key).orderBy("_bin"))
    spans = joined(totals.withColumn("_before", upto - F.col("_t")), edges.select(*key, "n"))
    ranks = F.array_distinct(F.flatten(F.array(*(F.array(F.floor(s * (F.col("n") - 1)), F.ceil(s * (F.col("n") - 1))) for s in shares))))
    wanted = spans.select(*key, "_bin", "_before", F.explode(ranks).alias("_rank"), "_t").where((F.col("_rank") >= F.col("_before")) & (F.col("_rank") < F.col("_before") + F.col("_t")))
    needed = wanted.groupBy(*key, "_bin", "_before").agg(F.collect_list("_rank").alias("_ranks"))
    inside = joined(binned.drop("_edges", "n"), needed, "_bin")
    end = F.col("_before") + F.sum("_c").over(Window.partitionBy(*key, "_bin").orderBy("_v"))
    found = inside.withColumn("_end", end).withColumn("_rank", F.explode("_ranks")).where((F.col("_rank") < F.col("_end")) & (F.col("_rank") >= F.col("_end") - F.col("_c")))
    at = found.groupBy(*key).agg(F.map_from_entries(F.collect_list(F.struct("_rank", "_v"))).alias("_at"))
    both = joined(edges.select(*key, "n"), at)

    def share(s: float) -> Column:
        r = s * (F.col("n") - 1)
        low, high = F.try_element_at("_at", F.floor(r)), F.try_element_at("_at", F.ceil(r))
        return low + (high - low) * (r - F.floor(r))

    return both.select(*key, "n", *(share(s).alias(f"p{i}") for i, s in enumerate(shares)))


def unpivot_hourly(rows: DataFrame, key: list[str], times: str = "times", columns: str = "columns") -> DataFrame:
    """times[] and columns{field: {member: values[]}} as rows (key, field, member, time, value)."""
    fields = rows.select(*key, times, F.explode(columns).alias("field", "members"))
    members = fields.select(*key, times, "field", F.explode("members").alias("member", "values"))
    zipped = members.select(*key, "field", F.col("member").cast("int").alias("member"), F.inline(F.arrays_zip(F.col(times).alias("time"), F.col("values").alias("value"))))
    return zipped.toDF(*key, "field", "member", "time", "value")


def at_leads(long: DataFrame, cycles: DataFrame, key: list[str], time: str = "time") -> DataFrame:
    """Member values at the leads of their cycle. ``cycles``: key, run, leads (array); rows of ``long`` whose time is no lead's valid time are left out, leads without values have none."""
    due = cycles.select(*key, "run", F.explode("leads").alias("lead"))
    valid = F.timestamp_seconds(F.unix_micros("run") / 1e6 + F.col("lead") * 3600)
    return due.withColumn(time, valid).join(long, [*key, time], "left")


def member_of(name: Column | str, prefix: str) -> Column:
    """The member of a column name: prefix_memberNN, or the bare prefix for member 0; null for other names."""
    n = F.col(name) if isinstance(name, str) else name
    return F.when(n == prefix, 0).when(n.rlike(rf"^{prefix}_member\d+$"), F.regexp_extract(n, r"(\d+)$", 1).cast("int"))


def by_field(long: DataFrame, key: list[str]) -> DataFrame:
    """Speed, direction and gust of members that have all three; precipitation and CAPE where they are there."""
    pick = lambda f: F.max(F.when(F.col("field") == f, F.col("value")))
    wide = long.groupBy(*key, "member", "time").agg(
        pick("wind_speed_10m").alias("wind_speed_ms"), pick("wind_direction_10m").alias("wind_direction_deg"), pick("wind_gusts_10m").alias("gust_ms"), pick("precipitation").alias("precipitation"), pick("cape").alias("cape")
    )
    return wide.where("wind_speed_ms is not null and wind_direction_deg is not null and gust_ms is not null")


def member_set(rows: DataFrame, key: list[str], member: str = "member", expected: int = MEMBERS) -> DataFrame:
    """Members of each group, and whether they are 0..expected-1, each once."""
    held = F.array_sort(F.collect_list(member))
    return rows.groupBy(*key).agg(held.alias("members")).withColumn("complete", F.col("members") == F.sequence(F.lit(0), F.lit(expected - 1)))


def hourly_axis(rows: DataFrame, times: str = "times") -> DataFrame:
    """Checks of a response's axis: whole hours, sorted, unique."""
    t = F.col(times)
    return rows.withColumns({"whole_hours": F.forall(t, lambda x: (F.minute(x) == 0) & (F.second(x) == 0)), "sorted": F.array_sort(t) == t, "unique": F.size(F.array_distinct(t)) == F.size(t)})
