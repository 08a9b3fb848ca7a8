"""Hourly ensemble responses: all that is wrong with one, and its records by lead.

A response is a VARIANT with a time axis and one list a field and member. It is checked as one row, by expressions over its
own arrays; its records are exploded once, by lead and member, and summed up again by lead.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gustloom.functions import columns as C
from gustloom.functions import variants as V
from gustloom.operators import ensemble, gate
from gustloom.sources.requests import SPOT

#: The fields of the wind, which every member has, and those that a member may have; the unit of speeds.
WIND = {"speed": "wind_speed_10m", "direction": "wind_direction_10m", "gust": "wind_gusts_10m"}
OPTIONAL = {"precipitation": "precipitation", "cape": "cape"}
UNIT = "m/s"
#: How far the returned point may be from the spot, in degrees; the hours that the trajectories cover.
NEAR, HOURS = (0.05, 0.08), 48
#: What of the provider's metadata must be the same before and after the response.
STABLE = ("last_run_initialisation_time_utc", "last_run_availability_time_utc", "last_run_modification_time_utc")
SETTLING_SECONDS = 600


def typed(responses: DataFrame) -> DataFrame:
    """(path, payload, before, after, asked_at) with times, the point and a map from member to values of each field.

    ``before`` and ``after`` are structs of the provider's metadata (instants named as in STABLE). Members are told by
    their column's name; a value that is no finite number is null, and so is a time that can't be read.
    """
    hourly = V.entries("payload", "$.hourly")

    def values(v: Column) -> Column:
        """A list's finite numbers; one look at its type tells a list of numbers, whose elements needn't be looked at."""
        plain = F.schema_of_variant(v).rlike(r"^ARRAY<(BIGINT|DOUBLE|FLOAT|DECIMAL\(\d+,\d+\))>$")
        return F.when(plain, F.try_variant_get(v, "$", "array<double>")).otherwise(F.transform(V.items(v), lambda x: V.number(x)))

    def members(field: str) -> Column:
        own = F.filter(F.map_entries("_hourly"), lambda e: ensemble.member_of(e["key"], field).isNotNull())
        return F.map_from_entries(F.transform(own, lambda e: F.struct(ensemble.member_of(e["key"], field).alias("key"), values(e["value"]).alias("value"))))

    return responses.withColumn("_hourly", hourly).select(
        "path", "before", "after", "asked_at", F.transform(V.items("payload", "$.hourly.time"), lambda t: V.instant(t)).alias("times"), F.size(V.items("payload", "$.hourly.time")).alias("_n"),
        V.number("payload", "$.latitude").alias("latitude"), V.number("payload", "$.longitude").alias("longitude"), V.number("payload", "$.utc_offset_seconds").alias("_offset"),
        *(V.text("payload", f"$.hourly_units.{f}").alias(f"_unit_{n}") for n, f in WIND.items()), *(members(f).alias(n) for n, f in (WIND | OPTIONAL).items()),
        F.sha2(F.to_json("payload"), 256).alias("response_sha256"), F.col(f"before.{STABLE[0]}").alias("run"),
    )


def checked(responses: DataFrame, expected: int = ensemble.MEMBERS, hours: int = HOURS, settling: int = SETTLING_SECONDS) -> DataFrame:
    """typed() with ``refusals``, why no record can be made, and ``hourly_faults``, why the trajectories over ``hours`` hours are no source; all of both, in a fixed order."""
    t = typed(responses)
    want = F.sequence(F.lit(0), F.lit(expected - 1))
    maps = list(WIND)
    common = F.array_sort(F.array_intersect(F.array_intersect(*(F.map_keys(m) for m in maps[:2])), F.map_keys(maps[2])))
    whole = F.forall("times", lambda x: x.isNotNull() & (F.minute(x) == 0) & (F.second(x) == 0) & (F.unix_micros(x) % 1_000_000 == 0))
    lengths = F.lit(True)
    for m in (*WIND, *OPTIONAL):
        lengths = lengths & F.forall(F.map_values(m), lambda v: F.size(v) == F.size("times"))
    far = (F.abs(F.col("latitude") - SPOT[0]) > NEAR[0]) | (F.abs(F.col("longitude") - SPOT[1]) > NEAR[1])
    none = lambda x: F.coalesce(x, F.lit(True))
    faults = lambda *pairs: F.filter(F.array(*(F.when(w, F.lit(n)) for w, n in pairs)), lambda x: x.isNotNull())
    before, after = ({k: F.col(f"{side}.{k}") for k in STABLE} for side in ("before", "after"))
    refusals = faults(
        (none(~gate.settled(before[STABLE[1]], F.col("run"), F.col("asked_at"), settling)), "run_not_settled_or_no_cycle"), (none(F.col("common") != want), "wind_member_identity_mismatch"), (~gate.stable(before, after, list(STABLE)), "run_metadata_changed"),
        (none(F.col("_offset") != 0), "utc_offset_not_zero"), (none((F.col("_unit_speed") != UNIT) | (F.col("_unit_gust") != UNIT)), "unexpected_wind_units"), (F.col("latitude").isNull() | F.col("longitude").isNull(), "returned_coordinate_missing"),
        (F.coalesce(far, F.lit(False)), "returned_coordinate_implausible"), (F.col("_n") == 0, "time_axis_empty"), (~whole, "time_axis_not_hourly"),
        (whole & ((F.array_sort("times") != F.col("times")) | (F.size(F.array_distinct("times")) != F.size("times"))), "time_axis_unordered_or_repeated"), (~lengths, "values_not_as_long_as_axis"),
    )
    steps = F.sequence(F.lit(0), F.lit(hours))
    place = lambda h: F.array_position("times", F.timestamp_micros(F.unix_micros("run") + h.cast("long") * 3_600_000_000)).cast("int")
    at = lambda v, i: F.get(v, i - 1)
    some = lambda test: F.exists("places", test)
    lacking = lambda m: some(lambda i: (i > 0) & F.exists(F.map_values(m), lambda v: at(v, i).isNull()))
    negative = lambda m: some(lambda i: (i > 0) & F.exists(F.map_values(m), lambda v: F.coalesce(at(v, i) < 0, F.lit(False))))
    hourly = faults(
        (F.col("run").isNull() | some(lambda i: F.coalesce(i, F.lit(0)) == 0), "hourly_timestamp_missing"), *((none(F.array_sort(F.map_keys(m)) != want), f"hourly_member_set_mismatch_{m}") for m in WIND),
        *((lacking(m), f"hourly_value_not_finite_{m}") for m in WIND), *((negative(m), f"hourly_value_negative_{m}") for m in WIND if m != "direction"),
    )
    out = t.withColumn("common", common).withColumn("places", F.transform(steps, place)).withColumn("refusals", refusals).withColumn("hourly_faults", hourly)
    return out.drop("_n", "_offset", "places", *(f"_unit_{n}" for n in WIND))


def records(checked_rows: DataFrame, leads: Column, expected: int = ensemble.MEMBERS) -> DataFrame:
    """One row per response without refusals and lead: path, run, lead, valid, members, statistics, derived, error.

    A member counts at a lead where its speed, direction and gust are there; precipitation and CAPE go with it where they
    are. A record with fewer than all members keeps those that it has and says so in ``error``; ``derived``, from the
    medians, is made of complete ones alone. ``checked_rows`` are read three times: best a table.
    """
    valid = F.timestamp_micros(F.unix_micros("run") + F.col("lead").cast("long") * 3_600_000_000)
    due = checked_rows.where(F.size("refusals") == 0).withColumn("lead", F.explode(leads)).withColumn("valid", valid)
    due = due.withColumn("_i", F.array_position("times", F.col("valid")).cast("int"))
    value = lambda m: F.when(F.col("_i") > 0, F.get(F.try_element_at(m, F.col("member")), F.col("_i") - 1))
    long = due.withColumn("member", F.explode("common")).select("path", "lead", "member", *(value(m).alias(m) for m in (*WIND, *OPTIONAL))).where("speed is not null and direction is not null and gust is not null")
    parts = F.array_sort(F.collect_list(F.struct("member", *WIND, *OPTIONAL))).alias("members")  # as many as an ensemble has
    named = long.withColumnsRenamed({"speed": "wind_speed_ms", "direction": "wind_direction_deg", "gust": "gust_ms"})
    stats = ensemble.statistics(named, ["path", "lead"])
    held = long.groupBy("path", "lead").agg(parts).join(stats, ["path", "lead"])
    joined = due.select("path", "run", "lead", "valid", "_i", "response_sha256").join(held, ["path", "lead"], "left")
    ids = F.coalesce(F.transform("members", lambda m: m["member"]), F.array().cast("array<int>"))
    complete = ids == F.sequence(F.lit(0), F.lit(expected - 1))
    error = F.when(F.coalesce("_i", F.lit(0)) == 0, "valid_time_not_on_axis").when(~complete, F.concat(F.lit("members_incomplete: "), F.array_join(F.transform(F.array_except(F.sequence(F.lit(0), F.lit(expected - 1)), ids), lambda x: x.cast("string")), ",")))
    columns = [c for c in stats.columns if c not in ("path", "lead")]
    derived = F.when(error.isNull(), C.wind_from_members("median", "direction_mean", "gust_median"))
    return joined.select(
        "path", "run", "lead", "valid", "response_sha256", "members", F.when(F.col("member_count").isNotNull(), F.struct(*columns)).alias("statistics"), derived.alias("derived"), error.alias("error")
    )
