"""Lead grids and horizons as expressions over (model, cycle hour): no joins, so they fuse into any scan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gustloom.functions.columns import col

MODELS = ("ICON-D2", "ICON-D2-EPS", "ICON-EU", "ECMWF-IFS", "GFS", "GEFS-control")
GRID_VERSION = "acquisition-grid-v2"
SYNOPTIC = (0, 6, 12, 18)
# Bands of the grid as first lead, last lead, step and the cycle hours that have it.
BANDS = ((0, 48, 3, tuple(range(24))), (51, 72, 3, SYNOPTIC), (78, 120, 6, SYNOPTIC), (132, 240, 12, (0, 12)), (264, 384, 24, (0, 12)), (408, 840, 24, (0,)))
# Test-mode leads, which two models have more of.
TEST_LEADS, DENSE_TEST_LEADS, DENSE_MODELS = (0, 12, 24, 36, 48), (0, 12, 24, 30, 36, 42, 48), ("ICON-D2", "GFS")


def native_max(model: Column | str, hour: Column | str) -> Column:
    """The provider's own horizon in hours."""
    m, h = col(model), col(hour)
    return (
        F.when(m.isin("ICON-D2", "ICON-D2-EPS"), 48).when(m == "ICON-EU", F.when(h.isin(*SYNOPTIC), 120).otherwise(51))
        .when(m == "ECMWF-IFS", F.when(h.isin(0, 12), 360).otherwise(144)).when(m == "GFS", 384)
        .when(m == "GEFS-control", F.when(h == 0, 840).otherwise(384))
    )


def compatibility_max(model: Column | str, hour: Column | str) -> Column:
    return F.when((col(model) == "ECMWF-IFS") & col(hour).isin(6, 18), 90).otherwise(F.least(F.lit(120), native_max(model, hour)))


def policy_max(model: Column | str, hour: Column | str) -> Column:
    """The horizon that the audit's policy gives; shorter than the native one for three models."""
    m, h = col(model), col(hour)
    return (
        F.when(m.isin("ICON-D2", "ICON-D2-EPS"), 48).when(m == "ICON-EU", F.when(h.isin(*SYNOPTIC), 120).otherwise(51))
        .when(m == "ECMWF-IFS", F.when(h.isin(0, 12), 120).otherwise(90)).when(m.isin("GFS", "GEFS-control"), 120)
    )


def _given(value: Column, body) -> Column:
    """``body`` of a value that is worked out once a row; inside a filter's lambda it would be once an element."""
    return F.get(F.transform(F.array(value), body), 0)


def grid(model: Column | str, hour: Column | str) -> Column:
    """Sorted leads of the acquisition grid."""
    none = F.array().cast("array<int>")
    parts = [F.when(col(hour).isin(*hours), F.sequence(F.lit(a), F.lit(b), F.lit(step))).otherwise(none) for a, b, step, hours in BANDS]
    return _given(native_max(model, hour), lambda most: F.filter(F.concat(*parts), lambda x: x <= most))


def extension(model: Column | str, hour: Column | str) -> Column:
    """Grid leads beyond the compatibility horizon."""
    return _given(compatibility_max(model, hour), lambda most: F.filter(grid(model, hour), lambda x: x > most))


def core_extension(model: Column | str, hour: Column | str) -> Column:
    """Grid leads over 48 h within the compatibility horizon."""
    return _given(compatibility_max(model, hour), lambda most: F.filter(grid(model, hour), lambda x: (x > 48) & (x <= most)))


def desired(model: Column | str) -> Column:
    """The leads that the policy wants of a model, whatever the cycle."""
    short = F.sequence(F.lit(0), F.lit(48), F.lit(3))
    return F.when(col(model).isin("ICON-D2", "ICON-D2-EPS"), short).otherwise(F.concat(short, F.sequence(F.lit(51), F.lit(72), F.lit(3)), F.sequence(F.lit(78), F.lit(120), F.lit(6))))


def base(model: Column | str, test: bool) -> Column:
    if test:
        return F.when(col(model).isin(*DENSE_MODELS), F.lit(list(DENSE_TEST_LEADS))).otherwise(F.lit(list(TEST_LEADS)))
    return F.sequence(F.lit(0), F.lit(48), F.lit(3))


def policy(model: Column | str, hour: Column | str) -> Column:
    leads = grid(model, hour)
    return F.struct(
        F.lit(GRID_VERSION).alias("acquisition_grid_version"), F.lit(GRID_VERSION).alias("retention_grid_version"), native_max(model, hour).alias("provider_native_horizon_hours"),
        compatibility_max(model, hour).alias("compatibility_horizon_hours"), F.array_max(leads).alias("acquisition_max_lead_hours"), leads.alias("acquisition_leads"), extension(model, hour).alias("extension_leads"),
    )


def gefs_contract(hour: Column | str, lead: Column | str) -> Column:
    """Products, resolution and padding for a lead; null with a reject reason for a lead that isn't a whole hour from 0."""
    most, h = native_max(F.lit("GEFS-control"), hour), col(lead)
    inside, near = h <= most, h <= 240
    pick = lambda a, b: F.when(inside, F.when(near, a).otherwise(b))
    return F.when(
        h >= 0,
        F.struct(
            inside.alias("expected"), most.alias("expected_max_hours"), pick("gefs_0p25s", "gefs_0p50a").alias("wind_product"), pick(0.25, 0.5).alias("wind_resolution_degrees"),
            pick("gefs_0p25s", "gefs_0p50b").alias("gust_product"), (inside & near).alias("gust_required"), pick(0.30, 0.75).alias("subset_padding_degrees"),
        ),
    )


def probe_lead(hour: Column | str, required: Column | str, full: bool) -> Column:
    """The lead that proves a cycle is published: its last one, or the required one where the cycle has it."""
    most = native_max(F.lit("GEFS-control"), hour)
    return most if full else F.when(col(required) <= most, col(required))


def candidate_cycles(spark: SparkSession, now: str, days: int = 3) -> DataFrame:
    """Cycles of the last days that have begun, newest first by ``rank``."""
    day = F.date_trunc("day", F.lit(now).cast("timestamp"))
    cycles = spark.range(days).crossJoin(spark.createDataFrame([(h,) for h in SYNOPTIC], "hour int"))
    run = (day - F.make_dt_interval(days=F.col("id").cast("int")) + F.make_dt_interval(hours=F.col("hour"))).alias("run")
    found = cycles.select(run, "hour").where(F.col("run") <= F.lit(now).cast("timestamp"))
    return found.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("run"))))  # at most 4 * days rows


def batches(leads: Column | str, size: int = 6) -> Column:
    """Leads in runs of ``size``, for requests that take several."""
    x = col(leads)
    count = F.ceil(F.size(x) / size).cast("int")
    return F.when(F.size(x) == 0, F.array().cast("array<array<int>>")).otherwise(F.transform(F.sequence(F.lit(0), count - 1), lambda i: F.slice(x, i * size + 1, F.lit(size))))
