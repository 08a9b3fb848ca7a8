"""Queries of the audits: bundles whose JSON is made of the driver's tables, audited, beside the same rules over the same tables in DuckDB.

Every bundle is one customer or supplier. Its key decides ages, flags and rows, so that each rule has bundles on both
sides of its bound; the DuckDB form never sees the JSON.
"""

from __future__ import annotations

import re

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gustloom.plans.catalog import query, table
from gustloom.rules import archive, models, stations
from gustloom.sources.bundles import from_text, spread

NOW = "2025-03-14 09:00:00"


def _now():
    return F.lit(f"{NOW}Z").cast("timestamp")


def _bundles(rows: DataFrame, json: str, absent: str = "k % 43 = 0", broken: str = "k % 47 = 0") -> DataFrame:
    """Bundles of (k): the JSON expression's text, null or not JSON for some keys."""
    text = F.expr(f"CASE WHEN {absent} THEN NULL WHEN {broken} THEN '[1,' ELSE {json} END")
    return from_text(rows.select("k", text.alias("json")), "k", "json")


def _codes(found: DataFrame) -> DataFrame:
    return found.groupBy(F.col("path").cast("long").alias("k"), "code", "severity").agg(F.count(F.lit(1)).alias("n"))


def _kept(bundles: DataFrame) -> DataFrame:
    """Bundles that several steps read: each is made and parsed once, and executors keep it on disk where memory is short."""
    return bundles.persist(StorageLevel.MEMORY_AND_DISK)


def _minutes(x: str) -> str:
    """Spark SQL: the time so many minutes before now, as the bundles have it."""
    return f"date_format(timestamp '{NOW}' - make_dt_interval(0, 0, {x}), \"yyyy-MM-dd'T'HH:mm:ss'+00:00'\")"


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k")), "k")


_SVG_JSON = f"""to_json(named_struct(
    'station', named_struct('id', if(k % 11 = 0, 999, 42374)),
    'requested_history_window', named_struct('start_utc', {_minutes("60")}, 'end_utc', {_minutes("0")}),
    'latest_observation', if(k % 13 = 0, named_struct('time_utc', cast(null as string)), named_struct('time_utc', {_minutes("(k * 7) % 80 - 8")})),
    'request_diagnostics', named_struct('current', named_struct('success', k % 5 <> 0, 'http_status', 200), 'historic', named_struct('success', k % 7 <> 0, 'http_status', 200),
                                        'stations', if(k % 3 = 0, null, named_struct('success', k % 4 <> 0, 'http_status', 503))),
    'recent_historic_observations', if(k % 31 = 0, array(), concat(
        transform(filter(sequence(0, 11), i -> i <> k % 17 and not (k % 37 = 0 and i >= 8) and not (k % 41 = 0 and i <= 2)), i -> named_struct('time_utc', {_minutes("3 + 5 * i")})),
        if(k % 6 = 0, array(named_struct('time_utc', {_minutes("8")})), array()), if(k % 19 = 0, array(named_struct('time_utc', 'soon')), array()),
        if(k % 23 = 0, array(named_struct('time_utc', {_minutes("-6")})), array()), if(k % 29 = 0, array(named_struct('time_utc', {_minutes("62")})), array())))))"""


@query("""
    WITH c AS (SELECT c_custkey AS k, (c_custkey * 7) % 80 - 8 AS age FROM customer),
    good AS (SELECT * FROM c WHERE k % 43 <> 0 AND k % 47 <> 0),
    h AS (SELECT k, 3 + 5 * i AS m FROM good, range(12) r(i) WHERE i <> k % 17 AND NOT (k % 37 = 0 AND i >= 8) AND NOT (k % 41 = 0 AND i <= 2)
          UNION ALL SELECT k, 8 FROM good WHERE k % 6 = 0 UNION ALL SELECT k, NULL FROM good WHERE k % 19 = 0 UNION ALL SELECT k, -6 FROM good WHERE k % 23 = 0 UNION ALL SELECT k, 62 FROM good WHERE k % 29 = 0),
    t AS (SELECT * FROM h WHERE k % 31 <> 0),
    g AS (SELECT k, count(*) AS gaps FROM (SELECT k, m, lead(m) OVER (PARTITION BY k ORDER BY m) - m AS gap FROM (SELECT DISTINCT k, m FROM t WHERE m IS NOT NULL)) WHERE gap > 5.1 GROUP BY 1),
    a AS (SELECT k, count(*) FILTER (m IS NULL) AS bad, count(m) AS timed, count(DISTINCT m) AS apart, count(*) FILTER (m < -5) AS late, count(*) FILTER (m < 0 OR m > 60) AS outside, max(m) AS oldest, min(m) AS newest FROM t GROUP BY 1),
    x AS (
        SELECT k, 'SVG_BUNDLE_FILE_NOT_CREATED' AS code, 'ERROR' AS severity FROM c WHERE k % 43 = 0
        UNION ALL SELECT k, 'SVG_BUNDLE_JSON_INVALID', 'ERROR' FROM c WHERE k % 47 = 0 AND k % 43 <> 0
        UNION ALL SELECT k, 'SVG_STATION_ID_MISMATCH', 'ERROR' FROM good WHERE k % 11 = 0
        UNION ALL SELECT k, 'WEATHERLINK_REQUEST_FAILED', 'ERROR' FROM good WHERE k % 5 = 0 UNION ALL SELECT k, 'WEATHERLINK_REQUEST_FAILED', 'ERROR' FROM good WHERE k % 7 = 0
        UNION ALL SELECT k, 'WEATHERLINK_REQUEST_FAILED', 'WARN' FROM good WHERE k % 3 <> 0 AND k % 4 = 0 UNION ALL SELECT k, 'SVG_REQUEST_DIAGNOSTIC_NOT_RECORDED', 'WARN' FROM good WHERE k % 3 = 0
        UNION ALL SELECT k, 'SVG_CURRENT_OBSERVATION_TIMESTAMP_UNAVAILABLE', 'ERROR' FROM good WHERE k % 13 = 0
        UNION ALL SELECT k, CASE WHEN age < -5 THEN 'SVG_OBSERVATION_TIMESTAMP_TOO_FAR_IN_FUTURE' WHEN age > 60 THEN 'SVG_CURRENT_OBSERVATION_EXCEEDS_MAXIMUM_AGE' ELSE 'SVG_CURRENT_OBSERVATION_EXCEEDS_FRESH_TARGET' END,
                         CASE WHEN age < -5 OR age > 60 THEN 'ERROR' ELSE 'WARN' END FROM good WHERE k % 13 <> 0 AND (age < -5 OR age > 15)
        UNION ALL SELECT k, 'SVG_HISTORIC_WINDOW_RETURNED_ZERO_RECORDS', 'ERROR' FROM good WHERE k % 31 = 0
        UNION ALL SELECT k, 'SVG_HISTORIC_TIMESTAMP_INVALID', 'ERROR' FROM a WHERE bad > 0 UNION ALL SELECT k, 'SVG_HISTORIC_TIMESTAMP_TOO_FAR_IN_FUTURE', 'ERROR' FROM a WHERE late > 0
        UNION ALL SELECT k, 'SVG_HISTORIC_TIMESTAMP_OUTSIDE_REQUEST_WINDOW', 'ERROR' FROM a WHERE outside > 0 UNION ALL SELECT k, 'SVG_HISTORIC_DUPLICATE_TIMESTAMPS', 'WARN' FROM a WHERE timed > apart
        UNION ALL SELECT k, 'SVG_HISTORIC_CADENCE_GAPS', 'WARN' FROM g UNION ALL SELECT k, 'SVG_HISTORIC_WINDOW_START_NOT_COVERED', 'WARN' FROM a WHERE 60 - oldest > 10
        UNION ALL SELECT k, 'SVG_HISTORIC_WINDOW_END_NOT_COVERED', 'WARN' FROM a WHERE newest > 10)
    SELECT k, code, severity, count(*) AS n FROM x GROUP BY ALL""")
def audit_svg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _codes(stations.audit_svg(_bundles(customers(spark, sf_dir), _SVG_JSON), _now())[0])


_SKM_JSON = f"""to_json(named_struct(
    'station', named_struct('id', if(k % 11 = 0, 1, 898)), 'source_timestamp_timezone', case when k % 13 = 0 then 'CET' when k % 17 = 0 then null else 'UTC' end,
    'endpoint_summary', named_struct(
        'wind', if(k % 19 = 0, null, named_struct('success', k % 7 <> 0, 'last_time_utc', {_minutes("(k * 11) % 180 - 20")}, 'http_requests_succeeded', k % 2 = 0, 'provider_returned_empty_measurement_series', k % 3 = 0)),
        'gust', named_struct('success', true, 'last_time_utc', if(k % 23 = 0, 'late', {_minutes("(k * 17) % 180 - 20")}), 'http_requests_succeeded', true, 'provider_returned_empty_measurement_series', k % 5 = 0)),
    'requests', array(named_struct('kind', 'wind', 'success', k % 4 <> 0), named_struct('kind', 'gust', 'success', k % 6 <> 0), named_struct('kind', 'other', 'success', k % 10 <> 0))))"""


@query("""
    WITH c AS (SELECT c_custkey AS k, (c_custkey * 11) % 180 - 20 AS wind, (c_custkey * 17) % 180 - 20 AS gust FROM customer), good AS (SELECT * FROM c WHERE k % 43 <> 0 AND k % 47 <> 0),
    e AS (SELECT k, wind AS age, k % 19 <> 0 AND k % 7 <> 0 AS works, k % 19 <> 0 AND k % 2 = 0 AND k % 3 = 0 AS empty FROM good UNION ALL SELECT k, gust, k % 23 <> 0, k % 5 = 0 FROM good),
    x AS (
        SELECT k, 'SKM_BUNDLE_FILE_NOT_CREATED' AS code, 'ERROR' AS severity FROM c WHERE k % 43 = 0 UNION ALL SELECT k, 'SKM_BUNDLE_JSON_INVALID', 'ERROR' FROM c WHERE k % 47 = 0 AND k % 43 <> 0
        UNION ALL SELECT k, 'SKM_STATION_ID_MISMATCH', 'ERROR' FROM good WHERE k % 11 = 0 UNION ALL SELECT k, 'SKM_TIMESTAMP_SEMANTICS_NOT_UTC', 'ERROR' FROM good WHERE k % 13 = 0 OR k % 17 = 0
        UNION ALL SELECT k, CASE WHEN empty THEN 'SKM_PROVIDER_SERIES_EMPTY_DESPITE_HTTP_SUCCESS' ELSE 'SKM_REQUIRED_ENDPOINT_UNAVAILABLE' END, 'ERROR' FROM e WHERE NOT works
        UNION ALL SELECT k, 'SKM_OBSERVATION_TIMESTAMP_TOO_FAR_IN_FUTURE', 'ERROR' FROM e WHERE works AND age < -15
        UNION ALL SELECT k, 'SKM_OBSERVATION_OLDER_THAN_DIAGNOSTIC_TARGET', 'WARN' FROM e WHERE works AND age > 120 UNION ALL SELECT k, 'SKM_OBSERVATION_EXCEEDS_FRESH_TARGET', 'WARN' FROM e WHERE works AND age > 30 AND age <= 120
        UNION ALL SELECT k, 'SKM_WIND_GUST_TIMESTAMP_MISALIGNMENT', 'WARN' FROM good WHERE k % 19 <> 0 AND k % 23 <> 0 AND abs(wind - gust) > 20
        UNION ALL SELECT k, 'SKM_HTTP_OR_PARSE_ATTEMPT_FAILED', CASE WHEN k % 19 = 0 OR k % 7 = 0 THEN 'ERROR' ELSE 'WARN' END FROM good WHERE k % 4 = 0
        UNION ALL SELECT k, 'SKM_HTTP_OR_PARSE_ATTEMPT_FAILED', 'WARN' FROM good WHERE k % 6 = 0 UNION ALL SELECT k, 'SKM_HTTP_OR_PARSE_ATTEMPT_FAILED', 'WARN' FROM good WHERE k % 10 = 0)
    SELECT k, code, severity, count(*) AS n FROM x GROUP BY ALL""")
def audit_skm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _codes(stations.audit_skm(_bundles(customers(spark, sf_dir), _SKM_JSON), _now())[0])


def _series_json(provider: str, station: str, step: int) -> str:
    """Five rows ``step`` minutes apart that end at the bundle's age; some bundles have a bad row, a repeated time, or none."""
    row = f"""named_struct('time_utc', case when i = 4 and k % 29 = 0 then replace({_minutes("age")}, '+00:00', '') when i = 2 and k % 13 = 0 then {_minutes(f"age + 3 * {step}")} else {_minutes(f"age + (4 - i) * {step}")} end,
        'wind_speed_ms', if(i = 1 and k % 17 = 0, -0.5, 4.0), 'wind_direction_deg', case when i = 0 and k % 19 = 0 then 361.0 when i = 3 and k % 5 = 0 then null else 250.0 end,
        'wind_direction_variable', i = 3 and k % 5 = 0, 'wind_gust_ms', if(i = 0 and k % 23 = 0, -1.0, null))"""
    return f"""to_json(named_struct('provider', if(k % 11 = 0, 'other', '{provider}'), 'station', named_struct({station}),
        'retrieved_at_utc', case when k % 7 = 0 then '2025-03-14T09:00:00' when k % 9 = 0 then {_minutes("-16")} when k % 10 = 0 then {_minutes("-15")} else {_minutes("0")} end,
        'observations', if(k % 31 = 0, array(), transform(sequence(0, 4), i -> {row})),
        'latest_observation_time_utc', {_minutes("age")}, 'latest_observation', named_struct('time_utc', if(k % 37 = 0, {_minutes("age + 1")}, {_minutes("age")}))))"""


def _series_sql(kind: str, age: str, step: int, variable: bool, fresh: str) -> str:
    return f"""
    WITH c AS (SELECT c_custkey AS k, {age} AS age FROM customer), good AS (SELECT * FROM c WHERE k % 43 <> 0 AND k % 47 <> 0),
    r AS (SELECT k, age, i, CASE WHEN i = 4 AND k % 29 = 0 THEN NULL WHEN i = 2 AND k % 13 = 0 THEN age + 3 * {step} ELSE age + (4 - i) * {step} END AS m,
                 NOT (i = 1 AND k % 17 = 0) AND NOT (i = 0 AND k % 19 = 0) AND NOT (i = 3 AND k % 5 = 0 AND NOT {variable}) AND NOT (i = 0 AND k % 23 = 0 AND {variable}) AS fit FROM good, range(5) s(i) WHERE k % 31 <> 0),
    v AS (SELECT *, fit AND m IS NOT NULL AND m >= -15 AS valid FROM r),
    o AS (SELECT k, i, m, lag(m) OVER (PARTITION BY k ORDER BY i) AS before FROM v WHERE valid),
    a AS (SELECT k, age, count(*) FILTER (NOT valid) AS bad, arg_max(m, i) FILTER (valid) AS last FROM v GROUP BY ALL),
    x AS (
        SELECT k, '{kind}_BUNDLE_MISSING' AS code, 'ERROR' AS severity FROM c WHERE k % 43 = 0 UNION ALL SELECT k, '{kind}_BUNDLE_JSON_INVALID', 'ERROR' FROM c WHERE k % 47 = 0 AND k % 43 <> 0
        UNION ALL SELECT k, '{kind}_SOURCE_IDENTITY_MISMATCH', 'ERROR' FROM good WHERE k % 11 = 0 UNION ALL SELECT k, '{kind}_RETRIEVAL_TIMESTAMP_INVALID', 'ERROR' FROM good WHERE k % 7 = 0
        UNION ALL SELECT k, '{kind}_RETRIEVAL_TIMESTAMP_TOO_FAR_IN_FUTURE', 'ERROR' FROM good WHERE k % 9 = 0 AND k % 7 <> 0
        UNION ALL SELECT k, '{kind}_OBSERVATIONS_MISSING', 'ERROR' FROM good WHERE k % 31 = 0 UNION ALL SELECT k, '{kind}_INVALID_OBSERVATION_ROWS', 'ERROR' FROM a WHERE bad > 0
        UNION ALL SELECT k, '{kind}_TIME_AXIS_INVALID', 'ERROR' FROM o WHERE before <= m GROUP BY k
        UNION ALL SELECT g.k, '{kind}_LATEST_POINTER_MISMATCH', 'ERROR' FROM good g LEFT JOIN a ON g.k = a.k WHERE a.last IS NULL OR a.last <> g.age OR g.k % 37 = 0
        UNION ALL SELECT k, {fresh} FROM good)
    SELECT k, code, severity, count(*) AS n FROM x WHERE code IS NOT NULL GROUP BY ALL"""


@query(_series_sql("WUNSTORF", "(c_custkey * 97) % 3600 - 30", 60, False, "CASE WHEN age > 2880 THEN 'WUNSTORF_ARCHIVE_UNUSUALLY_DELAYED' WHEN age > 180 THEN 'WUNSTORF_ARCHIVE_PROVIDER_LAG' END, CASE WHEN age > 2880 THEN 'WARN' ELSE 'INFO' END"))
def audit_wunstorf(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = customers(spark, sf_dir).withColumn("age", F.expr("(k * 97) % 3600 - 30"))
    text = _series_json("DWD", "'id', '05715'", 60).replace("'wind_direction_variable', i = 3 and k % 5 = 0, ", "").replace(", 'wind_gust_ms', if(i = 0 and k % 23 = 0, -1.0, null)", "")
    return _codes(stations.audit_wunstorf(_aged(rows, text), _now())[0])


@query(_series_sql("ETNW", "(c_custkey * 13) % 500 - 30", 30, True, "CASE WHEN age > 360 THEN 'ETNW_OBSERVATION_TOO_OLD' WHEN age > 120 THEN 'ETNW_OBSERVATION_EXCEEDS_FRESH_TARGET' END, CASE WHEN age > 360 THEN 'ERROR' ELSE 'WARN' END"))
def audit_etnw(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = customers(spark, sf_dir).withColumn("age", F.expr("(k * 13) % 500 - 30"))
    return _codes(stations.audit_etnw(_aged(rows, _series_json("AviationWeather.gov", "'icao', 'ETNW'", 30)), _now())[0])


def _aged(rows: DataFrame, json: str) -> DataFrame:
    text = F.expr(f"CASE WHEN k % 43 = 0 THEN NULL WHEN k % 47 = 0 THEN '[1,' ELSE {json} END")
    return from_text(rows.select("k", text.alias("json")), "k", "json")


RUN = "2025-03-14 06:00:00"
_HOURS = "date_format(timestamp '{run}' + make_interval(0, 0, 0, 0, {h}), \"yyyy-MM-dd'T'HH:mm:ss'+00:00'\")"


def _at(h: str, run: str = RUN) -> str:
    """Spark SQL: the time so many hours after a run."""
    return _HOURS.format(run=run, h=h)


#: Faults of a supplier's bundle of models, by number: the key modulo 34 says which one a bundle has.
_MEMBER = "named_struct('member', m, 'wind_speed_ms', 4.5, 'wind_direction_deg', 200.0, 'gust_ms', if(f = 22 and h = 12 and m = 7, null, 8.0))"
_IDENTITY = f"""named_struct('verification_status', if(f = 23, 'unverified', 'verified_stable_metadata_dwd_cycle_and_spatial_provenance'), 'run_time_utc', {_at("0")},
    'metadata_before', named_struct('last_run_initialisation_time_utc', {_at("0")}), 'metadata_after', named_struct('last_run_initialisation_time_utc', if(f = 24, {_at("6")}, {_at("0")})),
    'settling_age_seconds_at_request', case when f = 25 then 599 when f = 26 and h = 12 then 900 else 800 end, 'expected_member_ids', if(f = 27, sequence(0, 18), sequence(0, 19)), 'dwd_cycle_confirmation_url', 'https://example.net/c')"""
#: One record: fault f, model mo, lead h (an int), and the hours ``late`` by which its run is later.
_RECORD = f"""named_struct(
    'model', if(f = 4 and mo = 'GFS' and h = 24, 'ICON-EU', mo), 'run_time_utc', {_at("late + if(f = 5 and mo = 'GFS' and h = 36, -6, 0)")},
    'forecast_lead_hours', if(f = 3 and mo = 'GFS' and h = 24, 'soon', cast(h as string)), 'valid_time_utc', {_at("late + h + if(f = 5 and mo = 'GFS' and h = 36, -6, 0) + if(f = 9 and mo = 'GFS' and h = 12, 1, 0)")},
    'forecast_coordinate_or_grid_point', named_struct('latitude', case when f = 8 and mo = 'GFS' and h = 12 then 52.75 when f = 28 and mo = 'GFS' and h = 12 then 51.0 else 52.5 end, 'longitude', 9.25),
    'derived', named_struct('wind_speed_ms', if(f = 7 and mo = 'GFS' and h = 12, null, 4.5), 'gust_ms', 8.0, 'ensemble_member_count', 20),
    'error', if(f = 10 and mo = 'GFS' and h = 12, 'timeout', null), 'values', if(f = 11 and mo = 'GFS' and h = 12, named_struct('tcc', named_struct('error', 'absent')), null),
    'members', if(mo = 'ICON-D2-EPS', transform(sequence(0, if(f = 29 and h = 12, 18, 19)), m -> {_MEMBER}), null), 'ensemble_statistics', named_struct('member_count', 20),
    'source_run_identity', if(mo = 'ICON-D2-EPS' and not (f = 30 and h = 12), {_IDENTITY}, null))"""
_LEADS = """case when f = 17 and mo = 'ICON-EU' then array()
    when mo in ('ICON-D2', 'GFS') then concat(filter(array(0, 12, 24, 30, 36, 42, 48), x -> not (f = 1 and mo = 'GFS' and x = 30)), if(f = 2 and mo = 'GFS', array(12), array()), if(f = 6 and mo = 'GFS', array(60), array()))
    else array(0, 12, 24, 36, 48) end"""
_LATE = "case when f = 18 and mo in ('GFS', 'GEFS-control') then -12 when f = 19 and mo = 'ICON-D2' then 6 when f = 32 and mo in ('ECMWF-IFS', 'GFS', 'GEFS-control') then -24 when f = 100 and mo = 'GEFS-control' then -18 else 0 end"
_ATTEMPTS = "case when f = 15 then array(named_struct('model', 'GFS', 'stage', 'base', 'status', 'failed'), named_struct('model', 'GFS', 'stage', 'base', 'status', 'success')) when f = 16 then array(named_struct('model', 'GFS', 'stage', 'base', 'status', 'success'), named_struct('model', 'GFS', 'stage', 'far', 'status', 'failed')) else array() end"


def _model_bundles(spark: SparkSession, sf_dir: str, mode: str, fault: str, more: str = "") -> DataFrame:
    """One bundle a supplier, with its fault."""
    rows = spread(table(spark, sf_dir, "supplier").select("s_suppkey"), "s_suppkey").select(F.col("s_suppkey").alias("k"), F.expr(f"cast({fault} as int)").alias("f"))
    leads = _LEADS if mode == "test" else "filter(concat(sequence(0, 72, 3), sequence(78, 120, 6)), x -> x <= case when mo in ('ICON-D2', 'ICON-D2-EPS') then 48 when mo = 'ECMWF-IFS' then 90 else 120 end)"
    names = "array('ICON-D2', 'ICON-D2-EPS', 'ICON-EU', 'ECMWF-IFS', 'GFS', 'GEFS-control')"
    listed = f"transform({names}, mo -> transform({leads}, h -> {_RECORD.replace('late', '(' + _LATE + ')')}))"
    held = rows.select("k", "f", F.expr(f"map_from_arrays({names}, {listed})").alias("models"))
    retrieved = f"case when f = 13 then 'noon' when f = 14 then {_minutes('-16')} else {_minutes('0')} end"
    text = F.expr(f"""CASE f WHEN 21 THEN NULL WHEN 20 THEN '{{"models"' ELSE to_json(named_struct('mode', '{mode}', 'schema_version', 1, 'retrieved_at_utc', {retrieved},
        'spot', named_struct('lat', if(f = 12, 52.6, 52.4942), 'lon', 9.3418), 'quality', named_struct('errors', if(f = 31, array('GFS: decode'), array())), 'provider_attempts', {_ATTEMPTS}, 'models', models{more})) END""")
    return _kept(from_text(held.select("k", text.alias("json")), "k", "json"))


@query("""
    WITH s AS (SELECT s_suppkey AS k, s_suppkey % 34 AS f FROM supplier),
    e(f, code, severity) AS (VALUES
        (1, 'EXPECTED_PROVIDER_LEADS_NOT_RECEIVED', 'ERROR'), (2, 'DUPLICATE_FORECAST_LEADS', 'ERROR'), (3, 'FORECAST_LEAD_VALUE_INVALID', 'ERROR'), (3, 'EXPECTED_PROVIDER_LEADS_NOT_RECEIVED', 'ERROR'),
        (4, 'MODEL_RECORD_IDENTITY_MISMATCH', 'ERROR'), (5, 'MULTIPLE_MODEL_RUNS_IN_ONE_SOURCE_BUNDLE', 'ERROR'), (6, 'RECORDS_OUTSIDE_SELECTED_PROVIDER_CYCLE_HORIZON', 'INFO'),
        (7, 'REQUIRED_DERIVED_FIELDS_UNAVAILABLE', 'ERROR'), (8, 'MODEL_FORECAST_GRID_IDENTITY_INVALID', 'ERROR'), (28, 'MODEL_FORECAST_GRID_IDENTITY_INVALID', 'ERROR'), (9, 'FORECAST_TIMESTAMP_OR_LEAD_INCONSISTENCY', 'ERROR'),
        (10, 'SOURCE_FETCH_OR_DECODE_ERRORS_RECORDED', 'ERROR'), (31, 'SOURCE_FETCH_OR_DECODE_ERRORS_RECORDED', 'ERROR'), (11, 'OPTIONAL_WEATHER_CONTEXT_FIELDS_UNAVAILABLE', 'WARN'), (12, 'MODEL_SPOT_IDENTITY_MISMATCH', 'ERROR'),
        (13, 'RETRIEVAL_TIMESTAMP_INVALID', 'ERROR'), (14, 'RETRIEVAL_TIMESTAMP_IN_FUTURE', 'ERROR'), (15, 'PROVIDER_RETRY_RECOVERED', 'WARN'), (16, 'PROVIDER_STAGE_ATTEMPTS_FAILED', 'ERROR'),
        (17, 'MODEL_RUN_TIME_NOT_PRESENT', 'ERROR'), (17, 'EXPECTED_PROVIDER_LEADS_NOT_RECEIVED', 'ERROR'), (18, 'MODEL_RUN_OLDER_THAN_CURRENTNESS_POLICY', 'ERROR'), (18, 'MODEL_RUN_OLDER_THAN_CURRENTNESS_POLICY', 'ERROR'),
        (19, 'MODEL_RUN_TIME_IMPLAUSIBLY_FUTURE', 'ERROR'), (20, 'MODEL_BUNDLE_JSON_INVALID', 'ERROR'), (21, 'MODEL_BUNDLE_FILE_NOT_CREATED', 'ERROR'),
        (22, 'ENSEMBLE_MEMBER_SET_INCOMPLETE', 'ERROR'), (29, 'ENSEMBLE_MEMBER_SET_INCOMPLETE', 'ERROR'), (23, 'ENSEMBLE_RUN_IDENTITY_UNVERIFIED', 'ERROR'), (24, 'ENSEMBLE_RUN_IDENTITY_UNVERIFIED', 'ERROR'), (25, 'ENSEMBLE_RUN_IDENTITY_UNVERIFIED', 'ERROR'),
        (26, 'ENSEMBLE_RUN_IDENTITY_UNVERIFIED', 'ERROR'), (27, 'ENSEMBLE_RUN_IDENTITY_UNVERIFIED', 'ERROR'), (30, 'ENSEMBLE_RUN_IDENTITY_UNVERIFIED', 'ERROR'),
        (32, 'MODEL_RUN_OLDER_THAN_CURRENTNESS_POLICY', 'ERROR'), (32, 'MODEL_RUN_OLDER_THAN_CURRENTNESS_POLICY', 'ERROR'), (32, 'MODEL_RUN_OLDER_THAN_CURRENTNESS_POLICY', 'ERROR'), (32, 'FEWER_THAN_TWO_COMPLETE_CURRENT_INDEPENDENT_MODEL_FAMILIES', 'ERROR'))
    SELECT k, code, severity, count(*) AS n FROM s JOIN e USING (f) GROUP BY ALL""")
def audit_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _codes(models.audit(_model_bundles(spark, sf_dir, "test", "s_suppkey % 34"), _now(), keep=_kept)[0])


def _attempt(hours: int, status: str, lead: int) -> str:
    return f"named_struct('cycle_run_time_utc', {_at(str(hours))}, 'status', {status}, 'publication_probe_lead', {lead}, 'expected_max_lead_for_cycle', {lead})"


#: What is said of the choice of an old cycle, 18 hours before the run; the key modulo 12 says what is wrong with it (0, 11: nothing, 10: the cycle isn't old).
_EVIDENCE = f"""if(k % 12 = 1, null, named_struct('GEFS-control', named_struct(
    'method_version', if(k % 12 = 2, 'other', 'gefs-newest-mature-cycle-selection-v1'), 'full_horizon_publication_required', k % 12 <> 3, 'selected_cycle_run_time_utc', if(k % 12 = 4, {_at("-12")}, {_at("-18")}),
    'selected_expected_max_lead_hours', 384, 'selected_publication_probe_lead', if(k % 12 = 5, 120, 384),
    'attempts', filter(array(if(k % 12 = 11, {_attempt(-18, "'not_published'", 384)}, null), {_attempt(-18, "if(k % 12 = 6, 'not_published', 'published')", 384)}, {_attempt(-12, "'not_published'", 384)},
                             if(k % 12 = 7, null, {_attempt(-6, "'not_published'", 840)}), {_attempt(0, "if(k % 12 = 9, 'published', 'not_published')", 384)}, if(k % 12 = 8, {_attempt(0, "'not_published'", 120)}, null)), x -> x is not null))))"""


@query("""
    WITH s AS (SELECT s_suppkey AS k, s_suppkey % 12 AS g FROM supplier),
    x AS (
        SELECT k, 'PROJECT_LONG_RANGE_LEADS_NOT_PROVIDED_BY_SELECTED_CYCLE' AS code, 'INFO' AS severity FROM s UNION ALL SELECT k, 'ENSEMBLE_HOURLY_SOURCE_INVALID_FOR_V15', 'ERROR' FROM s
        UNION ALL SELECT k, 'GEFS_NEWEST_MATURE_CYCLE_EXCEEDS_NOMINAL_CURRENTNESS', 'WARN' FROM s WHERE g IN (0, 11) UNION ALL SELECT k, 'MODEL_RUN_OLDER_THAN_CURRENTNESS_POLICY', 'ERROR' FROM s WHERE g BETWEEN 1 AND 9)
    SELECT k, code, severity, count(*) AS n FROM x GROUP BY ALL""")
def audit_models_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Production bundles under full validation: an old cycle is excused only where it's proven the newest mature one."""
    bundles = _model_bundles(spark, sf_dir, "production", "if(s_suppkey % 12 = 10, 101, 100)", f", 'provider_selection_evidence', {_EVIDENCE}")
    return _codes(models.audit(bundles, _now(), full_validation=True, keep=_kept)[0])


@query("""
    WITH s AS (SELECT s_suppkey AS k, s_suppkey % 12 AS g FROM supplier)
    SELECT k, CASE WHEN g = 10 THEN 'ignored' WHEN g IN (0, 11) THEN 'excused' ELSE 'refused' END AS outcome FROM s""")
def mature_exception(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same evidence outside full validation proves nothing; nor does any where no newer cycle is due."""
    rows = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("k")).withColumn("e", F.try_parse_json(F.expr(f"to_json({_EVIDENCE})")))
    run = F.lit("2025-03-13T12:00:00Z").cast("timestamp")
    evidence = F.try_variant_get("e", "$.GEFS-control", "variant")
    full, never, early = (models.mature_exception(evidence, run, now, F.lit(flag)) for now, flag in ((_now(), True), (_now(), False), (F.lit("2025-03-13T17:59:00Z").cast("timestamp"), True)))
    g = F.col("k") % 12
    word = F.when(never.isNull() | early.isNull(), "wrong").when(g == 10, "ignored").when(full.isNull(), "excused").otherwise("refused")
    return rows.select("k", word.alias("outcome"))


_ARCHIVE_RUN = "2025-03-14 12:00:00"
_ARCHIVED = f"""named_struct('model', mo, 'run_time_utc', {_at("0", _ARCHIVE_RUN)}, 'forecast_lead_hours', h, 'valid_time_utc', {_at("h + if(f = 4 and mo = 'GFS' and h = 180, 1, 0)", _ARCHIVE_RUN)}, 'retrieved_at_utc', {_at("if(f = 13 and mo = 'GFS' and h = 180, -1, 6)", _ARCHIVE_RUN)},
    'provider_product', 'p', 'forecast_coordinate_or_grid_point', named_struct('latitude', if(f = 9 and mo = 'GFS' and h = 180, 51.5, 52.5), 'longitude', 9.5),
    'derived', named_struct('wind_speed_ms', if(f = 10 and mo = 'GFS' and h = 180, -1.0, 6.0), 'gust_ms', if(f in (2, 3) and mo = 'GEFS-control' and h = 264, null, 9.0)),
    'field_availability', if(f = 2 and mo = 'GEFS-control' and h = 264, named_struct('gust', false), null))"""
_SOURCE = f"""named_struct('run_time_utc', {_at("0", _ARCHIVE_RUN)}, 'target_max_hours', if(f = 11 and mo = 'GFS', 240, most), 'actual_max_lead', if(f = 14 and mo = 'GFS', 7, null),
    'lead_status', case when f = 7 and mo = 'GFS' then map('180', named_struct('status', 'odd')) when f = 8 and mo = 'GFS' then map('180', named_struct('status', 'fetch_error')) else map() end,
    'records', concat(transform(filter(ext, h -> not (f = 1 and mo = 'GFS' and h = 180)), h -> {_ARCHIVED}), if(f = 15 and mo = 'GFS', transform(array(180), h -> {_ARCHIVED}), array())))"""


def _archive_bundles(spark: SparkSession, sf_dir: str) -> DataFrame:
    from gustloom.operators import leads as L

    rows = spread(table(spark, sf_dir, "supplier").select("s_suppkey"), "s_suppkey").select(F.col("s_suppkey").alias("k"), F.expr("cast(s_suppkey % 17 as int)").alias("f"))
    hour = F.lit(12)
    leads = lambda mo: F.struct(mo.alias("mo"), L.extension(mo, hour).alias("ext"), F.filter(L.grid(mo, hour), lambda x: x <= L.compatibility_max(mo, hour)).alias("core"), L.native_max(mo, hour).alias("most"))
    grids = rows.withColumn("grids", F.transform(F.lit(list(L.MODELS)), leads))
    of = lambda text: re.sub(r"\b(mo|ext|core|most)\b", r"g.\1", text)
    pairs = lambda body, which="grids": F.expr(f"map_from_entries(transform({which}, g -> struct(g.mo, {of(body)})))")
    made = grids.select("k", "f", pairs(f"transform(core, h -> {_ARCHIVED})").alias("models"), pairs(_SOURCE, "filter(grids, g -> not (f = 6 and g.mo = 'GFS'))").alias("sources"))
    archive = "if(f = 12, null, named_struct('method_version', if(f = 5, 'v0', 'full-horizon-archive-v1'), 'sources', sources))"
    return _kept(from_text(made.select("k", F.expr(f"to_json(named_struct('models', models, 'full_horizon_archive', {archive}))").alias("json")), "k", "json"))


@query("""
    WITH s AS (SELECT s_suppkey AS k, s_suppkey % 17 AS f FROM supplier),
    e(f, code, severity, reason) AS (VALUES
        (1, 'FULL_HORIZON_REQUIRED_COVERAGE_INCOMPLETE', 'ERROR', NULL), (2, 'FULL_HORIZON_ARCHIVE_PARTIAL', 'WARN', NULL), (3, 'FULL_HORIZON_ARCHIVE_INVALID', 'ERROR', 'gust missing without explicit provider-unavailable marker'),
        (4, 'FULL_HORIZON_ARCHIVE_INVALID', 'ERROR', 'archive validity mismatch'), (5, 'FULL_HORIZON_ARCHIVE_INVALID', 'ERROR', 'unknown full-horizon archive version'), (6, 'FULL_HORIZON_ARCHIVE_INVALID', 'ERROR', 'full-horizon source inventory mismatch'),
        (7, 'FULL_HORIZON_ARCHIVE_INVALID', 'ERROR', 'invalid retrieval status'), (8, 'FULL_HORIZON_ARCHIVE_INVALID', 'ERROR', 'received lead is not marked published'), (9, 'FULL_HORIZON_ARCHIVE_INVALID', 'ERROR', 'wrong extraction location'),
        (10, 'FULL_HORIZON_ARCHIVE_INVALID', 'ERROR', 'invalid wind_speed_ms'), (11, 'FULL_HORIZON_ARCHIVE_INVALID', 'ERROR', 'archive parent/target mismatch'), (13, 'FULL_HORIZON_ARCHIVE_INVALID', 'ERROR', 'retrieval precedes run'),
        (14, 'FULL_HORIZON_ARCHIVE_INVALID', 'ERROR', 'archive actual-max mismatch'), (15, 'FULL_HORIZON_ARCHIVE_INVALID', 'ERROR', 'duplicate/unexpected archive lead'))
    SELECT k, code, severity, reason FROM s JOIN e USING (f)""")
def audit_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    coverage, rejects = archive.validate(_archive_bundles(spark, sf_dir))
    found = archive.coverage_issues(coverage, rejects, full_validation=True)
    return found.select(F.col("path").cast("long").alias("k"), "code", "severity", F.get_json_object("details", "$.reason").alias("reason"))


@query("""
    WITH s AS (SELECT s_suppkey AS k, s_suppkey % 17 AS f FROM supplier), m(model, most, received) AS (VALUES ('ICON-D2', 48, 0), ('ICON-D2-EPS', 48, 0), ('ICON-EU', 48, 0), ('ECMWF-IFS', 360, 15), ('GFS', 384, 16), ('GEFS-control', 384, 16))
    SELECT k, model, CASE WHEN f = 1 AND model = 'GFS' THEN 'partial' WHEN f = 2 AND model = 'GEFS-control' THEN 'partial_optional_fields' ELSE 'complete' END AS status, (f = 1 AND model = 'GFS')::INT AS missing,
           (received - (f = 1 AND model = 'GFS')::INT)::INT AS received, CASE WHEN model = 'ICON-EU' THEN 120 ELSE most END::INT AS actual_max FROM s, m WHERE f IN (0, 1, 2, 16)""")
def archive_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    coverage, _ = archive.validate(_archive_bundles(spark, sf_dir))
    return coverage.select(F.col("path").cast("long").alias("k"), "model", "status", F.size("missing_leads").alias("missing"), F.size("received_extension_leads").alias("received"), F.col("actual_max_lead").alias("actual_max"))
