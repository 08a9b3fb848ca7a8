"""Queries of the sources: payloads, listings and tool outputs made of the driver's tables, read by the engine, beside their DuckDB form."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gustloom.functions import columns as C
from gustloom.operators import ensemble, leads, records
from gustloom.plans.catalog import query, table
from gustloom.rules import availability
from gustloom.sources import bundles, grib_text, requests, stations

_NOW = "2024-02-01 00:00:00"


def _payloads(rows: DataFrame, key: str, json: Column) -> DataFrame:
    return bundles.from_text(rows.select(F.col(key).alias("k"), json.alias("json")), "k", "json")


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("k"), F.col("l_linenumber").alias("n"), "l_quantity", "l_discount", "l_tax", "l_returnflag", "l_linestatus", F.unix_timestamp("l_shipdate").alias("ts"))


def _listed(rows: DataFrame, item: Column) -> DataFrame:
    """(k, items): each order's items in line order."""
    return rows.groupBy("k").agg(F.array_sort(F.collect_list(F.struct("n", "ts", item.alias("x")))).alias("i")).select("k", F.transform("i", lambda i: i["x"]).alias("items"))


def _sensor(rows: DataFrame, structure: int, item: Column) -> DataFrame:
    """Payloads whose second sensor is the wanted one."""
    held = _listed(rows, item)
    sensor = lambda kind, data: F.struct(F.lit(48).alias("sensor_type"), F.lit(kind).alias("data_structure_type"), data.alias("data"))
    return _payloads(held, "k", F.to_json(F.struct(F.array(sensor(9, F.slice("items", 1, 1)), sensor(structure, F.col("items")), sensor(structure, F.slice("items", 1, 1))).alias("sensors"))))


@query("""
    WITH l AS (SELECT l_orderkey AS k, epoch(l_shipdate)::BIGINT AS ts, l_linenumber AS n, l_quantity AS q FROM lineitem WHERE l_linenumber <= 7),
    one AS (SELECT * FROM l QUALIFY row_number() OVER (PARTITION BY k, n ORDER BY ts, q) = 1)
    SELECT k, max(ts)::BIGINT AS ts, arg_max(n, ts * 10 + n)::DOUBLE AS direction, round(arg_max(q, ts * 10 + n) * 0.44704, 4) AS speed, round(arg_max(q + 1, ts * 10 + n) * 0.44704, 4) AS instant, round(arg_max(q + 2, ts * 10 + n) * 0.44704, 4) AS gust FROM one GROUP BY 1
    HAVING count(*) = count(DISTINCT ts)""")
def sensor_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest row of an order's lines as sensor rows; of repeated lines one, and only orders whose lines have different times."""
    from gustloom.operators.timeline import first_wins

    rows = first_wins(bundles.spread(_lines(spark, sf_dir).where("n <= 7"), "k"), ["k", "n"], ["ts", "l_quantity"])
    apart = rows.groupBy("k").agg((F.count(F.lit(1)) == F.size(F.collect_set("ts"))).alias("ok")).where("ok")
    item = F.struct("ts", F.col("n").alias("wind_dir"), F.col("l_quantity").alias("wind_speed_10_min_avg"), (F.col("l_quantity") + 1).alias("wind_speed"), (F.col("l_quantity") + 2).alias("wind_gust_10_min"))
    found = stations.current_observation(_sensor(rows.join(apart, "k", "left_semi"), stations.CURRENT, item))
    return found.select(F.col("path").alias("k"), F.unix_timestamp("time").alias("ts"), F.col("wind_direction_deg").alias("direction"), F.col("wind_speed_ms").alias("speed"), F.col("wind_speed_instant_ms").alias("instant"), F.col("wind_gust_ms").alias("gust"))


@query("""
    SELECT l_orderkey AS k, epoch(l_shipdate)::BIGINT AS ts, round(l_quantity * 0.44704, 4) AS speed, round(round(l_tax * 100) * 0.44704, 4) AS gust, l_linenumber * 22.5 AS direction, CASE WHEN l_linenumber * 3 <= 15 THEN l_linenumber * 3 * 22.5 END AS gust_direction,
           CASE WHEN l_returnflag = 'R' THEN NULL ELSE l_linenumber + 100 END::INT AS samples FROM lineitem""")
def sensor_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    item = F.struct("ts", F.col("l_quantity").alias("wind_speed_avg"), F.round(F.col("l_tax") * 100).alias("wind_speed_hi"), F.col("n").alias("wind_dir_of_prevail"), (F.col("n") * 3).alias("wind_dir_of_hi"), F.when(F.col("l_returnflag") != "R", F.col("n") + 100).alias("wind_num_samples"))
    found = stations.historic_observations(_sensor(bundles.spread(_lines(spark, sf_dir), "k"), stations.HISTORIC, item))
    return found.select(F.col("path").alias("k"), F.unix_timestamp("time").alias("ts"), F.col("wind_speed_ms").alias("speed"), F.col("wind_gust_ms").alias("gust"), F.col("wind_direction_deg").alias("direction"), F.col("wind_gust_direction_deg").alias("gust_direction"), F.col("wind_samples").alias("samples"))


@query(f"""
    WITH p AS (SELECT user_id, ts, value FROM events WHERE event_type <> 'view')
    SELECT user_id, count(*) FILTER (date_trunc('second', ts) <= TIMESTAMP '{_NOW}' + INTERVAL 15 MINUTES) AS n, count(*) FILTER (date_trunc('second', ts) > TIMESTAMP '{_NOW}' + INTERVAL 15 MINUTES) AS future_count FROM p WHERE value IS NOT NULL GROUP BY 1""")
def chart_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points of a chart from each user's events; a view's time isn't readable."""
    e = table(spark, sf_dir, "events")
    x = F.when(F.col("event_type") == "view", "later").otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
    held = e.groupBy("user_id").agg(F.collect_list(F.struct(x.alias("x"), F.col("value").alias("y"))).alias("d"))
    p = _payloads(held, "user_id", F.to_json(F.struct(F.struct(F.col("d").alias("data")).alias("data"))))
    found = stations.chart_summary(stations.chart_series(p, F.lit(_NOW).cast("timestamp")), ["path"])
    return found.select(F.col("path").alias("user_id"), "n", "future_count")


_METAR = f"""
    r AS (SELECT user_id AS k, epoch_us(ts) // 60000000 * 60 AS t, event_id, event_type, value, event_id % 11 = 0 AS other, event_id % 13 = 0 AS untimed, epoch_us(ts) // 60000000 * 60 > epoch(TIMESTAMP '{_NOW}') + 900 AS future FROM events),
    kept AS (SELECT k, t, max(event_id) AS event_id FROM r WHERE NOT other AND NOT untimed AND NOT future GROUP BY ALL)"""


def _metar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reports of a station from each user's events, in id order; some of another station, some without a time."""
    e = table(spark, sf_dir, "events")
    report = F.struct(
        F.when(F.col("event_id") % 11 == 0, "XXXX").otherwise("ETNW").alias("icaoId"), F.when(F.col("event_id") % 13 != 0, F.unix_timestamp(F.date_trunc("minute", "ts"))).alias("obsTime"), F.when(F.col("event_type") != "error", F.floor("value")).alias("wspd"),
        F.when(F.col("event_type") == "view", "VRB").when(F.col("event_type") != "click", F.floor(F.col("value") * 3).cast("string")).alias("wdir"), F.when(F.col("event_type") == "click", "ETNW VRB02KT").otherwise("ETNW").alias("rawOb"),
    )
    held = e.groupBy("user_id").agg(F.array_sort(F.collect_list(F.struct("event_id", report.alias("r")))).alias("d"))
    p = _payloads(held, "user_id", F.to_json(F.transform("d", lambda x: x["r"])))
    return stations.metar_reports(p, "ETNW", F.lit(_NOW).cast("timestamp"))


@query(f"""
    WITH {_METAR}
    SELECT kept.k, kept.t, CASE WHEN event_type <> 'error' THEN round(floor(value) * 0.514444, 2) END AS speed, event_type IN ('view', 'click') AS variable, CASE WHEN event_type NOT IN ('view', 'click') THEN floor(value * 3) END::DOUBLE AS direction
    FROM kept JOIN r USING (event_id)""")
def metar_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = stations.metar_latest(_metar(spark, sf_dir))
    return found.select(F.col("path").alias("k"), F.unix_timestamp("time").alias("t"), F.round("wind_speed_ms", 2).alias("speed"), F.col("wind_direction_variable").alias("variable"), F.col("wind_direction_deg").alias("direction"))


@query(f"""
    WITH {_METAR},
    j AS (SELECT kept.*, event_type, kept.t - lag(kept.t) OVER (PARTITION BY kept.k ORDER BY kept.t) AS gap FROM kept JOIN r USING (event_id)),
    a AS (SELECT k, count(*) AS records, round_even(100.0 * count(*) FILTER (event_type <> 'error') / count(*), 1) AS speed_pct, max(gap) AS gap, max(t) AS latest FROM j GROUP BY 1),
    b AS (SELECT k, count(*) AS source_rows, count(*) FILTER (other OR untimed) AS rejected_rows, count(*) FILTER (future AND NOT other AND NOT untimed) AS future_rows FROM r GROUP BY 1)
    SELECT b.*, coalesce(records, 0) AS records, abs(coalesce(speed_pct, 0)) AS speed_pct, 100.0::DOUBLE AS direction_pct, round(gap / 60.0, 1)::DOUBLE AS max_gap_minutes,
           CASE WHEN latest IS NULL THEN NULL WHEN (epoch(TIMESTAMP '{_NOW}') - latest) / 60 <= 120 THEN 'fresh' WHEN (epoch(TIMESTAMP '{_NOW}') - latest) / 60 <= 360 THEN 'delayed' ELSE 'stale' END AS availability
    FROM b LEFT JOIN a USING (k) WHERE records IS NOT NULL""")
def metar_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = stations.metar_quality(_metar(spark, sf_dir), F.lit(_NOW).cast("timestamp")).where("records > 0")
    return q.select(
        F.col("path").alias("k"), "source_rows", "rejected_rows", "future_rows", "records", F.col("wind_speed_availability_pct").alias("speed_pct"), F.col("direction_or_variable_availability_pct").alias("direction_pct"), "max_gap_minutes", "availability",
    )


_HOSTS = "https://data.example.org/a/b/list.html?C=M"


@query("""
    WITH h(i, link, want) AS (VALUES (0, 'f.bz2', 'https://data.example.org/a/b/f.bz2'), (1, '../up/f', 'https://data.example.org/a/up/f'), (2, '/top/x?y=1', 'https://data.example.org/top/x?y=1'), (3, 'http://o.example/z', 'http://o.example/z'),
        (4, './here/', 'https://data.example.org/a/b/here/'), (5, '//cdn.example/c', 'https://cdn.example/c'), (6, '?C=N', 'https://data.example.org/a/b/list.html?C=N'), (7, '../../../r', 'https://data.example.org/r'), (8, 'a/../b/./c', 'https://data.example.org/a/b/b/c'), (9, '..', 'https://data.example.org/a/'))
    SELECT n_nationkey, i, want AS url FROM nation, h""")
def links_resolved(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A directory page's links against the page's address."""
    links = ("f.bz2", "../up/f", "/top/x?y=1", "http://o.example/z", "./here/", "//cdn.example/c", "?C=N", "../../../r", "a/../b/./c", "..")
    page = F.concat(*(F.lit(f"<a href='{x}'>x</a>") for x in links))
    found = table(spark, sf_dir, "nation").select("n_nationkey", F.posexplode(stations.hrefs(page, F.lit(_HOSTS))).alias("i", "url"))
    return found.select("n_nationkey", "i", "url")


@query("""
    WITH l AS (SELECT DISTINCT ON (l_orderkey, l_linenumber) l_orderkey AS k, l_linenumber AS n, l_quantity AS q, l_orderkey % 90 AS lat FROM lineitem ORDER BY l_orderkey, l_linenumber, l_quantity)
    SELECT k, (row_number() OVER (PARTITION BY k ORDER BY n) - 1)::INT AS pos, 'v' || n AS short_name, (n * 3)::VARCHAR AS step_range, q AS value, (lat + 0.5)::DOUBLE AS latitude, 9.25 AS longitude FROM l WHERE k % 5 <> 0""")
def grib_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A tool's output: heads, values, and the point in a line of its own; some outputs have no point."""
    lines = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("k"), F.col("l_linenumber").alias("n")).agg(F.min("l_quantity").alias("q"))
    value = lines.select("k", (F.col("n") + 10).alias("pos"), F.concat(F.lit("v"), "n", F.lit("  "), (F.col("n") * 3).cast("string"), F.lit(" 20250314  surface "), F.col("q").cast("string"), F.lit(" ")).alias("line"))
    point = F.concat(F.lit("Grid Point chosen #1 index=17 latitude="), (F.col("k") % 90 + 0.5).cast("string"), F.lit(" longitude=9.25 distance=3.1 (Km)"))
    fixed = F.array(F.struct(F.lit(0), F.lit("edition 2 of file.grib2")), F.struct(F.lit(1), F.lit("shortName stepRange dataDate typeOfLevel value")), F.struct(F.lit(90), F.lit("3 of 3 messages in file.grib2")), F.struct(F.lit(91), F.lit("Input Point: latitude=52.49  longitude=9.34")), F.struct(F.lit(92), F.when(F.col("k") % 5 != 0, point).otherwise("Grid Point none")), F.struct(F.lit(93), F.lit("- 1 index=18 latitude=1.5 longitude=9.50 distance=7.0 (Km)")))
    rest = lines.select("k").distinct().select("k", F.explode(fixed).alias("x")).select("k", "x.*").toDF("k", "pos", "line")
    return grib_text.nearest(value.unionByName(rest), ["k"])


@query("""
    SELECT l_orderkey AS k, l_linenumber AS n, l_linenumber * 3.0::DOUBLE AS step_end, CASE WHEN l_returnflag = 'R' THEN 'incomplete_identity_row' WHEN l_linestatus = 'O' THEN 'validity_time_unreadable' END AS reject, count(*) AS rows FROM lineitem GROUP BY ALL""")
def grib_identities(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _lines(spark, sf_dir)
    start = F.concat(F.lit(" 10u 20250314  600 0-"), (F.col("n") * 3).cast("string"), F.lit(" 20250314"))
    text = F.when(F.col("l_returnflag") == "R", start).when(F.col("l_linestatus") == "O", F.concat(start, F.lit(" noon"))).otherwise(F.concat(start, F.lit(" 900 ")))
    found = grib_text.identities(lines.select("k", "n", text.alias("line")))
    return found.groupBy("k", "n", "step_end", "reject").agg(F.count(F.lit(1)).alias("rows"))


@query("""
    WITH l AS (SELECT DISTINCT l_orderkey AS k, l_linenumber AS n, l_returnflag AS g FROM lineitem),
    f AS (SELECT k, CASE WHEN g = 'R' THEN 'run_time_mismatch' WHEN g = 'A' THEN 'step_validity_disagreement' WHEN n > 5 THEN 'unexpected_lead' END AS reason FROM l
          UNION ALL SELECT k, 'unexpected_lead' FROM l WHERE g = 'A' AND n > 5
          UNION ALL SELECT o.k, 'expected_leads_missing_from_grib_batch' FROM (SELECT DISTINCT k FROM l) o, range(1, 6) r(n) WHERE NOT EXISTS (SELECT 1 FROM l WHERE l.k = o.k AND l.n = r.n AND l.g <> 'R'))
    SELECT k, reason, count(*) AS n FROM f WHERE reason IS NOT NULL GROUP BY ALL""")
def grib_batch_leads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages of leads 3, 6, ... of a file: returned lines are of another run, accepted ones have another step."""
    run = F.lit("2025-03-14 06:00:00").cast("timestamp")
    late = F.when(F.col("l_returnflag") == "R", 6).otherwise(0)
    lines = _lines(spark, sf_dir).select("k", "n", "l_returnflag").distinct()
    m = lines.select("k", F.lit("10u").alias("short_name"), (run + F.make_dt_interval(hours=late)).alias("run"), (run + F.make_dt_interval(hours=F.col("n").cast("int") * 3)).alias("valid"), (F.col("n") * 3 + F.when(F.col("l_returnflag") == "A", 1).otherwise(0)).cast("double").alias("step_end"))
    found = grib_text.batch_leads(m, ["k"], run, F.lit([3, 6, 9, 12, 15]))
    return found.select("k", F.explode("failures").alias("x")).groupBy("k", F.col("x.reason").alias("reason")).agg(F.count(F.lit(1)).alias("n"))


_PRODUCT_SQL = """
    p(product, file, dir, pad, form, flags) AS (VALUES
        ('gfs_0p25', 'gfs.t%02dz.pgrb2.0p25.f%03d', '/gfs.%s/%02d/atmos', 0.3, '%.3f', 'var_UGRD var_VGRD var_GUST var_APCP var_TMP var_DPT var_RH var_PRMSL var_PRES var_TCDC var_CAPE var_CIN var_DSWRF lev_10_m_above_ground lev_surface lev_2_m_above_ground lev_mean_sea_level lev_entire_atmosphere lev_180-0_mb_above_ground lev_90-0_mb_above_ground lev_255-0_mb_above_ground'),
        ('gefs_0p25s', 'gec00.t%02dz.pgrb2s.0p25.f%03d', '/gefs.%s/%02d/atmos/pgrb2sp25', 0.3, '%.3f', 'var_UGRD var_VGRD var_GUST var_APCP var_TMP var_DPT var_RH var_PRMSL var_PRES var_TCDC var_CAPE var_CIN var_DSWRF lev_10_m_above_ground lev_surface lev_2_m_above_ground lev_mean_sea_level lev_entire_atmosphere lev_180-0_mb_above_ground'),
        ('gefs_0p50a', 'gec00.t%02dz.pgrb2a.0p50.f%03d', '/gefs.%s/%02d/atmos/pgrb2ap5', 0.75, '%.4f', 'var_UGRD var_VGRD var_TMP var_RH var_PRMSL var_PRES var_TCDC var_CAPE var_CIN var_DSWRF lev_10_m_above_ground lev_2_m_above_ground lev_mean_sea_level lev_surface lev_entire_atmosphere lev_180-0_mb_above_ground'),
        ('gefs_0p50b', 'gec00.t%02dz.pgrb2b.0p50.f%03d', '/gefs.%s/%02d/atmos/pgrb2bp5', 0.75, '%.4f', 'var_DPT var_CAPE var_CIN lev_2_m_above_ground lev_surface lev_255-0_mb_above_ground'))"""


@query(f"""
    WITH {_PRODUCT_SQL}, c AS (SELECT o_orderkey AS k, o_orderdate AS run, (o_orderkey % 241)::INT AS lead FROM orders)
    SELECT k, product, 'file=' || printf(file, hour(run)::INT, lead) || '&' || replace(flags, ' ', '=on&') || '=on&subregion=&leftlon=' || printf(form, (9.3418 - pad)::DOUBLE) || '&rightlon=' || printf(form, (9.3418 + pad)::DOUBLE)
           || '&toplat=' || printf(form, (52.4942 + pad)::DOUBLE) || '&bottomlat=' || printf(form, (52.4942 - pad)::DOUBLE) || '&dir=' || replace(printf(dir, strftime(run, '%Y%m%d'), hour(run)::INT), '/', '%2F') AS query FROM c, p""")
def request_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"), F.lit("GFS").alias("model"), F.col("o_orderdate").cast("timestamp").alias("run"), (F.col("o_orderkey") % 241).cast("int").alias("lead"))
    planned = requests.plan(o.withColumn("model", F.col("k").cast("string")), {"gfs_0p25": 0.3, "gefs_0p25s": 0.3, "gefs_0p50a": 0.75, "gefs_0p50b": 0.75})
    return planned.select(F.col("model").cast("long").alias("k"), "product", "query")


@query("""
    SELECT o_orderkey AS k, CASE WHEN o_orderkey % 5 = 0 THEN 'probe_without_run_time' WHEN o_orderkey % 7 = 0 THEN 'probe_returned_another_cycle' END AS reject FROM orders""")
def probe_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, at = F.col("o_orderkey"), F.col("o_orderdate")
    got = F.when(k % 5 == 0, None).when(k % 7 == 0, at + F.expr("interval 6 hours")).otherwise(at)
    return requests.wrong_cycle(table(spark, sf_dir, "orders").select(k.alias("k"), at.alias("target"), got.alias("retrieved")), ["k"]).select("k", "reject")


#: Messages as (short name, label, type of level, level), and what they hold.
_MESSAGES = (
    ("2t", "2 metre temperature", "heightAboveGround", 2, "TMP"), ("t", "Temperature", "heightAboveGround", 10, ""), ("2d", "2 metre dewpoint temperature", "heightAboveGround", 2, "DPT"), ("d", "Dew point temperature", "heightAboveGround", 2, "DPT"),
    ("2r", "", "heightAboveGround", 2, "RH"), ("r", "Relative humidity", "isobaricInhPa", 850, "RH"), ("msl", "", "meanSea", 0, "PRMSL"), ("x", "Pressure reduced to MSL", "meanSea", 0, "PRMSL"), ("sp", "", "surface", 0, "PRES"), ("pres", "Pressure", "surface", 0, ""),
    ("x", "Surface pressure", "unknown", 0, "PRES"), ("tcc", "", "atmosphere", 0, "TCDC"), ("cape", "", "surface", 0, "CAPE"), ("x", "Convective inhibition", "surface", 0, "CIN"), ("sdswrf", "", "surface", 0, "DSWRF"), ("x", "Downward short-wave radiation flux", "surface", 0, "DSWRF"),
)


def _messages(rows: DataFrame) -> DataFrame:
    held = F.array(*(F.struct(*(F.lit(v).alias(c) for c, v in zip(("name", "label", "level_type", "level"), m[:4]))) for m in _MESSAGES))
    return rows.select("*", F.posexplode(held).alias("i", "m")).select(*rows.columns, "i", "m.*").withColumn("variables", grib_text.variables("name", "label", "level_type", "level"))


@query(f"""
    WITH m(i, want) AS (VALUES {", ".join(f"({i}, '{m[4]}')" for i, m in enumerate(_MESSAGES))}) SELECT n_nationkey, i, want AS variables FROM nation, m""")
def weather_variables(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = _messages(table(spark, sf_dir, "nation").select("n_nationkey"))
    return found.select("n_nationkey", "i", F.array_join("variables", ",").alias("variables"))


@query(f"""
    WITH m(i, want) AS (VALUES {", ".join(f"({i}, '{m[4]}')" for i, m in enumerate(_MESSAGES))}),
    p(product, v) AS (SELECT 'gfs_0p25', unnest(['TMP', 'DPT', 'RH', 'PRMSL', 'PRES', 'TCDC', 'CAPE', 'CIN', 'DSWRF']) UNION ALL SELECT 'gefs_0p50a', unnest(['TMP', 'RH', 'PRMSL', 'PRES', 'TCDC', 'CAPE', 'CIN', 'DSWRF']) UNION ALL SELECT 'gefs_0p50b', unnest(['DPT', 'CAPE', 'CIN']))
    SELECT c_custkey AS k, product, v, EXISTS (SELECT 1 FROM m WHERE want = v AND (c_custkey + i) % 5 <> 0) AS available FROM customer, p""")
def weather_availability(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of each customer's messages some are absent; a product's map has its own variables only."""
    rows = bundles.spread(table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k")), "k").select("k", F.explode(F.lit(["gfs_0p25", "gefs_0p50a", "gefs_0p50b"])).alias("product"))
    found = grib_text.availability(_messages(rows).where((F.col("k") + F.col("i")) % 5 != 0), ["k"])
    return found.select("k", "product", F.explode("available").alias("v", "available"))


@query("""
    WITH a(name, want) AS (VALUES ('t_2m', 'air_temperature_2m'), ('TD_2M', 'dewpoint_2m'), ('relhum_2m', 'relative_humidity_2m'), ('pmsl', 'mean_sea_level_pressure'), ('ps', 'surface_pressure'), ('tot_prec', 'precipitation_amount'), ('clct', 'total_cloud_fraction'),
        ('aswdir_s', 'surface_downward_shortwave_direct'), ('aswdifd_s', 'surface_downward_shortwave_diffuse'), ('cape_ml', 'cape_mixed_layer'), ('cin_ml', 'cin_mixed_layer'), ('u_10m', NULL))
    SELECT n_nationkey, name, want AS parameter FROM nation, a""")
def canonical_parameters(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = F.lit(["t_2m", "TD_2M", "relhum_2m", "pmsl", "ps", "tot_prec", "clct", "aswdir_s", "aswdifd_s", "cape_ml", "cin_ml", "u_10m"])
    return table(spark, sf_dir, "nation").select("n_nationkey", F.explode(names).alias("name")).withColumn("parameter", C.canonical_parameter("name"))


@query("""
    WITH p(kind, path, field) AS (VALUES ('models', 'integrity/models/latest_success.json', 'generated_at_utc'), ('svg', 'integrity/svg/latest_success.json', 'generated_at_utc'), ('wunstorf', 'integrity/wunstorf/latest_success.json', 'generated_at_utc'),
        ('etnw', 'integrity/etnw/latest_success.json', 'generated_at_utc'), ('secondary', 'transfer_receipts/secondary/latest.json', 'source_generated_at_utc'))
    SELECT r_regionkey, kind, 'data/inbox/public_collector/' || path AS path, field FROM region, p""")
def state_pointers(spark: SparkSession, sf_dir: str) -> DataFrame:
    pointers = spark.createDataFrame(records.state_pointers(), "kind string, path string, field string")
    return table(spark, sf_dir, "region").select("r_regionkey").join(F.broadcast(pointers))


@query("""
    WITH e AS (SELECT user_id AS k, event_type AS endpoint, count(*) AS bytes, bool_or(value > 90) AS flagged, min(value) > 5 AS ok FROM events GROUP BY ALL)
    SELECT k, count(*) AS requests, sum(bytes)::BIGINT AS response_bytes, count(*) FILTER (ok AND NOT flagged) AS succeeded FROM e GROUP BY 1""")
def response_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests by kind; one with an error flag hasn't succeeded."""
    e = table(spark, sf_dir, "events").groupBy("user_id", "event_type").agg(F.count(F.lit(1)).alias("b"), F.bool_or(F.col("value") > 90).alias("flagged"), (F.min("value") > 5).alias("ok"))
    request = F.struct(F.col("event_type").alias("kind"), F.col("ok").alias("success"), F.col("b").alias("response_bytes"), F.when(F.col("flagged"), "busy").otherwise("0").alias("provider_error"))
    p = _payloads(e.groupBy("user_id").agg(F.collect_list(request).alias("r")), "user_id", F.to_json(F.struct(F.col("r").alias("requests"))))
    d = bundles.request_diagnostics(p)
    good = d.groupBy("path").agg(F.count_if("success").alias("succeeded"))
    return bundles.response_bytes(d).join(good, "path").withColumnRenamed("path", "k")


@query("""
    WITH c AS (SELECT o_orderkey AS k, hour(o_orderdate)::INT AS h, (o_orderkey % 900)::INT AS lead FROM orders), m AS (SELECT *, CASE WHEN h = 0 THEN 840 ELSE 384 END AS most FROM c)
    SELECT k, lead <= most AS expected, most::INT AS most, CASE WHEN lead <= most THEN CASE WHEN lead <= 240 THEN 'gefs_0p25s' ELSE 'gefs_0p50a' END END AS wind_product, CASE WHEN lead <= most THEN CASE WHEN lead <= 240 THEN 'gefs_0p25s' ELSE 'gefs_0p50b' END END AS gust_product,
           CASE WHEN lead <= most THEN CASE WHEN lead <= 240 THEN 0.3 ELSE 0.75 END END::DOUBLE AS padding, CASE WHEN lead <= most THEN lead END AS probe FROM m""")
def gefs_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"), F.hour("o_orderdate").alias("h"), (F.col("o_orderkey") % 900).cast("int").alias("lead"))
    c = o.withColumn("c", leads.gefs_contract("h", "lead"))
    return c.select("k", "c.expected", F.col("c.expected_max_hours").alias("most"), "c.wind_product", "c.gust_product", F.col("c.subset_padding_degrees").alias("padding"), leads.probe_lead("h", "lead", False).alias("probe"))


@query("""
    WITH m(model) AS (VALUES ('ICON-D2'), ('ICON-D2-EPS'), ('ICON-EU'), ('ECMWF-IFS'), ('GFS'), ('GEFS-control')), h AS (SELECT unnest([0, 5, 6, 12])::INT AS hour),
    b(lo, hi, step, hours) AS (VALUES (0, 48, 3, NULL), (51, 72, 3, [0, 6, 12]), (78, 120, 6, [0, 6, 12]), (132, 240, 12, [0, 12]), (264, 384, 24, [0, 12]), (408, 840, 24, [0])),
    x AS (SELECT model, hour, CASE WHEN model LIKE 'ICON-D2%' THEN 48 WHEN model = 'ICON-EU' THEN CASE WHEN hour = 5 THEN 51 ELSE 120 END WHEN model = 'ECMWF-IFS' THEN CASE WHEN hour IN (0, 12) THEN 360 ELSE 144 END WHEN model = 'GFS' THEN 384 ELSE CASE WHEN hour = 0 THEN 840 ELSE 384 END END AS most FROM m, h),
    g AS (SELECT model, hour, most, CASE WHEN model = 'ECMWF-IFS' AND hour = 6 THEN 90 ELSE least(120, most) END AS compatible, unnest(generate_series(lo, hi, step)) AS lead FROM x JOIN b ON hours IS NULL OR list_contains(hours, hour))
    SELECT r_regionkey, model, hour, compatible::INT AS compatible, count(*) FILTER (lead > compatible) AS extension, count(*) FILTER (lead > 48 AND lead <= compatible) AS core_extension, max(lead)::INT AS last FROM region, g WHERE lead <= most GROUP BY ALL""")
def lead_policies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of each model and cycle hour: the compatibility horizon, and how many leads lie beyond it or between it and two days."""
    r = table(spark, sf_dir, "region").select("r_regionkey", F.explode(F.lit(list(leads.MODELS))).alias("model")).select("*", F.explode(F.lit([0, 5, 6, 12])).alias("hour"))
    p = leads.policy("model", "hour")
    return r.select("r_regionkey", "model", "hour", leads.compatibility_max("model", "hour").alias("compatible"), F.size(leads.extension("model", "hour")).cast("long").alias("extension"), F.size(leads.core_extension("model", "hour")).cast("long").alias("core_extension"), p["acquisition_max_lead_hours"].alias("last"))


@query("""
    WITH e AS (SELECT event_id, event_id % 8 AS form, epoch(ts)::BIGINT - (epoch(ts)::BIGINT > epoch(ts))::BIGINT AS s FROM events)
    SELECT event_id, form, CASE WHEN form < 4 THEN s END AS lenient, CASE WHEN form < 3 THEN s END AS aware, CASE WHEN form NOT IN (6, 7) THEN s END AS either, CASE WHEN form = 3 THEN 'timezone_required' WHEN form > 3 THEN 'unparseable_timestamp' END AS reject FROM e""")
def time_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event's time as text in one of eight forms: UTC, two offsets, without a zone, epoch seconds and milliseconds, words, nothing."""
    at = F.unix_seconds(F.col("ts").cast("timestamp"))
    iso = lambda shift: F.date_format(F.timestamp_seconds(at + shift), "yyyy-MM-dd'T'HH:mm:ss")
    forms = (F.concat(iso(0), F.lit("Z")), F.concat(iso(5400), F.lit("+01:30")), F.concat(iso(-25200), F.lit("-07:00")), F.regexp_replace(iso(0), "T", " "), at.cast("string"), (at * 1000).cast("string"), F.concat(F.lit("at "), iso(0)), F.lit(""))
    e = table(spark, sf_dir, "events").select("event_id", (F.col("event_id") % 8).alias("form"), F.get(F.array(*forms), (F.col("event_id") % 8).cast("int")).alias("t"))
    seconds = lambda c: F.unix_timestamp(c)
    return e.select("event_id", "form", seconds(C.lenient_utc("t")).alias("lenient"), seconds(C.aware_only("t")).alias("aware"), seconds(C.epoch_or_iso("t")).alias("either"), C.time_reject("t", True).alias("reject"))


@query("""
    SELECT l_orderkey AS k, l_linenumber AS n, l_extendedprice AS raw, CASE WHEN l_quantity > 40 THEN NULL ELSE l_quantity + 0.5 END AS number, CASE WHEN l_linenumber <= 4 THEN l_linenumber END::INT AS whole, l_linenumber * 22.5 AS sector FROM lineitem""")
def number_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers with a decimal comma and a sign for missing, whole numbers, compass sectors."""
    lines = table(spark, sf_dir, "lineitem")
    text = F.when(F.col("l_quantity") > 40, " -999").otherwise(F.concat(F.lit(" "), F.floor("l_quantity").cast("string"), F.lit(",5 ")))
    whole = F.col("l_linenumber") + F.when(F.col("l_linenumber") > 4, 0.25).otherwise(0.0)
    return lines.select(F.col("l_orderkey").alias("k"), F.col("l_linenumber").alias("n"), C.safe_double(F.col("l_extendedprice").cast("string")).alias("raw"), C.locale_number(text).alias("number"), C.integral(whole).alias("whole"), C.sector_degrees("l_linenumber").alias("sector"))


@query("""
    WITH f(i, status, reject, carried) AS (VALUES (0, 'received', NULL, TRUE), (1, 'fetch_error', NULL, FALSE), (2, 'fetch_error', 'non-received field cannot carry a value', FALSE), (3, NULL, 'unknown availability status odd', FALSE))
    SELECT c_custkey AS k, status, reject, carried FROM customer JOIN f ON i = c_custkey % 4""")
def availability_stamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One field a customer: with a value, with an error, with both, with an odd status."""
    k = F.col("c_custkey") % 4
    item = F.struct(F.when(k != 1, 2.5).alias("value"), F.when(k == 1, "timeout").when(k == 2, "late").alias("error"), F.when(k == 3, "odd").alias("availability_status"))
    record = F.struct(F.struct(F.array(item).alias("t")).alias("values"))
    p = _payloads(table(spark, sf_dir, "customer"), "c_custkey", F.to_json(F.struct(F.struct(F.array(record).alias("GFS")).alias("models"))))
    out = availability.stamp(bundles.native_values(bundles.records(p)), F.lit("2025-03-14T09:00:00Z"))
    return out.select(F.col("path").alias("k"), "status", "reject", F.coalesce(F.col("available_at").isNotNull(), F.lit(False)).alias("carried"))


@query("""
    WITH o AS (SELECT DISTINCT strftime(o_orderdate, '%Y%m%d%H') AS cycle FROM orders), w AS (SELECT cycle, n::INT AS lead, p AS parameter FROM o, (VALUES (3), (6), (9)) a(n), (VALUES ('t_2m'), ('ps')) b(p)),
    l AS (SELECT cycle, n AS lead, 'https://e.org/' || g || '_' || cycle || '_' || lpad(n::VARCHAR, 3, '0') || '_2d_' || p || v || '.bz2' AS url, p FROM o, (VALUES (3), (6)) a(n), (VALUES ('t_2m'), ('clct')) b(p), (VALUES ('regular-lat-lon'), ('icosahedral')) c(g), (VALUES ('.b'), ('')) d(v) WHERE NOT (n = 6 AND cycle LIKE '%1%')),
    r AS (SELECT w.*, min(url) FILTER (p = parameter AND contains(url, 'regular-lat-lon')) AS url, coalesce(min(url) FILTER (p = parameter), min(url)) AS any_url FROM w LEFT JOIN l USING (cycle, lead) GROUP BY ALL)
    SELECT * FROM r""")
def product_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of two parameters, in two grids and two versions, for the cycles of all orders; some leads have none."""
    o = table(spark, sf_dir, "orders").select(F.date_format("o_orderdate", "yyyyMMddHH").alias("cycle")).distinct()
    every = lambda df, name, *values: df.select("*", F.explode(F.lit(list(values))).alias(name))
    wanted = every(every(o, "lead", 3, 6, 9), "parameter", "t_2m", "ps")
    l = every(every(every(every(o, "n", 3, 6), "p", "t_2m", "clct"), "g", "regular-lat-lon", "icosahedral"), "v", ".b", "").where(~((F.col("n") == 6) & F.col("cycle").contains("1")))
    listing = l.select(F.format_string("https://e.org/%s_%s_%03d_2d_%s%s.bz2", "g", "cycle", "n", "p", "v").alias("url"))
    any_ = stations.product_files(listing, wanted, regular=False).withColumnRenamed("url", "any_url")
    return stations.product_files(listing, wanted).join(any_, ["cycle", "lead", "parameter"])


@query("""
    WITH c AS (SELECT vec_id AS k, TIMESTAMP '2025-03-14 06:00:00' + INTERVAL (vec_id % 4) HOUR AS run FROM embeddings), d AS (SELECT k, run, unnest([0, 2, 5]) AS lead FROM c)
    SELECT d.k, lead::INT AS lead, embedding[i]::DOUBLE AS value FROM d JOIN embeddings ON vec_id = k LEFT JOIN (SELECT unnest(range(1, 9)) AS i) t ON run + INTERVAL (lead) HOUR = TIMESTAMP '2025-03-14 05:00:00' + INTERVAL (i) HOUR""")
def members_at_leads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly values from six o'clock on, at three leads of cycles that begin up to three hours later."""
    e = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("k"), "embedding")
    start = F.lit("2025-03-14 06:00:00").cast("timestamp")
    hour = lambda n: start + F.make_dt_interval(hours=n)
    long = e.select("k", F.posexplode(F.slice("embedding", 1, 8)).alias("i", "value")).select("k", hour(F.col("i")).alias("time"), F.col("value").cast("double").alias("value"))
    cycles = e.select("k", hour((F.col("k") % 4).cast("int")).alias("run"), F.lit([0, 2, 5]).alias("leads"))
    return ensemble.at_leads(long, cycles, ["k"]).select("k", "lead", "value")


@query("""
    WITH l AS (SELECT o_orderkey AS k, o_orderkey % 6 AS odd, strftime(o_orderdate, '%H%M') AS hm FROM orders)
    SELECT k, CASE WHEN odd = 0 OR odd = 1 THEN NULL WHEN odd = 2 THEN '0100' ELSE hm END AS at, CASE odd WHEN 4 THEN k % 60 * (1.0::DOUBLE / 60) WHEN 5 THEN k % 9 * 24.0::DOUBLE WHEN 3 THEN k % 600 / 10.0::DOUBLE ELSE (k % 300)::DOUBLE END AS hours FROM l""")
def message_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Coded times with too many digits or none, short ones, and step ranges with units of either case."""
    odd = F.col("k") % 6
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"), F.date_format("o_orderdate", "HHmm").alias("hm"))
    time = F.when(odd == 0, F.concat("hm", F.lit("00"))).when(odd == 1, "noon").when(odd == 2, "100").otherwise(F.col("hm"))
    number = lambda n: n.cast("string")
    step = F.when(odd == 4, F.concat(F.lit("0-"), number(F.col("k") % 60), F.lit("M"))).when(odd == 5, F.concat(number(F.col("k") % 9), F.lit("D"))).when(odd == 3, F.format_string("0-%.1fH", (F.col("k") % 600) / 10)).otherwise(number(F.col("k") % 300))
    return o.select("k", F.date_format(C.message_time(F.lit("20250314"), time), "HHmm").alias("at"), C.step_end_hours(step).alias("hours"))


@query("""
    SELECT o_orderkey AS k, o_orderkey % 5 IN (0, 1) AND o_orderkey % 7 <> 0 AND o_orderkey % 11 <> 0 AS native_verified, abs(o_custkey % 100 / 1000.0 - 0.05) <= 0.011 AND o_custkey % 13 <> 0 AS parity_verified,
      (o_orderkey % 5 IN (0, 1) AND o_orderkey % 7 <> 0 AND o_orderkey % 11 <> 0) AND (abs(o_custkey % 100 / 1000.0 - 0.05) <= 0.011 AND o_custkey % 13 <> 0) AS verified FROM orders WHERE o_custkey % 100 NOT IN (39, 61)""")
def grid_provenance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of a native grid's identity, one in eleven cut short, and the point that a tool chose on the regular grid, missing in one of thirteen. Distances at the very tolerance are left to pytest."""
    o = table(spark, sf_dir, "orders").where("o_custkey % 100 not in (39, 61)").select(F.col("o_orderkey").alias("k"), (F.col("o_custkey") % 100 / 1000.0).alias("off"), F.col("o_custkey").alias("c"))
    kind = F.element_at(F.array(*map(F.lit, ("unstructured_grid", "unstructured", "regular_ll", "rotated_ll", "lambert"))), (F.col("k") % 5 + 1).cast("int"))
    number = F.when(F.col("k") % 7 == 0, "101").otherwise("47")
    line = F.concat_ws(" ", kind, F.lit("101"), number, F.when(F.col("k") % 11 != 0, F.lit("a1b2c3")), F.lit("542040"))
    natives = grib_text.grid_identity(o.select("k", line.alias("line")))
    point = F.concat(F.lit("Grid Point chosen #1 index=17 latitude=52.5"), F.lit(" longitude="), F.format_string("%.3f", F.col("off") + 9), F.lit(" distance=3.1 (Km)"))
    tool = o.where("c % 13 <> 0").select("k", F.posexplode(F.array(F.lit("10u 3 20250314 1.5"), point)).alias("pos", "line"))
    returned = o.select("k", F.lit(52.5).alias("latitude"), F.lit(9.05).alias("longitude"))
    return grib_text.provenance(natives, grib_text.nearest(tool, ["k"]), returned, ["k"])


@query("""
    WITH l AS (SELECT DISTINCT l_orderkey AS k, l_linenumber AS n FROM lineitem), c AS (SELECT k, count(*) AS m, max(n) AS top FROM l GROUP BY 1),
    v AS (SELECT *, m - (k % 4 = 0)::INT AS values_, k % 6 = 1 AS renamed FROM c)
    SELECT k, m AS n_metadata, values_ AS n_values, CASE WHEN m <> values_ THEN 'metadata_value_count_mismatch' ELSE 'metadata_value_name_mismatch' END AS reason FROM v WHERE m <> values_ OR renamed""")
def metadata_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files with a value fewer than messages, and files whose first value has another name."""
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("k"), F.col("l_linenumber").alias("n")).distinct()
    listed = lines.groupBy("k").agg(F.array_sort(F.collect_set("n")).alias("ns")).select("k", F.posexplode("ns").alias("pos", "n"), F.size("ns").alias("m"))  # an order's lines are few
    meta = listed.select("k", "pos", F.concat(F.lit("v"), "n").alias("short_name"))
    values = listed.where((F.col("k") % 4 != 0) | (F.col("pos") < F.col("m") - 1)).select("k", "pos", F.when((F.col("k") % 6 == 1) & (F.col("pos") == 0), "other").otherwise(F.concat(F.lit("v"), "n")).alias("short_name"), F.col("n").cast("double").alias("value"))
    return grib_text.metadata_reject(meta, values, ["k"])
