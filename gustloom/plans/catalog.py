"""Queries of the engine's operators over the driver's tables, each beside its DuckDB form."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gustloom.functions import columns as C
from gustloom.functions import variants as V
from gustloom.operators import coverage, ensemble, gate, leads, records, timeline
from gustloom.sinks import publish
from gustloom.sources import grib_text, stations

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a query under its function's name, with its DuckDB form if there is one."""

    def add(function):
        QUERIES[function.__name__] = function
        if sql:
            ORACLE_SQL[function.__name__] = sql
        return function

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("""
    WITH o AS (SELECT l_orderkey, max(l_linenumber) AS n FROM lineitem GROUP BY 1),
    e AS (SELECT l_orderkey, unnest(generate_series(1, n)) AS l_linenumber FROM o)
    SELECT e.l_orderkey, e.l_linenumber::INT AS l_linenumber FROM e ANTI JOIN lineitem USING (l_orderkey, l_linenumber)""")
def completeness_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber")
    spans = lines.groupBy("l_orderkey").agg(F.max("l_linenumber").alias("n"))
    expected = spans.select("l_orderkey", F.explode(F.sequence(F.lit(1), "n")).alias("l_linenumber"))
    return coverage.missing(expected, lines, ["l_orderkey", "l_linenumber"])


@query("""
    SELECT DISTINCT l_orderkey, l_linenumber, l_linenumber > 4 AS extra FROM lineitem WHERE l_linenumber > 4""")
def completeness_extra(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber").distinct()
    spans = lines.select("l_orderkey").distinct().select("l_orderkey", F.explode(F.sequence(F.lit(1), F.lit(4))).alias("l_linenumber"))
    both = coverage.compare(spans, lines, ["l_orderkey", "l_linenumber"])
    return both.where("received and not expected").select("l_orderkey", "l_linenumber", F.lit(True).alias("extra"))


_LINE = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]


@query(f"""
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {", ".join(_LINE[2:])}) AS n FROM lineitem) WHERE n = 1""")
def duplicate_leads_first_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select(*_LINE)
    return timeline.first_wins(lines, ["l_orderkey", "l_linenumber"], _LINE[2:]).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


@query("SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1")
def duplicate_leads_listed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return timeline.repeats(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("""
    WITH c AS (SELECT o_orderpriority, o_orderdate FROM orders JOIN lineitem ON o_orderkey = l_orderkey WHERE l_linenumber <= 3 GROUP BY ALL HAVING count(DISTINCT l_returnflag) = 3)
    SELECT o_orderpriority, max(o_orderdate) AS newest FROM c GROUP BY 1""")
def newest_cycle_all_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", "o_orderdate")
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag")
    joined = orders.join(lines, orders.o_orderkey == lines.l_orderkey)
    return coverage.newest_with_all(joined, ["o_orderpriority"], "o_orderdate", "l_returnflag", 3, F.col("l_linenumber") <= 3)


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with ``ts`` as an instant: the table has it without a zone."""
    return table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))


_GAPS = """t AS (SELECT DISTINCT user_id, ts FROM events),
    g AS (SELECT *, lag(ts) OVER (PARTITION BY user_id ORDER BY ts) AS after FROM t),
    m AS (SELECT user_id, ts, after, (epoch_us(ts) - epoch_us(after)) / 6e7 AS gap_minutes FROM g WHERE after IS NOT NULL)"""


@query(f"""
    WITH {_GAPS} SELECT user_id, (epoch_us(ts) - epoch_us(after))::BIGINT AS gap_us, greatest(0, round_even(gap_minutes / 720, 0)::BIGINT - 1)::INT AS missing, ts, after FROM m WHERE gap_minutes > 720.1""")
def cadence_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = timeline.cadence_gaps(events(spark, sf_dir), ["user_id"], "ts", 720.0)
    return found.select("user_id", F.round(F.col("gap_minutes") * 6e7).cast("long").alias("gap_us"), "missing", F.col("ts").cast("timestamp_ntz").alias("ts"), F.col("after").cast("timestamp_ntz").alias("after"))


@query(f"WITH {_GAPS} SELECT user_id, max(epoch_us(ts) - epoch_us(after))::BIGINT AS max_gap_us, count(*) AS n FROM m GROUP BY 1")
def max_gap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return timeline.gaps(events(spark, sf_dir), ["user_id"], "ts").groupBy("user_id").agg(F.round(F.max("gap_minutes") * 6e7).cast("long").alias("max_gap_us"), F.count(F.lit(1)).alias("n"))


@query("""
    WITH w AS (SELECT date_trunc('day', min(ts)) AS s, date_trunc('day', max(ts)) AS e FROM events),
    a AS (SELECT user_id, min(ts) AS f, max(ts) AS l, count(DISTINCT ts) AS n FROM events GROUP BY 1)
    SELECT user_id, n, greatest(1, floor((epoch_us(e) - epoch_us(s)) / 1e6 / 86400))::INT AS expected_slots, greatest(0, epoch_us(f) - epoch_us(s))::BIGINT AS start_gap_us,
           greatest(0, epoch_us(e) - epoch_us(l))::BIGINT AS end_gap_us, round(least(1, n / greatest(1, floor((epoch_us(e) - epoch_us(s)) / 1e6 / 86400))), 6) AS coverage_ratio FROM a, w""")
def window_edge_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = events(spark, sf_dir)
    start, end = e.agg(F.date_trunc("day", F.min("ts")), F.date_trunc("day", F.max("ts"))).first()
    found = timeline.edge_coverage(e, ["user_id"], "ts", F.lit(start), F.lit(end), 1440.0)
    return found.select("user_id", "n", "expected_slots", *(F.round(F.col(c) * 6e7).cast("long").alias(f"{c}_us") for c in ("start_gap", "end_gap")), F.round("coverage_ratio", 6).alias("coverage_ratio"))


_NOW = "2024-02-01 00:00:00"


@query(f"""
    WITH a AS (SELECT event_id, (epoch_us(TIMESTAMP '{_NOW}') - epoch_us(ts)) / 6e7 AS age FROM events)
    SELECT event_id, CASE WHEN age < -15 THEN 'timestamp_validation_failure' WHEN age <= 180 THEN 'recent_historical_reference' WHEN age <= 2880 THEN 'provider_archive_lag_plausible' ELSE 'provider_archive_unusually_delayed' END AS archive_class,
           CASE WHEN age <= 120 THEN 'fresh' WHEN age <= 360 THEN 'delayed' ELSE 'stale' END AS report_class, age < -15 OR greatest(age, 0) >= 150 AS is_due,
           CASE WHEN age < -15 THEN 'latest_success_timestamp_future_fail_open' WHEN age >= 150 THEN 'last_success_age_exceeds_threshold' ELSE 'last_success_within_threshold' END AS due_reason FROM a""")
def freshness_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    age = (F.unix_micros(F.lit(_NOW).cast("timestamp")) - F.unix_micros("ts")) / 6e7
    aged = events(spark, sf_dir).select("event_id", age.alias("age"))
    return aged.select("event_id", C.archive_age_class("age").alias("archive_class"), C.report_age_class("age").alias("report_class"), C.due("age", 150.0).alias("is_due"), C.due_reason("age", 150.0).alias("due_reason"))


@query(f"""
    WITH e AS (SELECT *, ts > TIMESTAMP '{_NOW}' AS future FROM events)
    SELECT event_type, count(*) FILTER (NOT future) AS n, count(*) FILTER (future) AS future_count, min(ts) FILTER (NOT future) AS first_time, max(ts) FILTER (NOT future) AS last_time FROM e GROUP BY 1""")
def future_split_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = events(spark, sf_dir).select("event_type", F.col("ts").alias("time"), "value", (F.col("ts") > F.lit(_NOW).cast("timestamp")).alias("future"))
    ntz = lambda c: F.col(c).cast("timestamp_ntz").alias(c)
    return stations.chart_summary(points, ["event_type"]).select("event_type", "n", "future_count", ntz("first_time"), ntz("last_time"))


@query("""
    WITH c AS (SELECT * FROM events WHERE event_type = 'click'), p AS (SELECT * FROM events WHERE event_type = 'purchase'),
    j AS (SELECT c.event_id AS left_id, p.event_id AS right_id, abs(epoch_us(p.ts) - epoch_us(c.ts)) AS distance_us, p.ts FROM c JOIN p ON c.user_id = p.user_id AND abs(epoch_us(p.ts) - epoch_us(c.ts)) <= 5400000000)
    SELECT left_id, right_id, distance_us FROM j QUALIFY row_number() OVER (PARTITION BY left_id ORDER BY distance_us, ts, right_id) = 1""")
def nearest_time_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = events(spark, sf_dir).select("event_id", "user_id", "ts", "event_type")
    found = timeline.nearest(e.where("event_type = 'click'"), e.where("event_type = 'purchase'"), "event_id", "ts", "event_id", "ts", 5400, ["user_id"])
    return found.select("left_id", "right_id", "distance_us")


@query("SELECT l_returnflag, quantile_cont(l_quantity, 0.1) AS p10, quantile_cont(l_quantity, 0.25) AS p25, quantile_cont(l_quantity, 0.75) AS p75, quantile_cont(l_quantity, 0.9) AS p90 FROM lineitem GROUP BY 1")
def exact_quantiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = ensemble.large_percentiles(table(spark, sf_dir, "lineitem"), ["l_returnflag"], "l_quantity", [0.1, 0.25, 0.75, 0.9])
    return found.select("l_returnflag", *(F.col(f"p{i}").alias(n) for i, n in enumerate(("p10", "p25", "p75", "p90"))))


@query("SELECT event_type, median(value) AS med, round(stddev_pop(value), 6) AS spread FROM events GROUP BY 1")
def median_stddev(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    middle = ensemble.large_percentiles(e, ["event_type"], "value", [0.5]).select("event_type", F.col("p0").alias("med"))
    return e.groupBy("event_type").agg(F.round(F.stddev_pop("value"), 6).alias("spread")).join(middle, "event_type")


@query("""
    WITH a AS (SELECT user_id, sum(sin(radians(value))) AS s, sum(cos(radians(value))) AS c FROM events GROUP BY 1)
    SELECT user_id, round((((degrees(atan2(s, c))) % 360) + 360) % 360, 6) AS mean_direction FROM a""")
def circular_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").groupBy("user_id").agg(F.round(ensemble.circular_mean("value"), 6).alias("mean_direction"))


@query("""
    WITH d AS (SELECT event_id, abs((((value - user_id) % 360) + 360) % 360) AS d FROM events) SELECT event_id, round(least(d, 360 - d), 6) AS difference FROM d""")
def circular_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", F.round(C.circular_difference("value", F.col("user_id").cast("double")), 6).alias("difference"))


@query("""
    WITH e AS (SELECT vec_id, embedding[1]::DOUBLE * 10 AS u, embedding[2]::DOUBLE * 10 AS v FROM embeddings), w AS (SELECT vec_id, sqrt(u * u + v * v) AS s, ((270 - degrees(atan2(v, u))) % 360 + 360) % 360 AS d FROM e)
    SELECT vec_id, round(s, 6) AS speed_ms, round(s * 1.943844, 6) AS speed_kt, round(d, 6) AS direction FROM w""")
def wind_from_uv(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "embeddings").select("vec_id", (F.get("embedding", 0).cast("double") * 10).alias("u"), (F.get("embedding", 1).cast("double") * 10).alias("v"))
    s = C.wind_speed("u", "v")
    return e.select("vec_id", F.round(s, 6).alias("speed_ms"), F.round(s * C.KNOTS_PER_MS, 6).alias("speed_kt"), F.round(C.wind_direction("u", "v"), 6).alias("direction"))


@query("""
    SELECT vec_id, f.field, m AS member, t AS time, embedding[f.start + 4 * m + t + 1]::DOUBLE AS value FROM embeddings, (VALUES ('speed', 0), ('gust', 20)) f(field, start), (SELECT unnest(range(5))::INT AS m) s, (SELECT unnest(range(4))::INT AS t) u""")
def member_unpivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns of five members over four times, in two fields, as rows."""
    member = lambda start, m: F.slice("embedding", start + 4 * m + 1, 4).cast("array<double>")
    field = lambda start: F.create_map(*(x for m in range(5) for x in (F.lit(str(m)), member(start, m))))
    e = table(spark, sf_dir, "embeddings").select("vec_id", F.sequence(F.lit(0), F.lit(3)).alias("times"), F.create_map(F.lit("speed"), field(0), F.lit("gust"), field(20)).alias("columns"))
    return ensemble.unpivot_hourly(e, ["vec_id"])


@query("SELECT l_orderkey, list_sort(list(l_linenumber)) = range(1, 5) AS complete, count(*) AS members FROM lineitem GROUP BY 1")
def member_set_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", (F.col("l_linenumber") - 1).alias("member"))
    return ensemble.member_set(lines, ["l_orderkey"], expected=4).select("l_orderkey", "complete", F.size("members").cast("long").alias("members"))


@query("""
    WITH m AS (SELECT vec_id, 5 + embedding[i]::DOUBLE AS s, 180 + embedding[i + 1]::DOUBLE * 90 AS d, 7 + embedding[i + 2]::DOUBLE AS g FROM embeddings, generate_series(1, 20) t(i))
    SELECT vec_id, count(*) AS member_count, round(median(s), 6) AS med, round(quantile_cont(s, 0.1), 6) AS p10, round(quantile_cont(s, 0.9), 6) AS p90, round(stddev_pop(s), 6) AS spread,
           round(((degrees(atan2(sum(sin(radians(d))), sum(cos(radians(d))))) % 360) + 360) % 360, 6) AS direction_mean, round(median(g), 6) AS gust_median, round(quantile_cont(g, 0.9), 6) AS gust_p90 FROM m GROUP BY 1""")
def ensemble_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = lambda i: F.get("embedding", F.col("i") + i).cast("double")
    e = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", F.explode(F.sequence(F.lit(0), F.lit(19))).alias("i"))
    m = e.select("vec_id", (5 + at(0)).alias("wind_speed_ms"), (180 + at(1) * 90).alias("wind_direction_deg"), (7 + at(2)).alias("gust_ms"))
    s = ensemble.statistics(m, ["vec_id"])
    return s.select("vec_id", "member_count", F.round("median", 6).alias("med"), *(F.round(c, 6).alias(c) for c in ("p10", "p90", "spread", "direction_mean", "gust_median", "gust_p90")))


_SEVERITY = "CASE event_type WHEN 'error' THEN 'ERROR' WHEN 'signup' THEN 'WARN' ELSE 'INFO' END"


@query(f"""
    WITH i AS (SELECT user_id % 50 AS grp, {_SEVERITY} AS severity FROM events),
    c AS (SELECT grp, count(*) FILTER (severity = 'ERROR') AS error_count, count(*) FILTER (severity = 'WARN') AS warning_count, count(*) FILTER (severity = 'INFO') AS info_count FROM i GROUP BY 1)
    SELECT *, CASE WHEN error_count > 0 THEN 'FAIL' WHEN warning_count > 0 THEN 'PASS_WITH_WARNINGS' ELSE 'PASS' END AS status FROM c""")
def severity_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    level = F.when(F.col("event_type") == "error", "ERROR").when(F.col("event_type") == "signup", "WARN").otherwise("INFO")
    return coverage.severity(table(spark, sf_dir, "events").select((F.col("user_id") % 50).alias("grp"), level.alias("severity")), ["grp"])


@query("""
    SELECT o_custkey, count(DISTINCT o_orderpriority) FILTER (o_orderstatus = 'F') AS families, count(DISTINCT o_orderpriority) FILTER (o_orderstatus = 'F') >= 2 AS met FROM orders GROUP BY 1""")
def family_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return coverage.families(table(spark, sf_dir, "orders"), ["o_custkey"], "o_orderpriority", F.col("o_orderstatus") == "F")


@query("""
    WITH a AS (SELECT user_id, event_type = 'error' AS bad, event_type = 'purchase' AS good, date_trunc('month', ts) AS stage FROM events)
    SELECT user_id, stage, CASE WHEN bool_or(bad) AND bool_or(good) THEN 'recovered' WHEN bool_or(bad) THEN 'failed' ELSE 'clean' END AS outcome FROM a GROUP BY 1, 2""")
def stage_recovery(spark: SparkSession, sf_dir: str) -> DataFrame:
    word = F.when(F.col("event_type") == "error", "failed").when(F.col("event_type") == "purchase", "success").otherwise("started")
    a = events(spark, sf_dir).select("user_id", F.date_trunc("month", "ts").cast("timestamp_ntz").alias("stage"), word.alias("status"))
    return coverage.stage_recovery(a, ["user_id", "stage"])


_STATUS = "CASE WHEN l_discount < 0.05 THEN 'received' WHEN l_discount < 0.08 THEN 'missing' END"


@query(f"""
    WITH l AS (SELECT *, {_STATUS} AS status FROM lineitem)
    SELECT l_returnflag, l_linestatus, count(*) AS requested, count(*) FILTER (status = 'received') AS received, count(*) FILTER (status IS DISTINCT FROM 'received') AS missing, round(sum(l_quantity), 2) AS bytes, round(sum(l_tax), 4) AS seconds,
           grouping(l_linestatus)::INT AS by_model, count(*) FILTER (status = 'missing') AS said_missing FROM l GROUP BY GROUPING SETS ((l_returnflag), (l_returnflag, l_linestatus))""")
def grouped_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").withColumn("status", F.expr(_STATUS))
    s = coverage.field_summary(lines, [], "l_returnflag", "l_linestatus", "status", "l_quantity", "l_tax")
    said = F.coalesce(F.try_element_at("status_counts", F.lit("missing")), F.lit(0)).alias("said_missing")
    return s.select("l_returnflag", "l_linestatus", "requested", "received", "missing", F.round("bytes", 2).alias("bytes"), F.round("seconds", 4).alias("seconds"), "by_model", said)


@query(f"""
    WITH l AS (SELECT l_orderkey AS k, l_linenumber::VARCHAR AS p, {_STATUS} IS NOT DISTINCT FROM 'received' AS got FROM lineitem)
    SELECT k, count(*) FILTER (got) AS received_count, count(*) FILTER (NOT got) AS missing_count, coalesce(string_agg(p, ',' ORDER BY p) FILTER (got), '') AS received, coalesce(string_agg(p, ',' ORDER BY p) FILTER (NOT got), '') AS missing FROM l GROUP BY 1""")
def probe_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("k"), F.col("l_linenumber").cast("string").alias("p"), F.expr(_STATUS).alias("status"))
    s = coverage.probe_summary(lines, ["k"], "p", "status")
    return s.select("k", "received_count", "missing_count", F.array_join("received_parameters", ",").alias("received"), F.array_join("missing_parameters", ",").alias("missing"))


@query("""SELECT page_id, unnest(regexp_extract_all(html, 'href=["'']([^"'']+)', 1)) AS href FROM pages""")
def href_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", F.explode(stations.hrefs("html")).alias("href"))


@query("""
    SELECT o_orderkey, l_linenumber, CASE WHEN l_linenumber < 5 THEN strftime(o_orderdate, '%Y%m%d%H') END AS cycle, CASE WHEN l_linenumber < 5 THEN l_linenumber * 3 END::INT AS lead FROM orders JOIN lineitem ON o_orderkey = l_orderkey""")
def filename_regex(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names of files, those of the last lines without a cycle."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.date_format("o_orderdate", "yyyyMMddHH").alias("c"))
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_linenumber").join(o, "o_orderkey")
    name = F.when(F.col("l_linenumber") < 5, F.format_string("icon_single-level_%s_%03d_2d_t_2m.grib2", "c", F.col("l_linenumber") * 3)).otherwise(F.concat(F.lit("icon_"), "c", F.lit("_latest.grib2")))
    cycle, lead = stations.cycle_and_lead(name)
    return lines.select("o_orderkey", "l_linenumber", cycle.alias("cycle"), lead.alias("lead"))


@query("SELECT event_id, json_extract(props, '$.k')::BIGINT AS k FROM events")
def json_field(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", V.number(F.try_parse_json("props"), "$.k").cast("long").alias("k"))


@query("SELECT doc_id, sha256(text) AS sha, strlen(text)::INT AS n_bytes FROM documents")
def sha_identity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", C.identity_sha("text").alias("sha"), F.octet_length("text").alias("n_bytes"))


@query(r"""
    WITH t AS (SELECT doc_id, 'GET /v1?station=' || doc_id || '&API-key=k' || doc_id || '&x=1 X-Api-Secret: ' || n_chars || '; token=' || n_chars || ' s/cret ' || coalesce(text, '') || ' s%2Fcret' AS t FROM documents)
    SELECT doc_id, sha256(regexp_replace(regexp_replace(replace(replace(t, 's/cret', '***REDACTED***'), 's%2Fcret', '***REDACTED***'), '([?&]api-key=)[^&\s''"]+', '\1***REDACTED***', 'gi'), '(X-Api-Secret[=: ]+)[^,;\s''"]+', '\1***REDACTED***', 'gi')) AS sha FROM t""")
def redact(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = (F.lit("GET /v1?station="), "doc_id", F.lit("&API-key=k"), "doc_id", F.lit("&x=1 X-Api-Secret: "), "n_chars", F.lit("; token="), "n_chars", F.lit(" s/cret "), F.coalesce("text", F.lit("")), F.lit(" s%2Fcret"))
    return table(spark, sf_dir, "documents").select("doc_id", F.sha2(C.redact(F.concat(*parts), "s/cret"), 256).alias("sha"))


@query("SELECT user_id, max(ts) AS ts, arg_max(event_id, ts) AS event_id FROM (SELECT DISTINCT ON (user_id, ts) * FROM events ORDER BY user_id, ts, event_id DESC) GROUP BY 1")
def latest_pointer(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = events(spark, sf_dir).select("user_id", "ts", "event_id", F.struct("ts", "event_id").alias("at"))
    return timeline.last_wins(e, ["user_id"], "at").select("user_id", F.col("ts").cast("timestamp_ntz").alias("ts"), "event_id")


@query("""
    WITH a AS (SELECT event_type, ts, event_id, (epoch_us(ts) - epoch_us(lag(ts) OVER (PARTITION BY event_type ORDER BY event_id))) / 6e7 AS gap FROM events)
    SELECT event_id, coalesce(gap > 1.5 * 60, false) AS continuity_gap, coalesce(greatest(0, floor(greatest(gap, 0) / 60) - 1), 0)::INT AS missed, coalesce(gap < 0, false) AS older_than_latest FROM a""")
def continuity(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = timeline.continuity(events(spark, sf_dir), "event_type", "event_id", "ts", F.lit(60.0))
    return found.select("event_id", "continuity_gap", "missed", "older_than_latest")


@query("""
    WITH o AS (SELECT o_custkey, max(o_orderdate) AS run FROM orders GROUP BY 1), f AS (SELECT DISTINCT o_custkey, o_orderdate FROM orders WHERE o_orderstatus = 'F'),
    s AS (SELECT o_custkey, min(o_orderdate) AS run FROM orders GROUP BY 1 HAVING count(DISTINCT o_orderdate) = 1),
    j AS (SELECT c_custkey AS model, o.run, f.o_custkey IS NOT NULL AS archived, s.o_custkey IS NOT NULL AS seeded FROM customer LEFT JOIN o ON c_custkey = o.o_custkey LEFT JOIN f ON o.o_custkey = f.o_custkey AND o.run = f.o_orderdate LEFT JOIN s ON o.o_custkey = s.o_custkey AND o.run = s.run)
    SELECT model, run, CASE WHEN model % 50 = 0 OR run IS NULL OR NOT archived OR NOT seeded THEN 'fetch' ELSE 'carry_forward' END AS action,
           CASE WHEN model % 50 = 0 THEN 'provider_cycle_probe_failed_fail_open' WHEN run IS NULL THEN 'probe_not_run_fail_open' WHEN NOT archived AND NOT seeded THEN 'fetch_fail_open_missing_private_cycle_evidence_seed_payload_rows'
                WHEN NOT archived THEN 'fetch_fail_open_missing_private_cycle_evidence' WHEN NOT seeded THEN 'fetch_fail_open_missing_seed_payload_rows' ELSE 'selected_cycle_already_archived' END AS reason FROM j""")
def carry_forward_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("model"), F.col("o_orderdate").alias("run"), "o_orderstatus")
    newest = o.groupBy("model").agg(F.max("run").alias("run"))
    discovered = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("model")).join(newest, "model", "left").withColumn("probe_error", F.when(F.col("model") % 50 == 0, "timeout"))
    archived = o.where("o_orderstatus = 'F'")
    latest = o.select("model", "run", F.lit(True).alias("complete"))
    none = spark.createDataFrame([], "model long, run timestamp_ntz, state string, attempts int, not_before timestamp")
    return gate.plan(discovered, archived, latest, o, none, F.lit(_NOW).cast("timestamp"))


@query("""
    WITH c AS (SELECT l_orderkey AS batch, l_linenumber AS n, max(l_shipdate) AS t, bool_and(l_returnflag <> 'R') AS verified, bool_and(l_tax < 0.07) AS clean FROM lineitem WHERE l_linenumber <= 2 GROUP BY ALL)
    SELECT batch, max(t) AS generated_at FROM c GROUP BY 1 HAVING count(*) = 2 AND bool_and(verified AND clean)""")
def batch_receipt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch's two kinds are its first lines; returned ones weren't read back, taxed ones have an error."""
    kind = F.when(F.col("l_linenumber") == 1, "wunstorf").otherwise("etnw").alias("kind")
    lines = table(spark, sf_dir, "lineitem").where("l_linenumber <= 2").groupBy(F.col("l_orderkey").alias("batch"), kind).agg(F.max("l_shipdate").alias("generated_at"), F.bool_and(F.col("l_returnflag") != "R").alias("verified"), F.bool_and(F.col("l_tax") < 0.07).alias("clean"))
    sha = F.concat_ws("/", "batch", "kind").alias("sha256")
    reports = lines.select("batch", F.concat_ws(":", "kind", "batch").alias("kind"), "generated_at", sha, F.when(F.col("clean"), 0).otherwise(1).alias("error_count"), F.lit(True).alias("ready"))
    found = lines.select(F.concat_ws(":", "kind", "batch").alias("kind"), "generated_at", sha, F.col("verified").alias("readback_verified"), F.lit("private-transfer-readback-v2").alias("method_version"))
    return publish.batch_receipts(reports, found)[0]


@query("""
    WITH b(lo, hi, step, hours) AS (VALUES (0, 48, 3, [0, 6, 12, 18]), (51, 72, 3, [0, 6, 12, 18]), (78, 120, 6, [0, 6, 12, 18]), (132, 240, 12, [0, 12]), (264, 384, 24, [0, 12]), (408, 840, 24, [0])),
    o AS (SELECT DISTINCT o_custkey AS k, o_custkey % 5 AS m, o_orderkey % 4 * 6 AS hour FROM orders),
    m AS (SELECT k, hour, CASE m WHEN 0 THEN 48 WHEN 1 THEN 120 WHEN 2 THEN CASE WHEN hour IN (0, 12) THEN 360 ELSE 144 END WHEN 3 THEN 384 ELSE CASE WHEN hour = 0 THEN 840 ELSE 384 END END AS most FROM o),
    x AS (SELECT k, m.hour, most, unnest(generate_series(lo, hi, step)) AS lead FROM m JOIN b ON list_contains(b.hours, m.hour))
    SELECT k, hour::INT AS hour, lead::INT AS lead FROM x WHERE lead <= most""")
def expected_sequence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The leads of every customer's model and of the cycles of their orders."""
    names = F.array(*map(F.lit, ("ICON-D2", "ICON-EU", "ECMWF-IFS", "GFS", "GEFS-control")))
    o = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("k"), F.get(names, (F.col("o_custkey") % 5).cast("int")).alias("model"), (F.col("o_orderkey") % 4 * 6).cast("int").alias("hour")).distinct()
    return o.select("k", "hour", F.explode(leads.grid("model", "hour")).alias("lead"))


@query("""
    SELECT 'both' AS op, * FROM (SELECT c_nationkey AS k FROM customer INTERSECT SELECT s_nationkey FROM supplier)
    UNION ALL SELECT 'left_only', * FROM (SELECT c_nationkey FROM customer EXCEPT SELECT s_nationkey FROM supplier)
    UNION ALL SELECT 'either', * FROM (SELECT c_nationkey FROM customer UNION SELECT s_nationkey FROM supplier)""")
def set_ops(spark: SparkSession, sf_dir: str) -> DataFrame:
    return coverage.set_views(table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("k")), table(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("k")), ["k"])


@query("""
    WITH e AS (SELECT event_id, value > 50 AS failed, CASE event_type WHEN 'click' THEN 'received' WHEN 'view' THEN 'missing' WHEN 'purchase' THEN 'unsupported' WHEN 'error' THEN 'lost' END AS given FROM events),
    m AS (SELECT event_id, CASE WHEN given IS NULL THEN CASE WHEN failed THEN 'fetch_error' ELSE 'received' END WHEN given = 'missing' THEN 'fetch_error' WHEN given = 'unsupported' THEN 'unsupported_by_provider_or_product' ELSE given END AS s FROM e)
    SELECT event_id, CASE WHEN s <> 'lost' THEN s END AS status, CASE WHEN s = 'lost' THEN 'unknown availability status lost' END AS reject FROM m""")
def enum_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = F.create_map(*(F.lit(x) for x in ("click", "received", "view", "missing", "purchase", "unsupported", "error", "lost")))
    status, reject = C.availability_status("given", F.col("value") > 50)
    return events(spark, sf_dir).withColumn("given", F.try_element_at(words, F.col("event_type"))).select("event_id", status.alias("status"), reject.alias("reject"))


@query("""
    WITH s AS (SELECT user_id, max(ts) AS selected FROM events WHERE event_type = 'purchase' GROUP BY 1)
    SELECT e.user_id, s.selected, count(*) AS probes FROM events e JOIN s USING (user_id) WHERE e.ts >= s.selected GROUP BY ALL""")
def newest_eligible_trail(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = events(spark, sf_dir).select("user_id", "ts", (F.col("event_type") == "purchase").alias("published"))
    found = timeline.newest_eligible(e, ["user_id"], "ts", "published")
    return found.select("user_id", F.col("selected").cast("timestamp_ntz").alias("selected"), "probes")


@query("""
    WITH a AS (SELECT user_id, ts, event_id, lag(ts) OVER (PARTITION BY user_id ORDER BY event_id) AS b FROM events) SELECT user_id, bool_and(b IS NULL OR b < ts) AS axis_valid FROM a GROUP BY 1""")
def axis_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    return timeline.axis_valid(events(spark, sf_dir), ["user_id"], "event_id", "ts")


@query("""SELECT l_returnflag, count(*) AS records, count(*) FILTER (l_discount > 0) AS derived_records, count(*) FILTER (l_discount > 0) > 0 AS success, count(*) FILTER (l_discount > 0) >= 100 AS complete FROM lineitem GROUP BY 1""")
def quality_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return coverage.quality(table(spark, sf_dir, "lineitem"), ["l_returnflag"], F.col("l_discount") > 0, F.lit(100))


@query("""
    SELECT l_orderkey, l_linenumber, max(p) AS price FROM (SELECT l_orderkey, l_linenumber, max(l_extendedprice) AS p FROM lineitem WHERE l_returnflag = 'R' GROUP BY ALL
    UNION ALL SELECT l_orderkey, l_linenumber, max(l_extendedprice) FROM lineitem l WHERE NOT EXISTS (SELECT 1 FROM lineitem r WHERE r.l_returnflag = 'R' AND r.l_orderkey = l.l_orderkey AND r.l_linenumber = l.l_linenumber) GROUP BY ALL) GROUP BY ALL""")
def upsert_patch(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", "l_extendedprice")
    best = lambda df: df.groupBy("l_orderkey", "l_linenumber").agg(F.max("l_extendedprice").alias("price"))
    return coverage.upsert(best(lines), best(lines.where("l_returnflag = 'R'")), ["l_orderkey", "l_linenumber"])


@query("""SELECT event_id, strftime(ts, '%Y%m%d%H') AS cycle, 'model=' || event_type || '/year=' || strftime(ts, '%Y') || '/month=' || strftime(ts, '%m') || '/day=' || strftime(ts, '%d') || '/run=' || strftime(ts, '%H') AS path FROM events""")
def evidence_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir).select("event_id", C.cycle_id("ts").alias("cycle"), C.evidence_path("event_type", "ts").alias("path"))


@query("""
    WITH w(code, hours) AS (VALUES ('0m-15m', 0.25), ('0m-90m', 1.5), ('0-3', 3.0), ('6', 6.0), ('1d', 24.0), ('', NULL))
    SELECT n_nationkey, code, hours::DOUBLE AS hours FROM nation, w""")
def step_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    codes = F.lit(["0m-15m", "0m-90m", "0-3", "6", "1d", ""])
    n = table(spark, sf_dir, "nation").select("n_nationkey", F.explode(codes).alias("code"))
    return n.select("n_nationkey", "code", C.step_end_hours("code").alias("hours"))


@query("SELECT l_orderkey, count(DISTINCT round(l_discount, 6)) > 1 AS moved, count(DISTINCT round(l_discount, 6)) AS points FROM lineitem GROUP BY 1")
def grid_points_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return coverage.distinct_points(table(spark, sf_dir, "lineitem"), ["l_orderkey"], "l_discount")


@query("""
    SELECT l_orderkey AS k, max(CASE WHEN l_returnflag = 'A' THEN l_linenumber END) AS "A", max(CASE WHEN l_returnflag = 'N' THEN l_linenumber END) AS "N", max(CASE WHEN l_returnflag = 'R' THEN l_linenumber END) AS "R" FROM lineitem GROUP BY 1""")
def max_lead_by_field(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("k"), F.col("l_returnflag").alias("field"), F.col("l_linenumber").alias("lead"))
    return records.max_leads(files, ["k"], ["A", "N", "R"])


@query("""
    WITH m(n, model, family) AS (VALUES (1, 'ICON-D2', 'DWD-ICON'), (2, 'ICON-EU', 'DWD-ICON'), (3, 'ECMWF-IFS', 'ECMWF'), (4, 'GFS', 'GFS'), (5, 'GEFS-control', 'GFS'), (6, 'ICON-D2-EPS', 'DWD-ICON'), (7, 'ICON-D2', 'DWD-ICON')),
    j AS (SELECT l_orderkey AS k, model, family, l_discount > 0.03 AS good FROM lineitem JOIN m ON n = l_linenumber)
    SELECT k, count(DISTINCT model) FILTER (good) >= 2 AS two_models, count(DISTINCT family) FILTER (good AND model <> 'GEFS-control') >= 2 AS two_families_without_gefs, count(DISTINCT family) FILTER (good) >= 2 AS two_families_with_gefs FROM j GROUP BY 1""")
def independent_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = F.lit(["ICON-D2", "ICON-EU", "ECMWF-IFS", "GFS", "GEFS-control", "ICON-D2-EPS", "ICON-D2"])
    lines = table(spark, sf_dir, "lineitem").where("l_linenumber <= 7").select(F.col("l_orderkey").alias("k"), F.get(names, F.col("l_linenumber") - 1).alias("model"), (F.col("l_discount") > 0.03).alias("good"))
    return coverage.two_model_rules(lines, ["k"], "model", F.col("good"))


@query("""
    SELECT o_orderkey, l_linenumber FROM orders JOIN lineitem ON o_orderkey = l_orderkey WHERE l_linenumber <= 3 AND o_orderstatus = 'F'
    UNION ALL SELECT o_orderkey, l_linenumber FROM orders JOIN lineitem ON o_orderkey = l_orderkey WHERE l_linenumber > 3 AND o_orderstatus = 'O'""")
def base_and_extension(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_linenumber").join(o, "o_orderkey")
    part = lambda s: lines.where(F.col("o_orderstatus") == s).select("o_orderkey", "l_linenumber")
    return records.extend_base(part("F"), part("O"), "l_linenumber", 3)


@query(f"SELECT event_id, value FROM events WHERE ts >= TIMESTAMP '{_NOW}' - INTERVAL 21 DAYS AND ts <= TIMESTAMP '{_NOW}' + INTERVAL 15 MINUTES")
def retention_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").where(C.retained("ts", F.lit(_NOW).cast("timestamp_ntz"))).select("event_id", "value")


@query("""
    WITH x AS (SELECT l_orderkey, l_linenumber, row_number() OVER (PARTITION BY l_returnflag ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey) AS n, l_returnflag FROM lineitem WHERE l_discount > 0.09)
    SELECT l_returnflag, l_orderkey, l_linenumber, n FROM x WHERE n <= 20""")
def bounded_examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first twenty of each kind: here the limit is the feature."""
    bad = table(spark, sf_dir, "lineitem").where("l_discount > 0.09")
    return timeline.top(bad, ["l_returnflag"], ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"], 20).select("l_returnflag", "l_orderkey", "l_linenumber", "n")


@query("""
    SELECT l_orderkey AS k, l_linenumber AS lead, count(*) AS parts, count(DISTINCT l_returnflag) > 1 AS conflict FROM lineitem GROUP BY ALL""")
def product_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("k"), F.col("l_linenumber").alias("lead"), F.col("l_returnflag").alias("point"), F.array("l_partkey").alias("v"))
    merged = coverage.merge_products(parts, ["k", "lead"], "point", "v")
    return merged.select("k", "lead", F.size("v").cast("long").alias("parts"), "conflict")


@query("""
    SELECT vec_id, i - 1 AS pos, embedding[i]::DOUBLE AS speed, embedding[i + 20]::DOUBLE AS direction FROM embeddings, generate_series(1, 20) s(i) WHERE embedding[i + 40] > 0""")
def positional_zip(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = lambda a, n: F.slice("embedding", a, 20).alias(n)
    e = table(spark, sf_dir, "embeddings").select("vec_id", F.sequence(F.lit(0), F.lit(19)).alias("pos"), part(1, "speed"), part(21, "direction"), part(41, "gust"))
    rows = grib_text.zipped(e, ["vec_id"], ["pos", "speed", "direction", "gust"])
    return rows.where("gust > 0").select("vec_id", F.col("pos").cast("long").alias("pos"), F.col("speed").cast("double").alias("speed"), F.col("direction").cast("double").alias("direction"))


@query("""
    WITH r AS (SELECT c_custkey AS k, c_acctbal AS v FROM customer) SELECT k, v BETWEEN 0 AND 360 AS direction_ok, v >= 0 AS speed_ok, abs(v - 500) <= 300 AS near FROM r""")
def valid_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = F.col("c_acctbal")
    return table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k"), (C.finite(v) & v.between(0, 360)).alias("direction_ok"), (C.finite(v) & (v >= 0)).alias("speed_ok"), (F.abs(v - 500) <= 300).alias("near"))


@query("""
    SELECT o_custkey AS k, CASE WHEN count(DISTINCT o_orderdate) = 1 THEN min(o_orderdate) END AS run, CASE WHEN count(DISTINCT o_orderdate) <> 1 THEN 'expected one cycle, found ' || count(DISTINCT o_orderdate) END AS reject FROM orders GROUP BY 1""")
def run_uniqueness(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records.one_cycle(table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("k"), F.col("o_orderdate").alias("run")), ["k"])


@query("""
    WITH j AS (SELECT o_orderkey, '{"a":' || o_custkey || ',"b":[' || o_orderkey % 7 || ',"' || o_orderstatus || '"],"c":null,"z":{"m":true,"n":"' || trim(o_orderpriority) || '"}}' AS canonical FROM orders)
    SELECT o_orderkey, canonical, sha256(canonical) AS sha FROM j""")
def canonical_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Objects whose keys come in another order than the canonical one."""
    text = F.format_string('{"z": {"n": "%s", "m": true}, "c": null, "b": [%s, "%s"], "a": %s}', F.trim("o_orderpriority"), (F.col("o_orderkey") % 7).cast("string"), "o_orderstatus", F.col("o_custkey").cast("string"))
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.try_parse_json(text).alias("v"))
    return o.select("o_orderkey", F.to_json("v").alias("canonical"), V.canonical_sha("v").alias("sha"))
