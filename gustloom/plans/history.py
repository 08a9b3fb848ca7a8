"""Queries of streams with state, reads as of a time and carried archives over the driver's tables, each beside its DuckDB form."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gustloom.functions import variants as V
from gustloom.operators import asof, leads
from gustloom.plans.catalog import query, table
from gustloom.rules import carry
from gustloom.sinks import assembly
from gustloom.sources import bundles, ensemble_responses, stations
from gustloom.streaming import stateful
from gustloom.streaming.folders import Folder

#: Arrivals that the stream queries deal the events into. Each is a run of its own that goes on from the checkpoint.
ARRIVALS = 3


def _arriving(spark: SparkSession, rows: DataFrame, build, folder: Folder) -> DataFrame:
    """Run a stream over rows that arrive by their column ``arrival``; all that it has written."""
    rows = folder.table("all", rows)
    for i in range(ARRIVALS):
        rows.where(F.col("arrival") == i).drop("arrival").write.parquet(folder.path(f"in/arrival={i}"))
        stream = build(spark.readStream.schema(rows.drop("arrival").schema).parquet(folder.path("in/*")))
        stateful.run(stream, folder.path("checkpoint"), folder.path("out")).awaitTermination()
    return stateful.written(spark, folder.path("out"), stream.schema)


@query("""
    WITH a AS (SELECT user_id, event_type, ts, (event_id % 4)::INT AS missing, event_id % 7 = 0 AS tried FROM events),
    counted AS (SELECT *, sum(tried::INT) OVER (PARTITION BY user_id, event_type ORDER BY ts, missing ROWS UNBOUNDED PRECEDING)::INT AS attempts, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, missing DESC) AS n FROM a),
    s AS (SELECT *, CASE WHEN missing = 0 THEN CASE WHEN attempts > 0 THEN 'complete' ELSE 'not_needed' END WHEN attempts >= 4 THEN 'exhausted' ELSE 'pending' END AS state FROM counted)
    SELECT user_id, event_type, state, attempts, CASE WHEN state = 'pending' THEN ts + INTERVAL 3 HOURS END AS not_before FROM s WHERE n = 1""")
def retry_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Attempts that arrive in three batches, late ones among them, with a restart after each."""
    rows = table(spark, sf_dir, "events").select("user_id", "event_type", F.col("ts").cast("timestamp").alias("at"), (F.col("event_id") % 4).cast("int").alias("missing"), (F.col("event_id") % 7 == 0).alias("tried"), (F.col("event_id") * 5 % 11 % ARRIVALS).cast("int").alias("arrival"))
    key = ["user_id", "event_type"]
    out = _arriving(spark, rows, lambda s: stateful.retries(s, key, lateness="400 days", most=4), Folder(spark, "retries"))
    last = out.where("kind = 'state'").groupBy(*key).agg(F.max_by(F.struct("state", "attempts", "not_before"), "batch").alias("x"))
    return last.select(*key, "x.state", "x.attempts", F.col("x.not_before").cast("timestamp_ntz").alias("not_before"))


@query("""
    WITH w AS (SELECT user_id || '/' || event_type AS path, sha256(event_id % 3 || '') AS sha256, ts, event_id * 5 % 11 % 3 AS arrival FROM events),
    first AS (SELECT path, arg_min(sha256, (arrival, ts, sha256)) AS kept_sha256 FROM w GROUP BY 1)
    SELECT DISTINCT path, CASE WHEN sha256 = kept_sha256 THEN 'written' ELSE 'conflict' END AS outcome, sha256, kept_sha256 FROM w JOIN first USING (path)""")
def first_write_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Writes to one path a user and kind of event: the first bytes to arrive stay, others come out as conflicts."""
    rows = table(spark, sf_dir, "events").select(F.concat_ws("/", F.col("user_id").cast("string"), "event_type").alias("path"), F.sha2((F.col("event_id") % 3).cast("string"), 256).alias("sha256"), F.col("ts").cast("timestamp").alias("at"), (F.col("event_id") * 5 % 11 % ARRIVALS).cast("int").alias("arrival"))
    return _arriving(spark, rows, stateful.first_writes, Folder(spark, "writes")).select("path", "outcome", "sha256", "kept_sha256")


_FACTS = """
    facts AS (SELECT l_returnflag AS field, date_trunc('month', l_shipdate)::TIMESTAMP AS valid, l_shipdate + INTERVAL 1 DAY * (l_suppkey % 40) AS revision,
      CASE WHEN l_partkey % 11 > 0 THEN l_shipdate + INTERVAL 1 DAY * (l_partkey % 50) END AS available, l_extendedprice AS value FROM lineitem),
    f AS (SELECT field, valid, revision, min(available) AS available, max(value) AS value FROM facts GROUP BY ALL),
    r AS (SELECT o_orderkey, (['A', 'N', 'R', 'X'])[1 + o_orderkey % 4] AS field, date_trunc('month', o_orderdate)::TIMESTAMP AS valid, o_orderdate + INTERVAL 1 DAY * (o_custkey % 90) AS at FROM orders)"""


@query(f"""
    WITH {_FACTS},
    seen AS (SELECT o_orderkey, f.*, row_number() OVER (PARTITION BY o_orderkey ORDER BY revision DESC) AS n FROM r JOIN f ON r.field = f.field AND r.valid = f.valid AND greatest(f.revision, f.available) <= r.at AND f.available IS NOT NULL),
    ever AS (SELECT DISTINCT field, valid FROM f WHERE available IS NOT NULL)
    SELECT r.o_orderkey, r.field, r.valid, r.at, s.revision, s.available, s.value, CASE WHEN s.revision IS NOT NULL THEN 'received' WHEN e.field IS NOT NULL THEN 'not_yet_known' ELSE 'never_known' END AS status
    FROM r LEFT JOIN seen s ON s.o_orderkey = r.o_orderkey AND s.n = 1 LEFT JOIN ever e ON e.field = r.field AND e.valid = r.valid""")
def known_at(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What was known at a time about a month: the newest revision of a field that was there and whose field was."""
    facts, requests = _facts(spark, sf_dir)
    return asof.known(requests, facts, ["field", "valid"], "at", ["value"]).select("o_orderkey", "field", "valid", "at", "revision", "available", "value", "status")


def _facts(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    plain = lambda c: F.col(c).cast("timestamp_ntz")
    days = lambda n: F.make_dt_interval(days=n.cast("int"))
    month = lambda c: F.date_trunc("month", plain(c)).cast("timestamp_ntz")
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_returnflag").alias("field"), month("l_shipdate").alias("valid"), (plain("l_shipdate") + days(F.col("l_suppkey") % 40)).alias("revision"),
        F.when(F.col("l_partkey") % 11 > 0, plain("l_shipdate") + days(F.col("l_partkey") % 50)).alias("available"), F.col("l_extendedprice").alias("value"),
    )
    facts = lines.groupBy("field", "valid", "revision").agg(F.min("available").alias("available"), F.max("value").alias("value"))
    letters = F.element_at(F.array(*map(F.lit, "ANRX")), (F.col("o_orderkey") % 4 + 1).cast("int"))
    return facts, table(spark, sf_dir, "orders").select("o_orderkey", letters.alias("field"), month("o_orderdate").alias("valid"), (plain("o_orderdate") + days(F.col("o_custkey") % 90)).alias("at"))


@query(f"""
    WITH {_FACTS},
    k AS (SELECT *, greatest(revision, available) AS known_from FROM f WHERE available IS NOT NULL),
    s AS (SELECT *, (SELECT min(j.known_from) FROM k j WHERE j.field = k.field AND j.valid = k.valid AND j.revision > k.revision) AS known_to FROM k)
    SELECT field, valid, revision, known_from, known_to, value FROM s WHERE known_to IS NULL OR known_from < known_to""")
def known_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return asof.intervals(_facts(spark, sf_dir)[0], ["field", "valid"]).select("field", "valid", "revision", "known_from", "known_to", "value")


def _grid_rows() -> str:
    """(model, hour, leads) of the acquisition grid beyond the compatibility horizon, as SQL rows, by the grid's bands."""
    native = lambda m, h: {"ICON-EU": 120 if h in leads.SYNOPTIC else 51, "ECMWF-IFS": 360 if h in (0, 12) else 144, "GFS": 384, "GEFS-control": 840 if h == 0 else 384}.get(m, 48)
    rows = []
    for m in leads.MODELS:
        for h in leads.SYNOPTIC:
            most, near = native(m, h), 90 if m == "ECMWF-IFS" and h in (6, 18) else min(120, native(m, h))
            grid = [x for a, b, step, hours in leads.BANDS if h in hours for x in range(a, b + 1, step) if x <= most]
            rows.append(f"('{m}', {h}, {[x for x in grid if x > near]}::INT[], {max(grid)})")
    return ", ".join(rows)


@query(f"""
    WITH grid(model, hour, wanted, top) AS (VALUES {_grid_rows()}),
    o AS (SELECT o_orderkey AS k, (['{"', '".join(leads.MODELS)}'])[1 + o_custkey % 6] AS model, o_orderkey % 4 * 6 AS hour, o_orderkey % 3 AS kind FROM orders),
    l AS (SELECT l_orderkey AS k, (120 + l_partkey % 30 * 12)::INT AS lead FROM lineitem),
    r AS (SELECT k, model, hour, kind, wanted, top, coalesce(list(DISTINCT lead ORDER BY lead) FILTER (lead IS NOT NULL), []) AS leads FROM o JOIN grid USING (model, hour) LEFT JOIN l USING (k) GROUP BY ALL),
    s AS (SELECT *, list_filter(leads, lambda x: list_contains(wanted, x)) AS kept, list_filter(leads, lambda x: NOT list_contains(wanted, x)) AS gone FROM r)
    SELECT k::VARCHAR AS path, model, array_to_string(kept, ',') AS kept, array_to_string(kept, ',') AS statuses, array_to_string(gone, ',') AS dropped, CASE WHEN len(kept) > 0 THEN 2 ELSE 1 END AS errors,
      kind = 0 OR len(gone) > 0 AS reconciled, CASE WHEN kind = 0 OR len(gone) > 0 THEN CASE kind WHEN 0 THEN 'acquisition-grid-v1' ELSE 'acquisition-grid-v2' END END AS former, 'acquisition-grid-v2' AS version, top AS most, 'kept' AS other
    FROM s WHERE kind < 2
    UNION ALL SELECT k::VARCHAR, model, NULL, NULL, NULL, NULL, false, NULL, NULL, NULL, NULL FROM s WHERE kind = 2""")
def carried_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archive sources written under the older grid, under the present one, and broken ones, under the contract of now."""
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"), F.element_at(F.array(*map(F.lit, leads.MODELS)), (F.col("o_custkey") % 6 + 1).cast("int")).alias("model"), (F.col("o_orderkey") % 4 * 6).cast("int").alias("hour"), (F.col("o_orderkey") % 3).alias("kind"))
    lines = bundles.spread(table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("k"), "l_partkey"), "k").groupBy("k").agg(F.array_sort(F.collect_set((120 + F.col("l_partkey") % 30 * 12).cast("int"))).alias("leads"))
    rows = bundles.spread(o, "k").join(lines.hint("merge"), "k", "left").withColumn("leads", F.coalesce("leads", F.array().cast("array<int>")))
    listed = F.array_join("leads", ",")
    records = F.array_join(F.transform("leads", lambda h: F.concat(F.lit('{"forecast_lead_hours":'), h.cast("string"), F.lit(',"v":1}'))), ",")
    statuses = F.array_join(F.transform("leads", lambda h: F.concat(F.lit('"'), h.cast("string"), F.lit('":{"status":"received"}'))), ",")
    now = F.to_json(leads.extension("model", "hour"))
    json = F.concat(
        F.lit('{"run_time_utc":"2026-09-25T'), F.lpad(F.col("hour").cast("string"), 2, "0"), F.lit(':00:00Z","other":"kept","acquisition_grid_version":"'), F.when(F.col("kind") == 0, "acquisition-grid-v1").otherwise("acquisition-grid-v2"),
        F.lit('","retention_grid_version":"acquisition-grid-v2","acquisition_max_lead_hours":'), F.array_max(leads.grid("model", "hour")).cast("string"), F.lit(',"requested_extension_leads":'), F.when(F.col("kind") == 0, "[]").otherwise(now),
        F.lit(',"records":['), records, F.when(F.col("kind") == 2, F.concat(F.when(F.size("leads") > 0, ",").otherwise(""), F.lit('{"forecast_lead_hours":true}'))).otherwise(""), F.lit('],"lead_status":{'), statuses,
        F.lit('},"errors":[{"reason":"late","leads":['), listed, F.lit(']},{"reason":"other"}]}'),
    )
    bundles_ = bundles.from_text(rows.select(F.col("k").cast("string").alias("k"), F.concat(F.lit('{"full_horizon_archive":{"sources":{"'), "model", F.lit('":'), json, F.lit("}}}")).alias("json")), "k", "json")
    out = carry.carried(carry.archive_sources(bundles_), F.lit("2026-09-26T00:00:00Z").cast("timestamp"))
    s = lambda p: V.text("source", p)
    known = F.col("source").isNotNull()
    joined = lambda xs: F.when(known, F.array_join(xs, ","))
    return out.select(
        "path", "model", joined(F.transform(V.items("source", "$.records"), lambda r: V.text(r, "$.forecast_lead_hours"))).alias("kept"), joined(F.transform(F.array_sort(F.transform(F.map_keys(V.entries("source", "$.lead_status")), lambda k: k.cast("int"))), lambda k: k.cast("string"))).alias("statuses"),
        F.when(known, F.array_join("dropped_leads", ",")).alias("dropped"), F.when(known, F.size(V.items("source", "$.errors"))).alias("errors"), "reconciled", s("$.carry_forward_contract_reconciliation.previous_contract.acquisition_grid_version").alias("former"),
        s("$.acquisition_grid_version").alias("version"), V.strict_int("source", "$.acquisition_max_lead_hours").alias("most"), s("$.other").alias("other"),
    )


_TILL = "2024-01-20 00:00:00"


@query(f"""
    WITH e AS (SELECT user_id, event_type, date_trunc('day', ts)::DATE AS day, ts, value, ts > TIMESTAMP '{_TILL}' + INTERVAL 15 MINUTES AS future, value > 120 AND user_id % 4 > 0 AS kept FROM events),
    d AS (SELECT user_id, event_type, day, min(ts) AS first_time, max(ts) AS last_time, arg_max(value, ts) AS latest_value, count(*) AS n FROM e WHERE kept AND NOT future GROUP BY ALL),
    f AS (SELECT user_id, event_type, day, count(*) FILTER (future) AS future_count FROM e WHERE kept GROUP BY ALL),
    b AS (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY last_time DESC, day DESC) AS r FROM d JOIN f USING (user_id, event_type, day)),
    q AS (SELECT user_id, event_type, day, epoch(day) // 86400 % 5 > 0 AND (user_id + epoch(day) // 86400) % 8 > 0 AND user_id % 8 <> 4 AS success, count(*) FILTER (kept) AS n FROM e GROUP BY ALL),
    a AS (SELECT user_id, event_type, bool_or(success) AS answered, coalesce(bool_and(n = 0) FILTER (success), false) AS nothing FROM q GROUP BY ALL)
    SELECT user_id, event_type, CASE WHEN b.n > 0 THEN 'received' WHEN nothing THEN 'empty_despite_success' ELSE 'request_or_parse_failure' END AS availability, b.day::VARCHAR AS source_day, coalesce(b.n, 0) AS n, first_time, last_time, latest_value,
      round((epoch_us(TIMESTAMP '{_TILL}') - epoch_us(last_time)) / 60000000.0::DOUBLE, 2) AS age_minutes, future_count, answered
    FROM a LEFT JOIN b USING (user_id, event_type) WHERE coalesce(r, 1) = 1""")
def newest_day_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Charts by user, kind and day: some users' are always empty, some requests fail, and points may lie in the future."""
    e = table(spark, sf_dir, "events").select("user_id", "event_type", F.to_date("ts").alias("day"), F.col("ts").alias("time"), "value", (F.col("ts") > F.lit(_TILL).cast("timestamp_ntz") + F.expr("interval 15 minutes")).alias("future"), ((F.col("value") > 120) & (F.col("user_id") % 4 > 0)).alias("kept"))
    days = F.unix_date("day")
    asked = e.groupBy("user_id", "event_type", "day").agg(F.count_if("kept").alias("n")).withColumn("success", (days % 5 > 0) & ((F.col("user_id") + days) % 8 > 0) & (F.col("user_id") % 8 != 4))
    return stations.newest_day(e.where("kept"), asked, ["user_id", "event_type"], F.lit(_TILL).cast("timestamp_ntz")).withColumn("source_day", F.col("source_day").cast("string"))


@query("""
    WITH b AS (SELECT l_orderkey % 7 AS batch, 'b' || l_suppkey % 5 AS path, l_returnflag AS model, l_linenumber::INT AS lead, l_linestatus AS field, l_shipdate AS t, CASE WHEN l_partkey % 3 > 0 THEN l_extendedprice END AS value, 'e' || l_partkey % 7 AS error FROM lineitem),
    c AS (SELECT path, model, lead, field, arg_max(value, (t, value)) FILTER (value IS NOT NULL) AS value, max(t) FILTER (value IS NOT NULL) AS got_at, arg_max(error, (t, error)) FILTER (value IS NULL) AS error, max(t) FILTER (value IS NULL) AS lost_at FROM b WHERE batch < 3 GROUP BY ALL)
    SELECT path, model, lead, field, value, CASE WHEN lost_at IS NOT NULL AND (got_at IS NULL OR lost_at > got_at) THEN error END AS error FROM c""")
def assembled_bundles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bundles merged from three batches, the newest first; each merge writes the bundles that it touches."""
    out = Folder(spark, "bundles").path("bundles")
    lines = table(spark, sf_dir, "lineitem").select(
        (F.col("l_orderkey") % 7).alias("batch"), F.concat(F.lit("b"), (F.col("l_suppkey") % 5).cast("string")).alias("path"), F.col("l_returnflag").alias("model"), F.col("l_linenumber").alias("lead"), F.col("l_linestatus").alias("field"),
        F.col("l_shipdate").cast("timestamp").alias("at"), F.when(F.col("l_partkey") % 3 > 0, F.col("l_extendedprice")).alias("value"), F.concat(F.lit("e"), (F.col("l_partkey") % 7).cast("string")).alias("error"),
    )
    for batch in (2, 0, 1):
        assembly.merge(spark, out, lines.where(F.col("batch") == batch).drop("batch"), ["F", "O"])
    r = assembly.records(spark, out)
    fields = r.withColumn("field", F.explode(F.array_distinct(F.concat(F.map_keys("values"), F.map_keys("errors")))))
    return fields.select("path", "model", "lead", "field", F.try_element_at("values", "field").alias("value"), F.try_element_at("errors", "field").alias("error"))


#: Hours of the made responses, and the leads that records are made of; the last one is beyond the axis.
_AXIS, _LEADS = 12, (0, 3, 6, 9, 12, 15)
_MADE = f"""
    e AS (SELECT vec_id AS k, list_transform(embedding, lambda x: floor(abs(x::DOUBLE) * 1000)::BIGINT / 10.0::DOUBLE) AS w FROM embeddings),
    v AS (SELECT k, m, h, w[1 + (m * 7 + h) % 64] AS speed, (w[1 + (m * 11 + h) % 64] * 37)::BIGINT % 360 AS direction, w[1 + (m * 5 + h) % 64] + 1 AS gust, NOT (k % 7 = 3 AND m = 3 AND h = 6) AS there
      FROM e, range(20) a(m), range({_AXIS + 1}) b(h)),
    bad AS (SELECT k, list_filter([CASE WHEN k % 11 = 1 THEN 'run_not_settled_or_no_cycle' END, CASE WHEN k % 13 = 1 THEN 'wind_member_identity_mismatch' END, CASE WHEN k % 17 = 1 THEN 'run_metadata_changed' END, CASE WHEN k % 19 = 1 THEN 'utc_offset_not_zero' END,
      CASE WHEN k % 23 = 1 THEN 'unexpected_wind_units' END, CASE WHEN k % 29 = 1 THEN 'returned_coordinate_missing' END, CASE WHEN k % 31 = 1 THEN 'returned_coordinate_implausible' END,
      CASE WHEN k % 37 = 1 THEN 'time_axis_unordered_or_repeated' END, CASE WHEN k % 41 = 1 THEN 'values_not_as_long_as_axis' END], lambda x: x IS NOT NULL) AS refusals FROM e)"""


def _responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Responses of twenty members made of vectors; each fault is in those of its own remainder."""
    k = F.col("vec_id")
    tenths = F.transform("embedding", lambda x: F.floor(F.abs(x.cast("double")) * 1000) / 10.0)
    rows = table(spark, sf_dir, "embeddings").select(k.alias("k"), tenths.alias("w")).repartition("k")  # a vector becomes a long text
    k, w = F.col("k"), F.col("w")
    stamp = lambda h: f"2026-09-25T{h:02d}:00"
    stamps = [stamp(h) for h in range(_AXIS + 1)]
    swapped = [stamps[1], stamps[0], *stamps[2:]]
    axis = F.when(k % 37 == 1, '["' + '","'.join(swapped) + '"]').otherwise('["' + '","'.join(stamps) + '"]')
    hours = F.sequence(F.lit(0), F.lit(_AXIS))

    def column(m: Column, name: str, value) -> Column:
        key = F.concat(F.lit(f'"{name}'), F.when(m == 0, "").otherwise(F.concat(F.lit("_member"), F.lpad(m.cast("string"), 2, "0"))), F.lit('":['))
        cut = F.when((k % 41 == 1) & (m == 2) & F.lit(name == "wind_speed_10m"), F.slice(hours, 1, _AXIS)).otherwise(hours)
        cells = F.transform(cut, lambda h: F.when((k % 7 == 3) & (m == 3) & (h == 6) & F.lit(name == "wind_speed_10m"), "null").otherwise(value(h).cast("string")))
        return F.concat(key, F.array_join(cells, ","), F.lit("]"))

    at = lambda m, n, h: F.get(w, ((m * n + h) % 64).cast("int"))
    members = F.sequence(F.lit(0), F.lit(19))
    named = lambda name, value: F.array_join(F.transform(members if name != "wind_gusts_10m" else F.when(k % 13 == 1, F.slice(members, 1, 19)).otherwise(members), lambda m: column(m, name, lambda h: value(m, h))), ",")
    json = F.concat(
        F.lit('{"utc_offset_seconds":'), F.when(k % 19 == 1, "3600").otherwise("0"), F.lit(',"hourly_units":{"wind_speed_10m":"'), F.when(k % 23 == 1, "km/h").otherwise("m/s"), F.lit('","wind_gusts_10m":"m/s"},"latitude":'), F.when(k % 31 == 1, "51.1").otherwise("52.5"),
        F.when(k % 29 == 1, "").otherwise(',"longitude":9.34'), F.lit(',"hourly":{"time":'), axis, F.lit(","), named("wind_speed_10m", lambda m, h: at(m, 7, h)), F.lit(","), named("wind_direction_10m", lambda m, h: (at(m, 11, h) * 37).cast("long") % 360), F.lit(","),
        named("wind_gusts_10m", lambda m, h: at(m, 5, h) + 1), F.lit("}}"),
    )
    t = lambda x: F.lit(x).cast("timestamp")
    meta = lambda changed: F.struct(t("2026-09-25T00:00:00Z").alias("last_run_initialisation_time_utc"), t("2026-09-25T01:30:00Z").alias("last_run_availability_time_utc"), F.when(changed, t("2026-09-25T01:40:00Z")).otherwise(t("2026-09-25T01:31:00Z")).alias("last_run_modification_time_utc"))
    return rows.select(k.alias("path"), F.parse_json(json).alias("payload"), meta(F.lit(False)).alias("before"), meta(k % 17 == 1).alias("after"), F.when(k % 11 == 1, t("2026-09-25T01:39:59Z")).otherwise(t("2026-09-25T01:40:00Z")).alias("asked_at"))


@query(f"""
    WITH {_MADE}
    SELECT k AS path, array_to_string(refusals, ',') AS refusals,
      array_to_string(list_filter([CASE WHEN k % 13 = 1 THEN 'hourly_member_set_mismatch_gust' END, CASE WHEN k % 7 = 3 OR k % 41 = 1 THEN 'hourly_value_not_finite_speed' END], lambda x: x IS NOT NULL), ',') AS hourly_faults FROM bad""")
def ensemble_refusals(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = ensemble_responses.checked(_responses(spark, sf_dir), hours=_AXIS)
    return out.select("path", F.array_join("refusals", ",").alias("refusals"), F.array_join("hourly_faults", ",").alias("hourly_faults"))


@query(f"""
    WITH {_MADE},
    l AS (SELECT k, lead FROM bad, (SELECT unnest({list(_LEADS)}) AS lead) WHERE len(refusals) = 0),
    s AS (SELECT k, h AS lead, count(*)::INT AS members, round(quantile_cont(speed, 0.5), 3) AS speed, round(quantile_cont(gust, 0.5), 3) AS gust, round(max(gust) - min(speed), 3) AS spread FROM v WHERE there GROUP BY ALL)
    SELECT l.k AS path, l.lead::INT AS lead, coalesce(members, 0) AS members, s.speed, s.gust, CASE WHEN members = 20 THEN round(s.speed, 3) END AS derived_speed,
      CASE WHEN l.lead > {_AXIS} THEN 'valid_time_not_on_axis' WHEN members < 20 THEN 'members_incomplete: 3' END AS error FROM l LEFT JOIN s ON s.k = l.k AND s.lead = l.lead""")
def ensemble_lead_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = Folder(spark, "responses").table("checked", ensemble_responses.checked(_responses(spark, sf_dir), hours=_AXIS))
    out = ensemble_responses.records(rows, F.lit(list(_LEADS)))
    return out.select("path", "lead", F.greatest(F.lit(0), F.coalesce(F.size("members"), F.lit(0))).alias("members"), F.round("statistics.median", 3).alias("speed"), F.round("statistics.gust_median", 3).alias("gust"), F.col("derived.wind_speed_ms").alias("derived_speed"), "error")
