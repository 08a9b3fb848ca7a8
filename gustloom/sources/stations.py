"""Station and listing inputs as typed rows: sensor JSON, chart series, METAR reports, zipped CSV, directory pages."""

from __future__ import annotations

import csv
import io
import re
import zipfile
import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gustloom.functions import columns as C
from gustloom.functions import variants as V

# Sensor type and data structures of the weather station's API.
SENSOR_TYPE, CURRENT, HISTORIC = 48, 2, 4


def sensor_rows(payloads: DataFrame, structure: int) -> DataFrame:
    """(path, row): data rows, objects only, of the first sensor that has the wanted type and structure."""
    wanted = lambda s: F.coalesce((V.number(s, "$.sensor_type") == SENSOR_TYPE) & (V.number(s, "$.data_structure_type") == structure), F.lit(False))
    sensor = F.get(F.filter(V.items("payload", "$.sensors"), wanted), 0)
    rows = payloads.select("path", sensor.alias("s")).select("path", F.explode(V.items("s", "$.data")).alias("row"))
    return rows.where(V.is_object("row"))


def _loose(row: str, path: str) -> Column:
    """A number, or text that reads as one."""
    return F.coalesce(V.number(row, path), V.text(row, path).try_cast("double"))


def _time() -> Column:
    return F.timestamp_seconds(_loose("row", "$.ts")).alias("time")


def current_observation(payloads: DataFrame) -> DataFrame:
    """The newest row of each payload's sensor: the mean of ten minutes, the speed of the moment, the gust of ten minutes, the direction in degrees."""
    speed = lambda path, name: C.mph_to_ms(_loose("row", path)).alias(name)
    typed = sensor_rows(payloads, CURRENT).select(
        "path", _time(), speed("$.wind_speed_10_min_avg", "wind_speed_ms"), speed("$.wind_speed", "wind_speed_instant_ms"), speed("$.wind_gust_10_min", "wind_gust_ms"), _loose("row", "$.wind_dir").alias("wind_direction_deg"),
    )
    fields = ("time", "wind_speed_ms", "wind_speed_instant_ms", "wind_gust_ms", "wind_direction_deg")
    return typed.where("time is not null").groupBy("path").agg(F.max_by(F.struct(*fields), "time").alias("latest")).select("path", "latest.*")


def historic_observations(payloads: DataFrame) -> DataFrame:
    """Rows of the archive; those without a time are dropped. Directions, of the wind and of the highest speed, come as sixteenths."""
    sector = lambda path, name: C.sector_degrees(_loose("row", path)).alias(name)
    return sensor_rows(payloads, HISTORIC).select(
        "path", _time(), C.mph_to_ms(_loose("row", "$.wind_speed_avg")).alias("wind_speed_ms"), C.mph_to_ms(_loose("row", "$.wind_speed_hi")).alias("wind_gust_ms"),
        sector("$.wind_dir_of_prevail", "wind_direction_deg"), sector("$.wind_dir_of_hi", "wind_gust_direction_deg"), _loose("row", "$.wind_num_samples").cast("int").alias("wind_samples"),
    ).where("time is not null")


def historic_series(payloads: DataFrame) -> DataFrame:
    """(path, observations): each payload's archive rows as one array, by time. A payload bounds it."""
    rows = historic_observations(payloads)
    return rows.groupBy("path").agg(F.array_sort(F.collect_list(F.struct(*[c for c in rows.columns if c != "path"]))).alias("observations"))


def chart_series(payloads: DataFrame, now: Column) -> DataFrame:
    """(path, time, value, future): points of a chart, in UTC without a zone; future ones are marked, not dropped."""
    points = payloads.select("path", F.explode(V.items("payload", "$.data.data")).alias("p"))
    time = F.try_to_timestamp(V.text("p", "$.x"), F.lit("yyyy-MM-dd HH:mm:ss"))
    typed = points.select("path", time.alias("time"), V.number("p", "$.y").alias("value")).where("time is not null and value is not null")
    return typed.withColumn("future", F.col("time") > now + F.expr("interval 15 minutes"))


def chart_summary(points: DataFrame, key: list[str]) -> DataFrame:
    """First and last time, latest value, counts of points and of future ones."""
    now = ~F.col("future")
    return points.groupBy(*key).agg(
        F.min(F.when(now, F.col("time"))).alias("first_time"), F.max(F.when(now, F.col("time"))).alias("last_time"), F.max_by("value", F.when(now, F.col("time"))).alias("latest_value"),
        F.count_if(now).alias("n"), F.count_if("future").alias("future_count"),
    )


def newest_day(points: DataFrame, requests: DataFrame, key: list[str], now: Column) -> DataFrame:
    """Of several days' series the one whose last point is newest, of each key: which day, its counts and times, or why there is none.

    points: key, day, time, value, future (of any number of days; the newest day wins a tie). requests: key, day, success,
    n (points that the provider sent). Every key of either has a row. ``availability``: ``received``;
    ``empty_despite_success``, where all requests that succeeded brought nothing; else ``request_or_parse_failure``.
    Days are summed up before keys are, so that neither a key's days nor its points meet unreduced.
    """
    days = chart_summary(points, [*key, "day"]).where("n > 0")
    best = days.groupBy(*key).agg(F.max(F.struct("last_time", "day", "first_time", "latest_value", "n", "future_count")).alias("x"))
    asked = requests.groupBy(*key).agg(F.bool_or("success").alias("answered"), F.coalesce(F.bool_and(F.when(F.col("success"), F.col("n") == 0)), F.lit(False)).alias("nothing"))
    joined = best.join(asked, key, "full")
    age = F.round((F.unix_micros(now.cast("timestamp")) - F.unix_micros(F.col("x.last_time").cast("timestamp"))) / 6e7, 2)
    why = F.when(F.col("x").isNotNull(), "received").when(F.coalesce("nothing", F.lit(False)), "empty_despite_success").otherwise("request_or_parse_failure")
    return joined.select(*key, why.alias("availability"), F.col("x.day").alias("source_day"), F.coalesce("x.n", F.lit(0)).alias("n"), "x.first_time", "x.last_time", "x.latest_value", age.alias("age_minutes"), "x.future_count", F.coalesce("answered", F.lit(False)).alias("answered"))


def fallback_days(chosen: DataFrame, station: list[str], endpoint: str, required: list[str]) -> DataFrame:
    """(station, endpoint) to ask again of the day before: all required ones, where any of them has no series yet. ``chosen``: newest_day() of the present day."""
    lacking = chosen.where(F.col(endpoint).isin(required)).groupBy(*station).agg(F.count_if(F.col("availability") == "received").alias("there")).where(F.col("there") < len(required))
    return lacking.select(*station, F.explode(F.lit(required)).alias(endpoint))


def series_empty(requests: DataFrame, key: list[str]) -> DataFrame:
    """Whether all successful requests returned no points (and there was one)."""
    return requests.where("success").groupBy(*key).agg(F.bool_and(F.col("n") == 0).alias("empty_despite_success"))


def metar_reports(payloads: DataFrame, icao: str, now: Column, tolerance_minutes: int = 15) -> DataFrame:
    """(path, pos, time, speed, gust, direction, variable, future): reports of one station; what isn't an object, or names another station, is rejected."""
    rows = payloads.select("path", F.posexplode(V.items("payload")).alias("pos", "r"))
    fits = V.is_object("r") & F.coalesce(V.text("r", "$.icaoId") == icao, F.lit(True))
    time = C.first_time(V.text("r", "$.obsTime"), V.text("r", "$.reportTime"), V.text("r", "$.receiptTime"))
    variable = C.variable_direction(V.text("r", "$.rawOb"), V.text("r", "$.wdir"))
    number = lambda p: F.coalesce(V.number("r", p), V.text("r", p).try_cast("double"))
    typed = rows.withColumn("accepted", F.coalesce(fits, F.lit(False))).select(
        "path", "pos", "accepted", time.alias("time"), C.knots_to_ms(number("$.wspd")).alias("wind_speed_ms"), C.knots_to_ms(number("$.wgst")).alias("wind_gust_ms"),
        number("$.wdir").alias("wind_direction_deg"), variable.alias("wind_direction_variable"),
    )
    return typed.withColumn("future", F.col("time") > now + F.make_dt_interval(mins=F.lit(tolerance_minutes)))


def metar_latest(reports: DataFrame) -> DataFrame:
    """One report per time: the last in input order."""
    from gustloom.operators.timeline import last_wins

    return last_wins(reports.where("accepted and not future and time is not null"), ["path", "time"], "pos")


def metar_quality(reports: DataFrame, now: Column) -> DataFrame:
    """A station's quality: kept, source, rejected and future rows, availability of speed and of a direction (or a variable one) in percent of kept ones, the widest gap in minutes, age and its class."""
    from gustloom.operators.timeline import gaps

    readable = F.col("accepted") & F.col("time").isNotNull()
    counts = reports.groupBy("path").agg(F.count(F.lit(1)).alias("source_rows"), F.count_if(~readable).alias("rejected_rows"), F.count_if(readable & F.col("future")).alias("future_rows"))
    kept = metar_latest(reports)
    widest = gaps(kept, ["path"], "time").groupBy("path").agg(C.py_round(F.max("gap_minutes"), 1).alias("max_gap_minutes"))
    share = lambda c: C.py_round(100 * F.count_if(c) / F.count(F.lit(1)), 1)
    agg = kept.groupBy("path").agg(
        F.count(F.lit(1)).alias("records"), share(F.col("wind_speed_ms").isNotNull()).alias("wind_speed_availability_pct"),
        share(F.col("wind_direction_deg").isNotNull() | F.col("wind_direction_variable")).alias("direction_or_variable_availability_pct"), F.max("time").alias("latest"),
    )
    age = F.greatest(F.lit(0.0), C.py_round((F.unix_micros(now) - F.unix_micros("latest")) / 6e7, 1))
    return counts.join(agg, "path", "left").join(widest, "path", "left").na.fill(0, ["records"]).withColumn("age_minutes", age).withColumn("availability", F.when(F.col("latest").isNotNull(), C.report_age_class("age_minutes")))


#: What the names of archive members with measurements hold, and the headers of time, speed and direction.
PRODUCT_MEMBERS = ("produkt_", "product_")
CSV_HEADERS = (("MESS_DATUM", "MESS_DATUM_WOZ"), ("F", "FF"), ("D", "DD"))


def station_csv(spark: SparkSession, path: str, now: Column | None = None, days: int = 21) -> DataFrame:
    """(path, member, time, wind_speed_ms, wind_direction_deg): semicolon CSV in Latin-1 inside zip files, from the member with the most usable rows (the first of several).

    Of a file's .txt members those named as products count, or all where none is. Headers are matched without case or
    surrounding spaces; -900 and less stand for missing. With ``now``, rows older than so many days are left out. A file
    that is no zip, or a damaged one, has no rows here, but one of station_csv_rejects().
    """
    def unzip(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if _damage(content):
                    continue
                with zipfile.ZipFile(io.BytesIO(content)) as z:
                    texts = [m for m in z.namelist() if m.lower().endswith(".txt")]
                    for order, member in enumerate([m for m in texts if any(p in m.lower() for p in PRODUCT_MEMBERS)] or texts):
                        rows = csv.reader(io.StringIO(z.read(member).decode("latin-1")), delimiter=";")
                        heads = {h.strip().upper(): i for i, h in enumerate(next(rows, []))}
                        at = [next((heads[h] for h in names if h in heads), None) for names in CSV_HEADERS]
                        if None in at:
                            continue
                        cells = [[r[i] if i < len(r) else None for i in at] for r in rows]
                        if cells:
                            t, s, d = zip(*cells)
                            yield pa.RecordBatch.from_arrays([pa.array([name] * len(t)), pa.array([order] * len(t), pa.int32()), pa.array([member] * len(t)), pa.array(t, pa.string()), pa.array(s, pa.string()), pa.array(d, pa.string())], ["path", "nth", "member", "t", "s", "d"])

    raw = _zips(spark, path).mapInArrow(unzip, "path string, nth int, member string, t string, s string, d string")
    typed = raw.select("path", "nth", "member", C.packed_time("t").alias("time"), C.locale_number("s").alias("wind_speed_ms"), C.locale_number("d").alias("wind_direction_deg")).where("time is not null and wind_speed_ms is not null and wind_direction_deg is not null")
    counts = typed.groupBy("path", "nth").agg(F.count(F.lit(1)).alias("n"))
    best = counts.groupBy("path").agg(F.max_by("nth", F.struct("n", -F.col("nth"))).alias("nth"))
    kept = typed.join(best, ["path", "nth"], "left_semi").drop("nth")
    return kept if now is None else kept.where(F.col("time") >= now - F.make_dt_interval(days=F.lit(days)))


def _zips(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", "*.zip").load(path).select(F.regexp_extract("path", r"[^/]+$", 0).alias("path"), "content")


def _damage(content: bytes) -> str | None:
    """Why an archive can't be read, or which of its members can't."""
    try:
        with zipfile.ZipFile(io.BytesIO(content)) as z:
            bad = z.testzip()
            return f"damaged member {bad}" if bad else None
    except (zipfile.BadZipFile, zlib.error, EOFError, NotImplementedError, RuntimeError) as error:
        return f"{type(error).__name__}: {error}"


def station_csv_rejects(spark: SparkSession, path: str) -> DataFrame:
    """(path, reject): archives that can't be read, and why. Spark lists no files without any bytes."""

    def test(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [(name, why) for name, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()) if (why := _damage(content))]
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in found], pa.string()) for i in (0, 1)], ["path", "reject"])

    return _zips(spark, path).mapInArrow(test, "path string, reject string")


def hrefs(html: Column | str, base: Column | None = None, ending: str = "") -> Column:
    """Links of a directory page, whatever the case of the attribute; with ``base``, the page's address, as they resolve against it.

    ``ending``: only links that end so, in any case, such as ``.grib2.bz2``.
    """
    found = F.regexp_extract_all(C.col(html), F.lit("(?i)href=[\"']([^\"']+" + re.escape(ending) + (")[\"']" if ending else ")")), F.lit(1))
    return found if base is None else F.transform(found, lambda x: resolved(x, base))


def resolved(link: Column, base: Column) -> Column:
    """A link against the address of its page: whole addresses, //host, /path, ?query, #fragment, and relative paths with . and .. steps."""
    bare = F.regexp_replace(base, r"[?#].*$", "")
    scheme = F.regexp_extract(bare, r"^([A-Za-z][A-Za-z0-9+.-]*:)", 1)
    site = F.regexp_extract(bare, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/]*)", 1)
    path = F.regexp_replace(bare, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/]*", "")
    own, rest = F.regexp_extract(link, r"^([^?#]*)", 1), F.regexp_extract(link, r"^[^?#]*(.*)$", 1)
    joined = F.when(own.startswith("/"), own).otherwise(F.concat(F.regexp_replace(F.when(path == "", "/").otherwise(path), r"[^/]*$", ""), own))
    steps = F.split(joined, "/")
    # A step .. takes the last one back, never above the root; a final . or .. leaves a folder.
    kept = F.aggregate(steps, F.array().cast("array<string>"), lambda done, x: F.when(x == ".", done).when(x == "..", F.slice(done, 1, F.greatest(F.least(F.size(done), F.lit(1)), F.size(done) - 1))).otherwise(F.concat(done, F.array(x))))
    folder = F.when(F.element_at(steps, -1).isin(".", ".."), "/").otherwise("")
    return (
        F.when(link.rlike("^[A-Za-z][A-Za-z0-9+.-]*:"), link).when(link.startswith("//"), F.concat(scheme, link)).when(link.startswith("#") | (link == ""), F.concat(F.regexp_replace(base, r"#.*$", ""), link))
        .when(link.startswith("?"), F.concat(bare, link)).otherwise(F.concat(site, F.array_join(kept, "/"), folder, rest))
    )


def cycle_and_lead(name: Column | str) -> tuple[Column, Column]:
    """The cycle (yyyyMMddHH) and lead of a file name like ..._2026092500_012_...; null where it has none."""
    n = C.col(name)
    return F.nullif(F.regexp_extract(n, r"_(\d{10})_(\d{3})_", 1), F.lit("")), F.regexp_extract(n, r"_(\d{10})_(\d{3})_", 2).try_cast("int")


def product_files(listing: DataFrame, wanted: DataFrame, regular: bool = True) -> DataFrame:
    """(cycle, lead, parameter, url): of the links (column ``url``) the first by name for each wanted (cycle, lead, parameter); null where there is none.

    A file's name must have the cycle, the lead as _NNN_ and the parameter, and that of a regular grid unless ``regular`` is
    false; without such a one, any of that cycle and lead will do then. Cycle and lead join as equals.
    """
    cycle, lead = cycle_and_lead("url")
    links = listing.select("url", F.regexp_extract("url", r"[^/]*$", 0).alias("name"), cycle.alias("cycle"), lead.alias("lead")).where("lead is not null")
    links = links.where(F.col("name").contains("regular-lat-lon")) if regular else links
    joined = wanted.join(links, ["cycle", "lead"], "left")
    fits = F.min(F.when(F.col("name").contains(F.col("parameter")), F.col("url")))
    return joined.groupBy("cycle", "lead", "parameter").agg((fits if regular else F.coalesce(fits, F.min("url"))).alias("url"))
