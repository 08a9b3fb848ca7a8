"""Column expressions of the domain: time rules, rounding, wind, circular measures, classes. All stay in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Factors between units, and the sixteen-sector compass step.
KNOTS_PER_MS, MS_PER_KNOT, MS_PER_MPH, SECTOR_DEGREES = 1.943844, 0.514444, 0.44704, 22.5
#: A gust factor needs at least this mean speed.
CALM_MS = 0.2
_ZONE = r"(Z|[+-]\d\d:?\d\d)$"


def col(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


# --- time -------------------------------------------------------------------------------------------------


def lenient_utc(text: Column | str) -> Column:
    """An instant; without a zone it's UTC, and what doesn't parse is null."""
    return col(text).try_cast("timestamp")


def aware_only(text: Column | str) -> Column:
    """An instant only where the text names a zone."""
    return F.when(col(text).rlike(_ZONE), lenient_utc(text))


def time_reject(text: Column | str, aware: bool) -> Column:
    """Why a strict reader would refuse the text; null if it wouldn't."""
    bad = F.when(lenient_utc(text).isNull(), "unparseable_timestamp")
    return bad.when(~col(text).rlike(_ZONE), "timezone_required") if aware else bad


def hours_between(start: Column, end: Column) -> Column:
    return (F.unix_micros(end) - F.unix_micros(start)) / 3.6e9


def retained(at: Column | str, now: Column, days: int = 21, tolerance_minutes: int = 15) -> Column:
    """Whether a row is neither too old to be kept nor from the future."""
    return (col(at) >= now - F.make_dt_interval(days=F.lit(days))) & (col(at) <= now + F.make_dt_interval(mins=F.lit(tolerance_minutes)))


def age_minutes(now: Column, at: Column | str) -> Column:
    """Signed minutes from an instant to ``now``, to two places. ``now`` is always given, never the clock."""
    return py_round((F.unix_micros(now) - F.unix_micros(col(at))) / 6e7, 2)


def valid_time(run: Column | str, lead: Column | str) -> Column:
    return F.timestamp_seconds(F.unix_micros(col(run)) / 1e6 + col(lead) * 3600)


def epoch_or_iso(value: Column | str) -> Column:
    """Seconds, milliseconds (over 1e12) or ISO text as an instant; null if none of them."""
    number = col(value).try_cast("double")
    seconds = F.when(number > 1e12, number / 1000).otherwise(number)
    return F.when(number.isNotNull(), F.timestamp_seconds(seconds)).otherwise(lenient_utc(value))


def first_time(*values: Column | str) -> Column:
    """The first value that parses: a failure moves on to the next."""
    return F.coalesce(*(epoch_or_iso(v) for v in values))


def packed_time(text: Column | str) -> Column:
    """yyyyMMddHHmm or yyyyMMddHH."""
    t = F.trim(col(text).cast("string"))
    return F.coalesce(F.try_to_timestamp(t, F.lit("yyyyMMddHHmm")), F.try_to_timestamp(t, F.lit("yyyyMMddHH")))


def message_time(date: Column | str, time: Column | str) -> Column:
    """A coded date and a time of up to four digits, padded to four; null unless both are digits. A longer time isn't cut: it's none."""
    given = F.trim(col(time).cast("string"))
    d, t = F.trim(col(date).cast("string")), F.when(F.length(given) <= 4, F.lpad(given, 4, "0")).otherwise(given)
    return F.when(d.rlike(r"^\d{8}$") & t.rlike(r"^\d{4}$"), F.try_to_timestamp(F.concat(d, t), F.lit("yyyyMMddHHmm")))


def compact_stamp(at: Column | str) -> Column:
    return F.date_format(col(at), "yyyyMMdd'T'HHmmssSSSSSS'Z'")


def cycle_id(run: Column | str) -> Column:
    """yyyyMMddHH: its text order is time order."""
    return F.date_format(col(run), "yyyyMMddHH")


def evidence_path(model: Column | str, run: Column | str) -> Column:
    return F.concat_ws("/", F.concat(F.lit("model="), col(model)), F.date_format(col(run), "'year='yyyy"), F.date_format(col(run), "'month='MM"), F.date_format(col(run), "'day='dd"), F.date_format(col(run), "'run='HH"))


def dated_path(prefix: str, kind: Column | str, at: Column | str, suffix: str) -> Column:
    """prefix/kind/year/month/day/stamp-suffix: the place of an object that never changes."""
    return F.concat_ws("/", F.lit(prefix), col(kind), F.date_format(col(at), "yyyy/MM/dd"), F.concat(compact_stamp(at), F.lit(suffix)))


# --- numbers ----------------------------------------------------------------------------------------------


def finite(x: Column | str) -> Column:
    x = col(x)
    return F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False))


def py_round(x: Column | str, places: int) -> Column:
    """Half-even on the exact binary value, unlike round() and bround()."""
    return F.regexp_replace(F.format_number(col(x).cast("double"), places), ",", "").try_cast("double")


def locale_number(text: Column | str) -> Column:
    """A number with a comma or a point; -900 and less stand for missing."""
    x = F.replace(F.trim(col(text).cast("string")), F.lit(","), F.lit(".")).try_cast("double")
    return F.when(finite(x) & (x > -900), x)


def safe_double(value: Column | str) -> Column:
    return col(value).try_cast("double")


def integral(x: Column | str) -> Column:
    """A whole number within 1e-9, as int."""
    x = col(x)
    return F.when(F.abs(x - F.rint(x)) <= 1e-9, F.rint(x).cast("int"))


# --- wind -------------------------------------------------------------------------------------------------


def wind_speed(u: Column | str, v: Column | str) -> Column:
    return F.hypot(col(u), col(v))


def wind_direction(u: Column | str, v: Column | str) -> Column:
    """The direction that the wind comes from, in [0, 360)."""
    return F.pmod(270 - F.degrees(F.atan2(col(v), col(u))), F.lit(360.0))


def wind_from_uv(u: Column | str, v: Column | str, gust: Column | str | None = None) -> Column:
    """Speeds, direction and gust factor; knots and the factor come from unrounded speeds."""
    speed, g = wind_speed(u, v), F.lit(None).cast("double") if gust is None else col(gust)
    known = col(u).isNotNull() & col(v).isNotNull()
    return F.when(known, _wind(speed, wind_direction(u, v), g))


def wind_from_speed(speed: Column | str, direction: Column | str, gust: Column | str) -> Column:
    """The same from a given speed and direction."""
    return F.when(col(speed).isNotNull(), _wind(col(speed), F.pmod(col(direction), F.lit(360.0)), col(gust)))


def wind_from_members(median: Column | str, direction: Column | str, gust: Column | str) -> Column:
    """From ensemble medians that are rounded first: knots and the factor come from the rounded ones."""
    return _wind(py_round(median, 3), F.pmod(col(direction), F.lit(360.0)), py_round(gust, 3))


def gust_factor(gust: Column, speed: Column) -> Column:
    return F.when(speed > CALM_MS, py_round(gust / speed, 2))


def _wind(speed: Column, direction: Column, gust: Column) -> Column:
    return F.struct(
        py_round(speed, 3).alias("wind_speed_ms"), py_round(speed * KNOTS_PER_MS, 2).alias("wind_speed_kt"), py_round(direction, 1).alias("wind_direction_deg"),
        py_round(gust, 3).alias("gust_ms"), py_round(gust * KNOTS_PER_MS, 2).alias("gust_kt"), gust_factor(gust, speed).alias("gust_factor"),
    )


def required_wind(u: Column | str, v: Column | str, gust: Column | str) -> tuple[Column, Column]:
    """The wind where all three inputs are there, and otherwise an error that names what is missing."""
    parts = {"u": col(u), "v": col(v), "gust": col(gust)}
    missing = F.filter(F.array(*(F.when(c.isNull(), n) for n, c in parts.items())), lambda x: x.isNotNull())
    return F.when(F.size(missing) == 0, wind_from_uv(u, v, gust)), F.when(F.size(missing) > 0, F.concat(F.lit("missing "), F.concat_ws(",", missing)))


def knots_to_ms(x: Column | str) -> Column:
    return py_round(col(x) * MS_PER_KNOT, 3)


def mph_to_ms(x: Column | str) -> Column:
    return py_round(col(x) * MS_PER_MPH, 4)


def sector_degrees(code: Column | str) -> Column:
    c = col(code)
    return F.when(c.between(0, 15), F.pmod(c * SECTOR_DEGREES, F.lit(360.0)))


def variable_direction(raw: Column | str, direction: Column | str) -> Column:
    """A report has a word that begins with VRB, or its direction isn't a number."""
    said = F.concat(F.lit(" "), F.coalesce(col(raw), F.lit(""))).contains(" VRB")
    return said | F.coalesce(col(direction).isNotNull() & col(direction).try_cast("double").isNull(), F.lit(False))


def circular_difference(a: Column | str, b: Column | str) -> Column:
    d = F.abs(F.pmod(col(a) - col(b), F.lit(360.0)))
    return F.least(d, 360 - d)


#: Fixed value: what stands in place of a secret.
REDACTED = "***REDACTED***"
#: The provider's eleven weather fields and the parameters that they stand for.
CANONICAL_PARAMETERS = {
    "t_2m": "air_temperature_2m", "td_2m": "dewpoint_2m", "relhum_2m": "relative_humidity_2m", "pmsl": "mean_sea_level_pressure", "ps": "surface_pressure", "tot_prec": "precipitation_amount",
    "clct": "total_cloud_fraction", "aswdir_s": "surface_downward_shortwave_direct", "aswdifd_s": "surface_downward_shortwave_diffuse", "cape_ml": "cape_mixed_layer", "cin_ml": "cin_mixed_layer",
}


# --- text -------------------------------------------------------------------------------------------------


def step_end_hours(text: Column | str) -> Column:
    """The end of a step range in hours: its last number with the letter right after it, in any case: minutes, seconds, days, else hours."""
    last = F.regexp_extract(F.lower(col(text)), r"([0-9]+[.]?[0-9]*)([a-z]?)[^0-9]*$", 0)
    value = F.regexp_extract(last, r"^([0-9]+([.][0-9]+)?)", 1).try_cast("double")
    unit = F.regexp_extract(last, r"^[0-9]+(?:[.][0-9]+)?([a-z]?)", 1)
    return value * F.when(unit == "m", 1 / 60).when(unit == "s", 1 / 3600).when(unit == "d", 24.0).otherwise(1.0)


def step_end(text: Column | str) -> Column:
    return integral(step_end_hours(text))


def first_alias(values: Column | str, *names: str) -> Column:
    """The first message's value under the first name that has any; ``values`` maps a name to its messages."""
    return F.coalesce(*(F.get(F.try_element_at(col(values), F.lit(n)), 0)["value"] for n in names))


def redact(text: Column | str, *secrets: str) -> Column:
    """Secrets as they are and URL-encoded, an api-key parameter's value, and an X-Api-Secret header's."""
    from urllib.parse import quote, quote_plus

    out = col(text)
    for secret in secrets:
        for form in dict.fromkeys((secret, quote(secret, safe=""), quote_plus(secret))):
            if form:
                out = F.replace(out, F.lit(form), F.lit(REDACTED))
    out = F.regexp_replace(out, r"(?i)([?&]api-key=)[^&\s'\"]+", f"$1{REDACTED}")
    return F.regexp_replace(out, r"(?i)(X-Api-Secret[=: ]+)[^,;\s'\"]+", f"$1{REDACTED}")


def canonical_parameter(name: Column | str) -> Column:
    """The parameter that a provider's field name stands for; null for names that aren't known."""
    return F.try_element_at(F.create_map(*(F.lit(x) for pair in CANONICAL_PARAMETERS.items() for x in pair)), F.lower(col(name)))


def present_fields(values: Column | str) -> Column:
    """Sorted keys of a map whose values aren't null."""
    return F.array_sort(F.map_keys(F.map_filter(col(values), lambda _, v: v.isNotNull())))


def identity_sha(content: Column | str) -> Column:
    return F.sha2(col(content), 256)


# --- classes ----------------------------------------------------------------------------------------------

#: Availability of a field, and of a lead.
AVAILABILITY = ("received", "unsupported_by_provider_or_product", "not_requested_by_policy", "not_yet_published", "fetch_error")
LEAD_STATUS = ("pending", "published", "not_yet_published", "not_expected_for_cycle", "fetch_error")
FAMILY = {"ICON-D2": "DWD-ICON", "ICON-D2-EPS": "DWD-ICON", "ICON-EU": "DWD-ICON", "ECMWF-IFS": "ECMWF", "GFS": "GFS", "GEFS-control": "GFS"}
#: Older words for a field's availability.
OLD_AVAILABILITY = {"not_offered": "not_yet_published", "missing": "fetch_error", "unsupported": "unsupported_by_provider_or_product", "not_requested": "not_requested_by_policy", "pending": "not_yet_published"}


def archive_age_class(age: Column | str) -> Column:
    a = col(age)
    return (
        F.when(a < -15, "timestamp_validation_failure").when(a <= 180, "recent_historical_reference")
        .when(a <= 2880, "provider_archive_lag_plausible").otherwise("provider_archive_unusually_delayed")
    )


def report_age_class(age: Column | str) -> Column:
    a = col(age)
    return F.when(a <= 120, "fresh").when(a <= 360, "delayed").otherwise("stale")


def due(age: Column | str, limit: Column | float, future_tolerance: float = 15.0) -> Column:
    """Whether new work is due: without a time, with one from the future, or past the limit. Fails open."""
    a = col(age)
    return F.when(a.isNull() | (a < -future_tolerance), True).otherwise(F.greatest(a, F.lit(0.0)) >= limit)


def due_reason(age: Column | str, limit: Column | float, future_tolerance: float = 15.0) -> Column:
    """Why work is due or isn't, for the same inputs as due()."""
    a = col(age)
    return (
        F.when(a.isNull(), "latest_success_has_no_generated_at_fail_open").when(a < -future_tolerance, "latest_success_timestamp_future_fail_open")
        .when(F.greatest(a, F.lit(0.0)) >= limit, "last_success_age_exceeds_threshold").otherwise("last_success_within_threshold")
    )


def family(model: Column | str) -> Column:
    return F.element_at(F.create_map(*(F.lit(x) for pair in FAMILY.items() for x in pair)), col(model))


def availability_status(status: Column | str, has_error: Column) -> tuple[Column, Column]:
    """The closed status, and why it's refused. Without one, an error means fetch_error."""
    s = col(status)
    mapped = F.coalesce(F.try_element_at(F.create_map(*(F.lit(x) for pair in OLD_AVAILABILITY.items() for x in pair)), s), s)
    given = F.when(s.isNull(), F.when(has_error, "fetch_error").otherwise("received")).otherwise(mapped)
    return F.when(given.isin(*AVAILABILITY), given), F.when(~given.isin(*AVAILABILITY), F.concat(F.lit("unknown availability status "), given))
