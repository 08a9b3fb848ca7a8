"""Text that GRIB tools print, as rows: message identities, metadata columns, nearest values, grid identity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gustloom.functions import columns as C
from gustloom.sources.requests import CONTEXT, context_variables


def identities(lines: DataFrame, line: str = "line") -> DataFrame:
    """short_name, run, valid, step end and reject of lines 'name date time stepRange validityDate validityTime'.

    Empty lines are left out; one with fewer fields, or with a date or time that can't be read, is kept and says why.
    """
    p = F.filter(F.split(F.col(line), r"\s+"), lambda x: x != "")
    at = lambda i: F.get(p, i)
    typed = lines.where(F.size(p) > 0).select(
        *[c for c in lines.columns if c != line], at(0).alias("short_name"), C.message_time(at(1), at(2)).alias("run"), at(3).alias("step_range"),
        C.step_end_hours(at(3)).alias("step_end"), C.message_time(at(4), at(5)).alias("valid"), F.size(p).alias("_n"),
    )
    reject = F.when(F.col("_n") < 6, "incomplete_identity_row").when(F.col("run").isNull(), "reference_time_unreadable").when(F.col("valid").isNull(), "validity_time_unreadable")
    return typed.withColumn("reject", reject).drop("_n")


def exact(messages: DataFrame, run: Column, valid: Column) -> DataFrame:
    return messages.where((F.col("run") == run) & (F.col("valid") == valid))


def identity_reject(messages: DataFrame, key: list[str], run: Column, valid: Column) -> DataFrame:
    """Why each file's messages aren't those of a run and valid time; the first reason, null if there is none."""
    step = C.hours_between(run, valid)
    agg = messages.groupBy(*key).agg(F.count(F.lit(1)).alias("n"), F.bool_and(F.coalesce(F.col("run") == run, F.lit(False))).alias("runs"), F.bool_and(F.coalesce(F.col("valid") == valid, F.lit(False))).alias("valids"), F.bool_and(F.coalesce(F.abs(F.col("step_end") - step) <= 1e-9, F.lit(False))).alias("steps"))
    return agg.select(*key, F.when(F.col("n") == 0, "no_messages").when(~F.col("runs"), "run_time_mismatch").when(~F.col("valids"), "valid_time_mismatch").when(~F.col("steps"), "step_end_mismatch").alias("reason"))


def identity_failures(files: DataFrame, messages: DataFrame, key: list[str], run: str = "expected_run", valid: str = "expected_valid") -> DataFrame:
    """(key, reason, short_name, observed): everything in which a file's messages aren't those of its run and valid time.

    ``files`` has the key and what is expected of each file. A file without messages and one whose expected lead is no whole
    hour from 0 on have one row each, and no others; a message has a row for each of run, valid time and step end that differs.
    """
    lead = C.hours_between(F.col(run), F.col(valid))
    whole = F.coalesce((F.abs(lead - F.rint(lead)) <= 1e-9) & (lead >= 0), F.lit(False))
    m = messages.select(*(F.col(k).alias(f"_m{i}") for i, k in enumerate(key)), *(F.col(c).alias(f"_{c}") for c in ("short_name", "run", "valid", "step_range", "step_end")), F.lit(True).alias("_there"))
    same = F.lit(True)
    for i, k in enumerate(key):
        same = same & F.col(k).eqNullSafe(F.col(f"_m{i}"))
    joined = files.join(m, same, "left")
    fault = lambda when, reason, observed: F.when(when, F.struct(F.lit(reason).alias("reason"), F.col("_short_name").alias("short_name"), observed.cast("string").alias("observed")))
    each = F.filter(F.array(
        fault(~F.col("_run").eqNullSafe(F.col(run)), "run_time_mismatch", F.col("_run")), fault(~F.col("_valid").eqNullSafe(F.col(valid)), "valid_time_mismatch", F.col("_valid")),
        fault(F.coalesce(F.abs(F.col("_step_end") - F.rint(lead)) > 1e-9, F.lit(True)), "step_end_mismatch", F.col("_step_range")),
    ), lambda x: x.isNotNull())
    alone = lambda reason: F.array(F.struct(F.lit(reason).alias("reason"), F.lit(None).cast("string").alias("short_name"), lead.cast("string").alias("observed")))
    faults = F.when(~whole, alone("expected_lead_not_whole_hours")).when(F.col("_there").isNull(), alone("no_messages")).otherwise(each)
    found = joined.select(*key, F.explode(faults).alias("_f")).select(*key, "_f.*")
    return found.where(~F.col("reason").isin("expected_lead_not_whole_hours", "no_messages")).unionByName(found.where(F.col("reason").isin("expected_lead_not_whole_hours", "no_messages")).distinct())


def batch_leads(messages: DataFrame, key: list[str], run: Column, expected: Column) -> DataFrame:
    """(key, leads, failures): the leads of a file that should hold several, and why it doesn't hold those.

    Each failure is a reason with what it is about: a message of another run, one whose validity is no whole lead, one
    whose step ends elsewhere, one of an unexpected lead; and the expected leads that are missing. A file is bounded.
    """
    hours = C.hours_between(F.col("run"), F.col("valid"))
    ours = F.coalesce(F.col("run") == run, F.lit(False))
    whole = ours & F.coalesce((F.abs(hours - F.rint(hours)) <= 1e-9) & (hours >= 0), F.lit(False))
    lead = F.when(whole, F.rint(hours).cast("int"))
    fault = lambda when, reason: F.when(when, F.struct(F.lit(reason).alias("reason"), F.col("short_name").alias("short_name"), lead.alias("lead")))
    faults = F.filter(F.array(
        fault(~ours, "run_time_mismatch"), fault(ours & ~whole, "non_integral_validity_lead"), fault(whole & F.coalesce(F.abs(F.col("step_end") - lead) > 1e-9, F.lit(True)), "step_validity_disagreement"),
        fault(whole & ~F.array_contains(expected, lead), "unexpected_lead"),
    ), lambda x: x.isNotNull())
    agg = messages.select(*key, lead.alias("_lead"), faults.alias("_f"), expected.alias("_e")).groupBy(*key).agg(F.array_sort(F.collect_set("_lead")).alias("leads"), F.array_sort(F.flatten(F.collect_list("_f"))).alias("f"), F.first("_e").alias("e"))
    missing = F.transform(F.array_sort(F.array_except("e", "leads")), lambda h: F.struct(F.lit("expected_leads_missing_from_grib_batch").alias("reason"), F.lit(None).cast("string").alias("short_name"), h.alias("lead")))
    return agg.select(*key, "leads", F.concat("f", missing).alias("failures"))


def zipped(columns: DataFrame, key: list[str], names: list[str]) -> DataFrame:
    """One row per message from one list per key; lists of unequal length give a reject reason and no rows."""
    same = F.lit(True)
    for n in names[1:]:
        same = same & (F.size(n) == F.size(names[0]))
    return columns.where(same).select(*key, F.inline(F.arrays_zip(*names)))


def zip_reject(columns: DataFrame, key: list[str], names: list[str]) -> DataFrame:
    sizes = F.array(*(F.size(n) for n in names))
    return columns.where(F.array_min(sizes) != F.array_max(sizes)).select(*key, F.lit("metadata_column_length_mismatch").alias("reason"))


#: Fixed value: the line with the point that the tool chose.
_POINT = r"Grid Point chosen .*?latitude=([+-]?\d+(?:\.\d+)?) longitude=([+-]?\d+(?:\.\d+)?)"
#: How lines begin, and what they hold, that have no value.
_NO_VALUE = r"^(?:edition|shortName|Other grid|- )|messages in|total messages|Input Point:|Grid Point"


def nearest(lines: DataFrame, key: list[str], line: str = "line", pos: str = "pos") -> DataFrame:
    """(key, pos, short_name, step_range, value, latitude, longitude): values at the grid point that a tool chose, in the order of its output.

    A value's line is 'name stepRange ... value'; the point is in a line of its own. ``pos`` numbers the values from 0.
    """
    text = F.trim(F.col(line))
    p = F.split(text, r"\s+")
    part = lambda i: F.nullif(F.regexp_extract(F.col(line), _POINT, i), F.lit("")).try_cast("double")
    points = lines.select(*key, pos, part(1).alias("latitude"), part(2).alias("longitude")).where("latitude is not null")
    chosen = points.groupBy(*key).agg(F.min_by(F.struct("latitude", "longitude"), pos).alias("_p"))
    value = F.element_at(p, -1).try_cast("double")
    rows = lines.where(~text.rlike(_NO_VALUE) & (F.size(p) >= 3) & value.isNotNull()).select(*key, pos, p[0].alias("short_name"), p[1].alias("step_range"), value.alias("value"))
    listed = rows.groupBy(*key).agg(F.array_sort(F.collect_list(F.struct(pos, "short_name", "step_range", "value"))).alias("_v"))  # one tool's output
    both = listed.join(chosen, key).select(*key, "_p", F.posexplode("_v").alias("pos", "_x"))
    return both.select(*key, "pos", "_x.short_name", "_x.step_range", "_x.value", "_p.latitude", "_p.longitude")


def nearest_reject(lines: DataFrame, key: list[str], line: str = "line") -> DataFrame:
    """(key, reject): outputs without a chosen point, or without any value."""
    text = F.trim(F.col(line))
    p = F.split(text, r"\s+")
    has_value = ~text.rlike(_NO_VALUE) & (F.size(p) >= 3) & F.element_at(p, -1).try_cast("double").isNotNull()
    agg = lines.groupBy(*key).agg(F.bool_or(F.col(line).rlike(_POINT)).alias("a"), F.bool_or(has_value).alias("b"))
    return agg.select(*key, F.when(~F.col("a"), "no_grid_point").when(~F.col("b"), "no_values").alias("reject")).where("reject is not null")


def with_metadata(metadata: DataFrame, values: DataFrame, key: list[str]) -> DataFrame:
    """Metadata and values of messages by position (column ``pos``); a short name that differs marks the row.

    A file that hasn't as many of the one as of the other has no rows here, but one of metadata_reject(): positions then
    say nothing about which value belongs to which message.
    """
    v = values.select(*key, "pos", F.col("short_name").alias("value_name"), "value")
    odd = _counts(metadata, values, key).where("n_metadata <> n_values").select(*key)
    return metadata.join(v, [*key, "pos"]).join(odd, key, "left_anti").withColumn("mismatch", F.col("short_name") != F.col("value_name"))


def _counts(metadata: DataFrame, values: DataFrame, key: list[str]) -> DataFrame:
    both = metadata.select(*key, F.lit(1).alias("m"), F.lit(0).alias("v")).unionByName(values.select(*key, F.lit(0).alias("m"), F.lit(1).alias("v")))
    return both.groupBy(*key).agg(F.sum("m").alias("n_metadata"), F.sum("v").alias("n_values"))


def metadata_reject(metadata: DataFrame, values: DataFrame, key: list[str]) -> DataFrame:
    """(key, n_metadata, n_values, reason): files whose values can't be told to their messages, by count or else by a short name."""
    counts = _counts(metadata, values, key)
    differs = with_metadata(metadata, values, key).where("mismatch").select(*key).distinct().withColumn("_named", F.lit(True))
    reason = F.when(F.col("n_metadata") != F.col("n_values"), "metadata_value_count_mismatch").when(F.col("_named"), "metadata_value_name_mismatch")
    return counts.join(differs, key, "left").select(*key, "n_metadata", "n_values", reason.alias("reason")).where("reason is not null")


def grid_identity(lines: DataFrame, line: str = "line") -> DataFrame:
    """A grid's identity from the five values that a tool prints in a line: its type, the number of its definition's template, the number of the grid, its UUID, the number of points.

    A line with fewer values is kept and says so in ``reject``; further ones are ignored.
    """
    p = F.filter(F.split(F.col(line), r"\s+"), lambda x: x != "")
    rest = [c for c in lines.columns if c != line]
    at = lambda i: F.when(F.size(p) >= 5, F.get(p, i))
    return lines.select(
        *rest, at(0).alias("grid_type"), at(1).try_cast("int").alias("template_number"), at(2).try_cast("int").alias("grid_number"), at(3).alias("uuid"), at(4).try_cast("long").alias("n_points"),
        F.when(F.size(p) < 5, "grid_identity_incomplete").alias("reject"),
    )


#: What a native grid calls itself, its number, and how near the regular grid's point is to the returned one.
NATIVE_TYPES, NATIVE_NUMBER, PARITY_DEGREES = ("unstructured_grid", "unstructured"), 47, 0.011


def native_grid(grid: str) -> Column:
    """Whether a grid_identity() (a struct's name) is that of the ensemble's native grid."""
    g = lambda c: F.col(f"{grid}.{c}")
    return F.coalesce(g("grid_type").isin(*NATIVE_TYPES) & (g("grid_number") == NATIVE_NUMBER) & (F.length(g("uuid")) > 0), F.lit(False))


def point_parity(point: str, returned: str) -> Column:
    """Whether the point that nearest() gives on the regular grid is the returned one (names of structs with latitude and longitude)."""
    near = lambda a: F.abs(F.col(f"{point}.{a}") - F.col(f"{returned}.{a}")) <= PARITY_DEGREES
    return F.coalesce(near("latitude") & near("longitude"), F.lit(False))


def provenance(natives: DataFrame, points: DataFrame, returned: DataFrame, key: list[str]) -> DataFrame:
    """(key, native_verified, parity_verified, verified): what the native grid's identity, the regular grid's chosen point and the returned coordinates of each response prove together.

    natives: key and the columns of grid_identity(). points: key, latitude, longitude, as of nearest(), in any number of
    rows. returned: key, latitude, longitude. Every returned response has a row.
    """
    one = points.groupBy(*key).agg(F.min(F.struct("latitude", "longitude")).alias("point"))
    held = natives.select(*key, F.struct("grid_type", "grid_number", "uuid").alias("grid"))
    joined = returned.select(*key, F.struct("latitude", "longitude").alias("returned")).join(held, key, "left").join(one, key, "left")
    return joined.select(*key, native_grid("grid").alias("native_verified"), point_parity("point", "returned").alias("parity_verified")).withColumn("verified", F.col("native_verified") & F.col("parity_verified"))


#: By which native names, or which words of its label, a message is a context variable.
MATCHES = {
    "DPT": ("2d dpt", ("dew point",)), "RH": ("2r", ("relative humidity",)), "PRMSL": ("prmsl msl", ("pressure reduced to msl",)), "TCDC": ("tcc", ("total cloud cover",)),
    "CAPE": ("cape", ("convective available potential energy",)), "CIN": ("cin", ("convective inhibition",)), "DSWRF": ("dswrf sdswrf", ("downward short-wave radiation flux", "downward shortwave radiation flux")),
}
VARIABLES = ("TMP", "DPT", "RH", "PRMSL", "PRES", "TCDC", "CAPE", "CIN", "DSWRF")


def variables(name: Column | str, label: Column | str, level_type: Column | str, level: Column | str) -> Column:
    """The context variables that a message holds. Temperature needs a label that says so, not of a dew point, 2 m above ground; pressure is the surface's."""
    n, t = F.lower(F.coalesce(C.col(name), F.lit(""))), F.lower(F.coalesce(C.col(label), F.lit("")))
    two = F.coalesce((C.col(level_type) == "heightAboveGround") & (C.col(level).cast("string") == "2"), F.lit(False))
    holds = {"TMP": t.contains("temperature") & ~t.contains("dew") & two, "PRES": (n == "sp") | (t == "surface pressure")}
    for variable, (names, words) in MATCHES.items():
        holds[variable] = n.isin(*names.split())
        for w in words:
            holds[variable] = holds[variable] | t.contains(w)
    return F.filter(F.array(*(F.when(holds[v], F.lit(v)) for v in VARIABLES)), lambda v: v.isNotNull())


def availability(messages: DataFrame, key: list[str], product: str = "product", variables_col: str = "variables") -> DataFrame:
    """(key, product, available): a map from each of the product's own context variables to whether any message holds it."""
    own = F.create_map(*(F.lit(x) for p in CONTEXT for x in (p, context_variables(p))))
    have = messages.groupBy(*key, product).agg(F.flatten(F.collect_set(variables_col)).alias("have"))  # sets of nine names at most
    return have.select(*key, product, F.map_from_entries(F.transform(F.try_element_at(own, F.col(product)), lambda v: F.struct(v.alias("key"), F.array_contains("have", v).alias("value")))).alias("available"))


def json_metadata(files: DataFrame, text: str = "text") -> DataFrame:
    """One row per message of a tool's JSON output {"messages": [[{"key", "value"}...]...]} or {"messages": [{...}...]}, in order."""
    from gustloom.functions import variants as V

    rest = [c for c in files.columns if c != text]
    messages = files.select(*rest, F.posexplode(V.items(F.try_parse_json(text), "$.messages")).alias("pos", "m"))
    pairs = F.map_from_entries(F.transform(V.items("m"), lambda e: F.struct(V.text(e, "$.key").alias("key"), V.text(e, "$.value").alias("value"))))
    flat = F.map_from_entries(F.transform(F.map_entries(V.entries("m")), lambda e: F.struct(e["key"].alias("key"), V.text(e["value"]).alias("value"))))
    meta = F.when(V.is_array("m"), pairs).otherwise(flat)
    names = {"short_name": "shortName", "name": "name", "units": "units", "level_type": "typeOfLevel", "step_type": "stepType", "step_range": "stepRange"}
    typed = messages.withColumn("meta", meta)
    at = lambda k: F.try_element_at("meta", F.lit(k))
    return typed.select(
        *rest, "pos", *(at(v).alias(k) for k, v in names.items()), at("paramId").try_cast("int").alias("param_id"), at("level").try_cast("int").alias("level"),
        C.message_time(at("dataDate"), at("dataTime")).alias("run"), C.message_time(at("validityDate"), at("validityTime")).alias("valid"),
    )
