"""Request plans as rows: what would be asked of each product for each lead. Nothing is fetched here."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gustloom.functions.columns import cycle_id
from gustloom.operators import leads as leads_of
from gustloom.sources.stations import cycle_and_lead

SPOT = (52.4942, 9.3418)
# The fields and levels of the context that each product offers.
CONTEXT = {
    "gfs_0p25": ("TMP DPT RH PRMSL PRES TCDC CAPE CIN DSWRF", "2_m_above_ground mean_sea_level surface entire_atmosphere 180-0_mb_above_ground 90-0_mb_above_ground 255-0_mb_above_ground"),
    "gefs_0p25s": ("TMP DPT RH PRMSL PRES TCDC CAPE CIN DSWRF", "2_m_above_ground mean_sea_level surface entire_atmosphere 180-0_mb_above_ground"),
    "gefs_0p50a": ("TMP RH PRMSL PRES TCDC CAPE CIN DSWRF", "2_m_above_ground mean_sea_level surface entire_atmosphere 180-0_mb_above_ground"),
    "gefs_0p50b": ("DPT CAPE CIN", "2_m_above_ground surface 255-0_mb_above_ground"),
}
# Each product's file and folder (a date, an hour and a lead go into them), the fields that every request asks for, and the digits of its box.
FILES = {
    "gfs_0p25": ("gfs.t%02dz.pgrb2.0p25.f%03d", "/gfs.%s/%02d/atmos", "UGRD VGRD GUST", "10_m_above_ground surface", 3),
    "gefs_0p25s": ("gec00.t%02dz.pgrb2s.0p25.f%03d", "/gefs.%s/%02d/atmos/pgrb2sp25", "UGRD VGRD GUST APCP", "10_m_above_ground surface", 3),
    "gefs_0p50a": ("gec00.t%02dz.pgrb2a.0p50.f%03d", "/gefs.%s/%02d/atmos/pgrb2ap5", "UGRD VGRD", "10_m_above_ground", 4),
    "gefs_0p50b": ("gec00.t%02dz.pgrb2b.0p50.f%03d", "/gefs.%s/%02d/atmos/pgrb2bp5", "", "", 4),
}
#: Fixed value: the field that the first product asks for unless it only probes.
NOT_PROBED = {"gfs_0p25": "APCP"}
# What the archive's requests ask for besides, and the digits of its box.
ARCHIVED = {"gfs_0p25": ("APCP", ""), "gefs_0p25s": ("", ""), "gefs_0p50a": ("APCP", "surface"), "gefs_0p50b": ("", "")}
ARCHIVE_DIGITS = 4


def context_variables(product: str) -> list[str]:
    """The context fields that a product offers."""
    return CONTEXT[product][0].split()


def flags(product: str, weather: bool = True, probe: bool = False, archive: bool = False) -> list[str]:
    """The var_ and lev_ parameters of a product, each once; a probe asks for the wind alone, the archive for precipitation of all products with wind."""
    fields, levels = FILES[product][2].split(), FILES[product][3].split()
    if archive:
        fields, levels = fields + ARCHIVED[product][0].split(), levels + ARCHIVED[product][1].split()
    if not probe:
        fields += NOT_PROBED.get(product, "").split()
        if weather:
            fields += context_variables(product)
            levels += CONTEXT[product][1].split()
    return [f"{kind}_{x}=on" for kind, names in (("var", fields), ("lev", levels)) for x in dict.fromkeys(names)]


def box(padding: Column | float, digits: Column | int = 4) -> list[Column]:
    """The bounding box around the spot."""
    pad, form = (x if isinstance(x, Column) else F.lit(x) for x in (padding, digits))
    number = lambda x: F.when(form == 3, F.format_string("%.3f", x)).otherwise(F.format_string("%.4f", x))
    side = lambda name, x: F.concat(F.lit(f"{name}="), number(x))
    return [F.lit("subregion="), side("leftlon", F.lit(SPOT[1]) - pad), side("rightlon", F.lit(SPOT[1]) + pad), side("toplat", F.lit(SPOT[0]) + pad), side("bottomlat", F.lit(SPOT[0]) - pad)]


def plan(leads: DataFrame, products: dict[str, float], weather: bool = True, probe: bool = False, archive: bool = False) -> DataFrame:
    """(model, run, lead, product, query): rows of (model, run, lead) times products, each with its padding in degrees. ``archive``: in the form of the full horizon's requests."""
    spark: SparkSession = leads.sparkSession
    rows = [(p, pad, flags(p, weather, probe, archive), FILES[p][0], FILES[p][1], ARCHIVE_DIGITS if archive else FILES[p][4]) for p, pad in products.items()]
    dims = spark.createDataFrame(rows, "product string, padding double, flags array<string>, file string, dir string, digits int")
    joined = leads.join(F.broadcast(dims))  # a handful of products
    fill = lambda c, *xs: F.printf(F.col(c), *xs)
    day, hour = F.date_format("run", "yyyyMMdd"), F.hour("run")
    query = F.concat_ws("&", F.concat(F.lit("file="), fill("file", hour, F.col("lead"))), F.concat_ws("&", "flags"), *box(F.col("padding"), F.col("digits")), F.concat(F.lit("dir="), F.url_encode(fill("dir", day, hour))))
    return joined.select("model", "run", "lead", "product", query.alias("query"))


def wrong_cycle(answers: DataFrame, key: list[str], wanted: str = "target", got: str = "retrieved") -> DataFrame:
    """Probe answers (key, target, retrieved): a field of another cycle than the one asked for proves nothing; ``reject`` says so."""
    same = F.col(got).eqNullSafe(F.col(wanted)) & F.col(wanted).isNotNull()
    return answers.select(*key, wanted, got, F.when(F.col(got).isNull(), "probe_without_run_time").when(~same, "probe_returned_another_cycle").alias("reject"))


def archive_plan(leads: DataFrame) -> DataFrame:
    """(model, run, lead, product, required, query): what the archive asks for each lead: GFS one product, the GEFS control run the products that its contract names for the lead.

    A lead that the cycle doesn't have has no rows; beyond 240 hours the second product, weather without wind, isn't required.
    """
    gefs = F.col("model") == "GEFS-control"
    contract = leads_of.gefs_contract(F.hour("run"), "lead")
    known = leads.withColumn("_c", F.when(gefs, contract)).where(~gefs | F.col("_c.expected"))
    near = known.where(~gefs | (F.col("lead") <= 240))
    part = lambda rows, model, product, pad: plan(rows.where(F.col("model") == model).select("model", "run", "lead"), {product: pad}, archive=True)
    far = known.where(gefs & (F.col("lead") > 240))
    out = part(near, "GFS", "gfs_0p25", 0.30).unionByName(part(near, "GEFS-control", "gefs_0p25s", 0.30)).unionByName(part(far, "GEFS-control", "gefs_0p50a", 0.75)).unionByName(part(far, "GEFS-control", "gefs_0p50b", 0.75))
    return out.select("model", "run", "lead", "product", (F.col("product") != "gefs_0p50b").alias("required"), "query")


def jobs(models: DataFrame, rows: DataFrame, parameters: list[str], inventory: DataFrame, regular: bool = True) -> DataFrame:
    """(model, run, lead, parameter, url): fields to fetch, the models' leads times parameters, each with the first url by name of its cycle, lead and parameter; null where there is none.

    rows: model, run, lead. inventory: model, url. A url counts for a field if its name has the cycle, the lead as _NNN_, the
    parameter as a word of its own, and that of a regular grid unless ``regular`` is false.
    """
    wanted = rows.join(models.select("model"), "model", "left_semi").select("model", "run", "lead", F.explode(F.lit(parameters)).alias("parameter"))
    name = F.regexp_extract("url", r"[^/]*$", 0)
    cycle, lead = cycle_and_lead("url")
    links = inventory.select("model", "url", cycle.alias("_cycle"), lead.alias("_lead"), F.lower(name).alias("_name")).where("_lead is not null")
    links = links.where(F.col("_name").contains("regular-lat-lon")) if regular else links
    # The words of a name that are parameters: few, so that the join is on equals.
    held = links.withColumn("parameter", F.explode(F.filter(F.lit(parameters), lambda p: F.concat(F.lit("_"), F.regexp_replace("_name", r"\.", "_"), F.lit("_")).contains(F.concat(F.lit("_"), F.lower(p), F.lit("_"))))))
    first = held.groupBy("model", "_cycle", "_lead", "parameter").agg(F.min("url").alias("url"))
    same = (F.col("w.model") == F.col("i.model")) & (cycle_id("w.run") == F.col("i._cycle")) & (F.col("w.lead") == F.col("i._lead")) & (F.col("w.parameter") == F.col("i.parameter"))
    return wanted.alias("w").join(first.alias("i"), same, "left").select("w.model", "w.run", "w.lead", "w.parameter", "i.url")
