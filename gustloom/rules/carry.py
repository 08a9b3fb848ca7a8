"""Carried archive sources, rewritten to the current acquisition contract inside their VARIANT.

What a provider gave is carried over, what policy said at the time isn't: records, statuses and errors of leads that are
no longer asked for go, the contract's fields are replaced, and what they were is recorded.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gustloom.functions import variants as V
from gustloom.operators import leads

#: The contract's fields whose former values are recorded, and the record's own name.
FORMER = ("acquisition_grid_version", "retention_grid_version", "requested_extension_leads", "acquisition_max_lead_hours")
RECONCILIATION, METHOD = "carry_forward_contract_reconciliation", "carry-forward-contract-reconciliation-v1"


def _variant(x: Column) -> Column:
    return F.coalesce(x.cast("variant"), F.parse_json(F.lit("null")))


def _object(**parts: Column) -> Column:
    """An object of variants."""
    return F.to_variant_object(F.create_map(*(x for k, v in parts.items() for x in (F.lit(k), v))))


def _list(xs: Column) -> Column:
    return F.to_variant_object(xs)


def carried(sources: DataFrame, now: Column) -> DataFrame:
    """(path, model, run, source, dropped_leads, reconciled, reject) of (path, model, run, source): each source under the contract of its model and cycle.

    Refused, with the source as null: records that are no list, a record that is no object, a lead that is no whole number.
    Without records, statuses or errors there is nothing to filter. An error that names leads keeps those that are still
    asked for, and goes if there are none; one that names none stays. ``reconciled``: whether anything differed.
    """
    given = sources.select("path", "model", "run", "source", leads.policy("model", F.hour("run")).alias("p"), leads.native_max("model", F.hour("run")).alias("most"))
    wanted = F.col("p.extension_leads")
    lead = lambda r: V.strict_int(r, "$.forecast_lead_hours")
    listed = given.withColumns({"recs": V.items("source", "$.records"), "wanted": wanted})
    listed = listed.withColumn("their_leads", F.transform("recs", lead))
    reject = (
        F.when(~V.is_array("source", "$.records") & V.kind("source", "$.records").isNotNull(), "records_are_no_list").when(F.exists("recs", lambda r: F.coalesce(~V.is_object(r), F.lit(True))), "record_is_no_object")
        .when(F.exists("their_leads", lambda h: h.isNull()), "record_lead_is_no_whole_number")
    )
    asked = lambda h: F.array_contains(F.col("wanted"), h)

    def error(item: Column) -> Column:
        kept = F.filter(V.items(item, "$.leads"), lambda h: F.coalesce(asked(V.strict_int(h)), F.lit(False)))
        cut = F.to_variant_object(F.map_concat(F.map_filter(V.entries(item), lambda k, _: k != "leads"), F.create_map(F.lit("leads"), _list(kept))))
        named = F.coalesce(V.is_array(item, "$.leads"), F.lit(False))
        return F.when(~named, item).when(F.size(kept) > 0, cut)

    statuses = F.map_filter(V.entries("source", "$.lead_status"), lambda k, _: F.coalesce(asked(k.try_cast("int")) & (k.try_cast("int").cast("string") == k), F.lit(False)))
    former = _object(**{k: F.coalesce(V.part("source", f"$.{k}"), F.parse_json(F.lit("null"))) for k in FORMER})
    dropped = F.array_sort(F.array_distinct(F.filter("their_leads", lambda h: ~asked(h))))
    text = lambda k: F.to_json(V.part("source", f"$.{k}"))
    differs = (
        (F.size("dropped_leads") > 0) | ~text("acquisition_grid_version").eqNullSafe(F.to_json(_variant(F.col("p.acquisition_grid_version")))) | ~text("retention_grid_version").eqNullSafe(F.to_json(_variant(F.col("p.retention_grid_version"))))
        | ~text("requested_extension_leads").eqNullSafe(F.to_json("wanted")) | ~V.strict_int("source", "$.acquisition_max_lead_hours").eqNullSafe(F.col("p.acquisition_max_lead_hours"))
    )
    contract = {
        "run_time_utc": _variant(F.date_format("run", "yyyy-MM-dd'T'HH:mm:ss'+00:00'")), "target_max_hours": _variant(F.col("most")), "expected_max_lead_for_cycle": _variant(F.col("most")),
        "provider_native_horizon_hours": _variant(F.col("p.provider_native_horizon_hours")), "compatibility_horizon_hours": _variant(F.col("p.compatibility_horizon_hours")),
        "acquisition_grid_version": _variant(F.col("p.acquisition_grid_version")), "retention_grid_version": _variant(F.col("p.retention_grid_version")),
        "acquisition_max_lead_hours": _variant(F.col("p.acquisition_max_lead_hours")), "requested_extension_leads": _list(F.col("wanted")),
        "records": _list(F.filter("recs", lambda r: asked(lead(r)))), "lead_status": F.to_variant_object(statuses),
    }
    record = _object(
        method_version=_variant(F.lit(METHOD)), reconciled_at_utc=_variant(F.date_format(now, "yyyy-MM-dd'T'HH:mm:ss'+00:00'")), previous_contract=former, current_acquisition_grid_version=contract["acquisition_grid_version"],
        current_retention_grid_version=contract["retention_grid_version"], current_requested_extension_leads=_list(F.col("wanted")), dropped_obsolete_extension_leads=_list(F.col("dropped_leads")),
    )
    none = F.create_map().cast("map<string,variant>")
    errors = F.when(V.is_array("source", "$.errors"), F.create_map(F.lit("errors"), _list(F.filter(F.transform(V.items("source", "$.errors"), error), lambda x: x.isNotNull())))).otherwise(none)
    replaced = (*contract, RECONCILIATION)
    kept = F.map_filter(V.entries("source"), lambda k, _: ~k.isin(*replaced) & ((k != "errors") | F.coalesce(~V.is_array("source", "$.errors"), F.lit(True))))
    old = F.map_filter(V.entries("source"), lambda k, _: k == RECONCILIATION)
    noted = F.when(F.col("reconciled"), F.create_map(F.lit(RECONCILIATION), record)).otherwise(old)
    fields = F.map_concat(kept, F.create_map(*(x for k, v in contract.items() for x in (F.lit(k), v))), errors, noted)
    typed = listed.withColumn("reject", reject).withColumn("dropped_leads", F.when(F.col("reject").isNull(), dropped)).withColumn("reconciled", F.col("reject").isNull() & F.coalesce(differs, F.lit(False)))
    return typed.select("path", "model", "run", F.when(F.col("reject").isNull(), F.to_variant_object(fields)).alias("source"), "dropped_leads", "reconciled", "reject")


def archive_sources(bundles: DataFrame) -> DataFrame:
    """(path, model, run, source) of bundles' archives, as carried() takes them; a source without a readable run is left out."""
    found = bundles.select("path", F.explode(V.entries("payload", "$.full_horizon_archive.sources")).alias("model", "source"))
    return found.select("path", "model", V.instant("source", "$.run_time_utc").alias("run"), "source").where("run is not null")
