"""Field availability: stamping of items, declarations from older booleans, and all problems of a snapshot."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gustloom.functions import columns as C
from gustloom.functions import variants as V
from gustloom.sources import bundles as B


def stamp(items: DataFrame, observed: Column) -> DataFrame:
    """Rows of native_values() with a closed status and two times; ``reject`` says why an item is refused.

    The observed time and the field's time are set only where they're absent; a field that isn't received has no time
    of its own, and one with a value is refused.
    """
    status, unknown = C.availability_status("status", F.col("error").isNotNull())
    had = V.text("item", "$.availability_observed_at_utc")
    field = V.text("item", "$.field_available_at_utc")
    out = items.withColumns({"status": status, "reject": unknown})
    carries = (F.col("status") != "received") & F.col("value").isNotNull()
    return out.withColumns({
        "observed_at": F.coalesce(had, observed.cast("string")), "available_at": F.when(F.col("status") == "received", F.coalesce(field, observed.cast("string"))),
        "reject": F.coalesce("reject", F.when(carries, "non-received field cannot carry a value")),
    })


def row_times(recs: DataFrame, observed: Column, replace: bool) -> DataFrame:
    """The retrieval time of each record: its own unless it has none or is replaced."""
    own = F.when(V.truth("rec", "$.retrieved_at_utc"), V.text("rec", "$.retrieved_at_utc"))
    return recs.withColumn("retrieved_at_utc", observed.cast("string") if replace else F.coalesce(own, observed.cast("string")))


def declarations(recs: DataFrame, observed: Column) -> DataFrame:
    """State rows from boolean evidence, once each; ``reject`` where a value isn't boolean."""
    product = V.text("rec", "$.provider_product")
    simple = recs.select("path", "model", "pos", product.alias("product"), F.explode(V.entries("rec", "$.field_availability")).alias("parameter", "flag"), F.lit("legacy_field_availability_boolean_v1").alias("evidence"))
    context = recs.select("path", "model", "pos", F.explode(V.entries("rec", "$.weather_context_availability")).alias("product", "fields"))
    nested = context.select("path", "model", "pos", "product", F.explode(V.entries("fields")).alias("parameter", "flag"), F.lit("product_weather_context_boolean_v1").alias("evidence"))
    both = simple.unionByName(nested)
    boolean = F.coalesce(V.kind("flag") == "boolean", F.lit(False))
    status = F.when(boolean, F.when(V.true("flag", "$"), "received").otherwise("unsupported_by_provider_or_product"))
    typed = both.select(
        "path", "model", "pos", "parameter", "product", "evidence", status.alias("availability_status"), F.when(~boolean, "field availability must be boolean").alias("reject"),
        F.concat(F.lit("availability:"), F.coalesce(F.concat("product", F.lit(":")), F.lit("")), "parameter").alias("semantic_id"),
    )
    once = typed.dropDuplicates(["path", "model", "pos", "parameter", "product", "evidence", "availability_status"])
    return once.withColumns({"observed_at": observed.cast("string"), "available_at": F.when(F.col("availability_status") == "received", observed.cast("string"))})


def problems(bundles: DataFrame) -> DataFrame:
    """(path, scope, model, pos, place, problem): all of them; a reader that shows twenty takes the first by this order."""
    scopes = [("models", B.records(bundles)), ("full_horizon", B.archive_records(bundles))]
    out = None
    for scope, recs in scopes:
        states = V.part("rec", "$.field_availability_states")
        row = F.filter(F.array(
            F.when(~V.truth("rec", "$.retrieved_at_utc"), F.lit("missing retrieved_at_utc")),
            F.when(V.kind(states).isNull(), F.lit("missing field_availability_states")).when(~V.is_array(states), "field_availability_states is not a list"),
        ), lambda x: x.isNotNull())
        a = recs.select("path", "model", "pos", F.lit("").alias("place"), F.explode(row).alias("problem"))

        def of(x: Column, declared: bool) -> Column:
            status = V.text(x, "$.availability_status")
            known = F.coalesce(status.isin(*C.AVAILABILITY), F.lit(False))
            base = [F.when(~known, "invalid status"), F.when(~V.truth(x, "$.availability_observed_at_utc"), "missing observed time"), F.when((status == "received") & ~V.truth(x, "$.field_available_at_utc"), "received without field_available_at_utc")]
            if declared:
                base += [F.when(~V.truth(x, "$.parameter_native") | F.coalesce(V.text(x, "$.namespace") != "availability", F.lit(True)), "identity incomplete"), F.when(V.schema_has(x, "value"), "must not carry a value")]
                return F.when(F.coalesce(~V.is_object(x), F.lit(True)), F.array(F.lit("is not an object"))).otherwise(F.filter(F.array(*base), lambda y: y.isNotNull()))
            base.append(F.when(known & (status != "received") & V.kind(x, "$.value").isNotNull(), "non-received carries value"))
            return F.when(~known, F.array(F.lit("invalid status"))).otherwise(F.filter(F.array(*base), lambda y: y.isNotNull()))

        d = recs.select("path", "model", "pos", F.posexplode(V.items("rec", "$.field_availability_states")).alias("i", "x")).select("path", "model", "pos", F.concat(F.lit("declaration "), "i").alias("place"), F.explode(of(F.col("x"), True)).alias("problem"))
        v = B.native_values(recs).select("path", "model", "pos", F.concat_ws(" ", "parameter", "message").alias("place"), F.explode(of(F.col("item"), False)).alias("problem"))
        found = a.unionByName(d).unionByName(v).withColumn("scope", F.lit(scope))
        out = found if out is None else out.unionByName(found)
    return out.select("path", "scope", "model", "pos", "place", "problem")
