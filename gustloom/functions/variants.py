"""Typed reads of VARIANT values that tell "missing" from "of another type"."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gustloom.functions.columns import aware_only, col, lenient_utc


def part(v: Column | str, path: str) -> Column:
    return F.try_variant_get(col(v), path, "variant")


def text(v: Column | str, path: str = "$") -> Column:
    return F.try_variant_get(col(v), path, "string")


_KINDS = {"OBJECT": "object", "ARRAY": "array", "BOOLEAN": "boolean", "STRING": "string", "": "number"}


def kind(v: Column | str, path: str = "$") -> Column:
    """object, array, number, boolean, string, or null for what isn't there. It walks the whole value, once: is_object() and is_array() don't."""
    word = F.regexp_extract(F.schema_of_variant(part(v, path)), "^(VOID|OBJECT|ARRAY|BOOLEAN|STRING)", 1)
    return F.try_element_at(F.create_map(*(F.lit(x) for pair in _KINDS.items() for x in pair)), word)


def is_object(v: Column | str, path: str = "$") -> Column:
    return F.try_variant_get(col(v), path, "struct<>").isNotNull()


def is_array(v: Column | str, path: str = "$") -> Column:
    return F.try_variant_get(col(v), path, "array<variant>").isNotNull()


def number(v: Column | str, path: str = "$") -> Column:
    """A finite number, and neither a boolean nor text; null otherwise."""
    x = F.try_variant_get(col(v), path, "double")
    return F.when((F.abs(x) < float("inf")) & (kind(v, path) == "number"), x)


def truth(v: Column | str, path: str = "$") -> Column:
    """Whether a value counts as true: there, and not empty, zero or false."""
    return F.coalesce(~F.coalesce(F.to_json(part(v, path)), F.lit("null")).isin("null", '""', "0", "0.0", "false", "[]", "{}"), F.lit(False))


def true(v: Column | str, path: str) -> Column:
    """Whether a value is the boolean true."""
    return F.coalesce((kind(v, path) == "boolean") & F.try_variant_get(col(v), path, "boolean"), F.lit(False))


def instant(v: Column | str, path: str = "$") -> Column:
    return lenient_utc(text(v, path))


def aware_instant(v: Column | str, path: str = "$") -> Column:
    return aware_only(text(v, path))


def lenient_int(v: Column | str, path: str = "$") -> Column:
    """int() of a value: numbers are cut, booleans count as 0 and 1, text must be digits."""
    s = F.trim(text(v, path))
    return (
        F.when(kind(v, path) == "number", F.try_variant_get(col(v), path, "double").try_cast("int"))
        .when(kind(v, path) == "boolean", F.try_variant_get(col(v), path, "boolean").cast("int"))
        .when((kind(v, path) == "string") & s.rlike(r"^[+-]?\d+$"), s.try_cast("int"))
    )


def strict_int(v: Column | str, path: str = "$") -> Column:
    """A whole JSON number, not a boolean."""
    return F.when(F.schema_of_variant(part(v, path)) == "BIGINT", F.try_variant_get(col(v), path, "int"))


def items(v: Column | str, path: str = "$") -> Column:
    """An array's elements; an empty array for anything else."""
    return F.coalesce(F.try_variant_get(col(v), path, "array<variant>"), F.array().cast("array<variant>"))


def entries(v: Column | str, path: str = "$") -> Column:
    """An object as a map; an empty map for anything else."""
    return F.coalesce(F.try_variant_get(col(v), path, "map<string,variant>"), F.create_map().cast("map<string,variant>"))


def schema_has(v: Column | str, key: str) -> Column:
    """Whether an object has a key, whatever its value."""
    return F.map_contains_key(entries(v), key)


def canonical_sha(v: Column | str) -> Column:
    """SHA-256 of a value's JSON with sorted keys: variants keep an object's keys in order, so to_json() is canonical."""
    return F.sha2(F.to_json(col(v)), 256)
