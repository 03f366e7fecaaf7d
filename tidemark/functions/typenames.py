"""Wrapped field types as an introspection document nests them, at any depth."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

LEVEL = "struct<kind: string, name: string>"
ENTRY = "struct<kind: string, name: string, ofType: variant>"


def levels(field_type: Column) -> Column:
    """(kind, name) of every level of a VARIANT type, outermost first.

    The walk takes as many steps as the type's text has `ofType` keys, so no depth is cut.
    Each step reads its level once, whatever lies below; what is no object has no entry.
    """
    text, key = F.to_json(field_type), '"ofType"'
    keys = (F.length(text) - F.length(F.replace(text, F.lit(key), F.lit("")))) / F.lit(len(key))
    entry = lambda value: F.try_variant_get(value, "$", ENTRY)
    start = F.struct(entry(field_type).alias("entry"), F.array().cast(f"array<{LEVEL}>").alias("seen"))

    def step(state: Column, _: Column) -> Column:
        here = state["entry"]
        level = F.struct(here["kind"].alias("kind"), here["name"].alias("name"))
        return F.struct(
            entry(here["ofType"]).alias("entry"),
            F.when(here.isNotNull(), F.concat(state["seen"], F.array(level))).otherwise(state["seen"]).alias("seen"),
        )

    walked = F.aggregate(F.sequence(F.lit(1), keys.cast("int") + 1), start, step, lambda s: s["seen"])
    return F.when(field_type.isNotNull(), walked).otherwise(start["seen"])


def type_text(field_type: Column) -> Column:
    return text_of_levels(levels(field_type))


def text_of_levels(seen: Column) -> Column:
    """`[T!]!` notation, built from the innermost level outwards."""
    return F.aggregate(
        F.reverse(seen),
        F.lit("Unknown"),
        lambda text, level: F.when(level["kind"] == "NON_NULL", F.concat(text, F.lit("!")))
        .when(level["kind"] == "LIST", F.concat(F.lit("["), text, F.lit("]")))
        .when(F.coalesce(level["name"], F.lit("")) != "", level["name"])
        .otherwise(F.lit("Unknown")),
    )


def base_type(field_type: Column) -> Column:
    return base_of_levels(levels(field_type))


def base_of_levels(seen: Column) -> Column:
    """Name of the first level that has one below wrapping levels only."""
    return F.aggregate(
        F.reverse(seen),
        F.lit("Unknown"),
        lambda name, level: F.when(F.coalesce(level["name"], F.lit("")) != "", level["name"])
        .when(level["kind"].isin("NON_NULL", "LIST"), name)
        .otherwise(F.lit("Unknown")),
    )


def is_nullable(field_type: Column) -> Column:
    return ~F.coalesce(F.try_variant_get(field_type, "$.kind", "string") == "NON_NULL", F.lit(False))
