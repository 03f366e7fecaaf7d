"""Contact lists: arrays of {value, primary} objects."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.values import Node, truthy


def contact_array(node: Node, path: str, field: str) -> Column:
    """Contacts at `path` as array<struct<field string, primary variant>>."""
    return node.typed(path, f"array<struct<{field} string, primary variant>>")


def _filled(contact: Column, field: str) -> Column:
    return F.coalesce(contact[field], F.lit("")) != ""


def all_values(contacts: Column, field: str) -> Column:
    filled = F.filter(contacts, lambda c: _filled(c, field))
    return F.coalesce(F.transform(filled, lambda c: c[field]), F.array().cast("array<string>"))


def primary_value(contacts: Column, field: str) -> Column:
    """First flagged contact that has a value, else the first value, else blank."""
    flagged = F.filter(contacts, lambda c: truthy(c["primary"]) & _filled(c, field))
    return F.coalesce(
        F.get(flagged, F.lit(0))[field],
        F.get(all_values(contacts, field), F.lit(0)),
        F.lit(""),
    )


def additional_values(contacts: Column, field: str) -> Column:
    """Every value that differs from the primary one; repeats of others stay."""
    primary = primary_value(contacts, field)
    return F.filter(all_values(contacts, field), lambda v: v != primary)


def first_trimmed(values: Column) -> Column:
    """First value that is not blank after trimming."""
    trimmed = F.transform(values, lambda v: F.trim(v))
    return F.coalesce(F.get(F.filter(trimmed, lambda v: v != ""), F.lit(0)), F.lit(""))
