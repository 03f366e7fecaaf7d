"""Ids and labels derived from records and request texts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Entity names looked for, in this order, when a request text
# carries no paged root field.
REQUEST_ENTITIES = [
    "clients",
    "invoices",
    "quotes",
    "jobs",
    "properties",
    "requests",
    "users",
    "expenses",
    "visits",
    "timesheetEntries",
    "products",
    "taxRates",
    "attachments",
    "notes",
]
DEFAULT_BATCH_SIZE = 30


def parent_of_note(note_id: Column, fallback_type: Column) -> tuple[Column, Column]:
    """(parent_type, parent_id) out of `<type>_<id>_note_<n>`.

    The plural is the bare type plus `s`, whatever the type.
    """
    parts = F.split(note_id, "_")
    named = F.size(parts) >= 2
    parent_type = F.when(named, F.concat(F.get(parts, F.lit(0)), F.lit("s"))).otherwise(
        fallback_type
    )
    parent_id = F.when(named, F.get(parts, F.lit(1))).otherwise(note_id)
    return parent_type, parent_id


def display_id(entity_type: Column, number: Column, first: Column, last: Column) -> Column:
    """Human label of a record; a missing name or number reads `None`."""
    said = lambda c: F.coalesce(c.cast("string"), F.lit("None"))
    full_name = F.trim(F.concat(said(first), F.lit(" "), said(last)))
    named = F.when(full_name == "", F.lit("Client: (unnamed)")).otherwise(
        F.concat(F.lit("Client: "), full_name)
    )
    numbered = {name: f"{name.title()} #" for name in ("invoice", "job", "quote", "request", "visit")}
    label = F.when(entity_type.isin("client", "user"), named)
    for name, prefix in numbered.items():
        label = label.when(entity_type == name, F.concat(F.lit(prefix), said(number)))
    words = F.transform(F.split(entity_type, "_"), lambda w: F.initcap(w))
    return label.otherwise(F.array_join(words, "_"))


def request_entity(query: Column) -> Column:
    """Entity a request text asks for."""
    found = F.regexp_extract(query, r"(\w+)\s*\([^)]*first:", 1)
    label = F.when(found != "", found)
    for name in REQUEST_ENTITIES:
        label = label.when(F.contains(query, F.lit(name)), F.lit(name))
    return label.otherwise("unknown")


def request_batch_size(query: Column) -> Column:
    size = F.regexp_extract(query, r"first:\s*(\d+)", 1).try_cast("bigint")
    return F.coalesce(size, F.lit(DEFAULT_BATCH_SIZE).cast("bigint"))
