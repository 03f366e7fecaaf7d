"""Nodes to flat rows, with the reason why a node was refused."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.timestamps import iso_passthrough
from tidemark.functions.values import Node
from tidemark.operators.specs import EntitySpec

REJECT_REASON = "reject_reason"

# Parents a note may hang on, first match wins, and placeholders
# that lenient mapping fills in.
NOTE_PARENTS = ["client", "property", "request", "job", "visit", "quote", "invoice"]
ORPHAN_NOTE_ID = "ORPHANED_NOTE_MISSING_ID"
ORPHAN_ATTACHMENT_ID = "ORPHANED_ATTACHMENT_MISSING_ID"
ORPHAN = "ORPHANED"
UNKNOWN_PARENT = "UNKNOWN"
ATTACHMENT_ROOT = "./attachments"


class Mapped(NamedTuple):
    accepted: DataFrame
    rejects: DataFrame


def first_problem(problems: Mapping[str, Column]) -> Column:
    reason = F.lit(None).cast("string")
    for label, condition in reversed(list(problems.items())):
        reason = F.when(F.coalesce(condition, F.lit(True)), F.lit(label)).otherwise(reason)
    return reason


def map_with(
    nodes: DataFrame,
    node: Node,
    columns: Mapping[str, Column],
    problems: Mapping[str, Column],
    keep: Sequence[str] = (),
    carry: Sequence[str] = (),
) -> DataFrame:
    """Mapped columns plus `reject_reason`, NULL for accepted nodes.

    The reason is decided before the columns are built and handed on through a
    one-element explode. A filter on it then runs where it is decided and is not
    rewritten into the conditions behind it, which would read the node twice and
    make planning very slow.
    """
    rows = node.fields(nodes, list(dict.fromkeys([*keep, *carry])))
    kept = rows.columns
    reasoned = rows.select("*", first_problem(problems).alias("_reason")).select(
        *[F.col(f"`{c}`") for c in kept], F.explode(F.array("_reason")).alias(REJECT_REASON)
    )
    named = [column.alias(name) for name, column in columns.items()]
    return reasoned.select(*keep, *named, REJECT_REASON)


def map_entities(
    nodes: DataFrame, spec: EntitySpec, node: str = "node", keep: Sequence[str] = ()
) -> DataFrame:
    reader = Node(node)
    return map_with(nodes, reader, spec.columns(reader), spec.problems(reader), keep)


def split_mapped(mapped: DataFrame) -> Mapped:
    return Mapped(
        mapped.where(F.col(REJECT_REASON).isNull()).drop(REJECT_REASON),
        mapped.where(F.col(REJECT_REASON).isNotNull()),
    )


def note_parent(node: Node, given_type: Column, given_id: Column) -> tuple[Column, Column]:
    """(entity_type, entity_id) of a note; a given parent joins the chain of its kind.

    A parent of an earlier kind already in the node wins over a given one.
    """
    parent_type = F.lit(None).cast("string")
    parent_id = F.lit(None).cast("string")
    for name in reversed(NOTE_PARENTS):
        given = F.coalesce(given_type == name, F.lit(False))
        here = given | node.is_object(name)
        this_id = F.when(given, given_id).otherwise(node.text(f"{name}.id"))
        parent_type = F.when(here, F.lit(name)).otherwise(parent_type)
        parent_id = F.when(here, this_id).otherwise(parent_id)
    return parent_type, parent_id


def map_notes(
    nodes: DataFrame,
    node: str = "node",
    given: tuple[str, str] | None = None,
    lenient: bool = False,
    keep: Sequence[str] = (),
    orphan_flag: str | None = None,
) -> DataFrame:
    """Notes; lenient mapping fills placeholders instead of refusing a node.

    `given` names two columns with the parent's type and id, if it is known; a note that
    strict mapping would refuse is kept under what its own node says. `orphan_flag` names
    a column that marks those.
    """
    reader = Node(node)
    nothing = F.lit(None).cast("string")
    given_type, given_id = (F.col(c) for c in given) if given else (nothing, nothing)
    entity_type, entity_id = note_parent(reader, given_type, given_id)
    has_id = reader.truthy("id")
    note_id = reader.string("id")
    problems: dict[str, Column] = {}
    no_parent_id = F.coalesce(entity_id, F.lit("")) == ""
    if lenient:
        note_id = F.when(has_id, note_id).otherwise(F.lit(ORPHAN_NOTE_ID))
        refused = entity_type.isNull() | no_parent_id
        own_type, own_id = note_parent(reader, nothing, nothing) if given else (entity_type, entity_id)
        no_own_id = F.coalesce(own_id, F.lit("")) == ""
        entity_type = F.when(refused, F.coalesce(own_type, F.lit(ORPHAN))).otherwise(entity_type)
        kept_id = F.when(no_own_id, F.lit(UNKNOWN_PARENT)).otherwise(own_id)
        entity_id = F.when(refused, kept_id).otherwise(entity_id)
    else:
        problems = {
            "missing id": ~has_id,
            "missing parent": entity_type.isNull(),
            "missing parent id": no_parent_id,
        }
    columns = {
        "id": note_id,
        "entity_type": entity_type,
        "entity_id": entity_id,
        "message": reader.text("message"),
        "created_at": iso_passthrough(reader.string("createdAt")),
        "updated_at": iso_passthrough(reader.string("updatedAt")),
    }
    if lenient and orphan_flag:
        columns[orphan_flag] = refused
    return map_with(nodes, reader, columns, problems, keep, given or ())


def map_attachments(
    nodes: DataFrame,
    node: str = "node",
    note_id: str | None = None,
    parent_id: str | None = None,
    lenient: bool = False,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Attachment metadata; without a note, lenient mapping files it under its parent.

    `note_id` and `parent_id` name columns that carry them outside the node.
    """
    reader = Node(node)
    has_id = reader.truthy("id")
    attachment_id = reader.string("id")
    note = reader.text_or_blank("note.id") if note_id is None else F.col(note_id)
    no_note = F.coalesce(note, F.lit("")) == ""
    problems: dict[str, Column] = {}
    if lenient:
        attachment_id = F.when(has_id, attachment_id).otherwise(F.lit(ORPHAN_ATTACHMENT_ID))
        note = F.when(no_note, F.lit(ORPHAN)).otherwise(note)
    else:
        problems = {"missing id": ~has_id, "missing note id": no_note}
    file_name = reader.text("fileName")
    owner = F.lit("") if parent_id is None else F.coalesce(F.col(parent_id), F.lit(""))
    folder = F.when(
        (note == ORPHAN) & (owner != ""), F.concat(F.lit(f"{ORPHAN}/"), owner)
    ).otherwise(note)
    path = F.concat(F.lit(f"{ATTACHMENT_ROOT}/"), folder, F.lit("/"), file_name)
    no_name = F.coalesce(file_name, F.lit("")) == ""
    columns = {
        "id": attachment_id,
        "note_id": note,
        "file_name": file_name,
        "content_type": reader.text("contentType"),
        "original_url": reader.text("url"),
        "local_file_path": F.when(no_name, F.lit("")).otherwise(path),
        "file_size": reader.strict_integer("fileSize"),
        "created_at": iso_passthrough(reader.string("createdAt")),
        "download_status": F.lit("pending"),
        "hash": F.lit(None).cast("string"),
        "downloaded_at": F.lit(None).cast("string"),
        "download_error": F.lit(None).cast("string"),
    }
    carry = [c for c in (note_id, parent_id) if c]
    return map_with(nodes, reader, columns, problems, keep, carry)
