"""Notes and their attachments: references, deferred and inline loading."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.values import truthy, variant_at
from tidemark.operators.mapping import (
    ATTACHMENT_ROOT,
    ORPHAN,
    REJECT_REASON,
    Mapped,
    map_attachments,
    map_notes,
    split_mapped,
)
from tidemark.operators.merge import valid_rows
from tidemark.sources.pages import child_nodes

REFERENCE = ["note_id", "entity_type", "entity_id"]


def collect_references(
    parents: DataFrame,
    entity_type: str,
    parent_id: str = "id",
    node: str = "node",
    continuation: DataFrame | None = None,
) -> DataFrame:
    """One reference per note edge that has an id, of first and of continuation pages."""
    children = child_nodes(parents, "notes", parent_id, continuation, node)
    note_id = F.try_variant_get(F.col("child"), "$.id", "string")
    return children.where(truthy(variant_at(F.col("child"), "id"))).select(
        note_id.alias("note_id"), F.lit(entity_type).alias("entity_type"), F.col(parent_id).alias("entity_id")
    )


def pending_references(references: DataFrame, notes: DataFrame) -> DataFrame:
    """Complete references whose note is not stored; each (note, parent) once."""
    return (
        valid_rows(references, REFERENCE)
        .select(*REFERENCE)
        .distinct()
        .join(notes.select(F.col("id").alias("note_id")), "note_id", "left_anti")
    )


def deferred_notes(references: DataFrame, note_nodes: DataFrame, node: str = "node") -> DataFrame:
    """Notes fetched by reference; the reference says who the parent is.

    `note_nodes` has note_id and the node, one row per id.
    """
    fetched = references.join(note_nodes.select("note_id", node), "note_id", "inner")
    return map_notes(fetched, node, given=("entity_type", "entity_id"), keep=["note_id"])


def note_attachments(
    note_nodes: DataFrame, note_id: str = "note_id", node: str = "node"
) -> DataFrame:
    """Attachments listed inside note nodes; they belong to that note."""
    edges = F.try_variant_get(F.col(node), "$.attachments.edges", "array<variant>")
    files = note_nodes.select(note_id, F.explode(edges).alias("edge")).select(
        note_id, F.try_variant_get(F.col("edge"), "$.node", "variant").alias("file")
    )
    return map_attachments(
        files.where(truthy(F.col("file"))), "file", note_id=note_id
    )


def inline_notes(children: DataFrame, entity_type: str, parent_id: str, child: str = "child") -> DataFrame:
    """Notes delivered inside their parent; edges without an id are skipped.

    A parent kind notes cannot hang on still keeps its notes, as orphans.
    """
    with_id = children.where(truthy(variant_at(F.col(child), "id"))).withColumn(
        "_parent_type", F.lit(entity_type)
    )
    mapped = map_notes(
        with_id, child, given=("_parent_type", parent_id), lenient=True, orphan_flag="orphaned"
    )
    return mapped.drop(REJECT_REASON)


def inline_attachments(children: DataFrame, parent_id: str, child: str = "child") -> Mapped:
    """Attachments delivered inside a parent.

    Those without a note are kept under the parent; those without an id are refused.
    One pass decides both ways, because lenient mapping only adds placeholders.
    """
    has_id = truthy(variant_at(F.col(child), "id"))
    mapped = map_attachments(
        children.where(truthy(F.col(child))).select(parent_id, child, has_id.alias("_has_id")),
        child,
        parent_id=parent_id,
        lenient=True,
        keep=[parent_id, "_has_id"],
    ).drop(REJECT_REASON)
    return Mapped(
        mapped.where("_has_id").drop("_has_id").withColumn("orphaned", F.col("note_id") == ORPHAN),
        mapped.where("not _has_id").select(parent_id, F.lit("missing id").alias(REJECT_REASON)),
    )


def orphan_issues(
    attachments: DataFrame, entity_type: str, parent_id: str, skipped_notes: DataFrame | None = None
) -> DataFrame:
    """One issue row per parent that has orphaned attachments or skipped notes.

    `skipped_notes` has the parent's id, one row per note that was not stored.
    """
    folder = F.regexp_replace(F.col(parent_id), r"^.*/", "")
    found = attachments.where("orphaned").select(parent_id, F.lit(1).alias("_kept"), F.lit(0).alias("_skipped"))
    if skipped_notes is not None:
        found = found.unionByName(
            skipped_notes.select(parent_id, F.lit(0).alias("_kept"), F.lit(1).alias("_skipped"))
        )
    kept = F.sum("_kept").alias("attachments_saved_orphaned")
    skipped = [] if skipped_notes is None else [F.sum("_skipped").alias("notes_skipped")]
    counts = found.groupBy(parent_id).agg(kept, *skipped)
    return counts.select(
        F.lit(entity_type).alias("entity_type"),
        F.col(parent_id).alias("entity_id"),
        "attachments_saved_orphaned",
        *(["notes_skipped"] if skipped else []),
        F.lit("orphaned_data_preserved").alias("issue_type"),
        F.concat(F.lit(f"{ATTACHMENT_ROOT}/{ORPHAN}/"), folder, F.lit("/")).alias("review_path"),
    )


def skipped_notes(children: DataFrame, parent_id: str, child: str = "child") -> DataFrame:
    """Edges without an id, which `inline_notes` leaves out: one row with the parent each."""
    return children.where(~truthy(variant_at(F.col(child), "id"))).select(parent_id)


def issue_summary(issues: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    counts = [("attachments_saved_orphaned", "attachments_orphaned"), ("notes_skipped", "notes_skipped")]
    return issues.groupBy(*by).agg(
        F.count(F.lit(1)).alias("entities_with_issues"),
        *[F.coalesce(F.sum(c), F.lit(0)).alias(name) for c, name in counts if c in issues.columns],
    )


def reference_summary(references: DataFrame) -> DataFrame:
    """References per parent kind and in total (entity_type NULL)."""
    return references.rollup("entity_type").agg(F.count(F.lit(1)).alias("n"))


def unique_notes(references: DataFrame) -> DataFrame:
    return references.select("note_id").distinct()


def notes_per_type(references: DataFrame) -> DataFrame:
    """Distinct notes per parent kind; distinct values are spread before they are counted."""
    return references.groupBy("entity_type").agg(F.count_distinct("note_id").alias("notes"))
