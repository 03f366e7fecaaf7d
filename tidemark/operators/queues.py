"""Work queues as table state."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.records import parent_of_note
from tidemark.operators.inventory import of_snapshot
from tidemark.operators.merge import insert_or_ignore

EXTRACT_KEY = ["entity_type", "entity_id", "map_snapshot_id"]
ATTACHMENT_KEY = ["attachment_id", "map_snapshot_id"]
STATUSES = ["pending", "in_progress", "done", "failed"]
RETRYABLE = ["pending", "failed"]
EXTRACT_SCHEMA = (
    "entity_type string, entity_id string, status string, attempt_count int, "
    "last_error string, map_snapshot_id string, updated_at string"
)
ATTACHMENT_SCHEMA = (
    "attachment_id string, parent_type string, parent_id string, status string, "
    "attempt_count int, last_error string, map_snapshot_id string, updated_at string"
)


def pending(as_of: str) -> list[Column]:
    return [
        F.lit("pending").alias("status"),
        F.lit(0).alias("attempt_count"),
        F.lit(None).cast("string").alias("last_error"),
        F.lit(as_of).alias("updated_at"),
    ]


def queue_from_inventory(queue: DataFrame, inventory: DataFrame, as_of: str) -> DataFrame:
    """Queue every inventoried record that is not queued yet; known items keep their status."""
    new = inventory.select(*EXTRACT_KEY, *pending(as_of))
    return insert_or_ignore(queue, new, EXTRACT_KEY, ["updated_at"])


def queue_attachments(
    queue: DataFrame, attachments: DataFrame, snapshot_id: str, as_of: str, fallback_type: str
) -> DataFrame:
    """Queue mapped attachments; the parent is read off the note id."""
    parent_type, parent_id = parent_of_note(F.col("note_id"), F.lit(fallback_type))
    new = attachments.select(
        F.col("id").alias("attachment_id"),
        parent_type.alias("parent_type"),
        parent_id.alias("parent_id"),
        F.lit(snapshot_id).alias("map_snapshot_id"),
        *pending(as_of),
    )
    return insert_or_ignore(queue, new, ATTACHMENT_KEY, ["parent_type", "parent_id"])


def select_work(
    queue: DataFrame,
    resume: bool = True,
    types: Sequence[str] | None = None,
    snapshot_id: str | None = None,
) -> DataFrame:
    """Items to work on: pending, and failed ones again when resuming.

    `types` are kinds of records in an extract queue, of parents in an attachment queue.
    """
    wanted = of_snapshot(queue, snapshot_id)
    wanted = wanted.where(F.col("status").isin(RETRYABLE if resume else ["pending"]))
    if types is not None:
        kind = "parent_type" if "parent_type" in queue.columns else "entity_type"
        wanted = wanted.where(F.col(kind).isin(list(types)))
    return wanted


def reclaim_stuck(queue: DataFrame, as_of: str, ttl_seconds: int) -> DataFrame:
    """Put items a crash left in_progress back to pending after `ttl_seconds`."""
    age = F.unix_timestamp(F.lit(as_of).cast("timestamp")) - F.unix_timestamp(
        F.col("updated_at").cast("timestamp")
    )
    stuck = (F.col("status") == "in_progress") & (age > ttl_seconds)
    return queue.withColumn("status", F.when(stuck, "pending").otherwise(F.col("status")))


def apply_results(
    queue: DataFrame, results: DataFrame, keys: Sequence[str], as_of: str
) -> DataFrame:
    """Move worked items to done or failed in one pass.

    `results` has the keys, `success` and `error`, one row per item. Failure counts an
    attempt and keeps the error; success clears it.
    """
    outcome = results.select(*keys, F.col("success").alias("_ok"), F.col("error").alias("_error"))
    ok, worked = F.col("_ok"), F.col("_ok").isNotNull()
    changed = {
        "status": F.when(ok, "done").when(~ok, "failed").otherwise(F.col("status")),
        "attempt_count": F.col("attempt_count") + F.when(~ok, 1).otherwise(0),
        "last_error": F.when(ok, F.lit(None))
        .when(~ok, F.coalesce("_error", F.lit("Unknown error")))
        .otherwise(F.col("last_error")),
        "updated_at": F.when(worked, F.lit(as_of)).otherwise(F.col("updated_at")),
    }
    return queue.join(outcome, list(keys), "left").select(
        *[changed[c].alias(c) if c in changed else F.col(c) for c in queue.columns]
    )


def extract_outcomes(work: DataFrame, mapped: DataFrame, id_column: str = "id") -> DataFrame:
    """Outcome per work item: stored, not found, or refused by the mapper.

    `mapped` holds accepted and refused nodes, one row per id.
    """
    seen = mapped.select(
        F.col(id_column).alias("entity_id"), F.col("reject_reason"), F.lit(True).alias("_seen")
    )
    found = F.coalesce("_seen", F.lit(False))
    refused = F.col("reject_reason").isNotNull()
    error = (
        F.when(~found, F.concat(F.lit("Entity not found: "), F.col("entity_id")))
        .when(
            refused,
            F.concat(
                F.lit("Mapping error for "),
                F.col("entity_type"),
                F.lit(" "),
                F.col("entity_id"),
                F.lit(": "),
                F.col("reject_reason"),
            ),
        )
    )
    return work.join(seen, "entity_id", "left").select(
        *EXTRACT_KEY,
        (found & ~refused).alias("success"),
        found.alias("entity_found"),
        error.alias("error"),
    )


def status_matrix(
    queue: DataFrame, types: DataFrame | None = None, snapshot_id: str | None = None
) -> DataFrame:
    """Items per kind and status in one pass; kinds without items show zeros."""
    counts = of_snapshot(queue, snapshot_id).groupBy("entity_type").agg(
        *[F.count_if(F.col("status") == s).alias(s) for s in STATUSES],
        F.count(F.lit(1)).alias("_all"),
    )
    total = sum((F.col(s) for s in STATUSES[1:]), F.col(STATUSES[0]))
    counts = counts.select("entity_type", *STATUSES, total.alias("total"))
    if types is None:
        return counts
    return types.select("entity_type").join(counts, "entity_type", "left").na.fill(
        0, [*STATUSES, "total"]
    )


def preview(queue: DataFrame) -> DataFrame:
    """Counts by parent type, by status and overall, as (dimension, value, n)."""
    grouped = queue.groupingSets([["parent_type"], ["status"], []], "parent_type", "status").agg(
        F.count(F.lit(1)).alias("n"), F.grouping_id().alias("_set")
    )
    return grouped.select(
        F.when(F.col("_set") == 1, "parent_type")
        .when(F.col("_set") == 2, "status")
        .otherwise("total")
        .alias("dimension"),
        F.when(F.col("_set") == 1, F.col("parent_type"))
        .when(F.col("_set") == 2, F.col("status"))
        .alias("value"),
        "n",
    )
