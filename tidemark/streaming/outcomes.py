"""Queue state kept by a feed of outcomes.

Outcomes are facts: at a position of their item's order an attempt was claimed, succeeded or
failed. A feed stores each fact once, however often and in whatever order it arrives; the
queue's state follows from the facts, so replays and shuffled batches change nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.merge import latest_per_key
from tidemark.streaming import batches, feed

CLAIMED, SUCCEEDED, FAILED = "claimed", "succeeded", "failed"
# Columns of an outcome besides the item's key and the order of its outcomes.
OUTCOME = ["kind", "error", "at"]


def outcome_stream(
    outcomes: DataFrame, target: str, checkpoint: str, keys: Sequence[str], seq: Sequence[str]
) -> StreamingQuery:
    """Store the outcomes of a feed; `keys` and `seq` name one outcome."""
    columns = [*keys, *seq, *OUTCOME]
    return feed.upsert_stream(outcomes.select(*columns), target, checkpoint, [*keys, *seq], OUTCOME)


def fold_outcomes(spark: SparkSession, target: str, keys: Sequence[str], seq: Sequence[str]) -> None:
    """One folder instead of many; what arrived twice is kept once."""
    feed.compact(spark, target, [*keys, *seq], OUTCOME)


def settled(
    outcomes: DataFrame,
    queue: DataFrame,
    keys: Sequence[str],
    seq: Sequence[str],
    as_of: str,
    ttl_seconds: int | None = None,
) -> DataFrame:
    """The queue after all outcomes, applied in their order.

    Every failure counts an attempt. The last outcome decides the status: done, failed, or in
    progress after a claim; a claim older than `ttl_seconds` at `as_of` is pending again.
    The last success or failure decides the error. Items without outcomes stay as they are,
    outcomes of unknown items are left out. An item's outcomes are reduced where they are
    read, so an item with very many moves one row per task.
    """
    once = latest_per_key(outcomes, [*keys, *seq], OUTCOME) if batches.BATCH in outcomes.columns else outcomes
    place = F.struct(*[F.col(c) for c in seq])
    kind, ended = F.col("kind"), F.col("kind") != CLAIMED
    summed = once.groupBy(*keys).agg(
        F.count_if(kind == FAILED).alias("_failures"),
        F.max_by(F.struct("kind", "at"), place).alias("_last"),
        F.max_by(F.when(ended, F.struct("kind", "error")), F.when(ended, place)).alias("_ended"),
    )
    age = F.unix_timestamp(F.lit(as_of).cast("timestamp")) - F.unix_timestamp(F.col("_last.at").cast("timestamp"))
    claimed = F.lit("in_progress") if ttl_seconds is None else F.when(age > ttl_seconds, "pending").otherwise("in_progress")
    last, end = F.col("_last.kind"), F.col("_ended.kind")
    changed = {
        "status": F.when(last == SUCCEEDED, "done")
        .when(last == FAILED, "failed")
        .when(last == CLAIMED, claimed)
        .otherwise(F.col("status")),
        "attempt_count": F.col("attempt_count") + F.coalesce("_failures", F.lit(0)).cast("int"),
        "last_error": F.when(end == SUCCEEDED, F.lit(None))
        .when(end == FAILED, F.coalesce("_ended.error", F.lit("Unknown error")))
        .otherwise(F.col("last_error")),
        "updated_at": F.coalesce("_last.at", "updated_at"),
    }
    return queue.join(summed, list(keys), "left").select(
        *[changed[c].alias(c) if c in changed else F.col(c) for c in queue.columns]
    )


def queue_state(
    spark: SparkSession,
    target: str,
    queue: DataFrame,
    keys: Sequence[str],
    seq: Sequence[str],
    as_of: str,
    ttl_seconds: int | None = None,
) -> DataFrame:
    """The queue after everything its feed has stored. A fold holds every fact once, so
    where it is all there is, its rows are taken as they are."""
    folders = batches.live_folders(spark, target)
    if not folders:
        return queue
    rows = batches.read_folders(spark, target, folders)
    if len(folders) == 1 and folders[0][0].startswith(f"{batches.FOLDED}-"):
        rows = rows.drop(batches.FEED, batches.BATCH)
    return settled(rows, queue, keys, seq, as_of, ttl_seconds)
