"""Windowed counts that lose no late row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.streaming import batches
from tidemark.streaming.feed import drain

START = "window_start"


def count_stream(
    rows: DataFrame, target: str, checkpoint: str, time: str, keys: Sequence[str], width: str
) -> StreamingQuery:
    """Requests per window and key of every batch. A row counts in its own window however
    late it comes: batches are added up when they are read, so no window ever closes."""

    def counts(batch: DataFrame, _: int) -> DataFrame:
        windows = batch.groupBy(F.window(time, width).alias("window"), *keys)
        return windows.agg(F.count(F.lit(1)).alias("requests")).select(
            F.col("window.start").alias(START), *keys, "requests"
        )

    return drain(rows, target, checkpoint, counts)


def _added(rows: DataFrame, keys: Sequence[str], width: str | None) -> DataFrame:
    if width is not None:
        rows = rows.withColumn("_window", F.window(START, width)).withColumn(START, F.col("_window.start"))
    return rows.groupBy(START, *keys).agg(F.sum("requests").alias("requests"))


def rate_per_window(spark: SparkSession, target: str, keys: Sequence[str], width: str | None = None) -> DataFrame:
    """The counts of all batches per window and key, or of wider windows that hold them."""
    return _added(batches.read_live(spark, target), keys, width)


def fold_counts(spark: SparkSession, target: str, keys: Sequence[str], width: str | None = None) -> None:
    """Add up all batches in one folder, rolled up to wider windows where `width` is given.

    Sums are kept, not newest rows, and a folded batch never counts twice: the fold takes
    effect at once, and a batch replayed after it stays covered. Windows of the feed's own
    width keep arriving; they are read together with the wider ones by a `width` that is a
    multiple of both.
    """
    batches.fold(spark, target, lambda rows: _added(rows, keys, width))
