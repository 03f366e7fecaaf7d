"""Attachment downloads as table work: selection, outcomes, content-addressed storage."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.files import content_hash, extension, storage_suffix


@dataclass(frozen=True)
class DownloadFilters:
    """Optional limits on what is downloaded; an empty filter lets everything pass."""

    file_types: Sequence[str] = ()
    min_size: int | None = None
    max_size: int | None = None
    parent_types: Sequence[str] = ()

    def __post_init__(self) -> None:
        for name in ("min_size", "max_size"):
            value = getattr(self, name)
            if value is not None and value < 0:
                raise ValueError(f"{name} must not be negative")
        if None not in (self.min_size, self.max_size) and self.min_size > self.max_size:
            raise ValueError("min_size must not exceed max_size")

    def matches_file_type(self, name: Column) -> Column:
        if not self.file_types:
            return F.lit(True)
        types = [t.lower().lstrip(".") for t in self.file_types]
        return (F.coalesce(name, F.lit("")) != "") & extension(F.coalesce(name, F.lit(""))).isin(types)

    def matches_size(self, size: Column) -> Column:
        """An unknown size passes only when there are no bounds."""
        passes = F.lit(True)
        if self.min_size is not None:
            passes = passes & (size >= self.min_size)
        if self.max_size is not None:
            passes = passes & (size <= self.max_size)
        unbounded = self.min_size is None and self.max_size is None
        return F.when(size.isNull(), F.lit(unbounded)).otherwise(passes)

    def matches_parent_type(self, parent_type: Column) -> Column:
        if not self.parent_types:
            return F.lit(True)
        return F.lower(parent_type).isin([t.lower() for t in self.parent_types])

    @property
    def needs_metadata(self) -> bool:
        return bool(self.file_types) or self.min_size is not None or self.max_size is not None


def with_metadata(queue: DataFrame, attachments: DataFrame) -> DataFrame:
    """Queue items with file name, size and url of their attachment; `found` tells if any."""
    known = attachments.select(
        F.col("id").alias("attachment_id"),
        "file_name",
        "file_size",
        "original_url",
        F.lit(True).alias("found"),
    )
    return queue.join(known, "attachment_id", "left").withColumn(
        "found", F.coalesce("found", F.lit(False))
    )


def pending_of_parents(
    pending: DataFrame,
    parents: DataFrame,
    key: str,
    parent_key: str,
    parent_type: Column,
    filters: DownloadFilters,
) -> DataFrame:
    """Pending items whose parent is of a wanted kind, without case; items of a parent that
    does not exist fall out where kinds are asked for. Parents need no unique keys."""
    if not filters.parent_types:
        return pending
    wanted = parents.where(filters.matches_parent_type(parent_type)).select(F.col(parent_key).alias(key))
    return pending.join(wanted, key, "left_semi")


def filter_work(work: DataFrame, filters: DownloadFilters) -> DataFrame:
    """Keep matching items; those without metadata fall out only if a filter needs it."""
    by_file = filters.matches_file_type(F.col("file_name")) & filters.matches_size(
        F.col("file_size")
    )
    without = F.lit(not filters.needs_metadata)
    return work.where(
        filters.matches_parent_type(F.col("parent_type"))
        & F.when(F.col("found"), by_file).otherwise(without)
    )


def store_contents(files: DataFrame, content: str = "content", name: str = "file_name") -> DataFrame:
    """Hash of each file and the name it is stored under."""
    digest = content_hash(F.col(content))
    return files.withColumn("hash", digest).withColumn(
        "stored_name", F.concat(F.col("hash"), storage_suffix(F.col(name)))
    )


def dedup_by_hash(hashed: DataFrame, key: str, size: str) -> DataFrame:
    """One row per distinct content: keeper, copies, bytes saved.

    Only counters travel, so a content with a third of all copies is one small row
    per map task.
    """
    return hashed.groupBy("hash").agg(
        F.min(key).alias("keeper"),
        F.count(F.lit(1)).alias("copies"),
        (F.sum(size) - F.max(size)).alias("bytes_saved"),
    )


def download_summary(results: DataFrame, seconds: float) -> DataFrame:
    """Totals and rates of a download pass; `results` has success and bytes."""
    done = F.count_if("success")
    total = F.count(F.lit(1))
    loaded = F.coalesce(F.sum(F.when(F.col("success"), F.col("bytes"))), F.lit(0)).cast("bigint")
    agg = results.agg(
        total.alias("total_attachments"),
        done.alias("downloaded"),
        (total - done).alias("failed"),
        loaded.alias("total_bytes"),
    )
    rate = F.coalesce(F.try_divide(F.col("downloaded") * 100.0, F.col("total_attachments")), F.lit(0.0))
    span = F.lit(float(seconds))
    per_file = F.coalesce(F.try_divide(span, F.col("downloaded")), F.lit(0.0))
    return agg.select(
        "*",
        F.round(rate, 2).alias("success_rate"),
        F.round(F.coalesce(F.try_divide(F.col("total_bytes"), span), F.lit(0.0)), 2).alias(
            "bytes_per_second"
        ),
        F.round(F.coalesce(F.try_divide(F.col("downloaded"), span), F.lit(0.0)), 2).alias(
            "files_per_second"
        ),
        F.round(per_file, 2).alias("seconds_per_file"),
    )
