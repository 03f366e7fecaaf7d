"""Report numbers as small DataFrames, and the JSON sink for them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.files import error_class


def _ratio(part: Column, whole: Column) -> Column:
    return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Row count of every table as one result."""
    frames = [
        df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("table_name"), "n")
        for name, df in tables.items()
    ]
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame)
    return result


def status_histogram(df: DataFrame, status: str) -> DataFrame:
    return df.groupBy(F.col(status).alias("status")).agg(F.count(F.lit(1)).alias("n"))


def pending_megabytes(attachments: DataFrame, size: str) -> DataFrame:
    return attachments.agg(
        F.round(F.coalesce(F.sum(size), F.lit(0)) / F.lit(1048576.0), 2).alias("total_mb")
    )


def date_range(df: DataFrame, column: str) -> DataFrame:
    return df.agg(F.min(column).alias("first"), F.max(column).alias("last"))


def extraction_summary(page_log: DataFrame, keys: list[str]) -> DataFrame:
    """Processed, skipped, pages, page size and speed; `page_log` has one row per page."""
    return (
        page_log.groupBy(*keys)
        .agg(
            F.sum("entities").alias("total_entities"),
            F.sum("skipped").alias("entities_skipped"),
            F.count(F.lit(1)).alias("total_pages"),
            F.sum("seconds").alias("extraction_seconds"),
        )
        .withColumn("average_page_size", _ratio(F.col("total_entities"), F.col("total_pages")))
        .withColumn(
            "entities_per_second", _ratio(F.col("total_entities"), F.col("extraction_seconds"))
        )
    )


def run_totals(summaries: DataFrame) -> DataFrame:
    """Totals over all kinds with the share that was skipped."""
    processed, skipped = F.col("processed"), F.col("skipped")
    return summaries.agg(
        F.sum("processed").alias("processed"), F.sum("skipped").alias("skipped")
    ).select(
        "processed",
        "skipped",
        (processed + skipped).alias("total"),
        (_ratio(skipped, processed + skipped) * 100).alias("skip_percentage"),
    )


def run_report(summaries: DataFrame) -> DataFrame:
    """Totals per kind and overall (entity_type NULL) of entities, pages and errors."""
    return summaries.rollup("entity_type").agg(
        F.sum("total_entities").alias("total_entities"),
        F.sum("total_pages").alias("total_pages"),
        F.sum("error_count").alias("error_count"),
    )


def extract_report(queue: DataFrame) -> DataFrame:
    """Extracted, failed and success rate per kind."""
    counted = queue.groupBy("entity_type").agg(
        F.count_if(F.col("status") == "done").alias("extracted"),
        F.count_if(F.col("status") == "failed").alias("failed"),
    )
    rate = _ratio(F.col("extracted") * 100, F.col("extracted") + F.col("failed"))
    return counted.withColumn("success_rate", rate)


def map_report(counts: DataFrame, density: DataFrame) -> DataFrame:
    """Count, pages, rows per page and share with relations per kind."""
    share = _ratio(F.col("entities_with_relations") * 100, F.col("total_entities"))
    return (
        counts.join(density, "entity_type", "left")
        .withColumn("avg_per_page", _ratio(F.col("total_entities"), F.col("total_pages")))
        .withColumn("with_relations_pct", share)
    )


def error_classes(failures: DataFrame, error: str, n: int | None = None) -> DataFrame:
    """Most common error classes; all of them when `n` is not given."""
    counted = failures.groupBy(error_class(F.col(error)).alias("error_type")).agg(
        F.count(F.lit(1)).alias("n")
    )
    return counted if n is None else counted.orderBy(F.desc("n"), "error_type").limit(n)


def listed_failures(failures: DataFrame, order: list[str], shown: int = 20) -> DataFrame:
    """The first failures with the number of those not shown."""
    remaining = F.greatest(F.lit(0), F.count(F.lit(1)) - shown).cast("bigint")
    rest = failures.agg(remaining.alias("n")).scalar()
    return failures.orderBy(*order).limit(shown).withColumn("not_shown", rest)


def time_shares(counts: DataFrame, seconds: float) -> DataFrame:
    """Each kind's share of the runtime by its share of the rows."""
    total = counts.agg(F.greatest(F.sum("entities"), F.lit(1))).scalar()
    return counts.withColumn("estimated_seconds", _ratio(F.col("entities"), total) * float(seconds))


def write_report(report: DataFrame, path: str) -> None:
    """JSON lines."""
    report.write.mode("overwrite").json(path)


def top_parents(
    parents: DataFrame, children: DataFrame, key: str, child_key: str, n: int = 10, count: str = "children"
) -> DataFrame:
    """The `n` parents with the most children, parents without any included; ties go to the
    smaller key. Children are counted where they are read, so a parent that has a third of
    all children moves as one row per task; the order is limited in every task as well."""
    per_parent = children.groupBy(F.col(child_key).alias(key)).agg(F.count(F.lit(1)).alias(count))
    counted = parents.join(per_parent, key, "left").na.fill(0, [count])
    return counted.orderBy(F.desc(count), key).limit(n)


def largest(rows: DataFrame, size: Column, ties: Sequence[str], n: int = 20, name: str = "size") -> DataFrame:
    """The `n` rows of the greatest size, the size under `name`; unknown sizes come last.
    Payloads stay behind: keep of `rows` what the report needs besides the size."""
    return rows.withColumn(name, size).orderBy(F.desc_nulls_last(name), *ties).limit(n)
