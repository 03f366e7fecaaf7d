"""Integrity, completeness and threshold checks as rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.inventory import SNAPSHOT_ID, of_snapshot

ISSUE_COLUMNS = ["severity", "category", "table", "field", "count"]


@dataclass(frozen=True)
class ForeignKey:
    child: str
    column: str
    parent: str
    parent_key: str = "id"


# The checks of the business tables.
FOREIGN_KEYS = [
    ForeignKey("invoices", "client_id", "clients"),
    ForeignKey("quotes", "client_id", "clients"),
    ForeignKey("properties", "client_id", "clients"),
    ForeignKey("jobs", "client_id", "clients"),
    ForeignKey("jobs", "property_id", "properties"),
    ForeignKey("jobs", "quote_id", "quotes"),
    ForeignKey("requests", "client_id", "clients"),
    ForeignKey("requests", "property_id", "properties"),
    ForeignKey("requests", "converted_to_quote_id", "quotes"),
    ForeignKey("requests", "converted_to_job_id", "jobs"),
    ForeignKey("expenses", "job_id", "jobs"),
    ForeignKey("visits", "job_id", "jobs"),
    ForeignKey("visits", "client_id", "clients"),
    ForeignKey("visits", "property_id", "properties"),
    ForeignKey("visits", "assigned_user_id", "users"),
    ForeignKey("timesheet_entries", "user_id", "users"),
    ForeignKey("timesheet_entries", "job_id", "jobs"),
    ForeignKey("timesheet_entries", "visit_id", "visits"),
    ForeignKey("timesheet_entries", "approved_by_id", "users"),
    ForeignKey("timesheet_entries", "paid_by_id", "users"),
    ForeignKey("attachments", "note_id", "notes"),
]
REQUIRED_FIELDS = [
    ("invoices", "client_id"),
    ("quotes", "client_id"),
    ("properties", "client_id"),
    ("jobs", "client_id"),
    ("requests", "client_id"),
    ("expenses", "job_id"),
    ("visits", "job_id"),
    ("visits", "client_id"),
    ("timesheet_entries", "user_id"),
    ("timesheet_entries", "job_id"),
    ("attachments", "note_id"),
    ("notes", "entity_type"),
    ("notes", "entity_id"),
]
NOTE_PARENT_TABLES = {
    "Client": "clients",
    "Job": "jobs",
    "Quote": "quotes",
    "Request": "requests",
    "Invoice": "invoices",
}


def _union(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def _issues(counts: DataFrame, category: str) -> DataFrame:
    return counts.select(
        F.lit("ERROR").alias("severity"),
        F.lit(category).alias("category"),
        "table",
        "field",
        F.col("count").cast("bigint").alias("count"),
    )


def _value_type(tables: Mapping[str, DataFrame], rules: Sequence[ForeignKey]) -> str:
    """The type that all keys and references have; text where they differ."""
    types = {tables[t].schema[c].dataType.simpleString() for r in rules for t, c in ((r.child, r.column), (r.parent, r.parent_key))}
    return types.pop() if len(types) == 1 else "string"


def foreign_key_orphans(
    tables: Mapping[str, DataFrame],
    rules: Sequence[ForeignKey] = tuple(FOREIGN_KEYS),
    blank_is_null: bool = False,
) -> DataFrame:
    """Orphan rows per rule, zeros included: (table, field, parent, count).

    One scan per table, one shuffle, no join of tables. A scan gives all keys and references
    of a row, tagged with the parent they belong to; a (parent, value) that no key has is an
    orphan. References are counted where they are read, so a hot value moves as one row per
    task. Parents need no unique keys. Rules on absent tables are skipped.
    """
    rules = [r for r in rules if r.child in tables and r.parent in tables]
    parents = list(dict.fromkeys((r.parent, r.parent_key) for r in rules))
    # A rule has its own counter among those of its parent.
    slots = [sum(q.parent == r.parent and q.parent_key == r.parent_key for q in rules[:i]) for i, r in enumerate(rules)]
    tags = [parents.index((r.parent, r.parent_key)) for r in rules]
    kind = _value_type(tables, rules)
    is_key = -1

    def entry(tag: int, slot: int, column: str) -> Column:
        value = F.col(column).cast(kind)
        if slot != is_key and blank_is_null:
            value = F.when(F.col(column).cast("string") != "", value)
        return F.struct(F.lit(tag).alias("tag"), F.lit(slot).alias("slot"), value.alias("value"))

    frames = []
    for name in dict.fromkeys([*(r.child for r in rules), *(p for p, _ in parents)]):
        entries = [entry(t, s, r.column) for r, t, s in zip(rules, tags, slots) if r.child == name]
        entries += [entry(tag, is_key, key) for tag, (parent, key) in enumerate(parents) if parent == name]
        frames.append(tables[name].select(F.inline(F.array(*entries))).where("value is not null"))
    counters = [F.count_if(F.col("slot") == i).alias(f"n{i}") for i in range(max(slots, default=0) + 1)]
    values = _union(frames).groupBy("tag", "value").agg(F.max(F.col("slot") == is_key).alias("found"), *counters)
    found = values.where(~F.col("found")).groupBy("tag").agg(*[F.sum(f"n{i}").alias(f"n{i}") for i in range(len(counters))])
    pairs = F.array(*[F.struct(F.lit(i).alias("slot"), F.col(f"n{i}").alias("orphans")) for i in range(len(counters))])
    names = [(t, s, r.child, r.column, f"{r.parent}.{r.parent_key}") for r, t, s in zip(rules, tags, slots)]
    listed = values.sparkSession.createDataFrame(names, "tag int, slot int, `table` string, field string, parent string")
    return listed.join(found.select("tag", F.inline(pairs)), ["tag", "slot"], "left").select(
        "table", "field", "parent", F.coalesce("orphans", F.lit(0)).alias("count")
    )


def foreign_key_issues(
    tables: Mapping[str, DataFrame],
    rules: Sequence[ForeignKey] = tuple(FOREIGN_KEYS),
    blank_is_null: bool = False,
) -> DataFrame:
    found = foreign_key_orphans(tables, rules, blank_is_null).where("count > 0")
    return _issues(found, "FK_INTEGRITY")


def null_counts(
    tables: Mapping[str, DataFrame], required: Sequence[tuple[str, str]] = tuple(REQUIRED_FIELDS)
) -> DataFrame:
    """NULLs per required field, zeros included; one scan per table."""
    frames = []
    for table in dict.fromkeys(t for t, _ in required if t in tables):
        fields = [f for t, f in required if t == table]
        counted = tables[table].agg(
            *[F.count_if(F.col(f).isNull()).alias(f) for f in fields]
        )
        pairs = F.array(
            *[F.struct(F.lit(f).alias("field"), F.col(f).alias("count")) for f in fields]
        )
        frames.append(counted.select(F.lit(table).alias("table"), F.inline(pairs)))
    return _union(frames)


def required_issues(
    tables: Mapping[str, DataFrame], required: Sequence[tuple[str, str]] = tuple(REQUIRED_FIELDS)
) -> DataFrame:
    return _issues(null_counts(tables, required).where("count > 0"), "NULL_REQUIRED")


def count_matching(df: DataFrame, table: str, rules: Mapping[str, Column]) -> DataFrame:
    """Rows per named condition in one scan: (table, field, count)."""
    counted = df.agg(*[F.count_if(cond).alias(name) for name, cond in rules.items()])
    pairs = F.array(
        *[F.struct(F.lit(name).alias("field"), F.col(name).alias("count")) for name in rules]
    )
    return counted.select(F.lit(table).alias("table"), F.inline(pairs))


def polymorphic_orphans(
    notes: DataFrame,
    parents: Mapping[str, DataFrame],
    keys: Mapping[str, str] | None = None,
    strict_case: bool = False,
) -> DataFrame:
    """Notes per parent kind whose parent does not exist, in one join over all kinds.

    `strict_case` compares kind names as they are written; by default case does not
    matter. Kinds outside `parents` are not checked.
    """
    keys = keys or {}

    def label(name: Column) -> Column:
        return name if strict_case else F.lower(name)

    known = _union(
        [
            df.select(
                label(F.lit(kind)).alias("kind"),
                F.col(keys.get(kind, "id")).cast("string").alias("entity_id"),
            )
            for kind, df in parents.items()
        ]
    )
    counts = (
        notes.select(label(F.col("entity_type")).alias("kind"), F.col("entity_id").cast("string"))
        .where(F.col("kind").isin([k if strict_case else k.lower() for k in parents]))
        .groupBy("kind", "entity_id")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return (
        counts.join(known, ["kind", "entity_id"], "left_anti")
        .groupBy("kind")
        .agg(F.sum("n").alias("count"))
    )


def polymorphic_issues(
    notes: DataFrame,
    parents: Mapping[str, DataFrame],
    keys: Mapping[str, str] | None = None,
    strict_case: bool = False,
) -> DataFrame:
    found = polymorphic_orphans(notes, parents, keys, strict_case)
    return _issues(
        found.select(F.lit("notes").alias("table"), F.lit("entity_id").alias("field"), "count"),
        "NOTES_INTEGRITY",
    )


def issue_totals(issues: DataFrame) -> DataFrame:
    return issues.groupBy("category", "severity").agg(
        F.count(F.lit(1)).alias("issues"), F.sum("count").alias("rows")
    )


def verdict(issues: DataFrame) -> DataFrame:
    """One row: passed when there is no ERROR issue."""
    errors = F.count_if(F.col("severity") == "ERROR")
    return issues.agg((errors == 0).alias("passed"), F.count(F.lit(1)).alias("issues"))


def completeness(
    inventory: DataFrame,
    queue: DataFrame,
    run_counts: DataFrame | None = None,
    snapshot_id: str | None = None,
) -> DataFrame:
    """What of the inventory was not attempted or failed, per kind and snapshot.

    Counts come from the queue's state; `run_counts` (entity_type, extracted, failed)
    compares one run with the whole inventory instead.
    """
    inventory, queue = of_snapshot(inventory, snapshot_id), of_snapshot(queue, snapshot_id)
    if run_counts is None:
        # Both sides as rows of one grouping: what is expected, and how it went.
        sides = [inventory.withColumn("_status", F.lit("expected")), queue.withColumn("_status", F.col("status"))]
        status = F.col("_status")
        both = (
            _union([df.select("entity_type", SNAPSHOT_ID, "_status") for df in sides])
            .groupBy("entity_type", SNAPSHOT_ID)
            .agg(
                F.count_if(status == "expected").alias("expected"),
                F.count_if(status == "done").alias("extracted"),
                F.count_if(status == "failed").alias("failed"),
            )
            .where("expected > 0")
        )
    else:
        expected = inventory.groupBy("entity_type").agg(F.count(F.lit(1)).alias("expected"))
        both = expected.join(run_counts, "entity_type", "left").na.fill(0, ["extracted", "failed"])
    attempted = F.col("extracted") + F.col("failed")
    checks = F.array(
        F.struct(
            F.lit("entity_count_mismatch").alias("type"),
            attempted.alias("actual"),
            (F.col("expected") - attempted).alias("difference"),
            F.lit("error").alias("severity"),
        ),
        F.struct(
            F.lit("failed_entities").alias("type"),
            F.col("extracted").alias("actual"),
            F.col("failed").alias("difference"),
            failure_severity(F.col("failed"), F.col("expected")).alias("severity"),
        ),
    )
    return (
        both.select("entity_type", "expected", F.inline(checks))
        .where("difference > 0")
        .select("type", "entity_type", "expected", "actual", "difference", "severity")
    )


def failure_severity(failed: Column, expected: Column) -> Column:
    """A warning while strictly less than a tenth failed."""
    return F.when(failed * 10 < expected, F.lit("warning")).otherwise(F.lit("error"))


def attachment_completeness(summary: DataFrame) -> DataFrame:
    """The same check for a download pass; `summary` has downloaded, failed, skipped."""
    total = F.col("downloaded") + F.col("failed") + F.col("skipped")
    return summary.where("failed > 0").select(
        F.lit("failed_attachments").alias("type"),
        F.lit(None).cast("string").alias("entity_type"),
        total.alias("expected"),
        F.col("downloaded").alias("actual"),
        F.col("failed").alias("difference"),
        failure_severity(F.col("failed"), total).alias("severity"),
    )


def mapped_versus_extracted(
    inventory: DataFrame, queue: DataFrame, snapshot_id: str | None = None
) -> DataFrame:
    """Mapped, extracted and failed records per kind.

    Records and their queue state are rows of one grouping. A record counts once however
    often it is mapped, and its state where it is mapped in the same snapshot; over several
    snapshots rows are dealt out by record, which serves both groupings.
    """
    record, key = ["entity_type", "entity_id"], ["entity_type", "entity_id", SNAPSHOT_ID]
    mapped = of_snapshot(inventory, snapshot_id).select(*key, F.lit(True).alias("_mapped"), F.lit("").alias("status"))
    state = of_snapshot(queue, snapshot_id).select(*key, F.lit(False).alias("_mapped"), "status")
    rows = mapped.unionByName(state)
    if snapshot_id is None:
        rows = rows.repartition(*record)
    records = (
        rows.groupBy(*key)
        .agg(
            F.max("_mapped").alias("_mapped"),
            F.count_if(F.col("status") == "done").alias("done"),
            F.count_if(F.col("status") == "failed").alias("failed"),
        )
        .where("_mapped")
    )
    if snapshot_id is None:
        records = records.groupBy(*record).agg(F.sum("done").alias("done"), F.sum("failed").alias("failed"))
    return records.groupBy("entity_type").agg(
        F.count(F.lit(1)).alias("mapped_count"),
        F.sum("done").alias("extracted_count"),
        F.sum("failed").alias("failed_count"),
    )


# Metric, operator, threshold, code of a finding.
THRESHOLDS = [
    ("total_entities", ">", 10000.0, "large_entity_count"),
    ("avg_relations", ">", 20.0, "high_average_relations"),
    ("max_relations", ">", 100.0, "hotspot_entities"),
    ("success_rate", "<", 95.0, "low_success_rate"),
    ("bytes_per_second", "<", 1048576.0, "slow_download"),
    ("bytes_per_second", ">", 104857600.0, "fast_download"),
    ("max_requested_cost", ">", 8000.0, "high_query_cost"),
    ("min_available_points", "<", 2000.0, "low_capacity"),
    ("requests_per_second", "<", 2.0, "rate_too_low"),
    ("requests_per_second", ">", 8.0, "rate_too_high"),
    ("rows_per_second", "<", 10.0, "slow_extraction"),
    ("peak_memory_mb", ">", 1000.0, "high_memory"),
]


def threshold_findings(
    metrics: DataFrame, rules: Sequence[tuple[str, str, float, str]] = tuple(THRESHOLDS)
) -> DataFrame:
    """Rules that hit; `metrics` has (subject, metric, value)."""
    table = metrics.sparkSession.createDataFrame(
        list(rules), "metric string, op string, threshold double, code string"
    )
    hit = F.when(F.col("op") == ">", F.col("value") > F.col("threshold")).otherwise(
        F.col("value") < F.col("threshold")
    )
    return metrics.join(table, "metric").where(hit).select(
        "subject", "metric", "value", "threshold", "code"
    )


def unpivot_metrics(df: DataFrame, subject: str, columns: Sequence[str]) -> DataFrame:
    """(subject, metric, value) rows out of metric columns."""
    pairs = F.array(
        *[
            F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("value"))
            for c in columns
        ]
    )
    return df.select(F.col(subject).alias("subject"), F.inline(pairs))
