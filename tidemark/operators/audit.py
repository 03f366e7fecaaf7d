"""Which fields a source has, which ones are read, and where the two differ."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fields that matter most per kind.
PRIORITY_FIELDS = {
    "Client": ["balance", "companyName", "billingAddress", "isArchivable"],
    "Invoice": ["amounts", "dueDate", "invoiceNet"],
    "Quote": ["amounts"],
    "Job": ["billingType", "completedAt", "instructions", "invoicedTotal"],
    "Property": ["name", "taxRate", "isBillingAddress", "routingOrder"],
    "Visit": ["completedAt", "completedBy", "allDay", "clientConfirmed"],
    "User": ["isAccountAdmin", "isAccountOwner", "availableForScheduling", "assignedColor"],
}


def field_list(spark: SparkSession, fields: Mapping[str, Sequence[str]]) -> DataFrame:
    rows = [(entity, field) for entity, names in fields.items() for field in names]
    return spark.createDataFrame(rows, "entity string, field string")


def field_differences(available: DataFrame, queried: DataFrame) -> DataFrame:
    """(entity, field, side): missing where only available, extra where only queried."""
    a = available.select("entity", "field", F.lit(True).alias("_a")).distinct()
    q = queried.select("entity", "field", F.lit(True).alias("_q")).distinct()
    side = (
        F.when(F.col("_q").isNull(), "missing").when(F.col("_a").isNull(), "extra").otherwise("both")
    )
    return a.join(q, ["entity", "field"], "full_outer").select("entity", "field", side.alias("side"))


def coverage(available: DataFrame, queried: DataFrame) -> DataFrame:
    """Coverage per queried entity; extras count as queried, so it may exceed 100.

    Entities nobody queries are no part of it.
    """
    side = F.col("side")
    asked = available.join(queried.select("entity").distinct(), "entity", "left_semi")
    counted = (
        field_differences(asked, queried)
        .groupBy("entity")
        .agg(
            F.count_if(side != "extra").alias("total_available"),
            F.count_if(side != "missing").alias("total_queried"),
            F.count_if(side == "missing").alias("missing"),
            F.count_if(side == "extra").alias("extra"),
        )
    )
    percent = F.try_divide(F.col("total_queried") * 100.0, F.col("total_available"))
    return counted.withColumn(
        "coverage_percent", F.coalesce(F.bround(percent, 1), F.lit(0.0))
    )


def coverage_totals(report: DataFrame) -> DataFrame:
    return report.agg(
        F.avg("coverage_percent").alias("avg_coverage"),
        F.sum("missing").alias("total_missing"),
        F.sum("extra").alias("total_extra"),
    )


def priority_missing(differences: DataFrame, priority: DataFrame) -> DataFrame:
    missing = differences.where("side = 'missing'").select("entity", "field")
    return priority.join(missing, ["entity", "field"], "left_semi")


def kind_statistics(types: DataFrame) -> DataFrame:
    """Types per kind."""
    return types.groupBy("kind").agg(F.count(F.lit(1)).alias("types"))
