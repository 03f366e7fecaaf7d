"""Introspection documents (types with fields) and field inventories."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.typenames import base_of_levels, is_nullable, levels, text_of_levels
from tidemark.session import remove, scratch_path

FIELD_INVENTORY_SCHEMA = (
    "Type string, Field string, `GraphQL Type` string, `Base Type` string, "
    "Nullable string, Kind string"
)


def type_entry_schema() -> str:
    return "struct<kind: string, fields: array<struct<name: string, type: variant>>>"


def read_introspection(spark: SparkSession, path: str) -> DataFrame:
    """(type_name, kind, fields) rows out of documents `{results: {<type>: {...}}}`."""
    schema = f"results map<string, {type_entry_schema()}>"
    documents = spark.read.schema(schema).option("multiLine", True).json(path)
    return documents.select(F.explode("results").alias("type_name", "entry")).select(
        "type_name",
        F.coalesce("entry.kind", F.lit("UNKNOWN")).alias("kind"),
        F.col("entry.fields").alias("fields"),
    )


def field_inventory(types: DataFrame) -> DataFrame:
    """One row per field of an object type. A type is walked once for its text and its name."""
    field, seen = F.col("field"), F.col("_levels")
    return (
        types.where("kind = 'OBJECT'")
        .select("type_name", "kind", F.explode("fields").alias("field"))
        .withColumn("_levels", levels(field["type"]))
        .select(
            F.col("type_name").alias("Type"),
            field["name"].alias("Field"),
            text_of_levels(seen).alias("GraphQL Type"),
            base_of_levels(seen).alias("Base Type"),
            F.when(is_nullable(field["type"]), "Yes").otherwise("No").alias("Nullable"),
            F.col("kind").alias("Kind"),
        )
    )


def read_field_inventory(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(FIELD_INVENTORY_SCHEMA).option("header", True).csv(path)


def write_field_inventory(fields: DataFrame, path: str) -> None:
    """CSV ordered by type and field. The fields are worked out once, into scratch: an order
    over a whole table reads its rows twice, once to find the ranges."""
    spark = fields.sparkSession
    worked_out = scratch_path(spark, "field-rows")
    fields.write.parquet(worked_out)
    rows = spark.read.schema(fields.schema).parquet(worked_out)
    rows.orderBy("Type", "Field").write.mode("overwrite").option("header", True).csv(path)
    remove(spark, worked_out)
