"""Pages by key over a table that is stored in key order.

The table is written in ranges of its key, and beside it a sparse directory holds the first
and last key of every file, so that a page reads the files that hold its rows and no other.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.session import remove

DIRECTORY = "_directory"
# Directory rows asked for first; doubled until their files fill the page.
FIRST_FILES = 4


def write_in_order(df: DataFrame, path: str, key: str, files: int | None = None) -> None:
    """Store the rows with a key, sorted by it, in `files` ranges (by default as many as a
    shuffle gives), then the directory. Rows without a key have no place in an order of keys
    and are left out."""
    spark = df.sparkSession
    remove(spark, f"{path}/{DIRECTORY}")
    keyed = df.where(F.col(key).isNotNull())
    ranges = keyed.repartitionByRange(files, key) if files else keyed.repartitionByRange(key)
    ranges.sortWithinPartitions(key).write.mode("overwrite").parquet(path)
    stored = spark.read.schema(df.schema).parquet(path)
    held = stored.groupBy(F.col("_metadata.file_path").alias("file")).agg(
        F.min(key).alias("first"), F.max(key).alias("last"), F.count(F.lit(1)).alias("rows")
    )
    held.write.parquet(f"{path}/{DIRECTORY}")


def files_of_page(
    spark: SparkSession, path: str, schema: T.StructType, key: str, after: object | None, size: int
) -> list[str]:
    """Files, in key order, that hold the `size` rows that follow `after`. All but the first
    hold only such rows, so the page ends in the file that brings their number to `size`."""
    kind = schema[key].dataType
    fields = [("file", T.StringType()), ("first", kind), ("last", kind), ("rows", T.LongType())]
    directory = spark.read.schema(T.StructType([T.StructField(n, t) for n, t in fields])).parquet(f"{path}/{DIRECTORY}")
    behind = directory if after is None else directory.where(F.col("last") > F.lit(after))
    wanted = FIRST_FILES
    while True:
        rows = behind.orderBy("first", "last").limit(wanted).collect()
        out, held = [], 0
        for i, row in enumerate(rows):
            out.append(row["file"])
            held += row["rows"] if i or after is None or row["first"] > after else 0
            if held >= size:
                return out
        if len(rows) < wanted:
            return out
        wanted *= 2


def page_in_order(
    spark: SparkSession, path: str, schema: T.StructType, key: str, after: object | None, size: int
) -> DataFrame:
    """The `size` rows that follow `after`; the last key of a page starts the next one.
    Pages are whole where the key is unique."""
    files = files_of_page(spark, path, schema, key, after, size)
    if not files:
        return spark.createDataFrame([], schema)
    rows = spark.read.schema(schema).parquet(*files)
    rows = rows if after is None else rows.where(F.col(key) > F.lit(after))
    return rows.orderBy(key).limit(size)
