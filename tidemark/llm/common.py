"""What the corpus operators share: reading, row keys, staged tables and their removal."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import scratch_path

Query = Callable[[SparkSession, str], DataFrame]


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def stretch(chars: int, text: str = "text", key: str = "doc_id") -> Column:
    """So many characters of the text, or all, from a place that the key's hash decides."""
    places = F.greatest(F.length(text) - chars + 1, F.lit(1))
    return F.substring(F.col(text), (F.pmod(F.xxhash64(key), places) + 1).cast("int"), F.lit(chars))


def worked_out(value: Column, then: Callable[[Column], Column]) -> Column:
    """`then` of a value that is worked out once, however often `then` uses it."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def fresh(prefix: str) -> str:
    """A column name that no caller's column has."""
    return f"_{prefix}_{uuid.uuid4().hex[:8]}"


class Scratch:
    """Tables that one job hands to the next, below `spark.checkpoint.dir`.

    They are files all executors reach, so that a lost executor costs its tasks only.
    `drop` removes a table as soon as nothing reads it any more.
    """

    def __init__(self, spark: SparkSession) -> None:
        self._spark = spark

    def stage(self, df: DataFrame, label: str) -> DataFrame:
        path = scratch_path(self._spark, label)
        df.write.parquet(path)
        out = self._spark.read.schema(df.schema).parquet(path)
        out._scratch_path = path
        return out

    def drop(self, *tables: DataFrame) -> None:
        jvm = self._spark._jvm
        conf = self._spark.sparkContext._jsc.hadoopConfiguration()
        for table in tables:
            path = jvm.org.apache.hadoop.fs.Path(table._scratch_path)
            path.getFileSystem(conf).delete(path, True)
