"""Table readers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


# Session setting: number of partitions to deal scans to before work that costs CPU per row.
SCAN_PARTITIONS = "spark.tidemark.scan.partitions"
# Splits per core below which `spread` deals a scan, and partitions per core it deals to.
FEW_SPLITS, SPREAD = 2, 4


def dealt(scan: DataFrame) -> DataFrame:
    """The scan, dealt to as many partitions as SCAN_PARTITIONS says; as it is where unset.

    For inputs in fewer row groups than cores, which no split size can divide. It shuffles
    the input, so it is a choice of the session and never made by size.
    """
    partitions = scan.sparkSession.conf.get(SCAN_PARTITIONS, None)
    return scan.repartition(int(partitions)) if partitions else scan


def spread(scan: DataFrame) -> DataFrame:
    """The scan for work that costs much CPU per row: dealt as the session says, else to some
    partitions per core where it has few splits, else as it is.

    The rows of a scan of few splits may all lie in one row group, and then in one task.
    Dealing moves the columns that are read; the work after it costs many times that.
    """
    asked = dealt(scan)
    cores = scan.sparkSession.sparkContext.defaultParallelism
    if asked is not scan or scan.rdd.getNumPartitions() >= FEW_SPLITS * cores:
        return asked
    return scan.repartition(SPREAD * cores)


def keyset_page(df: DataFrame, key: str, after: object | None, size: int) -> DataFrame:
    """The `size` rows that follow `after`; the last key of a page starts the next one."""
    rows = df if after is None else df.where(F.col(key) > F.lit(after))
    return rows.orderBy(key).limit(size)


def offset_page(df: DataFrame, order: Sequence[str], offset: int, size: int) -> DataFrame:
    """Kept for small reads: every skipped row is read again."""
    return df.orderBy(*order).offset(offset).limit(size)


def newest(df: DataFrame, size: int, *order: Column) -> DataFrame:
    return df.orderBy(*order).limit(size)


def snapshot_named(snapshots: DataFrame, name: str) -> DataFrame:
    """The snapshot with this id, else the one with this label."""
    return (
        snapshots.where((F.col("id") == name) | (F.col("label") == name))
        .orderBy((F.col("id") != name).cast("int"), "id")
        .limit(1)
    )
