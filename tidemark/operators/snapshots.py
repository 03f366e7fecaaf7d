"""Stored snapshots of an inventory, compared by digests of their key buckets.

A snapshot is stored in buckets of its record keys, and beside it one digest per bucket that
does not depend on the order of rows. Two snapshots then differ at most in the buckets whose
digests differ; only those are read and joined.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.inventory import KEY, SNAPSHOT_ID, snapshot_diff
from tidemark.session import folders_in, remove

BUCKETS = 256
BUCKET = "bucket"
# What a comparison looks at: the record's key and when it changed.
COMPARED = [*KEY, "updated_at"]
DIGEST = "bucket int, buckets int, records long, first decimal(38,0), second decimal(38,0)"


def _hash(salt: int) -> Column:
    """Of a record; nulls count as values of their own."""
    return F.xxhash64(F.lit(salt), *COMPARED, *[F.col(c).isNull() for c in COMPARED])


def _folder(path: str, snapshot_id: str, digests: bool = False) -> str:
    return f"{path.rstrip('/')}{'/_digests' if digests else ''}/{SNAPSHOT_ID}={snapshot_id}"


def write_snapshot(inventory: DataFrame, path: str, snapshot_id: str, buckets: int = BUCKETS) -> None:
    """Store the records of one snapshot, replacing it where it is there.

    Rows move once, to their bucket; a bucket that is far larger than others is split. The
    digests are written last, so a snapshot that was left half written has none.
    """
    spark = inventory.sparkSession
    remove(spark, _folder(path, snapshot_id, digests=True))
    rows = inventory.where(F.col(SNAPSHOT_ID) == snapshot_id).drop(SNAPSHOT_ID)
    placed = rows.withColumn(BUCKET, F.pmod(F.xxhash64(*KEY), F.lit(buckets)).cast("int"))
    folder = _folder(path, snapshot_id)
    placed.hint("rebalance", BUCKET).write.mode("overwrite").partitionBy(BUCKET).parquet(folder)
    stored = spark.read.schema(placed.schema).parquet(folder)
    digests = stored.groupBy(BUCKET).agg(
        F.count(F.lit(1)).alias("records"),
        F.sum(_hash(1).cast("decimal(38,0)")).alias("first"),
        F.sum(_hash(2).cast("decimal(38,0)")).alias("second"),
    )
    digests.withColumn("buckets", F.lit(buckets)).write.parquet(_folder(path, snapshot_id, digests=True))


def stored_snapshots(spark: SparkSession, path: str) -> list[str]:
    """Snapshots that are whole."""
    folders = folders_in(spark, f"{path.rstrip('/')}/_digests")
    return sorted(f.rsplit("=", 1)[-1] for f in folders)


def _digests(spark: SparkSession, path: str, snapshot_id: str) -> DataFrame:
    if snapshot_id not in stored_snapshots(spark, path):
        raise ValueError(f"no whole snapshot {snapshot_id} in {path}")
    return spark.read.schema(DIGEST).parquet(_folder(path, snapshot_id, digests=True))


def changed_buckets(spark: SparkSession, path: str, older: str, newer: str) -> list[int]:
    """Buckets that differ; at most as many as there are buckets reach the driver. Snapshots
    stored in different numbers of buckets differ in all of them."""
    a, b = (_digests(spark, path, s).alias(name) for s, name in ((older, "a"), (newer, "b")))
    values = ["buckets", "records", "first", "second"]
    differ = ~F.struct(*[F.col(f"a.{v}") for v in values]).eqNullSafe(F.struct(*[F.col(f"b.{v}") for v in values]))
    both = a.join(b, F.col(f"a.{BUCKET}") == F.col(f"b.{BUCKET}"), "full_outer").where(differ)
    rows = both.select(F.coalesce(f"a.{BUCKET}", f"b.{BUCKET}").alias(BUCKET)).collect()
    return sorted(r[BUCKET] for r in rows)


def read_snapshot(
    spark: SparkSession, path: str, snapshot_id: str, buckets: list[int] | None = None
) -> DataFrame:
    """The records of a stored snapshot, or those in some of its buckets."""
    rows = spark.read.option("basePath", path).parquet(_folder(path, snapshot_id))
    return rows if buckets is None else rows.where(F.col(BUCKET).isin(buckets))


def stored_diff(spark: SparkSession, path: str, older: str, newer: str) -> DataFrame:
    """new, changed and deleted records between two stored snapshots (see `snapshot_diff`)."""
    counts = {_digests(spark, path, s).agg(F.max("buckets")).first()[0] for s in (older, newer)} - {None}
    if len(counts) > 1:
        return snapshot_diff(read_snapshot(spark, path, older), read_snapshot(spark, path, newer))
    buckets = changed_buckets(spark, path, older, newer)
    return snapshot_diff(read_snapshot(spark, path, older, buckets), read_snapshot(spark, path, newer, buckets))
