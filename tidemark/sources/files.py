"""File contents as rows."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.files import content_hash, stored_name

# Files above this size are hashed block by block: a row cannot hold 2 GB, and a task should
# not hold much less.
LARGE, BLOCK = 64 << 20, 4 << 20


def _listed(spark: SparkSession, path: str, pattern: str) -> DataFrame:
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", True)
        .load(path)
    )


def _hashed_in_blocks(files: DataFrame, block: int) -> DataFrame:
    """SHA-256 of files of any size, read through their own file system; a task holds one
    block. The listing deals paths out by their files' sizes, so large files run side by side."""

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow.fs import FileSystem

        for batch in batches:
            hashes = []
            for uri in batch["path"].to_pylist():
                system, place = FileSystem.from_uri(uri)
                digest = hashlib.sha256()
                with system.open_input_stream(place, buffer_size=0) as stream:
                    while part := stream.read(block):
                        digest.update(part)
                hashes.append(digest.hexdigest())
            yield pa.RecordBatch.from_arrays([batch["path"], batch["length"], pa.array(hashes)], ["path", "length", "hash"])

    return files.mapInArrow(digests, "path string, length bigint, hash string")


def hashed_files(
    spark: SparkSession, path: str, pattern: str = "*", large: int = LARGE, block: int = BLOCK
) -> DataFrame:
    """(path, length, hash, stored_name) of every file; contents never leave the task.

    Files up to `large` bytes are hashed as rows of Spark's own reader, larger ones, whose
    paths alone are listed, in blocks of `block` bytes. Spark's listing leaves empty files out.
    """
    small = _listed(spark, path, pattern).where(F.col("length") <= large)
    small = small.select("path", "length", content_hash(F.col("content")).alias("hash"))
    rest = _listed(spark, path, pattern).where(F.col("length") > large).select("path", "length")
    hashed = small.unionByName(_hashed_in_blocks(rest, block))
    return hashed.withColumn("stored_name", stored_name(F.col("hash"), F.col("path")))
