"""Batch folders of a table that grows by micro-batches, and folding them.

A batch lies under its feed and number, and a replay replaces it. Folding writes one folder
in place of many and then records which ones it covers; that record is the moment the fold
takes effect. Readers take what is not covered, so a fold that stops halfway shows nothing,
a folder that outlives its fold is not read twice, and a replayed batch that a fold covers
already changes nothing.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.session import files_in, folders_in, read_text, remove, write_text

FEED = "feed"
BATCH = "batch"
FOLDED = "folded"
# Spark's readers pass over folders with a leading underscore.
COVERS = "_covers"
DONE = "_SUCCESS"
POSITION = T.StructType([T.StructField(FEED, T.StringType()), T.StructField(BATCH, T.LongType())])

Folder = tuple[str, int]


def folder_path(target: str, folder: Folder) -> str:
    return f"{target.rstrip('/')}/{FEED}={folder[0]}/{BATCH}={folder[1]}"


def _named(path: str, key: str) -> str | None:
    name = path.rstrip("/").rsplit("/", 1)[-1]
    return name.split("=", 1)[1] if name.startswith(f"{key}=") else None


def all_folders(spark: SparkSession, target: str) -> list[Folder]:
    """Every batch folder there is, covered or not."""
    found = []
    for path in folders_in(spark, target):
        feed = _named(path, FEED)
        if feed is not None:
            found += [(feed, int(b)) for p in folders_in(spark, path) if (b := _named(p, BATCH)) is not None]
    return sorted(found)


def covers(spark: SparkSession, target: str) -> dict[str, list[Folder]]:
    """Folds that took effect, by feed name, and the folders each covers."""
    records = files_in(spark, f"{target.rstrip('/')}/{COVERS}")
    return {path.rsplit("/", 1)[-1]: [(f, b) for f, b in json.loads(read_text(spark, path))] for path in records}


def live_folders(spark: SparkSession, target: str) -> list[Folder]:
    """The folders that make up the table now."""
    folds = covers(spark, target)
    hidden = {folder for folders in folds.values() for folder in folders}
    return [
        (feed, batch)
        for feed, batch in all_folders(spark, target)
        if (feed, batch) not in hidden and (not feed.startswith(FOLDED) or feed in folds)
    ]


def read_folders(
    spark: SparkSession, target: str, folders: Sequence[Folder], schema: T.StructType | None = None
) -> DataFrame:
    """The rows of these folders with their feed and batch number."""
    if not folders:
        if schema is None:
            raise ValueError(f"no batch in {target}")
        return spark.createDataFrame([], T.StructType([*schema.fields, *POSITION.fields]))
    reader = spark.read.option("basePath", target)
    if schema is not None:
        reader = reader.schema(T.StructType([*schema.fields, *POSITION.fields]))
    rows = reader.parquet(*[folder_path(target, f) for f in folders])
    return rows.withColumns({FEED: F.col(FEED).cast("string"), BATCH: F.col(BATCH).cast("long")})


def read_live(spark: SparkSession, target: str, schema: T.StructType | None = None) -> DataFrame:
    return read_folders(spark, target, live_folders(spark, target), schema)


def write_batch(rows: DataFrame, target: str, folder: Folder, by: Sequence[str] = ()) -> None:
    writer = rows.write.mode("overwrite")
    (writer.partitionBy(*by) if by else writer).parquet(folder_path(target, folder))


def sweep(spark: SparkSession, target: str) -> None:
    """Remove the folders that folds cover, once nothing reads them any more."""
    hidden = {folder for covered in covers(spark, target).values() for folder in covered}
    for folder in set(all_folders(spark, target)) & hidden:
        remove(spark, folder_path(target, folder))


def fold(
    spark: SparkSession,
    target: str,
    reduce_rows: Callable[[DataFrame], DataFrame],
    folders: Sequence[Folder] | None = None,
    by: Sequence[str] = (),
    name: str = FOLDED,
    before: Callable[[Folder, DataFrame], None] | None = None,
) -> Folder | None:
    """Fold these folders (all live ones by default) into one; returns it. A record lists at
    most the folders that came in since the fold before.

    `reduce_rows` gets their rows with feed and batch and gives the rows to keep. `before`
    is called with the new folder and its rows before it takes effect. Folders covered by
    an earlier fold are removed now: whoever listed them before that fold has had the time
    of one fold to read them.
    """
    folds = covers(spark, target)
    sweep(spark, target)
    folders = live_folders(spark, target) if folders is None else list(folders)
    if not folders:
        return None
    made = (f"{name}-{uuid.uuid4().hex[:12]}", 0)
    write_batch(reduce_rows(read_folders(spark, target, folders)), target, made, by)
    if before is not None:
        before(made, spark.read.parquet(folder_path(target, made)))
    # What the folded folders covered stays covered: their records go with them.
    inner = [f for feed, _ in folders for f in folds.get(feed, [])]
    write_text(spark, f"{target.rstrip('/')}/{COVERS}/{made[0]}", json.dumps([*folders, *inner]))
    for feed, _ in folders:
        if feed in folds:
            remove(spark, f"{target.rstrip('/')}/{COVERS}/{feed}")
    return made
