"""Page feed -> rows -> keyed table, resumable through the stream's checkpoint.

Each micro-batch writes its newest row per key under its feed and batch id, replacing
that folder when a batch is replayed; the table's state is the newest row per key
over all batches. A feed is named by its checkpoint, so feeds that share a target never
replace each other's batches. `compact` folds the batches into one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.merge import earliest_per_key, latest_per_key
from tidemark.session import absolute
from tidemark.sources.pages import nodes_of, page_columns, page_schema
from tidemark.sources.records import Record
from tidemark.streaming import batches
from tidemark.streaming.batches import BATCH, FEED, read_live
from tidemark.streaming.keyindex import BUCKETS, KeyIndex

COMPLETED = "completed"
IN_PROGRESS = "in_progress"
STATE_SCHEMA = (
    "entity_type string, last_cursor string, total_fetched bigint, sync_status string, "
    "updated_at string, last_sync_at string"
)


def page_stream(
    spark: SparkSession, path: str, root: str, files_per_batch: int | None = None
) -> DataFrame:
    reader = spark.readStream.schema(page_schema(root))
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return nodes_of(page_columns(reader.json(path), root))


def table_stream(
    spark: SparkSession, path: str, schema: T.StructType, files_per_batch: int | None = None
) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def feed_of(spark: SparkSession, checkpoint: str) -> str:
    """Name of the feed that keeps its cursor in this checkpoint, however that is spelled."""
    return hashlib.md5(absolute(spark, checkpoint).encode()).hexdigest()[:12]


def drain(
    rows: DataFrame,
    target: str,
    checkpoint: str,
    reduce_batch: Callable[[DataFrame, int], DataFrame],
    after_batch: Callable[[int], None] | None = None,
) -> StreamingQuery:
    """Run a feed until it is drained, each batch reduced and written to its own folder;
    started again, it goes on where it stopped. `after_batch` is called once a batch is
    written and, on a replay, again."""
    feed = feed_of(rows.sparkSession, checkpoint)

    def write(batch: DataFrame, batch_id: int) -> None:
        batches.write_batch(reduce_batch(batch, batch_id), target, (feed, batch_id))
        if after_batch is not None:
            after_batch(batch_id)

    return (
        rows.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def upsert_stream(
    rows: DataFrame,
    target: str,
    checkpoint: str,
    keys: Sequence[str],
    seq: Sequence[str],
    prepare: Callable[[DataFrame], DataFrame] | None = None,
    after_batch: Callable[[int], None] | None = None,
) -> StreamingQuery:
    """Newest row per key of every batch."""

    def newest(batch: DataFrame, _: int) -> DataFrame:
        return latest_per_key(prepare(batch) if prepare else batch, keys, seq)

    return drain(rows, target, checkpoint, newest, after_batch)


def current_state(
    spark: SparkSession, target: str, keys: Sequence[str], seq: Sequence[str]
) -> DataFrame:
    """Newest row per key. Equal sequence values of one feed go to its later batch; across
    feeds, whose batch numbers say nothing about each other, to one feed by name."""
    rows = read_live(spark, target)
    return latest_per_key(rows, keys, [*seq, FEED, BATCH]).drop(BATCH, FEED)


def compact(spark: SparkSession, target: str, keys: Sequence[str], seq: Sequence[str]) -> None:
    """Fold all batches into one folder and remove the others, so that a plain read of the
    target is right again too. Run it while no feed of the target is running."""
    index = KeyIndex.of(spark, target, keys)
    if index is not None:
        index.cover(target)

    def newest(rows: DataFrame) -> DataFrame:
        return latest_per_key(rows, keys, [*seq, FEED, BATCH]).drop(BATCH, FEED)

    made = batches.fold(spark, target, newest)
    if index is not None and made is not None:
        index.know(made)
    batches.sweep(spark, target)


def new_only_stream(
    rows: DataFrame,
    target: str,
    checkpoint: str,
    keys: Sequence[str],
    seq: Sequence[str],
    after_batch: Callable[[int], None] | None = None,
    buckets: int = BUCKETS,
) -> StreamingQuery:
    """Append rows whose key was never seen; the first arrival of a key stays.

    Every batch is held against all keys of the target, those stored before the feed and
    by other feeds included, but for the folder that a replayed batch replaces. The keys
    lie in an index beside the table; a batch reads those parts of it that may hold one of
    its own keys, so its work does not grow with what is stored. Null is a key like others.
    """
    spark = rows.sparkSession
    index, feed = KeyIndex(spark, target, rows.select(*keys).schema, buckets), feed_of(spark, checkpoint)
    held: list[DataFrame] = []

    def fresh(batch: DataFrame, batch_id: int) -> DataFrame:
        index.cover(target, but=(feed, batch_id))
        first = earliest_per_key(batch, keys, seq).persist()  # asked of the index, then written
        held.append(first)
        return index.unseen(first, but=(feed, batch_id))

    def remember(batch_id: int) -> None:
        held.pop().unpersist()
        written = spark.read.schema(rows.schema).parquet(batches.folder_path(target, (feed, batch_id)))
        index.add(written, (feed, batch_id))
        index.tidy(but=(feed, batch_id))
        if after_batch is not None:
            after_batch(batch_id)

    return drain(rows, target, checkpoint, fresh, remember)


class FeedRecord:
    """The resume record of a feed: one row, replaced after every batch, so that it can be
    read while the feed runs. The cursor is the last batch done; the offsets behind it are
    in the feed's checkpoint. A drained feed has no cursor.

    Pass `batch_done` as the feed's `after_batch`, and call `finished` when it has ended.
    """

    def __init__(self, spark: SparkSession, path: str, entity_type: str, target: str, clock: Callable[[], str]) -> None:
        self._spark, self._type, self._target, self._clock = spark, entity_type, target, clock
        self._record = Record(spark, path, STATE_SCHEMA)

    def batch_done(self, batch_id: int) -> None:
        self._put(str(batch_id), self._total(), IN_PROGRESS)

    def finished(self, query: StreamingQuery) -> None:
        """Completed without a cursor; in progress, at its last cursor, where it failed."""
        row = self._record.values()
        failed = query.isActive or query.exception() is not None
        cursor = row[1] if row and failed else None
        self._put(cursor, self._total(), IN_PROGRESS if failed else COMPLETED)

    def read(self) -> DataFrame:
        return self._record.read()

    def _total(self) -> int:
        """Rows stored; Parquet knows them without reading any."""
        folders = batches.live_folders(self._spark, self._target)
        return batches.read_folders(self._spark, self._target, folders).count() if folders else 0

    def _put(self, cursor: str | None, total: int, status: str) -> None:
        now = self._clock()
        self._record.put(self._type, cursor, total, status, now, now)


def migration_state(
    entity_type: str, state: DataFrame, query: StreamingQuery, as_of: str
) -> DataFrame:
    """The resume record of a drained feed; the cursor itself lives in the checkpoint."""
    finished = not query.isActive and query.exception() is None
    return state.agg(F.count(F.lit(1)).alias("total_fetched")).select(
        F.lit(entity_type).alias("entity_type"),
        F.lit(None).cast("string").alias("last_cursor"),
        "total_fetched",
        F.lit(COMPLETED if finished else IN_PROGRESS).alias("sync_status"),
        F.lit(as_of).alias("updated_at"),
        F.lit(as_of).alias("last_sync_at"),
    )
