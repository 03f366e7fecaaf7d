"""Streams drained to the end; the result is the state they leave behind."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.plans.reports import event_page_files
from tidemark.operators import queues
from tidemark.plans.registry import AS_OF, Tables, iso_text, key_text, query, time_text
from tidemark.session import scratch_path
from tidemark.streaming import feed, outcomes, rates
from tidemark.streaming.batches import read_live

EVENT_KEY = ["user_id"]
EVENT_SEQ = ["ts", "event_id"]


@query(
    "stream_upsert",
    """
    SELECT CAST(user_id AS VARCHAR) AS client_id, CAST(event_id AS VARCHAR) AS id, event_type AS title
    FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id // 100 DESC, event_id DESC) = 1
    """,
)
def stream_upsert(spark: SparkSession, folder: str) -> DataFrame:
    """Event pages as a feed; the table keeps the last request of every client."""
    source = event_page_files(Tables(spark, folder))
    target, checkpoint = scratch_path(spark, "requests"), scratch_path(spark, "cursor")

    def rows(nodes: DataFrame) -> DataFrame:
        return nodes.select(
            F.try_variant_get("node", "$.client.id", "string").alias("client_id"),
            F.try_variant_get("node", "$.id", "string").alias("id"),
            F.try_variant_get("node", "$.title", "string").alias("title"),
            "page",
            "pos",
        )

    for _ in range(2):  # the second start goes on from the cursor and finds nothing
        stream = feed.page_stream(spark, source, "requests", files_per_batch=4)
        feed.upsert_stream(stream, target, checkpoint, ["client_id"], ["page", "pos"], rows).awaitTermination()
    return feed.current_state(spark, target, ["client_id"], ["page", "pos"]).drop("page", "pos")


def _event_files(spark: SparkSession, folder: str) -> str:
    """All events in five files without any order, one per batch."""
    path = scratch_path(spark, "event-files")
    Tables(spark, folder).events.repartition(5, F.xxhash64("event_id")).write.parquet(path)
    return path


def _event_stream(spark: SparkSession, folder: str) -> DataFrame:
    schema = Tables(spark, folder).events.schema
    return feed.table_stream(spark, _event_files(spark, folder), schema, files_per_batch=1)


@query(
    "stream_rate",
    """
    SELECT strftime(time_bucket(INTERVAL 1 HOUR, ts), '%Y-%m-%d %H:%M:%S') AS window_start, event_type, count(*) AS requests
    FROM events GROUP BY ALL
    """,
)
def stream_rate(spark: SparkSession, folder: str) -> DataFrame:
    """Requests per hour and type; every batch holds rows of all hours."""
    target, checkpoint = scratch_path(spark, "rates"), scratch_path(spark, "cursor")
    events = _event_stream(spark, folder).withColumn("ts", F.col("ts").cast("timestamp"))
    rates.count_stream(events, target, checkpoint, "ts", ["event_type"], "1 hour").awaitTermination()
    counted = rates.rate_per_window(spark, target, ["event_type"])
    return counted.withColumn("window_start", time_text("window_start"))


@query(
    "stream_rate_folded",
    """
    SELECT strftime(time_bucket(INTERVAL 1 HOUR, ts), '%Y-%m-%d %H:%M:%S') AS window_start, event_type,
           CAST(2 AS BIGINT) * count(*) AS requests
    FROM events GROUP BY ALL
    """,
)
def stream_rate_folded(spark: SparkSession, folder: str) -> DataFrame:
    """Counts per minute of two feeds; those of the first are added up to hours before the
    second comes, a third start of the first finds nothing new, and all are read as hours."""
    target, cursor = scratch_path(spark, "rates"), scratch_path(spark, "cursor")
    source, schema = _event_files(spark, folder), Tables(spark, folder).events.schema

    def count(checkpoint: str) -> None:
        stream = feed.table_stream(spark, source, schema, files_per_batch=1)
        timed = stream.withColumn("ts", F.col("ts").cast("timestamp"))
        rates.count_stream(timed, target, checkpoint, "ts", ["event_type"], "1 minute").awaitTermination()

    count(cursor)
    rates.fold_counts(spark, target, ["event_type"], "1 hour")
    count(scratch_path(spark, "cursor"))
    count(cursor)
    counted = rates.rate_per_window(spark, target, ["event_type"], "1 hour")
    return counted.withColumn("window_start", time_text("window_start"))


ATTEMPTS = """
  SELECT l_orderkey, {'l': l_linenumber, 'p': l_partkey, 's': l_suppkey} AS place, l_shipdate,
         CASE l_returnflag WHEN 'R' THEN 'failed' WHEN 'A' THEN 'succeeded' ELSE 'claimed' END AS kind
  FROM lineitem
"""


@query(
    "stream_queue_state",
    f"""
    SELECT CAST(o_orderkey AS VARCHAR) AS entity_id,
           CASE last WHEN 'failed' THEN 'failed' WHEN 'succeeded' THEN 'done'
                WHEN 'claimed' THEN CASE WHEN last_at < TIMESTAMP '1996-01-01' THEN 'pending' ELSE 'in_progress' END
                ELSE 'pending' END AS status,
           CAST(coalesce(failures, 0) AS INTEGER) AS attempt_count,
           CASE ended WHEN 'failed' THEN 'line ' || ended_line.l END AS last_error
    FROM orders LEFT JOIN (
      SELECT l_orderkey, count(*) FILTER (kind = 'failed') AS failures, arg_max(kind, place) AS last,
             arg_max(l_shipdate, place) AS last_at,
             arg_max(kind, place) FILTER (kind <> 'claimed') AS ended,
             max(place) FILTER (kind <> 'claimed') AS ended_line
      FROM ({ATTEMPTS}) GROUP BY 1) ON l_orderkey = o_orderkey
    """,
)
def stream_queue_state(spark: SparkSession, folder: str) -> DataFrame:
    """Order lines as attempts at their order, in files without any order. The files come
    twice, by two feeds with a fold between them, as a source does that delivers again."""
    t, target = Tables(spark, folder), scratch_path(spark, "outcomes")
    kind = F.when(F.col("l_returnflag") == "R", outcomes.FAILED).when(F.col("l_returnflag") == "A", outcomes.SUCCEEDED)
    facts = t.lineitem.select(
        key_text("l_orderkey").alias("entity_id"),
        F.col("l_linenumber").alias("attempt"),
        "l_partkey",
        "l_suppkey",
        kind.otherwise(outcomes.CLAIMED).alias("kind"),
        F.concat(F.lit("line "), key_text("l_linenumber")).alias("error"),
        iso_text("l_shipdate").alias("at"),
    )
    source = scratch_path(spark, "outcome-files")
    key, order = ["entity_id"], ["attempt", "l_partkey", "l_suppkey"]
    # Five batches, each of as many files as there are cores to read them.
    files = spark.sparkContext.defaultParallelism
    facts.repartition(5 * files, F.xxhash64(*key, *order)).write.parquet(source)
    for _ in range(2):
        stream = feed.table_stream(spark, source, facts.schema, files_per_batch=files)
        outcomes.outcome_stream(stream, target, scratch_path(spark, "cursor"), key, order).awaitTermination()
        outcomes.fold_outcomes(spark, target, key, order)
    queue = t.orders.select(key_text("o_orderkey").alias("entity_id"), *queues.pending(AS_OF))
    year = 366 * 24 * 3600
    state = outcomes.queue_state(spark, target, queue, key, order, "1997-01-01T00:00:00Z", year)
    return state.select("entity_id", "status", "attempt_count", "last_error")


@query("stream_new_only", "SELECT DISTINCT user_id, 'x' AS event_type FROM events")
def stream_new_only(spark: SparkSession, folder: str) -> DataFrame:
    """Clients are stored when first seen: some before the feed, which are skipped, the rest
    by two feeds with a compaction between them; every client once."""
    target = scratch_path(spark, "seen")
    source, schema = _event_files(spark, folder), Tables(spark, folder).events.schema
    stored = Tables(spark, folder).events.where("user_id % 3 = 0")
    known = stored.groupBy("user_id").agg(F.first("event_type").alias("event_type"), F.min("ts").alias("ts"), F.min("event_id").alias("event_id"))
    known.write.parquet(f"{target}/{feed.FEED}=before/{feed.BATCH}=0")
    for _ in range(2):
        stream = feed.table_stream(spark, source, schema, files_per_batch=1).select("user_id", "event_type", "ts", "event_id")
        checkpoint = scratch_path(spark, "cursor")
        feed.new_only_stream(stream, target, checkpoint, EVENT_KEY, EVENT_SEQ, buckets=4).awaitTermination()
        feed.compact(spark, target, EVENT_KEY, EVENT_SEQ)
    return read_live(spark, target).select("user_id", F.lit("x").alias("event_type"))


@query("stream_dedup", "SELECT DISTINCT event_id FROM events")
def stream_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Every event offered twice, the copies in any batch, and kept once."""
    target, checkpoint = scratch_path(spark, "dedup"), scratch_path(spark, "cursor")
    events = _event_stream(spark, folder).select("event_id", "ts")
    twice = events.withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2))))
    feed.new_only_stream(twice, target, checkpoint, ["event_id"], ["ts", "copy"], buckets=4).awaitTermination()
    return read_live(spark, target).select("event_id")


STATE = """
    SELECT 'requests' AS entity_type, CAST(NULL AS VARCHAR) AS last_cursor,
           count(DISTINCT user_id) AS total_fetched, 'completed' AS sync_status,
           '2024-02-01T00:00:00+00:00' AS updated_at, '2024-02-01T00:00:00+00:00' AS last_sync_at
    FROM events
"""


@query("migration_state", STATE)
def migration_state(spark: SparkSession, folder: str) -> DataFrame:
    target, checkpoint = scratch_path(spark, "seen"), scratch_path(spark, "cursor")
    events = _event_stream(spark, folder).select("user_id", "event_type", "ts", "event_id")
    drained = feed.new_only_stream(events, target, checkpoint, EVENT_KEY, EVENT_SEQ, buckets=4)
    drained.awaitTermination()
    return feed.migration_state("requests", read_live(spark, target), drained, AS_OF)


@query("feed_record", STATE)
def feed_record(spark: SparkSession, folder: str) -> DataFrame:
    """The record that a feed keeps after every batch, once it is drained."""
    target, checkpoint = scratch_path(spark, "seen"), scratch_path(spark, "cursor")
    record = feed.FeedRecord(spark, scratch_path(spark, "record"), "requests", target, lambda: AS_OF)
    events = _event_stream(spark, folder).select("user_id", "event_type", "ts", "event_id")
    drained = feed.new_only_stream(events, target, checkpoint, EVENT_KEY, EVENT_SEQ, record.batch_done, buckets=4)
    drained.awaitTermination()
    record.finished(drained)
    return record.read()
