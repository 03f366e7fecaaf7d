"""Cost and request log analytics over events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import costlog
from tidemark.operators.ranking import average_folds, average_of, continued_folds, moving_average
from tidemark.plans.packing import cost_log, event_pages
from tidemark.plans.registry import Tables, epoch_seconds, query
from tidemark.sources.pages import cost_envelopes
from tidemark.session import scratch_path
from tidemark.sources.keydirectory import page_in_order, write_in_order
from tidemark.sources.tables import keyset_page, newest, offset_page

COSTS = """
  SELECT event_id AS id, event_type AS query_type, epoch_us(ts) // 1000000 AS at_s,
         CAST(json_extract(props, '$.k') AS BIGINT) * 100 AS requested_cost,
         CAST(floor(value * 10) AS BIGINT) AS actual_cost,
         CASE WHEN event_type <> 'click' THEN CAST(10000 AS BIGINT) END AS maximum_available,
         10000 - CAST(json_extract(props, '$.k') AS BIGINT) * 101 AS currently_available,
         CASE WHEN event_type <> 'view' THEN CAST(500 AS BIGINT) END AS restore_rate
  FROM events
"""
ACCURACY = "CASE WHEN actual_cost > 0 THEN 100 - abs((actual_cost - requested_cost) / actual_cost) * 100 ELSE 100 END"
STATISTICS = f"""
  count(*) AS total_queries, avg(requested_cost) AS avg_requested_cost, avg(actual_cost) AS avg_actual_cost,
  min(actual_cost) AS min_actual_cost, max(actual_cost) AS max_actual_cost,
  avg(actual_cost - requested_cost) AS avg_cost_difference,
  round(avg({ACCURACY}), 6) AS cost_accuracy_percentage
"""


def rounded(df: DataFrame, *columns: str, places: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, places) for c in columns})


@query(
    "cost_records",
    f"""
    SELECT id, requested_cost, actual_cost, actual_cost - requested_cost AS cost_difference FROM ({COSTS})
    """,
)
def cost_records(spark: SparkSession, folder: str) -> DataFrame:
    rows = costlog.cost_records(cost_log(Tables(spark, folder)))
    return rows.select("id", "requested_cost", "actual_cost", "cost_difference")


@query(
    "cost_by_type",
    f"""
    SELECT query_type, count(*) AS query_count, avg(actual_cost) AS avg_cost, max(actual_cost) AS max_cost,
           count(*) FILTER (requested_cost > currently_available) AS throttle_count
    FROM ({COSTS}) GROUP BY 1
    """,
)
def cost_by_type(spark: SparkSession, folder: str) -> DataFrame:
    return costlog.cost_by_type(cost_log(Tables(spark, folder)))


@query(
    "cost_overview",
    f"""
    SELECT avg(requested_cost) AS avg_requested_cost, avg(actual_cost) AS avg_actual_cost,
           max(requested_cost) AS max_requested_cost, min(currently_available) AS min_available_points,
           count(*) AS total_requests, count(*) / 3600.0::DOUBLE AS requests_per_second
    FROM ({COSTS})
    """,
)
def cost_overview(spark: SparkSession, folder: str) -> DataFrame:
    return costlog.cost_overview(cost_log(Tables(spark, folder)), 3600)


@query("cost_stats", f"SELECT {STATISTICS} FROM ({COSTS})")
def cost_stats(spark: SparkSession, folder: str) -> DataFrame:
    rows = costlog.cost_statistics(cost_log(Tables(spark, folder)))
    return rounded(rows, "cost_accuracy_percentage")


@query(
    "cost_last100",
    f"""
    SELECT query_type, {STATISTICS}
    FROM (SELECT * FROM ({COSTS}) QUALIFY row_number() OVER (PARTITION BY query_type ORDER BY at_s DESC, id DESC) <= 100)
    GROUP BY 1
    """,
)
def cost_last100(spark: SparkSession, folder: str) -> DataFrame:
    last = costlog.last_rows(cost_log(Tables(spark, folder)), ["query_type"], ["at_s", "id"])
    return rounded(costlog.cost_statistics(last, ["query_type"]), "cost_accuracy_percentage")


THROTTLE = """
  count(*) FILTER (ok) AS queries_with_throttle_data,
  arg_min(maximum_available, (at_s, id)) FILTER (ok) AS maximum_available,
  avg(currently_available) FILTER (ok) AS avg_currently_available,
  min(currently_available) FILTER (ok) AS min_currently_available,
  arg_min(restore_rate, (at_s, id)) FILTER (ok) AS restore_rate
"""


@query(
    "throttle_stats",
    f"""
    SELECT *, (maximum_available - avg_currently_available) * 100 / maximum_available AS avg_capacity_used_percentage,
           min_currently_available * 100 / maximum_available AS lowest_capacity_percentage
    FROM (SELECT query_type, {THROTTLE}
          FROM (SELECT *, maximum_available IS NOT NULL AND restore_rate IS NOT NULL AS ok FROM ({COSTS}))
          GROUP BY 1)
    """,
)
def throttle_stats(spark: SparkSession, folder: str) -> DataFrame:
    """Clicks and views carry no complete throttle data: count 0 and NULLs."""
    return costlog.throttle_statistics(
        cost_log(Tables(spark, folder)), ["at_s", "id"], ["query_type"]
    )


def request_columns() -> list[Column]:
    """Events as requests: errors are rate limits, signups waits, views retries."""
    kind = F.col("event_type")
    outcome = (
        F.when(kind == "error", "rate_limited")
        .when(kind == "signup", "throttled")
        .when((kind == "view") & (F.col("value") > 50), "retry_ok")
        .when(kind == "view", "retry_failed")
        .otherwise("ok")
    )
    return [
        epoch_seconds("ts").cast("double").alias("at"),
        outcome.alias("outcome"),
        F.col("value").alias("seconds"),
    ]


def request_log(t: Tables) -> DataFrame:
    return t.events.select("event_id", "user_id", *request_columns())


RATES = """
  count(*) FILTER (event_type IN ('click', 'purchase', 'error')) AS total_requests,
  count(*) FILTER (event_type IN ('click', 'purchase')) AS successful_requests,
  count(*) FILTER (event_type = 'error') AS rate_limit_errors,
  count(*) FILTER (event_type = 'signup') AS throttled_requests,
  count(*) FILTER (event_type = 'view') AS retry_attempts,
  count(*) FILTER (event_type = 'view' AND value > 50) AS successful_retries,
  round(avg(value) FILTER (event_type = 'signup'), 6) AS avg_throttle_seconds,
  max(value) FILTER (event_type = 'signup') AS max_throttle_seconds,
  CAST(max(epoch_us(ts) // 1000000) - min(epoch_us(ts) // 1000000) AS DOUBLE) AS uptime_seconds
"""
RATE_COLUMNS = """
  total_requests * 60.0::DOUBLE / uptime_seconds AS requests_per_minute,
  successful_requests * 60.0::DOUBLE / uptime_seconds AS successful_per_minute,
  rate_limit_errors * 100.0::DOUBLE / total_requests AS error_percentage,
  throttled_requests * 100.0::DOUBLE / (total_requests + throttled_requests) AS throttle_percentage,
  successful_retries * 100.0::DOUBLE / retry_attempts AS retry_success_percentage
"""


@query("request_rates", f"SELECT *, {RATE_COLUMNS} FROM (SELECT {RATES} FROM events)")
def request_rates(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(costlog.request_rates(request_log(Tables(spark, folder))), "avg_throttle_seconds")


@query(
    "metrics_summary",
    f"""
    SELECT r.*, c.*, t.* FROM (SELECT *, {RATE_COLUMNS} FROM (SELECT {RATES} FROM events)) r,
           (SELECT {STATISTICS} FROM ({COSTS})) c,
           (SELECT {THROTTLE} FROM (SELECT *, maximum_available IS NOT NULL AND restore_rate IS NOT NULL AS ok
                                    FROM ({COSTS}))) t
    """,
)
def metrics_summary(spark: SparkSession, folder: str) -> DataFrame:
    """All measures of a run in one row, out of one scan."""
    t = Tables(spark, folder)
    log = cost_log(t, keep=[*request_columns()])
    metrics = costlog.run_metrics(log, ["at_s", "id"])
    return rounded(metrics, "avg_throttle_seconds", "cost_accuracy_percentage")


def _requests(t: Tables) -> DataFrame:
    return t.events.select(
        "user_id",
        "ts",
        "event_id",
        F.get_json_object("props", "$.k").cast("bigint").alias("k"),
        (F.col("event_type") == "error").alias("throttled"),
    )


THROUGHPUT = """
    SELECT user_id, event_id, count(*) OVER w AS requests_made,
           CAST(sum(CAST(json_extract(props, '$.k') AS BIGINT)) OVER w AS BIGINT) AS entities_so_far,
           count(*) FILTER (event_type = 'error') OVER w AS throttles_so_far,
           (count(*) FILTER (event_type = 'error') OVER w) / (count(*) OVER w) AS throttle_rate
    FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)
"""


def _halves(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """A log cut at one moment: what was there, and the batch that follows."""
    cut = F.col("ts") < F.lit("2024-01-16 00:00:00").cast("timestamp_ntz")
    return rows.where(cut), rows.where(~cut)


@query("running_throughput", THROUGHPUT)
def running_throughput(spark: SparkSession, folder: str) -> DataFrame:
    events = _requests(Tables(spark, folder))
    rows = costlog.running_throughput(
        events, ["user_id"], ["ts", "event_id"], F.col("k"), F.col("throttled")
    )
    return rows.drop("ts", "k", "throttled")


@query("throughput_continued", THROUGHPUT)
def throughput_continued(spark: SparkSession, folder: str) -> DataFrame:
    """The log in two batches; the second goes on from the totals of the first."""
    k, throttled = F.col("k"), F.col("throttled")
    first, second = _halves(_requests(Tables(spark, folder)))
    known = costlog.throughput_at_end(first, ["user_id"], k, throttled)
    parts = [(first, None), (second, known)]
    rows = [costlog.running_throughput(p, ["user_id"], ["ts", "event_id"], k, throttled, s) for p, s in parts]
    return rows[0].unionByName(rows[1]).drop("ts", "k", "throttled")


def _ema_sql(alpha: float) -> str:
    rest = 1 - alpha
    return f"""
      SELECT event_type, CAST({alpha} AS DOUBLE) AS alpha,
             round(sum(value * CASE WHEN i = 1 THEN pow({rest}::DOUBLE, n - 1)
                                    ELSE {alpha} * pow({rest}::DOUBLE, n - i) END), 6) AS moving_average
      FROM (SELECT event_type, value, row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) AS i,
                   count(*) OVER (PARTITION BY event_type) AS n FROM events)
      GROUP BY 1
    """


@query("ema_latency", f"{_ema_sql(0.1)} UNION ALL {_ema_sql(0.01)}")
def ema_latency(spark: SparkSession, folder: str) -> DataFrame:
    """Two weights over all events; at the small one, old rows still count."""
    events = Tables(spark, folder).events

    def average(alpha: float) -> DataFrame:
        rows = moving_average(events, ["event_type"], ["ts", "event_id"], "value", alpha)
        return rounded(rows, "moving_average").withColumn("alpha", F.lit(alpha))

    return average(0.1).unionByName(average(0.01))


@query("ema_continued", f"{_ema_sql(0.1)} UNION ALL {_ema_sql(0.01)}")
def ema_continued(spark: SparkSession, folder: str) -> DataFrame:
    """The same from two batches: the second is added to what is stored of the first."""
    first, second = _halves(Tables(spark, folder).events)

    def average(alpha: float) -> DataFrame:
        folds = [average_folds(p, ["event_type"], ["ts", "event_id"], "value", alpha) for p in (first, second)]
        rows = average_of(continued_folds(*folds, ["event_type"], alpha), ["event_type"], alpha)
        return rounded(rows, "moving_average").withColumn("alpha", F.lit(alpha))

    return average(0.1).unionByName(average(0.01))


ADVICE = f"""
  SELECT id, CASE WHEN requested_cost > 8000 THEN CAST(40 AS BIGINT)
              WHEN currently_available < 2000 THEN CAST(25 AS BIGINT) ELSE CAST(50 AS BIGINT) END AS page_size,
         CASE WHEN requested_cost > 8000 THEN 'high_cost'
              WHEN currently_available < 2000 THEN 'low_capacity' END AS reason,
         CASE WHEN requested_cost > currently_available
              THEN (requested_cost - currently_available)::DOUBLE / coalesce(restore_rate, 500) + 1 END
           AS cooldown_seconds
  FROM ({COSTS})
"""


@query("page_size_advice", f"SELECT id, page_size, reason FROM ({ADVICE})")
def page_size_advice(spark: SparkSession, folder: str) -> DataFrame:
    rows = costlog.with_advice(cost_log(Tables(spark, folder)), F.lit(50))
    return rows.select("id", "page_size", "reason")


@query("cooldown_advice", f"SELECT id, cooldown_seconds FROM ({ADVICE})")
def cooldown_advice(spark: SparkSession, folder: str) -> DataFrame:
    rows = costlog.with_advice(cost_log(Tables(spark, folder)), F.lit(50))
    return rows.select("id", "cooldown_seconds")


@query(
    "recent_costs",
    f"SELECT id, query_type, requested_cost, actual_cost, at_s FROM ({COSTS}) ORDER BY at_s DESC, id DESC LIMIT 10",
)
def recent_costs(spark: SparkSession, folder: str) -> DataFrame:
    rows = newest(cost_log(Tables(spark, folder)), 10, F.desc("at_s"), F.desc("id"))
    return rows.select("id", "query_type", "requested_cost", "actual_cost", "at_s")


@query(
    "keyset_page",
    "SELECT event_id, event_type FROM events WHERE event_id > 4000 ORDER BY event_id LIMIT 100",
)
def keyset(spark: SparkSession, folder: str) -> DataFrame:
    events = Tables(spark, folder).events.select("event_id", "event_type")
    return keyset_page(events, "event_id", 4000, 100)


@query(
    "keyset_page_stored",
    "SELECT event_id, event_type FROM events WHERE event_id > 400 ORDER BY event_id LIMIT 300",
)
def keyset_stored(spark: SparkSession, folder: str) -> DataFrame:
    """Three pages of a table stored in key order, each starting behind the last key."""
    path, events = scratch_path(spark, "events-in-order"), Tables(spark, folder).events
    rows = events.select("event_id", "event_type")
    write_in_order(rows, path, "event_id", files=16)
    pages, after = [], 400
    for _ in range(3):
        page = page_in_order(spark, path, rows.schema, "event_id", after, 100)
        pages.append(page)
        after = page.agg(F.max("event_id")).first()[0]
    return pages[0].unionByName(pages[1]).unionByName(pages[2])


@query(
    "offset_page",
    "SELECT event_id, event_type FROM events ORDER BY event_id LIMIT 100 OFFSET 250",
)
def offset(spark: SparkSession, folder: str) -> DataFrame:
    events = Tables(spark, folder).events.select("event_id", "event_type")
    return offset_page(events, ["event_id"], 250, 100)


@query(
    "daily_rate",
    """
    SELECT strftime(ts, '%Y-%m-%d') AS date, event_type AS entity_type,
           CAST(sum(CAST(json_extract(props, '$.k') AS BIGINT)) AS BIGINT) AS total_processed,
           count(*) FILTER (value > 100) AS total_failed,
           round(avg(CAST(json_extract(props, '$.k') AS DOUBLE) / 60), 6) AS avg_rate
    FROM events WHERE event_type <> 'error' GROUP BY ALL
    """,
)
def daily_rate(spark: SparkSession, folder: str) -> DataFrame:
    """Events as runs of a minute each; error runs never completed."""
    start = epoch_seconds("ts")
    runs = Tables(spark, folder).events.select(
        F.col("event_type").alias("entity_type"),
        start.alias("started_at_s"),
        F.when(F.col("event_type") != "error", start + 60).alias("completed_at_s"),
        F.get_json_object("props", "$.k").cast("bigint").alias("entities_processed"),
        F.when(F.col("value") > 100, 1).otherwise(0).cast("bigint").alias("entities_failed"),
    )
    return rounded(costlog.daily_rates(runs), "avg_rate")


@query(
    "cost_envelope",
    """
    SELECT event_id // 100 AS page, CASE WHEN (event_id // 100) % 2 = 0 THEN 'requests' ELSE 'notes' END AS query_type,
           CASE WHEN (event_id // 100) % 2 = 0 THEN CAST(100 AS BIGINT) ELSE CAST(30 AS BIGINT) END AS batch_size,
           CAST(sum(k) AS BIGINT) AS requested_cost, CAST(sum(k) // 10 AS BIGINT) AS actual_cost,
           CAST(10000 AS BIGINT) AS maximum_available, CAST(10000 - sum(k) AS BIGINT) AS currently_available,
           CAST(500 AS BIGINT) AS restore_rate
    FROM (SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events)
    GROUP BY 1 HAVING sum(k) > 4500
    """,
)
def cost_envelope(spark: SparkSession, folder: str) -> DataFrame:
    """Cost numbers of event pages; cheap pages carry no actual cost and fall out."""
    pages = event_pages(Tables(spark, folder))
    text = F.to_json("extensions")
    with_query = pages.select("page", F.parse_json(text).alias("extensions"))
    asked = F.when(
        F.col("page") % 2 == 0, F.lit("query { requests(first: 100, after: $c) { edges } }")
    ).otherwise(F.lit("query { node(id: 1) { notes { id } } }"))
    return cost_envelopes(with_query, asked)
