"""Report numbers over the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.costs import performance_grade
from tidemark.operators import reports
from tidemark.plans.packing import event_pages
from tidemark.plans.queues import order_queue
from tidemark.plans.registry import Tables, epoch_seconds, query, time_text
from tidemark.session import scratch_path
from tidemark.sources.pages import nodes_of, page_totals, parse_pages, read_pages

NAMES = [
    "region",
    "nation",
    "customer",
    "supplier",
    "part",
    "orders",
    "lineitem",
    "events",
    "documents",
    "embeddings",
    "pages",
    "benchmark",
    "labels",
    "conversations",
]


@query(
    "table_counts",
    " UNION ALL ".join(f"SELECT '{n}' AS table_name, count(*) AS n FROM {n}" for n in NAMES),
)
def table_counts(spark: SparkSession, folder: str) -> DataFrame:
    t = Tables(spark, folder)
    return reports.table_counts({n: getattr(t, n) for n in NAMES})


@query(
    "status_histogram",
    "SELECT o_orderstatus AS status, count(*) AS n FROM orders GROUP BY 1",
)
def status_histogram(spark: SparkSession, folder: str) -> DataFrame:
    return reports.status_histogram(Tables(spark, folder).orders, "o_orderstatus")


@query(
    "pending_megabytes",
    "SELECT round(sum(n_chars) / 1048576.0::DOUBLE, 2) AS total_mb FROM documents",
)
def pending_megabytes(spark: SparkSession, folder: str) -> DataFrame:
    return reports.pending_megabytes(Tables(spark, folder).documents, "n_chars")


@query(
    "date_range",
    """
    SELECT strftime(min(o_orderdate), '%Y-%m-%d %H:%M:%S') AS first,
           strftime(max(o_orderdate), '%Y-%m-%d %H:%M:%S') AS last FROM orders
    """,
)
def date_range(spark: SparkSession, folder: str) -> DataFrame:
    found = reports.date_range(Tables(spark, folder).orders, "o_orderdate")
    return found.select(time_text("first").alias("first"), time_text("last").alias("last"))


@query(
    "extract_report",
    """
    SELECT o_orderpriority AS entity_type, count(*) FILTER (o_orderstatus = 'O') AS extracted,
           count(*) FILTER (o_orderstatus = 'F') AS failed,
           count(*) FILTER (o_orderstatus = 'O') * 100 / count(*) FILTER (o_orderstatus <> 'P') AS success_rate
    FROM orders GROUP BY 1
    """,
)
def extract_report(spark: SparkSession, folder: str) -> DataFrame:
    return reports.extract_report(order_queue(Tables(spark, folder)))


def _page_log(t: Tables) -> DataFrame:
    """Feed pages of 100 events and kind; errors count as skipped."""
    return t.events.groupBy(
        F.col("event_type").alias("entity_type"), F.floor(F.col("event_id") / 100).alias("page")
    ).agg(
        F.count(F.lit(1)).alias("entities"),
        F.count_if(F.col("value") > 100).alias("skipped"),
        (F.max(epoch_seconds("ts")) - F.min(epoch_seconds("ts"))).alias("seconds"),
    )


PAGE_LOG = """
  SELECT event_type AS entity_type, event_id // 100 AS page, count(*) AS entities,
         count(*) FILTER (value > 100) AS skipped,
         max(epoch_us(ts) // 1000000) - min(epoch_us(ts) // 1000000) AS seconds
  FROM events GROUP BY ALL
"""


@query(
    "extraction_summary",
    f"""
    SELECT entity_type, CAST(sum(entities) AS BIGINT) AS total_entities,
           CAST(sum(skipped) AS BIGINT) AS entities_skipped, count(*) AS total_pages,
           CAST(sum(seconds) AS BIGINT) AS extraction_seconds,
           sum(entities) / count(*) AS average_page_size, sum(entities) / sum(seconds) AS entities_per_second
    FROM ({PAGE_LOG}) GROUP BY 1
    """,
)
def extraction_summary(spark: SparkSession, folder: str) -> DataFrame:
    return reports.extraction_summary(_page_log(Tables(spark, folder)), ["entity_type"])


@query(
    "run_summary",
    f"""
    SELECT CAST(sum(entities - skipped) AS BIGINT) AS processed, CAST(sum(skipped) AS BIGINT) AS skipped,
           CAST(sum(entities) AS BIGINT) AS total, sum(skipped) / sum(entities) * 100 AS skip_percentage
    FROM ({PAGE_LOG})
    """,
)
def run_summary(spark: SparkSession, folder: str) -> DataFrame:
    per_kind = _page_log(Tables(spark, folder)).groupBy("entity_type").agg(
        F.sum(F.col("entities") - F.col("skipped")).alias("processed"), F.sum("skipped").alias("skipped")
    )
    return reports.run_totals(per_kind)


@query(
    "run_report",
    f"""
    SELECT entity_type, CAST(sum(entities) AS BIGINT) AS total_entities, count(*) AS total_pages,
           CAST(sum(skipped) AS BIGINT) AS error_count
    FROM ({PAGE_LOG}) GROUP BY ROLLUP (entity_type)
    """,
)
def run_report(spark: SparkSession, folder: str) -> DataFrame:
    summaries = _page_log(Tables(spark, folder)).select(
        "entity_type",
        F.col("entities").alias("total_entities"),
        F.lit(1).cast("bigint").alias("total_pages"),
        F.col("skipped").alias("error_count"),
    )
    return reports.run_report(summaries)


@query(
    "time_shares",
    """
    SELECT event_type AS entity_type, count(*) AS entities,
           count(*) / (SELECT count(*) FROM events) * 600 AS estimated_seconds
    FROM events GROUP BY 1
    """,
)
def time_shares(spark: SparkSession, folder: str) -> DataFrame:
    counts = Tables(spark, folder).events.groupBy(F.col("event_type").alias("entity_type")).agg(
        F.count(F.lit(1)).alias("entities")
    )
    return reports.time_shares(counts, 600)


@query(
    "performance_grades",
    """
    SELECT user_id, CASE WHEN score >= 95 THEN 'A+' WHEN score >= 90 THEN 'A' WHEN score >= 80 THEN 'B'
                         WHEN score >= 70 THEN 'C' WHEN score >= 60 THEN 'D' ELSE 'F' END AS grade
    FROM (SELECT user_id, 100 - 5 * count(*) FILTER (event_type = 'error' AND value > 90)
            - CASE WHEN sum(k) / 600.0 < 5 THEN 20 WHEN sum(k) / 600.0 < 10 THEN 10 ELSE 0 END
            - CASE WHEN sum(k) > 3000 THEN 10 ELSE 0 END
            - CASE WHEN count(*) / 8.0 > 8 THEN 15 ELSE 0 END AS score
          FROM (SELECT *, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events) GROUP BY 1)
    """,
)
def performance_grades(spark: SparkSession, folder: str) -> DataFrame:
    """Each user's events as one run of ten minutes."""
    k = F.get_json_object("props", "$.k").cast("bigint")
    runs = Tables(spark, folder).events.groupBy("user_id").agg(
        F.count_if((F.col("event_type") == "error") & (F.col("value") > 90)).alias("errors"),
        F.sum(k).alias("rows"),
        F.count(F.lit(1)).alias("requests"),
    )
    grade = performance_grade(
        F.col("errors"), F.col("rows"), F.lit(600.0), F.col("rows") / 3, F.col("requests") / 8
    )
    return runs.select("user_id", grade.alias("grade"))


CLASS_SQL = "substr(split_part(text, chr(10), 1), 1, 50)"


@query(
    "error_classes",
    f"SELECT {CLASS_SQL} AS error_type, count(*) AS n FROM documents GROUP BY 1",
)
def error_classes(spark: SparkSession, folder: str) -> DataFrame:
    return reports.error_classes(Tables(spark, folder).documents, "text")


@query(
    "error_classes_top",
    f"""
    SELECT {CLASS_SQL} AS error_type, count(*) AS n FROM documents GROUP BY 1
    ORDER BY n DESC, encode(error_type) LIMIT 10
    """,
)
def error_classes_top(spark: SparkSession, folder: str) -> DataFrame:
    return reports.error_classes(Tables(spark, folder).documents, "text", 10)


@query(
    "listed_failures",
    """
    SELECT o_orderkey, o_orderpriority, (SELECT greatest(0, count(*) - 20) FROM orders WHERE o_orderstatus = 'F') AS not_shown
    FROM orders WHERE o_orderstatus = 'F' ORDER BY o_orderkey LIMIT 20
    """,
)
def listed_failures(spark: SparkSession, folder: str) -> DataFrame:
    failed = Tables(spark, folder).orders.where("o_orderstatus = 'F'")
    return reports.listed_failures(failed.select("o_orderkey", "o_orderpriority"), ["o_orderkey"])


@query(
    "failed_list",
    "SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderstatus = 'F'",
)
def failed_list(spark: SparkSession, folder: str) -> DataFrame:
    return Tables(spark, folder).orders.where("o_orderstatus = 'F'").select(
        "o_orderkey", "o_orderpriority"
    )


def event_page_files(t: Tables) -> str:
    """Write the event pages as a JSON feed; returns its folder."""
    path = scratch_path(t._spark, "feed")
    event_pages(t).write.json(path)
    return path


@query(
    "page_feed",
    """
    SELECT CAST(event_id AS VARCHAR) AS id, event_id // 100 AS page,
           CAST(row_number() OVER (PARTITION BY event_id // 100 ORDER BY event_id) - 1 AS INTEGER) AS pos,
           event_type AS title
    FROM events
    """,
)
def page_feed(spark: SparkSession, folder: str) -> DataFrame:
    """Nodes read back from page files with their arrival order."""
    pages = read_pages(spark, event_page_files(Tables(spark, folder)), "requests")
    return nodes_of(pages).select(
        F.try_variant_get("node", "$.id", "string").alias("id"),
        "page",
        "pos",
        F.try_variant_get("node", "$.title", "string").alias("title"),
    )


@query(
    "page_totals",
    "SELECT count(*) AS announced, count(DISTINCT event_id // 100) AS pages, count(*) AS delivered FROM events",
)
def page_totals_query(spark: SparkSession, folder: str) -> DataFrame:
    pages = event_pages(Tables(spark, folder))
    body = F.to_json(F.struct("data", "extensions")).alias("body")
    return page_totals(parse_pages(pages.select("page", body), "requests"))


@query(
    "report_sink",
    "SELECT o_orderpriority AS entity_type, count(*) FILTER (o_orderstatus = 'F') AS failed FROM orders GROUP BY 1",
)
def report_sink(spark: SparkSession, folder: str) -> DataFrame:
    """A report written as JSON and read back."""
    path = scratch_path(spark, "report")
    reports.write_report(
        reports.extract_report(order_queue(Tables(spark, folder))).select("entity_type", "failed"), path
    )
    return spark.read.schema("entity_type string, failed bigint").json(path)
