"""Integrity and completeness of the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import inventory as inv
from tidemark.operators import validate
from tidemark.operators.validate import ForeignKey
from tidemark.plans.inventory import by_segment
from tidemark.plans.packing import cost_log
from tidemark.plans.queues import order_queue
from tidemark.plans.registry import SNAPSHOT, Tables, key_text, query

KEYS = [
    ForeignKey("nation", "n_regionkey", "region", "r_regionkey"),
    ForeignKey("customer", "c_nationkey", "nation", "n_nationkey"),
    ForeignKey("supplier", "s_nationkey", "nation", "n_nationkey"),
    ForeignKey("orders", "o_custkey", "customer", "c_custkey"),
    ForeignKey("lineitem", "l_orderkey", "orders", "o_orderkey"),
    ForeignKey("lineitem", "l_partkey", "part", "p_partkey"),
    ForeignKey("lineitem", "l_suppkey", "supplier", "s_suppkey"),
    ForeignKey("orders", "o_orderkey", "lineitem", "l_orderkey"),
    ForeignKey("events", "user_id", "customer", "c_custkey"),
    ForeignKey("documents", "doc_id", "labels", "doc_id"),
    ForeignKey("labels", "doc_id", "documents", "doc_id"),
    ForeignKey("events", "user_id", "supplier", "s_suppkey"),
]
TABLE_NAMES = sorted({k.child for k in KEYS} | {k.parent for k in KEYS})

FK_COUNTS = " UNION ALL ".join(
    f"SELECT '{k.child}' AS \"table\", '{k.column}' AS field, '{k.parent}.{k.parent_key}' AS parent, "
    f"(SELECT count(*) FROM {k.child} WHERE {k.column} IS NOT NULL AND {k.column} NOT IN "
    f"(SELECT {k.parent_key} FROM {k.parent})) AS count"
    for k in KEYS
)


def tables_of(t: Tables) -> dict[str, DataFrame]:
    return {name: getattr(t, name) for name in TABLE_NAMES}


@query("fk_suite", FK_COUNTS)
def fk_suite(spark: SparkSession, folder: str) -> DataFrame:
    return validate.foreign_key_orphans(tables_of(Tables(spark, folder)), KEYS)


@query(
    "fk_issues",
    f"""
    SELECT 'ERROR' AS severity, 'FK_INTEGRITY' AS category, "table", field, count
    FROM ({FK_COUNTS}) WHERE count > 0
    """,
)
def fk_issues(spark: SparkSession, folder: str) -> DataFrame:
    return validate.foreign_key_issues(tables_of(Tables(spark, folder)), KEYS)


def _with_blanks(t: Tables) -> dict[str, DataFrame]:
    """Orders as jobs: P lacks its client (blank), O points nowhere (NULL)."""
    status = F.col("o_orderstatus")
    client = F.when(status == "P", F.lit("")).when(status == "F", key_text("o_custkey"))
    return {
        "jobs": t.orders.select(key_text("o_orderkey").alias("id"), client.alias("client_id")),
        "clients": t.customer.where("c_acctbal >= 0").select(key_text("c_custkey").alias("id")),
    }


BLANK_RULE = [ForeignKey("jobs", "client_id", "clients")]


@query(
    "fk_blank_counts",
    """
    SELECT 'jobs' AS "table", 'client_id' AS field, 'clients.id' AS parent,
           count(*) FILTER (o_orderstatus = 'P' OR (o_orderstatus = 'F' AND c_acctbal < 0)) AS count
    FROM orders LEFT JOIN customer ON c_custkey = o_custkey
    """,
)
def fk_blank_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Blank keys count as orphans; a third of all rows shares the blank."""
    return validate.foreign_key_orphans(_with_blanks(Tables(spark, folder)), BLANK_RULE)


@query(
    "fk_blank_is_null",
    """
    SELECT 'jobs' AS "table", 'client_id' AS field, 'clients.id' AS parent,
           count(*) FILTER (o_orderstatus = 'F' AND c_acctbal < 0) AS count
    FROM orders LEFT JOIN customer ON c_custkey = o_custkey
    """,
)
def fk_blank_is_null(spark: SparkSession, folder: str) -> DataFrame:
    tables = _with_blanks(Tables(spark, folder))
    return validate.foreign_key_orphans(tables, BLANK_RULE, blank_is_null=True)


REQUIRED = [
    ("labelled", "quality"),
    ("labelled", "toxic"),
    ("labelled", "lang"),
    ("orders", "o_custkey"),
    ("customer", "c_name"),
]


def _labelled(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", "lang").join(t.labels, "doc_id", "left")


@query(
    "required_suite",
    """
    WITH labelled AS (SELECT lang, quality, toxic FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id)
    SELECT 'labelled' AS "table", 'quality' AS field, count(*) FILTER (quality IS NULL) AS count FROM labelled
    UNION ALL SELECT 'labelled', 'toxic', count(*) FILTER (toxic IS NULL) FROM labelled
    UNION ALL SELECT 'labelled', 'lang', count(*) FILTER (lang IS NULL) FROM labelled
    UNION ALL SELECT 'orders', 'o_custkey', count(*) FILTER (o_custkey IS NULL) FROM orders
    UNION ALL SELECT 'customer', 'c_name', count(*) FILTER (c_name IS NULL) FROM customer
    """,
)
def required_suite(spark: SparkSession, folder: str) -> DataFrame:
    t = Tables(spark, folder)
    tables = {"labelled": _labelled(t), "orders": t.orders, "customer": t.customer}
    return validate.null_counts(tables, REQUIRED)


@query(
    "missing_critical_fields",
    """
    SELECT 'labelled' AS "table", 'no label at all' AS field,
           count(*) FILTER (quality IS NULL AND toxic IS NULL) AS count
    FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id
    UNION ALL SELECT 'labelled', 'not English and no quality',
           count(*) FILTER (quality IS NULL AND lang <> 'en')
    FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id
    """,
)
def missing_critical_fields(spark: SparkSession, folder: str) -> DataFrame:
    rules = {
        "no label at all": F.col("quality").isNull() & F.col("toxic").isNull(),
        "not English and no quality": F.col("quality").isNull() & (F.col("lang") != "en"),
    }
    return validate.count_matching(_labelled(Tables(spark, folder)), "labelled", rules)


def _polymorphic(t: Tables) -> tuple[DataFrame, dict[str, DataFrame], dict[str, str]]:
    """Events as notes on customers, suppliers and documents, by event type."""
    kind = (
        F.when(F.col("event_type") == "click", "Client")
        .when(F.col("event_type") == "view", "supplier")
        .when(F.col("event_type") == "error", "Document")
        .otherwise(F.lit("elsewhere"))
    )
    notes = t.events.select(kind.alias("entity_type"), (F.col("user_id") * 10).alias("entity_id"))
    parents = {"client": t.customer, "supplier": t.supplier, "document": t.labels}
    return notes, parents, {"client": "c_custkey", "supplier": "s_suppkey", "document": "doc_id"}


POLYMORPHIC_SQL = """
  SELECT 'client' AS kind, count(*) AS count FROM events
  WHERE event_type = 'click' AND user_id * 10 NOT IN (SELECT c_custkey FROM customer)
  UNION ALL SELECT 'supplier', count(*) FROM events
  WHERE event_type = 'view' AND user_id * 10 NOT IN (SELECT s_suppkey FROM supplier)
  UNION ALL SELECT 'document', count(*) FROM events
  WHERE event_type = 'error' AND user_id * 10 NOT IN (SELECT doc_id FROM labels)
"""


@query("polymorphic_suite", f"SELECT * FROM ({POLYMORPHIC_SQL}) WHERE count > 0")
def polymorphic_suite(spark: SparkSession, folder: str) -> DataFrame:
    notes, parents, keys = _polymorphic(Tables(spark, folder))
    return validate.polymorphic_orphans(notes, parents, keys)


@query(
    "polymorphic_strict_case",
    f"SELECT * FROM ({POLYMORPHIC_SQL}) WHERE kind = 'supplier' AND count > 0",
)
def polymorphic_strict_case(spark: SparkSession, folder: str) -> DataFrame:
    """Compared as written, only the kind spelled like its parent is checked."""
    notes, parents, keys = _polymorphic(Tables(spark, folder))
    return validate.polymorphic_orphans(notes, parents, keys, strict_case=True)


def all_issues(t: Tables) -> DataFrame:
    notes, parents, keys = _polymorphic(t)
    required = {"labelled": _labelled(t), "orders": t.orders, "customer": t.customer}
    return (
        validate.foreign_key_issues(tables_of(t), KEYS)
        .unionByName(validate.required_issues(required, REQUIRED))
        .unionByName(validate.polymorphic_issues(notes, parents, keys))
    )


ISSUE_SQL = f"""
  SELECT 'FK_INTEGRITY' AS category, count FROM ({FK_COUNTS}) WHERE count > 0
  UNION ALL SELECT 'NOTES_INTEGRITY', count FROM ({POLYMORPHIC_SQL}) WHERE count > 0
  UNION ALL SELECT 'NULL_REQUIRED', unnest([count(*) FILTER (quality IS NULL), count(*) FILTER (toxic IS NULL)])
  FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id
"""


@query(
    "issue_totals",
    f"""
    SELECT category, 'ERROR' AS severity, count(*) AS issues, CAST(sum(count) AS BIGINT) AS rows
    FROM ({ISSUE_SQL}) GROUP BY 1
    """,
)
def issue_totals(spark: SparkSession, folder: str) -> DataFrame:
    return validate.issue_totals(all_issues(Tables(spark, folder)))


@query("verdict", f"SELECT count(*) = 0 AS passed, count(*) AS issues FROM ({ISSUE_SQL})")
def verdict(spark: SparkSession, folder: str) -> DataFrame:
    return validate.verdict(all_issues(Tables(spark, folder)))


@query(
    "notes_without_parent",
    """
    SELECT 'conversations' AS "table", 'no parent' AS field, count(*) FILTER (role = 'system') AS count
    FROM conversations
    """,
)
def notes_without_parent(spark: SparkSession, folder: str) -> DataFrame:
    parent = F.when(F.col("role") != "system", F.col("conv_id"))
    notes = Tables(spark, folder).conversations.select(parent.alias("entity_id"))
    return validate.count_matching(notes, "conversations", {"no parent": F.col("entity_id").isNull()})


def _line_states(t: Tables) -> tuple[DataFrame, DataFrame]:
    """Orders inventoried by priority; those with lines were worked on, P ones in vain."""
    orders = order_queue(t)
    worked = t.lineitem.select(key_text("l_orderkey").alias("entity_id"))
    status = F.when(F.col("status") == "pending", "failed").otherwise("done")
    queue = orders.join(worked, "entity_id", "left_semi").withColumn("status", status)
    return orders.select("entity_type", "entity_id", "map_snapshot_id"), queue


LINE_STATES = """
  SELECT o_orderpriority AS entity_type, count(*) AS expected,
         count(*) FILTER (has_lines AND o_orderstatus <> 'P') AS extracted,
         count(*) FILTER (has_lines AND o_orderstatus = 'P') AS failed
  FROM (SELECT *, o_orderkey IN (SELECT l_orderkey FROM lineitem) AS has_lines FROM orders) GROUP BY 1
"""


@query(
    "completeness",
    f"""
    SELECT 'entity_count_mismatch' AS type, entity_type, expected, extracted + failed AS actual,
           expected - extracted - failed AS difference, 'error' AS severity
    FROM ({LINE_STATES}) WHERE extracted + failed < expected
    UNION ALL
    SELECT 'failed_entities', entity_type, expected, extracted, failed,
           CASE WHEN failed * 10 < expected THEN 'warning' ELSE 'error' END
    FROM ({LINE_STATES}) WHERE failed > 0
    """,
)
def completeness(spark: SparkSession, folder: str) -> DataFrame:
    inventory, queue = _line_states(Tables(spark, folder))
    return validate.completeness(inventory, queue)


@query(
    "completeness_of_run",
    f"""
    SELECT 'entity_count_mismatch' AS type, entity_type, expected, extracted AS actual,
           expected - extracted AS difference, 'error' AS severity
    FROM ({LINE_STATES}) WHERE extracted < expected
    """,
)
def completeness_of_run(spark: SparkSession, folder: str) -> DataFrame:
    """A resumed run that only did the done ones is compared with the whole inventory."""
    inventory, queue = _line_states(Tables(spark, folder))
    run = (
        queue.where("status = 'done'")
        .groupBy("entity_type")
        .agg(F.count(F.lit(1)).alias("extracted"), F.lit(0).cast("bigint").alias("failed"))
    )
    return validate.completeness(inventory, queue, run)


@query(
    "attachment_completeness",
    """
    SELECT 'failed_attachments' AS type, CAST(NULL AS VARCHAR) AS entity_type, count(*) AS expected,
           count(*) FILTER (lang = 'en') AS actual, count(*) FILTER (lang = 'es') AS difference,
           CASE WHEN count(*) FILTER (lang = 'es') * 10 < count(*) THEN 'warning' ELSE 'error' END AS severity
    FROM documents HAVING count(*) FILTER (lang = 'es') > 0
    """,
)
def attachment_completeness(spark: SparkSession, folder: str) -> DataFrame:
    summary = Tables(spark, folder).documents.agg(
        F.count_if(F.col("lang") == "en").alias("downloaded"),
        F.count_if(F.col("lang") == "es").alias("failed"),
        F.count_if(~F.col("lang").isin("en", "es")).alias("skipped"),
    )
    return validate.attachment_completeness(summary)


@query(
    "map_vs_extracted",
    """
    SELECT entity_type, count(*) AS mapped_count, CAST(sum(done) AS BIGINT) AS extracted_count,
           CAST(sum(failed) AS BIGINT) AS failed_count
    FROM (SELECT o_orderpriority AS entity_type, o_orderkey,
                 count(*) FILTER (l_linestatus = 'F') AS done, count(*) FILTER (l_linestatus = 'O') AS failed
          FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY ALL)
    GROUP BY 1
    """,
)
def map_vs_extracted(spark: SparkSession, folder: str) -> DataFrame:
    """Order lines as queue rows of their order: F done, O failed."""
    t = Tables(spark, folder)
    inventory = order_queue(t).select("entity_type", "entity_id", "map_snapshot_id")
    kinds = inventory.select("entity_id", "entity_type")
    status = F.when(F.col("l_linestatus") == "F", "done").otherwise("failed")
    lines = t.lineitem.select(key_text("l_orderkey").alias("entity_id"), status.alias("status"))
    queue = lines.join(kinds, "entity_id").withColumn("map_snapshot_id", F.lit(SNAPSHOT))
    return validate.mapped_versus_extracted(inventory, queue)


@query(
    "threshold_findings",
    """
    WITH d AS (
      SELECT c_mktsegment, count(*) AS total_entities, avg(k) AS avg_relations, max(k) AS max_relations
      FROM (SELECT c_custkey, c_mktsegment, count(o_orderkey) + count(*) FILTER (o_orderstatus = 'F') AS k
            FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY ALL) GROUP BY 1),
    c AS (SELECT event_type, CAST(max(json_extract(props, '$.k')::BIGINT * 100) AS DOUBLE) AS mx,
                 CAST(min(10000 - json_extract(props, '$.k')::BIGINT * 101) AS DOUBLE) AS mn
          FROM events GROUP BY 1)
    SELECT c_mktsegment AS subject, 'total_entities' AS metric, CAST(total_entities AS DOUBLE) AS value,
           10000.0::DOUBLE AS threshold, 'large_entity_count' AS code FROM d WHERE total_entities > 10000
    UNION ALL SELECT c_mktsegment, 'avg_relations', avg_relations, 20.0, 'high_average_relations'
    FROM d WHERE avg_relations > 20
    UNION ALL SELECT c_mktsegment, 'max_relations', max_relations, 100.0, 'hotspot_entities'
    FROM d WHERE max_relations > 100
    UNION ALL SELECT event_type, 'max_requested_cost', mx, 8000.0, 'high_query_cost' FROM c WHERE mx > 8000
    UNION ALL SELECT event_type, 'min_available_points', mn, 2000.0, 'low_capacity' FROM c WHERE mn < 2000
    """,
)
def threshold_findings(spark: SparkSession, folder: str) -> DataFrame:
    t = Tables(spark, folder)
    density = validate.unpivot_metrics(
        inv.density(by_segment(t)), "entity_type", ["total_entities", "avg_relations", "max_relations"]
    )
    capacity = cost_log(t).groupBy("query_type").agg(
        F.max("requested_cost").alias("max_requested_cost"),
        F.min("currently_available").alias("min_available_points"),
    )
    costs = validate.unpivot_metrics(
        capacity, "query_type", ["max_requested_cost", "min_available_points"]
    )
    return validate.threshold_findings(density.unionByName(costs))
