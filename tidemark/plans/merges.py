"""Keyed writes on the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators import merge
from tidemark.operators.merge import Reference
from tidemark.plans.registry import Tables, key_text, query, time_text

LINE_KEY = ["l_orderkey", "l_linenumber"]
LINE_SEQ = ["l_shipdate", "l_partkey", "l_suppkey"]


@query(
    "upsert_lineitem",
    """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice,
           l_linestatus, strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS l_shipdate
    FROM lineitem
    QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
      ORDER BY l_linestatus = 'O' DESC, l_shipdate DESC, l_partkey DESC, l_suppkey DESC) = 1
    """,
)
def upsert_lineitem(spark: SparkSession, folder: str) -> DataFrame:
    """The F lines are the stored table; the O lines arrive as a batch and win."""
    lines = Tables(spark, folder).lineitem.select(
        *LINE_KEY, "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_linestatus", "l_shipdate"
    )
    stored = merge.latest_per_key(lines.where("l_linestatus <> 'O'"), LINE_KEY, LINE_SEQ)
    result = merge.upsert(stored, lines.where("l_linestatus = 'O'"), LINE_KEY, LINE_SEQ)
    return result.withColumn("l_shipdate", time_text("l_shipdate"))


@query(
    "upsert_latest_lineitem",
    """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice
    FROM lineitem
    QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
      ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC) = 1
    """,
)
def upsert_latest_lineitem(spark: SparkSession, folder: str) -> DataFrame:
    lines = Tables(spark, folder).lineitem.select(
        *LINE_KEY, "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate"
    )
    return merge.latest_per_key(lines, LINE_KEY, LINE_SEQ).drop("l_shipdate")


@query(
    "insert_ignore_queue",
    """
    SELECT CAST(o_orderkey AS VARCHAR) AS entity_id, 'failed' AS status
    FROM orders WHERE o_orderstatus = 'F'
    UNION ALL
    SELECT DISTINCT CAST(l_orderkey AS VARCHAR), 'pending' FROM lineitem
    WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')
    """,
)
def insert_ignore_queue(spark: SparkSession, folder: str) -> DataFrame:
    """F orders are queued as failed already; every order with a line is offered as pending."""
    t = Tables(spark, folder)
    queued = t.orders.where("o_orderstatus = 'F'").select(
        key_text("o_orderkey").alias("entity_id"), F.lit("failed").alias("status")
    )
    offered = t.lineitem.select(
        key_text("l_orderkey").alias("entity_id"), F.lit("pending").alias("status")
    )
    return merge.insert_or_ignore(queued, offered, ["entity_id"], ["status"])


@query(
    "patch_coalesce",
    """
    SELECT d.doc_id, coalesce(CASE WHEN quality = 1 THEN 'completed' END, lang) AS lang,
           source, coalesce(CAST(toxic AS BIGINT), n_chars) AS n_chars
    FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id
    """,
)
def patch_coalesce(spark: SparkSession, folder: str) -> DataFrame:
    t = Tables(spark, folder)
    base = t.documents.select("doc_id", "lang", "source", "n_chars")
    changes = t.labels.select(
        "doc_id",
        F.when(F.col("quality") == 1, F.lit("completed")).alias("lang"),
        F.col("toxic").cast("bigint").alias("n_chars"),
    )
    return merge.patch(base, changes, ["doc_id"], ["lang", "n_chars"])


@query(
    "update_full_row",
    """
    SELECT d.doc_id,
           CASE WHEN l.doc_id IS NULL THEN lang WHEN quality = 1 THEN 'completed' END AS lang,
           source, CASE WHEN l.doc_id IS NULL THEN n_chars ELSE CAST(toxic AS BIGINT) END AS n_chars
    FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id
    """,
)
def update_full_row(spark: SparkSession, folder: str) -> DataFrame:
    t = Tables(spark, folder)
    base = t.documents.select("doc_id", "lang", "source", "n_chars")
    changes = t.labels.select(
        "doc_id",
        F.when(F.col("quality") == 1, F.lit("completed")).alias("lang"),
        F.col("toxic").cast("bigint").alias("n_chars"),
    )
    return merge.update_rows(base, changes, ["doc_id"])


@query(
    "delete_keys",
    """
    SELECT o_orderkey, o_custkey, o_totalprice FROM orders o
    WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_returnflag = 'R')
    """,
)
def delete_keys(spark: SparkSession, folder: str) -> DataFrame:
    """Delete the orders that had a line returned."""
    t = Tables(spark, folder)
    doomed = t.lineitem.where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey"))
    orders = t.orders.select("o_orderkey", "o_custkey", "o_totalprice")
    return merge.delete_keys(orders, doomed, ["o_orderkey"])


def _after_customer_delete(t: Tables, action: str) -> dict[str, DataFrame]:
    tables = {
        "customer": t.customer.select("c_custkey", "c_name"),
        "orders": t.orders.select("o_orderkey", "o_custkey", "o_orderstatus"),
        "lineitem": t.lineitem.select(*LINE_KEY, "l_partkey", "l_suppkey"),
    }
    references = [
        Reference("orders", "o_custkey", "customer", "c_custkey", action),
        Reference("lineitem", "l_orderkey", "orders", "o_orderkey", "cascade"),
    ]
    doomed = t.customer.where("c_acctbal < 0").select("c_custkey")
    return merge.delete_with_references(tables, "customer", doomed, "c_custkey", references)


@query(
    "cascade_delete",
    """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem
    WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders JOIN customer ON c_custkey = o_custkey
                             WHERE c_acctbal < 0)
    """,
)
def cascade_delete(spark: SparkSession, folder: str) -> DataFrame:
    return _after_customer_delete(Tables(spark, folder), "cascade")["lineitem"]


@query(
    "cascade_delete_orders",
    """
    SELECT o_orderkey, o_custkey, o_orderstatus FROM orders
    WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)
    """,
)
def cascade_delete_orders(spark: SparkSession, folder: str) -> DataFrame:
    return _after_customer_delete(Tables(spark, folder), "cascade")["orders"]


@query(
    "set_null_fk",
    """
    SELECT o_orderkey, CASE WHEN c_acctbal < 0 THEN NULL ELSE o_custkey END AS o_custkey, o_orderstatus
    FROM orders LEFT JOIN customer ON c_custkey = o_custkey
    """,
)
def set_null_fk(spark: SparkSession, folder: str) -> DataFrame:
    return _after_customer_delete(Tables(spark, folder), "set_null")["orders"]


@query(
    "prune_snapshot",
    """
    SELECT CAST(o_orderkey AS VARCHAR) AS entity_id, 'snapshot-' || o_orderstatus AS map_snapshot_id
    FROM orders WHERE o_orderstatus <> 'F'
    """,
)
def prune_snapshot(spark: SparkSession, folder: str) -> DataFrame:
    inventory = Tables(spark, folder).orders.select(
        key_text("o_orderkey").alias("entity_id"),
        F.concat(F.lit("snapshot-"), F.col("o_orderstatus")).alias("map_snapshot_id"),
    )
    return merge.prune_snapshot({"entity_inventory": inventory}, "snapshot-F")["entity_inventory"]


@query(
    "append_valid_refs",
    """
    SELECT CAST(event_id AS VARCHAR) AS note_id, event_type AS entity_type,
           CAST(user_id AS VARCHAR) AS entity_id
    FROM events WHERE event_type NOT IN ('error', 'view')
    """,
)
def append_valid_refs(spark: SparkSession, folder: str) -> DataFrame:
    """Errors carry a blank kind and views a NULL parent: neither may be appended."""
    kind = F.col("event_type")
    refs = Tables(spark, folder).events.select(
        key_text("event_id").alias("note_id"),
        F.when(kind == "error", F.lit("")).otherwise(kind).alias("entity_type"),
        F.when(kind != "view", key_text("user_id")).alias("entity_id"),
    )
    return merge.valid_rows(refs, ["note_id", "entity_type", "entity_id"])


@query(
    "evolve_schema",
    """
    SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS first_name, CAST(0 AS BIGINT) AS balance_cents,
           '' AS company_name, CAST(NULL AS VARCHAR) AS billing_city
    FROM customer
    """,
)
def evolve_schema(spark: SparkSession, folder: str) -> DataFrame:
    old = Tables(spark, folder).customer.select(
        key_text("c_custkey").alias("id"), F.col("c_name").alias("first_name")
    )
    target = T.StructType.fromDDL(
        "id string, first_name string, balance_cents bigint, company_name string, billing_city string"
    )
    return merge.evolve(old, target, {"balance_cents": 0, "company_name": ""})


@query(
    "skip_existing",
    """
    SELECT doc_id, lang, CAST(NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id) AS BOOLEAN) AS is_new
    FROM documents d
    """,
)
def skip_existing(spark: SparkSession, folder: str) -> DataFrame:
    """All documents, flagged whether a label is stored already."""
    t = Tables(spark, folder)
    marked = merge.with_known(t.labels, t.documents.select("doc_id", "lang"), ["doc_id"], "known")
    return marked.select("doc_id", "lang", (~F.col("known")).alias("is_new"))


@query(
    "missing_fetch",
    "SELECT count(*) AS missing FROM documents d ANTI JOIN labels l ON l.doc_id = d.doc_id",
)
def missing_fetch(spark: SparkSession, folder: str) -> DataFrame:
    t = Tables(spark, folder)
    return merge.new_rows(t.labels, t.documents.select("doc_id"), ["doc_id"]).agg(
        F.count(F.lit(1)).alias("missing")
    )
