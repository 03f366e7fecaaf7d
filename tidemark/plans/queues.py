"""Work queues over orders and documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import queues
from tidemark.operators.downloads import DownloadFilters, pending_of_parents
from tidemark.operators.mapping import map_attachments, map_entities
from tidemark.operators.merge import evolve
from tidemark.operators.specs import SPECS
from tidemark.plans.packing import attachment_nodes, invoice_nodes
from tidemark.plans.pipelines import ExtractPass, extract_pass
from tidemark.plans.registry import AS_OF, SNAPSHOT, Tables, iso_text, json_of, key_text, pack, query
from tidemark.sources.pages import lookup_nodes, single_nodes

STATUS_SQL = "CASE o_orderstatus WHEN 'P' THEN 'pending' WHEN 'F' THEN 'failed' ELSE 'done' END"


def order_status() -> Column:
    status = F.col("o_orderstatus")
    return F.when(status == "P", "pending").when(status == "F", "failed").otherwise("done")


def order_queue(t: Tables) -> DataFrame:
    """Orders as extract queue, priority as kind."""
    return t.orders.select(
        F.col("o_orderpriority").alias("entity_type"),
        key_text("o_orderkey").alias("entity_id"),
        order_status().alias("status"),
        F.when(F.col("o_orderstatus") == "F", 1).otherwise(0).alias("attempt_count"),
        F.when(F.col("o_orderstatus") == "F", "timeout").alias("last_error"),
        F.lit(SNAPSHOT).alias("map_snapshot_id"),
        iso_text("o_orderdate").alias("updated_at"),
    )


@query(
    "queue_from_inventory",
    f"""
    SELECT o_orderpriority AS entity_type, CAST(o_orderkey AS VARCHAR) AS entity_id,
           CASE WHEN o_orderstatus = 'F' THEN 'failed' ELSE 'pending' END AS status,
           CAST(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS INTEGER) AS attempt_count
    FROM orders
    """,
)
def queue_from_inventory(spark: SparkSession, folder: str) -> DataFrame:
    """All orders are inventoried; the failed ones are queued already and stay failed."""
    all_orders = order_queue(Tables(spark, folder))
    queued = all_orders.where("status = 'failed'")
    result = queues.queue_from_inventory(queued, all_orders.select(*queues.EXTRACT_KEY), AS_OF)
    return result.select("entity_type", "entity_id", "status", "attempt_count")


@query(
    "queue_attachments",
    """
    SELECT CAST(doc_id AS VARCHAR) AS attachment_id,
           CASE WHEN lang = 'fr' THEN 'loose' ELSE lang || 's' END AS parent_type,
           CASE WHEN lang = 'fr' THEN 'ORPHANED' ELSE CAST(doc_id AS VARCHAR) END AS parent_id,
           'pending' AS status
    FROM documents
    """,
)
def queue_attachments(spark: SparkSession, folder: str) -> DataFrame:
    note = F.concat(F.col("lang"), F.lit("_"), key_text("doc_id"), F.lit("_note_1"))
    attachments = Tables(spark, folder).documents.select(
        key_text("doc_id").alias("id"),
        F.when(F.col("lang") == "fr", F.lit("ORPHANED")).otherwise(note).alias("note_id"),
    )
    empty = spark.createDataFrame([], queues.ATTACHMENT_SCHEMA)
    result = queues.queue_attachments(empty, attachments, SNAPSHOT, AS_OF, "loose")
    return result.select("attachment_id", "parent_type", "parent_id", "status")


@query(
    "queue_status_matrix",
    """
    SELECT o_orderpriority AS entity_type,
           count(*) FILTER (o_orderstatus = 'P') AS pending, CAST(0 AS BIGINT) AS in_progress,
           count(*) FILTER (o_orderstatus = 'O') AS done,
           count(*) FILTER (o_orderstatus = 'F') AS failed, count(*) AS total
    FROM orders GROUP BY 1
    UNION ALL SELECT DISTINCT c_mktsegment, CAST(0 AS BIGINT), CAST(0 AS BIGINT), CAST(0 AS BIGINT),
              CAST(0 AS BIGINT), CAST(0 AS BIGINT) FROM customer
    """,
)
def queue_status_matrix(spark: SparkSession, folder: str) -> DataFrame:
    """Kinds of the snapshot are priorities and segments; segments have nothing queued."""
    t = Tables(spark, folder)
    types = (
        t.orders.select(F.col("o_orderpriority").alias("entity_type"))
        .unionByName(t.customer.select(F.col("c_mktsegment").alias("entity_type")))
        .distinct()
    )
    return queues.status_matrix(order_queue(t), types)


@query(
    "dry_run_preview",
    f"""
    SELECT 'parent_type' AS dimension, o_orderpriority AS value, count(*) AS n FROM orders GROUP BY 2
    UNION ALL SELECT 'status', {STATUS_SQL}, count(*) FROM orders GROUP BY 2
    UNION ALL SELECT 'total', NULL, count(*) FROM orders
    """,
)
def dry_run_preview(spark: SparkSession, folder: str) -> DataFrame:
    queue = order_queue(Tables(spark, folder)).withColumnRenamed("entity_type", "parent_type")
    return queues.preview(queue)


@query(
    "work_selection",
    f"""
    SELECT CAST(o_orderkey AS VARCHAR) AS entity_id, {STATUS_SQL} AS status
    FROM orders WHERE o_orderstatus IN ('P', 'F')
    """,
)
def work_selection(spark: SparkSession, folder: str) -> DataFrame:
    return queues.select_work(order_queue(Tables(spark, folder))).select("entity_id", "status")


@query(
    "work_selection_first_run",
    """
    SELECT CAST(o_orderkey AS VARCHAR) AS entity_id, 'pending' AS status
    FROM orders WHERE o_orderstatus = 'P' AND o_orderpriority IN ('1-URGENT', '2-HIGH')
    """,
)
def work_selection_first_run(spark: SparkSession, folder: str) -> DataFrame:
    queue = order_queue(Tables(spark, folder))
    other = queue.withColumn("map_snapshot_id", F.lit(OTHER_SNAPSHOT))
    wanted = ["1-URGENT", "2-HIGH"]
    work = queues.select_work(queue.unionByName(other), False, wanted, SNAPSHOT)
    return work.select("entity_id", "status")


@query(
    "reclaim_stuck",
    """
    SELECT CAST(event_id AS VARCHAR) AS entity_id,
           CASE WHEN event_type = 'view' AND ts < TIMESTAMP '2024-01-15' THEN 'pending'
                WHEN event_type = 'view' THEN 'in_progress' ELSE 'done' END AS status
    FROM events
    """,
)
def reclaim_stuck(spark: SparkSession, folder: str) -> DataFrame:
    queue = Tables(spark, folder).events.select(
        key_text("event_id").alias("entity_id"),
        F.when(F.col("event_type") == "view", "in_progress").otherwise("done").alias("status"),
        iso_text("ts").alias("updated_at"),
    )
    result = queues.reclaim_stuck(queue, "2024-01-16T00:00:00Z", 86400)
    return result.select("entity_id", "status")


@query(
    "apply_results",
    f"""
    WITH worked AS (SELECT l_orderkey, bool_or(l_returnflag = 'R') AS bad FROM lineitem GROUP BY 1)
    SELECT CAST(o_orderkey AS VARCHAR) AS entity_id,
           CASE WHEN o_orderstatus = 'O' OR bad IS NULL THEN {STATUS_SQL}
                WHEN bad THEN 'failed' ELSE 'done' END AS status,
           CAST(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END
             + CASE WHEN o_orderstatus <> 'O' AND bad THEN 1 ELSE 0 END AS INTEGER) AS attempt_count,
           CASE WHEN o_orderstatus = 'O' THEN NULL
                WHEN bad IS NULL THEN CASE WHEN o_orderstatus = 'F' THEN 'timeout' END
                WHEN bad THEN 'line returned' END AS last_error
    FROM orders LEFT JOIN worked ON l_orderkey = o_orderkey
    """,
)
def apply_results(spark: SparkSession, folder: str) -> DataFrame:
    """Work on pending and failed orders that have lines; a returned line is a failure."""
    t = Tables(spark, folder)
    queue = order_queue(t)
    returned = t.lineitem.groupBy(key_text("l_orderkey").alias("entity_id")).agg(
        F.bool_or(F.col("l_returnflag") == "R").alias("bad")
    )
    results = (
        queues.select_work(queue)
        .select(*queues.EXTRACT_KEY)
        .join(returned, "entity_id")
        .select(
            *queues.EXTRACT_KEY,
            (~F.col("bad")).alias("success"),
            F.when(F.col("bad"), "line returned").alias("error"),
        )
    )
    result = queues.apply_results(queue, results, queues.EXTRACT_KEY, AS_OF)
    return result.select("entity_id", "status", "attempt_count", "last_error")


OTHER_SNAPSHOT = "snapshot-0"


def _invoice_extract(spark: SparkSession, folder: str) -> ExtractPass:
    """Orders as invoices: F is queued as failed, O as done; P nodes are never delivered.

    Urgent orders are in the inventory and queue of an older snapshot as well, where they
    stay pending: the pass is for one snapshot.
    """
    t = Tables(spark, folder)
    kind = F.lit(SPECS["invoice"].root)
    orders = order_queue(t)
    older = orders.where("entity_type = '1-URGENT'").withColumns(
        {"map_snapshot_id": F.lit(OTHER_SNAPSHOT), "status": F.lit("pending"), "attempt_count": F.lit(7)}
    )
    snapshot = orders.unionByName(older).withColumn("entity_type", kind).select(*queues.EXTRACT_KEY)
    queued = orders.where("status <> 'pending'").unionByName(older).withColumn("entity_type", kind)
    packed = invoice_nodes(t)
    node_id = F.try_variant_get("node", "$.id", "string")
    nodes = packed.where(F.try_variant_get("node", "$.invoiceStatus", "string") != "P").select(
        node_id.alias("entity_id"), node_id.alias("seq"), "node"
    )
    schema = map_entities(nodes, SPECS["invoice"]).drop("reject_reason").schema
    stored = spark.createDataFrame([], schema)
    return extract_pass(snapshot, queued, stored, nodes, SPECS["invoice"], AS_OF, snapshot_id=SNAPSHOT)


@query(
    "extract_pass",
    """
    SELECT CAST(o_orderkey AS VARCHAR) AS entity_id,
           CASE WHEN o_orderstatus = 'O' THEN 'done'
                WHEN o_orderstatus = 'F' AND o_orderpriority <> '1-URGENT' THEN 'done'
                ELSE 'failed' END AS status,
           CAST(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END
             + CASE WHEN o_orderstatus = 'P' OR (o_orderstatus = 'F' AND o_orderpriority = '1-URGENT')
               THEN 1 ELSE 0 END AS INTEGER) AS attempt_count,
           CASE WHEN o_orderstatus = 'P' THEN 'Entity not found: ' || o_orderkey
                WHEN o_orderstatus = 'F' AND o_orderpriority = '1-URGENT'
                THEN 'Mapping error for invoices ' || o_orderkey || ': missing client id' END AS last_error
    FROM orders
    UNION ALL SELECT CAST(o_orderkey AS VARCHAR), 'pending', 7, CASE WHEN o_orderstatus = 'F' THEN 'timeout' END
    FROM orders WHERE o_orderpriority = '1-URGENT'
    """,
)
def extract_pass_queue(spark: SparkSession, folder: str) -> DataFrame:
    result = _invoice_extract(spark, folder).queue
    return result.select("entity_id", "status", "attempt_count", "last_error")


@query(
    "extract_pass_stored",
    """
    SELECT CAST(o_orderkey AS VARCHAR) AS id, CAST(o_custkey AS VARCHAR) AS client_id,
           CAST(trunc(o_totalprice * 100) AS BIGINT) AS total_cents
    FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority <> '1-URGENT'
    """,
)
def extract_pass_stored(spark: SparkSession, folder: str) -> DataFrame:
    return _invoice_extract(spark, folder).stored.select("id", "client_id", "total_cents")


@query(
    "extract_pass_attachments",
    f"""
    SELECT o_orderkey || '-file' AS attachment_id, 'invoices' AS parent_type, CAST(o_orderkey AS VARCHAR) AS parent_id,
           '{SNAPSHOT}' AS map_snapshot_id, 'pending' AS status, 'invoice_' || o_orderkey || '_note_1' AS note_id
    FROM orders WHERE o_orderstatus = 'F'
    UNION ALL SELECT 'known', 'invoices', '7', '{SNAPSHOT}', 'done', 'invoice_7_note_1'
    """,
)
def extract_pass_attachments(spark: SparkSession, folder: str) -> DataFrame:
    """Failed orders list one file in their node; a known file keeps its queue status."""
    t = Tables(spark, folder)
    spec, key = SPECS["invoice"], key_text("o_orderkey")
    snapshot = order_queue(t).withColumn("entity_type", F.lit(spec.root)).select(*queues.EXTRACT_KEY)
    note = F.struct(F.concat(F.lit("invoice_"), key, F.lit("_note_1")).alias("id"))
    file = F.struct(F.concat(key, F.lit("-file")).alias("id"), F.lit("order.txt").alias("fileName"), note.alias("note"))
    edges = F.when(F.col("o_orderstatus") == "F", F.array(F.struct(file.alias("node"))))
    text = json_of(
        key.alias("id"),
        F.struct(key_text("o_custkey").alias("id")).alias("client"),
        F.struct(edges.alias("edges")).alias("noteAttachments"),
    )
    nodes = pack(t.orders, text, key.alias("entity_id"), key.alias("seq"))
    stored = spark.createDataFrame([], map_entities(nodes, spec).drop("reject_reason").schema)
    files = map_attachments(attachment_nodes(t)).drop("reject_reason")
    known = spark.createDataFrame(
        [("known", "invoices", "7", "done", 0, None, SNAPSHOT, AS_OF)], queues.ATTACHMENT_SCHEMA
    )
    row = spark.createDataFrame([("known", "invoice_7_note_1")], "id string, note_id string")
    result = extract_pass(
        snapshot,
        spark.createDataFrame([], queues.EXTRACT_SCHEMA),
        stored,
        nodes,
        spec,
        AS_OF,
        snapshot_id=SNAPSHOT,
        attachments=evolve(row, files.schema),
        attachment_queue=known,
    )
    metadata = result.attachments.select(F.col("id").alias("attachment_id"), "note_id")
    queued = result.attachment_queue.select("attachment_id", "parent_type", "parent_id", "map_snapshot_id", "status")
    return queued.join(metadata, "attachment_id")


@query(
    "extract_pass_discrepancies",
    """
    SELECT 'failed_entities' AS type, 'invoices' AS entity_type, count(*) AS expected,
           count(*) - count(*) FILTER (bad) AS actual, count(*) FILTER (bad) AS difference,
           CASE WHEN count(*) FILTER (bad) * 10 < count(*) THEN 'warning' ELSE 'error' END AS severity
    FROM (SELECT o_orderstatus = 'P' OR (o_orderstatus = 'F' AND o_orderpriority = '1-URGENT') AS bad
          FROM orders)
    """,
)
def extract_pass_discrepancies(spark: SparkSession, folder: str) -> DataFrame:
    return _invoice_extract(spark, folder).discrepancies


@query(
    "extract_outcomes",
    """
    SELECT CAST(o_orderkey AS VARCHAR) AS entity_id,
           o_orderstatus = 'F' AND o_orderpriority <> '1-URGENT' AS success,
           o_orderstatus = 'F' AS entity_found
    FROM orders WHERE o_orderstatus <> 'O'
    """,
)
def extract_outcomes(spark: SparkSession, folder: str) -> DataFrame:
    outcomes = _invoice_extract(spark, folder).outcomes
    return outcomes.select("entity_id", "success", "entity_found")


@query(
    "batch_lookup",
    """
    SELECT doc_id, EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id) AS found
    FROM documents d
    """,
)
def batch_lookup(spark: SparkSession, folder: str) -> DataFrame:
    t = Tables(spark, folder)
    return lookup_nodes(t.documents.select("doc_id"), t.labels, "doc_id")


@query(
    "single_node",
    """
    SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END AS status,
           o_orderstatus <> 'P' AS found
    FROM orders
    """,
)
def single_node(spark: SparkSession, folder: str) -> DataFrame:
    """Single-node responses; pending orders answer with a null node."""
    node = F.when(
        F.col("o_orderstatus") != "P", F.struct(F.col("o_orderstatus").alias("status"))
    )
    body = F.to_json(
        F.struct(F.struct(node.alias("node")).alias("data")), {"ignoreNullFields": "false"}
    )
    responses = Tables(spark, folder).orders.select("o_orderkey", body.alias("body"))
    return single_nodes(responses).select(
        "o_orderkey",
        F.try_variant_get("node", "$.status", "string").alias("status"),
        F.col("node").isNotNull().alias("found"),
    )


@query(
    "pending_by_parent_type",
    """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem JOIN orders ON o_orderkey = l_orderkey
    WHERE l_linestatus = 'O' AND o_orderpriority IN ('1-URGENT', '2-HIGH')
    """,
)
def pending_by_parent_type(spark: SparkSession, folder: str) -> DataFrame:
    """Open lines whose order is of a wanted kind; both filters reach the scans."""
    t = Tables(spark, folder)
    pending = t.lineitem.where("l_linestatus = 'O'").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    wanted = DownloadFilters(parent_types=["1-urgent", "2-High"])
    return pending_of_parents(pending, t.orders, "l_orderkey", "o_orderkey", F.col("o_orderpriority"), wanted)
