"""Inventory, snapshots, density, hotspots."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.jsontext import count_at, count_map, total_of_counts
from tidemark.functions.values import Node
from tidemark.operators import inventory as inv
from tidemark.operators.reports import largest, map_report
from tidemark.operators.reports import top_parents as top_parents_of
from tidemark.operators.merge import upsert
from tidemark.operators.snapshots import stored_diff, write_snapshot
from tidemark.operators.specs import SPECS
from tidemark.plans.packing import light_customers, light_orders
from tidemark.plans.pipelines import MapPass, map_pass
from tidemark.plans.mappers import NODES
from tidemark.plans.registry import AS_OF, SNAPSHOT, Tables, iso_text, key_text, query
from tidemark.session import scratch_path
from tidemark.sources.tables import snapshot_named

CUSTOMER_TOTALS = """
  SELECT c_custkey, c_mktsegment, count(o_orderkey) AS notes,
         count(*) FILTER (o_orderstatus = 'F') AS attachments, max(o_orderdate) AS last_order
  FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY ALL
"""


def customer_inventory(t: Tables) -> DataFrame:
    return inv.inventory_of_nodes(light_customers(t), SPECS["client"], SNAPSHOT, AS_OF)


@query(
    "inventory_customer_orders",
    f"""
    SELECT 'clients' AS entity_type, CAST(c_custkey AS VARCHAR) AS entity_id,
           strftime(last_order, '%Y-%m-%dT%H:%M:%SZ') AS updated_at,
           notes, attachments, notes + attachments AS total_relations
    FROM ({CUSTOMER_TOTALS})
    """,
)
def inventory_customer_orders(spark: SparkSession, folder: str) -> DataFrame:
    rows = inv.with_total(customer_inventory(Tables(spark, folder)))
    relations = F.col(inv.RELATIONS)
    return rows.select(
        "entity_type",
        "entity_id",
        "updated_at",
        count_at(relations, "notes").alias("notes"),
        count_at(relations, "attachments").alias("attachments"),
        "total_relations",
    )


@query(
    "inventory_all_kinds",
    """
    SELECT 'clients' AS entity_type, count(*) AS n, CAST(sum(k) AS BIGINT) AS relations
    FROM (SELECT c_custkey, count(o_orderkey) + count(*) FILTER (o_orderstatus = 'F') AS k
          FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY c_custkey)
    UNION ALL
    SELECT 'quotes', count(*), CAST(sum(k) AS BIGINT)
    FROM (SELECT o_orderkey, count(l_orderkey) AS k
          FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_orderkey)
    """,
)
def inventory_all_kinds(spark: SparkSession, folder: str) -> DataFrame:
    t = Tables(spark, folder)
    rows = inv.combine(
        [
            customer_inventory(t),
            inv.inventory_of_nodes(light_orders(t), SPECS["quote"], SNAPSHOT, AS_OF),
        ]
    )
    return (
        inv.with_total(rows)
        .groupBy("entity_type")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("total_relations").alias("relations"))
    )


@query(
    "relation_inventory",
    f"""
    SELECT 'clients' AS parent_type, CAST(c_custkey AS VARCHAR) AS parent_id,
           relation_type, relation_count
    FROM (SELECT c_custkey, notes, attachments FROM ({CUSTOMER_TOTALS}))
    UNPIVOT (relation_count FOR relation_type IN (notes, attachments))
    """,
)
def relation_inventory(spark: SparkSession, folder: str) -> DataFrame:
    rows = inv.relation_inventory(customer_inventory(Tables(spark, folder)))
    return rows.select("parent_type", "parent_id", "relation_type", "relation_count")


def by_segment(t: Tables) -> DataFrame:
    """Inventory rows with the segment as kind: what the per-kind reports run over."""
    node = Node("node")
    columns = {
        "entity_type": F.col("c_mktsegment"),
        "entity_id": node.string("id"),
        inv.RELATIONS: F.to_json(inv.relation_counts(node, SPECS["client"])),
    }
    return node.select(light_customers(t), [], columns, carry=["c_mktsegment"])


@query(
    "density_by_segment",
    f"""
    SELECT c_mktsegment AS entity_type, count(*) AS total_entities,
           avg(notes + attachments) AS avg_relations, max(notes + attachments) AS max_relations,
           count(*) FILTER (notes + attachments > 0) AS entities_with_relations
    FROM ({CUSTOMER_TOTALS}) GROUP BY 1
    """,
)
def density_by_segment(spark: SparkSession, folder: str) -> DataFrame:
    return inv.density(by_segment(Tables(spark, folder)))


@query(
    "hotspots_by_segment",
    f"""
    SELECT c_mktsegment AS entity_type, CAST(c_custkey AS VARCHAR) AS entity_id,
           notes + attachments AS total_relations,
           CAST(row_number() OVER (PARTITION BY c_mktsegment
             ORDER BY notes + attachments DESC, CAST(c_custkey AS VARCHAR)) AS INTEGER) AS rank
    FROM ({CUSTOMER_TOTALS}) QUALIFY rank <= 10
    """,
)
def hotspots_by_segment(spark: SparkSession, folder: str) -> DataFrame:
    rows = inv.hotspots(by_segment(Tables(spark, folder)), 10)
    return rows.select("entity_type", "entity_id", "total_relations", "rank")


@query(
    "map_report",
    f"""
    SELECT c_mktsegment AS entity_type, count(*) AS total_entities,
           CAST(ceil(count(*) / 100) AS BIGINT) AS total_pages,
           count(*) / ceil(count(*) / 100) AS avg_per_page,
           count(*) FILTER (notes + attachments > 0) * 100 / count(*) AS with_relations_pct
    FROM ({CUSTOMER_TOTALS}) GROUP BY 1
    """,
)
def map_report_query(spark: SparkSession, folder: str) -> DataFrame:
    t = Tables(spark, folder)
    pages = t.customer.groupBy(F.col("c_mktsegment").alias("entity_type")).agg(
        F.ceil(F.count(F.lit(1)) / 100).alias("total_pages")
    )
    report = map_report(pages, inv.density(by_segment(t)))
    return report.select(
        "entity_type", "total_entities", "total_pages", "avg_per_page", "with_relations_pct"
    )


@query(
    "largest_payloads",
    """
    SELECT CAST(doc_id AS VARCHAR) AS entity_id, source AS entity_type, length(text) AS chars
    FROM documents ORDER BY length(text) DESC, source, doc_id LIMIT 20
    """,
)
def largest_payloads(spark: SparkSession, folder: str) -> DataFrame:
    docs = Tables(spark, folder).documents
    payload = docs.select(key_text("doc_id").alias("entity_id"), "doc_id", F.col("source").alias("entity_type"), "text")
    top = largest(payload, F.length("text").cast("bigint"), ["entity_type", "doc_id"], 20, "chars")
    return top.select("entity_id", "entity_type", "chars")


@query(
    "top_parents",
    """
    SELECT c_custkey, c_name, count(o_orderkey) AS n_orders
    FROM customer LEFT JOIN orders ON o_custkey = c_custkey
    GROUP BY ALL ORDER BY n_orders DESC, c_custkey LIMIT 10
    """,
)
def top_parents(spark: SparkSession, folder: str) -> DataFrame:
    t = Tables(spark, folder)
    return top_parents_of(t.customer.select("c_custkey", "c_name"), t.orders, "c_custkey", "o_custkey", 10, "n_orders")


def _two_snapshots(t: Tables) -> tuple[DataFrame, DataFrame]:
    """Orders at two times: O comes, P goes, urgent F orders were touched a day later."""
    kind, key = F.col("o_orderpriority"), key_text("o_orderkey")
    touched = F.when(
        kind == "1-URGENT", F.col("o_orderdate") + F.expr("interval 1 day")
    ).otherwise(F.col("o_orderdate"))

    def snapshot(rows: DataFrame, updated) -> DataFrame:
        return rows.select(
            kind.alias("entity_type"), key.alias("entity_id"), iso_text(updated).alias("updated_at")
        )

    older = snapshot(t.orders.where("o_orderstatus in ('P', 'F')"), F.col("o_orderdate"))
    newer = snapshot(t.orders.where("o_orderstatus in ('F', 'O')"), touched)
    return older, newer


@query(
    "snapshot_diff_new",
    """
    SELECT o_orderpriority AS entity_type, CAST(o_orderkey AS VARCHAR) AS entity_id
    FROM orders WHERE o_orderstatus = 'O'
    """,
)
def snapshot_diff_new(spark: SparkSession, folder: str) -> DataFrame:
    older, newer = _two_snapshots(Tables(spark, folder))
    return inv.new_since(older, newer).select("entity_type", "entity_id")


@query(
    "snapshot_diff_full",
    """
    SELECT o_orderpriority AS entity_type, CAST(o_orderkey AS VARCHAR) AS entity_id,
           CASE o_orderstatus WHEN 'O' THEN 'new' WHEN 'P' THEN 'deleted' ELSE 'changed' END AS change
    FROM orders WHERE o_orderstatus <> 'F' OR o_orderpriority = '1-URGENT'
    """,
)
def snapshot_diff_full(spark: SparkSession, folder: str) -> DataFrame:
    older, newer = _two_snapshots(Tables(spark, folder))
    return inv.snapshot_diff(older, newer).select("entity_type", "entity_id", "change")


@query(
    "snapshot_diff_stored",
    """
    SELECT o_orderpriority AS entity_type, CAST(o_orderkey AS VARCHAR) AS entity_id,
           CASE o_orderstatus WHEN 'O' THEN 'new' WHEN 'P' THEN 'deleted' ELSE 'changed' END AS change
    FROM orders WHERE o_orderstatus <> 'F' OR o_orderpriority = '1-URGENT'
    """,
)
def snapshot_diff_stored(spark: SparkSession, folder: str) -> DataFrame:
    """The same, of snapshots stored with digests."""
    path = scratch_path(spark, "snapshots")
    for name, rows in zip(("old", "new"), _two_snapshots(Tables(spark, folder))):
        write_snapshot(rows.withColumn(inv.SNAPSHOT_ID, F.lit(name)), path, name, buckets=16)
    return stored_diff(spark, path, "old", "new").select("entity_type", "entity_id", "change")


@query(
    "inventory_rewritten",
    """
    SELECT 'clients' AS entity_type, CAST(c_custkey AS VARCHAR) AS entity_id, map_snapshot_id,
           CASE WHEN map_snapshot_id = 'snapshot-1' THEN 'second' ELSE 'first' END AS discovered_at
    FROM customer, (VALUES ('snapshot-0'), ('snapshot-1')) s(map_snapshot_id)
    """,
)
def inventory_rewritten(spark: SparkSession, folder: str) -> DataFrame:
    """Two snapshots are written, one of them a second time: it is replaced record by record."""
    path, clients = scratch_path(spark, "inventory"), light_customers(Tables(spark, folder))
    for snapshot_id, when in ((OTHER, "first"), (SNAPSHOT, "first"), (SNAPSHOT, "second")):
        inv.write_inventory(inv.inventory_of_nodes(clients, SPECS["client"], snapshot_id, when), path)
    stored = spark.read.parquet(path)
    return stored.select("entity_type", "entity_id", inv.SNAPSHOT_ID, "discovered_at")


def snapshots_of_segments(t: Tables) -> DataFrame:
    """One snapshot per market segment, which lists the nations of its customers as kinds."""
    kinds = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    listed = kinds.groupBy("c_mktsegment").agg(F.to_json(F.sort_array(F.collect_set("n_name"))).alias("entities_included"))
    return listed.select(
        F.lower("c_mktsegment").alias("id"),
        F.concat(F.lit("map-"), "c_mktsegment").alias("label"),
        "entities_included",
    )


SEGMENTS = """
  SELECT lower(c_mktsegment) AS id, 'map-' || c_mktsegment AS label, list_sort(list(DISTINCT n_name)) AS kinds
  FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY c_mktsegment
"""


@query(
    "snapshot_lookup",
    f"""
    SELECT 'by id' AS asked, id, label FROM ({SEGMENTS}) WHERE id = 'building'
    UNION ALL SELECT 'by label', id, label FROM ({SEGMENTS}) WHERE label = 'map-MACHINERY'
    """,
)
def snapshot_lookup(spark: SparkSession, folder: str) -> DataFrame:
    """One snapshot by its id, one by its label, and one that is not there."""
    snapshots = snapshots_of_segments(Tables(spark, folder))
    frames = [
        snapshot_named(snapshots, name).select(F.lit(asked).alias("asked"), "id", "label")
        for asked, name in (("by id", "building"), ("by label", "map-MACHINERY"), ("unknown", "nowhere"))
    ]
    return inv.combine(frames)


@query(
    "snapshot_rows",
    """
    SELECT lower(c_mktsegment) AS id, 'map-20240201-000000' AS label, '["clients","quotes"]' AS entities_included,
           '2024-02-01T00:00:00+00:00' AS created_at, '2024-02-01T00:00:00+00:00' AS pass1_cutoff
    FROM customer GROUP BY c_mktsegment
    """,
)
def snapshot_rows(spark: SparkSession, folder: str) -> DataFrame:
    """A snapshot record per market segment, each upserted twice and kept once."""
    segments = [r[0] for r in Tables(spark, folder).customer.select(F.lower("c_mktsegment")).distinct().collect()]
    rows = [inv.snapshot_row(spark, s, AS_OF, ["clients", "quotes"]) for s in segments]
    batch = inv.combine(rows).withColumn("seq", F.lit(1))
    once = upsert(inv.combine(rows).limit(0), batch, ["id"], ["seq"])
    return upsert(once, batch, ["id"], ["seq"]).select("id", "label", "entities_included", "created_at", "pass1_cutoff")


@query(
    "kinds_not_in_snapshot",
    f"""
    SELECT id, n_name AS entity_type FROM ({SEGMENTS}), nation
    WHERE n_regionkey = 1 AND NOT list_contains(kinds, n_name)
    UNION ALL SELECT id, 'NOWHERE' FROM ({SEGMENTS})
    """,
)
def kinds_not_in_snapshot(spark: SparkSession, folder: str) -> DataFrame:
    """Nations of one region, and one that does not exist, asked of every snapshot."""
    t = Tables(spark, folder)
    asked = t.nation.where("n_regionkey = 1").select(F.col("n_name").alias("entity_type"))
    asked = asked.unionByName(spark.createDataFrame([("NOWHERE",)], "entity_type string"))
    return inv.kinds_missing(snapshots_of_segments(t), asked).select("id", "entity_type")


@query(
    "json_count_filter",
    """
    SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k
    FROM events WHERE CAST(json_extract(props, '$.k') AS BIGINT) > 10
    """,
)
def json_count_filter(spark: SparkSession, folder: str) -> DataFrame:
    events = Tables(spark, folder).events.select("event_id", count_at(F.col("props"), "k").alias("k"))
    return events.where("k > 10")


@query(
    "json_map_totals",
    """
    SELECT event_type, CAST(sum(CAST(json_extract(props, '$.k') AS BIGINT)) AS BIGINT) AS relations,
           count(*) AS n
    FROM events GROUP BY 1
    """,
)
def json_map_totals(spark: SparkSession, folder: str) -> DataFrame:
    events = Tables(spark, folder).events
    return events.groupBy("event_type").agg(
        F.sum(total_of_counts(count_map(F.col("props")))).alias("relations"),
        F.count(F.lit(1)).alias("n"),
    )


OTHER = "snapshot-0"
# Kinds without relations in the given tables, by the table they are packed from.
PLAIN_KINDS = {
    "invoices": "orders",
    "jobs": "orders",
    "properties": "customer",
    "requests": "events",
    "users": "supplier",
    "expenses": "lineitem",
    "visits": "lineitem",
    "timeSheetEntries": "events",
    "productsAndServices": "part",
    "taxRates": "nation",
}


def _map_pass(spark: SparkSession, folder: str) -> MapPass:
    """All twelve kinds; clients and quotes carry relations."""
    t = Tables(spark, folder)
    kinds = {kind: (SPECS[kind], nodes(t)) for kind, nodes in NODES.items()}
    kinds["client"] = (SPECS["client"], light_customers(t))
    kinds["quote"] = (SPECS["quote"], light_orders(t))
    # A kind that the source has no record of.
    kinds["user"] = (SPECS["user"], NODES["user"](t).where("node is null"))
    return map_pass(spark, kinds, SNAPSHOT, AS_OF)


MAPPED = """
  SELECT 'clients' AS entity_type, CAST(c_custkey AS VARCHAR) AS entity_id,
         count(o_orderkey) + count(*) FILTER (o_orderstatus = 'F') AS k
  FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY c_custkey
  UNION ALL
  SELECT 'quotes', CAST(o_orderkey AS VARCHAR), count(l_orderkey)
  FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_orderkey
"""


@query(
    "map_pass_density",
    f"""
    SELECT entity_type, count(*) AS total_entities, avg(k) AS avg_relations, max(k) AS max_relations,
           count(*) FILTER (k > 0) AS entities_with_relations
    FROM ({MAPPED}) GROUP BY 1
    """
    + "".join(
        f" UNION ALL SELECT '{kind}', {'count(*) - count(*)' if kind == 'users' else 'count(*)'}, 0.0::DOUBLE, 0, 0 FROM {table}"
        for kind, table in PLAIN_KINDS.items()
    ),
)
def map_pass_density(spark: SparkSession, folder: str) -> DataFrame:
    return _map_pass(spark, folder).density


@query(
    "map_pass_hotspots",
    f"""
    SELECT entity_type, entity_id, k AS total_relations,
           CAST(row_number() OVER (PARTITION BY entity_type ORDER BY k DESC, entity_id) AS INTEGER) AS rank
    FROM ({MAPPED}) WHERE k > 0 QUALIFY rank <= 10
    """,
)
def map_pass_hotspots(spark: SparkSession, folder: str) -> DataFrame:
    """Of the kinds whose records have relations at all."""
    rows = _map_pass(spark, folder).hotspots.where("total_relations > 0")
    return rows.select("entity_type", "entity_id", "total_relations", "rank")
