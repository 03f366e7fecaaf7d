"""Pages of a JSON connection: pages -> edges -> nodes.

A page is `{data: {<root>: {totalCount, edges: [{node}], pageInfo}}, extensions}`.
Only the root field asked for is parsed into columns; nodes and the cost envelope
stay VARIANT until a mapper reads them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.records import request_batch_size, request_entity
from tidemark.functions.values import variant_at


def connection_schema(root: str) -> T.StructType:
    connection = T.StructType.fromDDL(
        "totalCount bigint, edges array<struct<cursor string, node variant>>, "
        "pageInfo struct<hasNextPage boolean, endCursor string>"
    )
    return T.StructType(
        [
            T.StructField("data", T.StructType([T.StructField(root, connection)])),
            T.StructField("extensions", T.VariantType()),
        ]
    )


def page_schema(root: str) -> T.StructType:
    """A page as a feed file line: its number next to the response."""
    return T.StructType([T.StructField("page", T.LongType()), *connection_schema(root).fields])


def page_columns(pages: DataFrame, root: str) -> DataFrame:
    """(page, total_count, edges, has_next, end_cursor, extensions) of parsed pages."""
    connection = F.col("data").getField(root)
    return pages.select(
        "page",
        connection["totalCount"].alias("total_count"),
        connection["edges"].alias("edges"),
        connection["pageInfo"]["hasNextPage"].alias("has_next"),
        connection["pageInfo"]["endCursor"].alias("end_cursor"),
        "extensions",
    )


def parse_pages(pages: DataFrame, root: str, body: str = "body", page: str = "page") -> DataFrame:
    """The same out of a column of response texts."""
    parsed = F.from_json(F.col(body), connection_schema(root))
    return page_columns(
        pages.select(F.col(page).alias("page"), parsed.alias("_p")).select("page", "_p.*"), root
    )


def read_pages(spark: SparkSession, path: str, root: str) -> DataFrame:
    return page_columns(spark.read.schema(page_schema(root)).json(path), root)


def nodes_of(pages: DataFrame) -> DataFrame:
    """One row per node with its arrival order (page, pos); null nodes are dropped."""
    edge = F.col("edge.node")
    return (
        pages.select("page", F.posexplode("edges").alias("pos", "edge"))
        .select("page", "pos", edge.alias("node"))
        .where(F.col("node").isNotNull() & ~F.is_variant_null("node"))
    )


def page_totals(pages: DataFrame) -> DataFrame:
    """Announced total (from the first page), pages read and nodes delivered."""
    return pages.groupBy().agg(
        F.min_by("total_count", "page").alias("announced"),
        F.count(F.lit(1)).alias("pages"),
        F.coalesce(F.sum(F.size("edges").cast("bigint")), F.lit(0)).alias("delivered"),
    )


def single_nodes(responses: DataFrame, body: str = "body") -> DataFrame:
    """`{data: {node}}` responses; a missing or null node stays as a NULL node."""
    node = variant_at(F.try_parse_json(F.col(body)), "data.node")
    return responses.withColumn(
        "node", F.when(node.isNotNull() & ~F.is_variant_null(node), node)
    ).drop(body)


def lookup_nodes(wanted: DataFrame, nodes: DataFrame, key: str = "id") -> DataFrame:
    """Wanted ids with `found`: ids are looked up in all pages, with no page limit."""
    there = nodes.select(key).distinct().withColumn("_there", F.lit(True))
    return wanted.join(there, key, "left").select(
        *wanted.columns, F.coalesce("_there", F.lit(False)).alias("found")
    )


def child_nodes(
    parents: DataFrame,
    connection: str,
    parent_id: str,
    continuation: DataFrame | None = None,
    node: str = "node",
) -> DataFrame:
    """Children inline in a parent's first page, plus those of continuation pages.

    `continuation` has the same parent id column and an `edges` array<variant>.
    """

    def exploded(frame: DataFrame, edges: Column) -> DataFrame:
        child = F.try_variant_get(F.col("_edge"), "$.node", "variant")
        return (
            frame.select(parent_id, F.explode(edges).alias("_edge"))
            .select(parent_id, child.alias("child"))
            .where(F.col("child").isNotNull() & ~F.is_variant_null("child"))
        )

    inline = F.try_variant_get(F.col(node), f"$.{connection}.edges", "array<variant>")
    children = exploded(parents, inline)
    if continuation is None:
        return children
    return children.unionByName(exploded(continuation, F.col("edges")))


def cost_envelopes(
    pages: DataFrame, query: Column, query_type: Column | None = None
) -> DataFrame:
    """Cost and throttle numbers of responses; rows without both costs are dropped."""
    cost = F.col("extensions")

    def number(path: str) -> Column:
        return F.try_variant_get(cost, f"$.cost.{path}", "bigint")

    return pages.select(
        "page",
        (request_entity(query) if query_type is None else query_type).alias("query_type"),
        request_batch_size(query).alias("batch_size"),
        number("requestedQueryCost").alias("requested_cost"),
        number("actualQueryCost").alias("actual_cost"),
        number("throttleStatus.maximumAvailable").alias("maximum_available"),
        number("throttleStatus.currentlyAvailable").alias("currently_available"),
        number("throttleStatus.restoreRate").alias("restore_rate"),
    ).where("requested_cost is not null and actual_cost is not null")
