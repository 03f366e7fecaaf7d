"""JSON held as text: arrays, count maps, connections."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.values import Node, is_object, variant_at

COUNT_MAP = "map<string,bigint>"


def json_or_empty_list(value: Column) -> Column:
    return F.coalesce(F.to_json(value), F.lit("[]"))


def parsed_or(text: Column, schema: str, default: Column) -> Column:
    """Parse JSON text; blank or invalid text gives `default`."""
    return F.coalesce(F.from_json(F.nullif(text, F.lit("")), schema), default)


def count_at(text: Column, key: str) -> Column:
    """The count stored under `key`; NULL when there is none."""
    return F.get_json_object(text, f"$.{key}").try_cast("bigint")


def count_map(text: Column) -> Column:
    return F.from_json(text, COUNT_MAP)


def total_of_counts(counts: Column) -> Column:
    """Sum over the values of a count map, 0 for an empty or missing one."""
    return F.aggregate(
        F.coalesce(F.map_values(counts), F.array().cast("array<bigint>")),
        F.lit(0).cast("bigint"),
        lambda total, n: total + F.coalesce(n, F.lit(0)),
    )


def edge_nodes(node: Node, path: str) -> Column:
    """Nodes of a connection that are objects, as array<variant>."""
    edges = node.typed(f"{path}.edges", "array<variant>")
    return F.filter(F.transform(edges, lambda e: variant_at(e, "node")), is_object)


def edge_nodes_json(node: Node, path: str) -> Column:
    return json_or_empty_list(edge_nodes(node, path))
