"""Connected components of an undirected graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import Scratch


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Edges with u > v; every node's lower neighbours move to the lowest of them."""
    low = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(low, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(low.select("u", F.col("m").alias("v"))).distinct()


def _signature(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())


def connected(links: DataFrame, scratch: Scratch) -> DataFrame:
    """(a, b) links of comparable ids -> (node, root), root the smallest id reachable.

    Alternates large and small stars until every node hangs off its root. Nodes' links
    are reduced by a grouped minimum and a join, never gathered, so one hub is no group
    in memory; each round is a table in the shared folder and the one before is removed.
    Nodes without a link, links of a node to itself and null ids are left out.
    """
    start = links.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    edges = scratch.stage(start.distinct(), "links")
    before = _signature(edges)
    while before[0]:
        after = scratch.stage(_small_star(_large_star(edges)), "links")
        scratch.drop(edges)
        edges, now = after, _signature(after)
        if now == before:
            break
        before = now
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots)
