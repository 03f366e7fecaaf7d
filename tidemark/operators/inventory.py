"""Snapshots of what exists: one light row per record, with relation counts."""

from __future__ import annotations

import json
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.jsontext import count_map, total_of_counts
from tidemark.functions.values import Node
from tidemark.operators.merge import upsert
from tidemark.operators.ranking import top_per_key
from tidemark.operators.specs import EntitySpec
from tidemark.session import folders_in

KEY = ["entity_type", "entity_id"]
SNAPSHOT_ID = "map_snapshot_id"
PARTS = [SNAPSHOT_ID, "entity_type"]
RELATIONS = "estimated_relations_json"
TOTAL = "total_relations"
# What is read of a connection; NULL where there is no object.
CONNECTION = "struct<totalCount: bigint>"


def relation_counts(node: Node, spec: EntitySpec) -> Column:
    """Map of relation -> announced total of its connection."""
    if not spec.relations:
        return F.create_map().cast("map<string,bigint>")
    pairs = []
    for name, path in spec.relations.items():
        connection = node.typed(path, CONNECTION)
        pair = F.struct(F.lit(name).alias("key"), _announced(connection).alias("value"))
        pairs.append(F.when(connection.isNotNull(), pair) if spec.sparse_relations else pair)
    return F.map_from_entries(F.array_compact(F.array(*pairs)))


def _announced(connection: Column) -> Column:
    return F.coalesce(connection["totalCount"], F.lit(0).cast("bigint"))


def relation_total(node: Node, spec: EntitySpec) -> Column:
    """What `total_of_counts` makes of the relation counts, without a map in between."""
    counts = [_announced(node.typed(path, CONNECTION)) for path in spec.relations.values()]
    return reduce(lambda a, b: a + b, counts, F.lit(0).cast("bigint"))


def inventory_of_nodes(
    nodes: DataFrame, spec: EntitySpec, snapshot_id: str, as_of: str, node: str = "node", total: bool = False
) -> DataFrame:
    """Inventory rows of one record kind, with the relations' total where asked for."""
    reader = Node(node)
    updated = reader.string(spec.updated_path) if spec.updated_path else F.lit(None).cast("string")
    columns = {
        "entity_type": F.lit(spec.root),
        "entity_id": reader.string("id"),
        "discovered_at": F.lit(as_of),
        "map_snapshot_id": F.lit(snapshot_id),
        "updated_at": updated,
        RELATIONS: F.to_json(relation_counts(reader, spec)),
    }
    if total:
        columns[TOTAL] = relation_total(reader, spec)
    return reader.select(nodes, [], columns)


def combine(inventories: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, inventories)


def of_snapshot(rows: DataFrame, snapshot_id: str | None) -> DataFrame:
    """The rows of one snapshot; all rows for None."""
    return rows if snapshot_id is None else rows.where(F.col(SNAPSHOT_ID) == snapshot_id)


def write_inventory(inventory: DataFrame, path: str) -> None:
    """Insert or replace by (kind, id, snapshot).

    Partitioned so that one snapshot or one kind is read and pruned by itself; only the
    partitions that the new rows touch are written again, so repeating a map pass changes
    nothing but the times.
    """
    rows = inventory
    if folders_in(inventory.sparkSession, path):
        # One row per snapshot and kind: as literals they prune the stored partitions.
        written = inventory.select(*PARTS).distinct().collect()
        touched = reduce(
            lambda a, b: a | b, [(F.col(PARTS[0]) == r[0]) & (F.col(PARTS[1]) == r[1]) for r in written], F.lit(False)
        )
        stored = inventory.sparkSession.read.schema(inventory.schema).parquet(path).where(touched)
        rows = upsert(stored.select(*inventory.columns), inventory, [*KEY, SNAPSHOT_ID], ["discovered_at"])
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*PARTS).parquet(path)


def snapshot_row(
    spark: SparkSession, snapshot_id: str, as_of: str, types: Sequence[str], label: str | None = None
) -> DataFrame:
    """The one-row record of a snapshot; the default label carries the time."""
    stamp = F.date_format(F.lit(as_of).cast("timestamp"), "yyyyMMdd-HHmmss")
    return spark.range(1).select(
        F.lit(snapshot_id).alias("id"),
        F.lit(as_of).alias("created_at"),
        F.lit(as_of).alias("pass1_cutoff"),
        (F.concat(F.lit("map-"), stamp) if label is None else F.lit(label)).alias("label"),
        F.to_json(F.array(*[F.lit(t) for t in types])).alias("entities_included"),
    )


def missing_types(requested: Sequence[str], included: Sequence[str]) -> list[str]:
    """Requested kinds a snapshot does not hold; both lists are arguments, not data."""
    return sorted(set(requested) - set(included))


def kinds_missing(snapshots: DataFrame, requested: DataFrame) -> DataFrame:
    """(id, entity_type) for every requested kind that a snapshot does not list, for many
    snapshots at once; `requested` is a short list of kinds, which travels with them."""
    kinds = requested.agg(F.array_sort(F.collect_set("entity_type"))).first()[0]
    listed = F.from_json("entities_included", "array<string>")
    asked = F.array(*[F.lit(k) for k in kinds]).cast("array<string>")
    missing = F.array_except(asked, F.coalesce(listed, F.array().cast("array<string>")))
    return snapshots.select("id", F.explode(missing).alias("entity_type"))


def snapshot_kinds(snapshots: DataFrame, snapshot_id: str, requested: Sequence[str] | None = None) -> list[str]:
    """Kinds to work on: those requested, else all of the snapshot (one row is read).

    An unknown snapshot and kinds the snapshot does not hold are refused.
    """
    row = snapshots.where(F.col("id") == snapshot_id).select("entities_included").first()
    if row is None:
        raise ValueError(f"no snapshot {snapshot_id}")
    included = json.loads(row[0])
    unknown = missing_types(requested or [], included)
    if unknown:
        raise ValueError(f"snapshot {snapshot_id} has no {', '.join(unknown)}; it has {', '.join(included)}")
    return list(included if requested is None else requested)


def with_total(inventory: DataFrame) -> DataFrame:
    """The relations' total read out of the stored counts, unless the rows have it."""
    if TOTAL in inventory.columns:
        return inventory
    return inventory.withColumn(TOTAL, total_of_counts(count_map(F.col(RELATIONS))))


def relation_inventory(inventory: DataFrame) -> DataFrame:
    """Long form: one row per parent and relation."""
    return inventory.select(
        F.col("entity_type").alias("parent_type"),
        F.col("entity_id").alias("parent_id"),
        "map_snapshot_id",
        "discovered_at",
        F.explode(count_map(F.col(RELATIONS))).alias("relation_type", "relation_count"),
    )


def hotspots(inventory: DataFrame, n: int = 10, snapshot_id: str | None = None) -> DataFrame:
    """Records with the most relations per kind; ties go to the smaller id."""
    return top_per_key(
        with_total(of_snapshot(inventory, snapshot_id)),
        ["entity_type"],
        [F.col("total_relations").desc(), F.col("entity_id").asc()],
        n,
    )


def density(
    inventory: DataFrame, snapshot_id: str | None = None, types: Sequence[str] | None = None
) -> DataFrame:
    """Relations per record by kind; with `types`, kinds without records get a row of zeros."""
    counted = (
        with_total(of_snapshot(inventory, snapshot_id))
        .groupBy("entity_type")
        .agg(
            F.count(F.lit(1)).alias("total_entities"),
            F.avg("total_relations").alias("avg_relations"),
            F.max("total_relations").alias("max_relations"),
            F.count_if(F.col("total_relations") > 0).alias("entities_with_relations"),
        )
    )
    if types is None:
        return counted
    kinds = inventory.sparkSession.createDataFrame([(t,) for t in types], "entity_type string")
    return kinds.join(counted, "entity_type", "left").na.fill(0)


def new_since(older: DataFrame, newer: DataFrame) -> DataFrame:
    """Records the newer snapshot has and the older one lacks."""
    return newer.join(older.select(*KEY), KEY, "left_anti")


def snapshot_diff(older: DataFrame, newer: DataFrame) -> DataFrame:
    """new, changed (updated later) and deleted records between two snapshots."""
    a = older.select(*KEY, F.col("updated_at").alias("old_updated_at"), F.lit(1).alias("_old"))
    b = newer.select(*KEY, F.col("updated_at").alias("new_updated_at"), F.lit(1).alias("_new"))
    change = (
        F.when(F.col("_old").isNull(), "new")
        .when(F.col("_new").isNull(), "deleted")
        .when(F.col("new_updated_at") > F.col("old_updated_at"), "changed")
    )
    return (
        a.join(b, KEY, "full_outer")
        .withColumn("change", change)
        .where("change is not null")
        .select(*KEY, "old_updated_at", "new_updated_at", "change")
    )
