"""Keyed writes as table state: the new state of a table out of the old one and a batch.

Arrival order is a column here (`seq`), because rows of a DataFrame have none.
`seq` must be unique within a key.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.ranking import first_per_key


def latest_per_key(batch: DataFrame, keys: Sequence[str], seq: Sequence[str]) -> DataFrame:
    """Last writer wins inside a batch."""
    return first_per_key(batch, keys, [F.col(c).desc() for c in seq])


def earliest_per_key(batch: DataFrame, keys: Sequence[str], seq: Sequence[str]) -> DataFrame:
    return first_per_key(batch, keys, [F.col(c).asc() for c in seq])


def upsert(
    base: DataFrame,
    batch: DataFrame,
    keys: Sequence[str],
    seq: Sequence[str],
    defaults: Mapping[str, object] | None = None,
) -> DataFrame:
    """Rows of the batch replace rows of the base with the same key.

    Columns the batch lacks fall back to `defaults` or NULL: a replace is a delete
    and an insert. Use `patch` to keep what the base has. The base is only probed with the batch's keys, so a small batch costs the base
    no shuffle.
    """
    untouched = base.join(batch.select(*keys).distinct(), list(keys), "left_anti")
    newest = evolve(latest_per_key(batch, keys, seq), base.schema, defaults)
    return untouched.unionByName(newest)


def insert_or_ignore(
    existing: DataFrame, new: DataFrame, keys: Sequence[str], seq: Sequence[str]
) -> DataFrame:
    """Rows of `new` with keys the table lacks, first one per key; the rest stays as it is."""
    fresh = earliest_per_key(new, keys, seq).join(
        existing.select(*keys).distinct(), list(keys), "left_anti"
    )
    return existing.unionByName(fresh.select(*existing.columns))


def patch(
    base: DataFrame, changes: DataFrame, keys: Sequence[str], columns: Sequence[str]
) -> DataFrame:
    """Set `columns` where the change has a value; `changes` has one row per key."""
    renamed = changes.select(*keys, *[F.col(c).alias(f"_new_{c}") for c in columns])
    return base.join(renamed, list(keys), "left").select(
        *[
            F.coalesce(f"_new_{c}", c).alias(c) if c in columns else F.col(c)
            for c in base.columns
        ]
    )


def update_rows(base: DataFrame, changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Replace whole rows by key, NULLs included; keys the base lacks are not inserted."""
    columns = [c for c in changes.columns if c not in keys]
    renamed = changes.select(
        *keys, *[F.col(c).alias(f"_new_{c}") for c in columns], F.lit(True).alias("_hit")
    )
    return base.join(renamed, list(keys), "left").select(
        *[
            F.when(F.col("_hit"), F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c)
            if c in columns
            else F.col(c)
            for c in base.columns
        ]
    )


def delete_keys(base: DataFrame, doomed: DataFrame, keys: Sequence[str]) -> DataFrame:
    return base.join(doomed.select(*keys).distinct(), list(keys), "left_anti")


def existing_keys(base: DataFrame, wanted: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The wanted rows whose key is in the table."""
    return wanted.join(base.select(*keys).distinct(), list(keys), "left_semi")


def new_rows(base: DataFrame, candidates: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The candidates whose key is not in the table."""
    return candidates.join(base.select(*keys).distinct(), list(keys), "left_anti")


def with_known(base: DataFrame, candidates: DataFrame, keys: Sequence[str], known: str) -> DataFrame:
    """The candidates with a flag whether the table has their key, in one join."""
    there = base.select(*keys).distinct().withColumn("_there", F.lit(True))
    flag = F.coalesce(F.col("_there"), F.lit(False))
    return candidates.join(there, list(keys), "left").withColumn(known, flag).drop("_there")


@dataclass(frozen=True)
class Reference:
    """child.column points at parent.parent_key; `action` is cascade or set_null."""

    child: str
    column: str
    parent: str
    parent_key: str = "id"
    action: str = "cascade"


def delete_with_references(
    tables: Mapping[str, DataFrame],
    table: str,
    doomed: DataFrame,
    key: str,
    references: Sequence[Reference],
) -> dict[str, DataFrame]:
    """State of all tables after deleting `doomed` keys from `table`.

    References are followed in the order given; list parents before children.
    """
    state = dict(tables)
    gone = {table: state[table].join(doomed.select(key).distinct(), key, "left_semi")}
    state[table] = delete_keys(state[table], doomed, [key])
    for ref in references:
        if ref.parent not in gone:
            continue
        dead = gone[ref.parent].select(F.col(ref.parent_key).alias(ref.column)).distinct()
        child = state[ref.child]
        if ref.action == "cascade":
            removed = child.join(dead, ref.column, "left_semi")
            previous = gone.get(ref.child)
            gone[ref.child] = removed if previous is None else previous.unionByName(removed)
            state[ref.child] = child.join(dead, ref.column, "left_anti").select(*child.columns)
        else:
            state[ref.child] = child.join(
                dead.withColumn("_dead", F.lit(True)), ref.column, "left"
            ).select(
                *[
                    F.when(F.col("_dead"), F.lit(None)).otherwise(F.col(c)).alias(c)
                    if c == ref.column
                    else F.col(c)
                    for c in child.columns
                ]
            )
    return state


def prune_snapshot(
    tables: Mapping[str, DataFrame], snapshot_id: str, column: str = "map_snapshot_id"
) -> dict[str, DataFrame]:
    """Drop one snapshot everywhere; on tables partitioned by it no other file is read."""
    return {
        name: df.where(~F.col("id" if column not in df.columns else column).eqNullSafe(snapshot_id))
        for name, df in tables.items()
    }


def filled(column: str) -> Column:
    """Neither NULL nor blank."""
    return F.col(column).isNotNull() & (F.col(column).cast("string") != "")


def valid_rows(rows: DataFrame, required: Sequence[str]) -> DataFrame:
    """Rows in which every required column has a value; zero is one, blank is not."""
    return rows.where(reduce(lambda a, b: a & b, [filled(c) for c in required]))


def evolve(
    df: DataFrame, target: T.StructType, defaults: Mapping[str, object] | None = None
) -> DataFrame:
    """Bring a table to a wider schema: added columns get their default, order follows it."""
    defaults = defaults or {}
    return df.select(
        *[
            F.col(f.name).cast(f.dataType).alias(f.name)
            if f.name in df.columns
            else F.lit(defaults.get(f.name)).cast(f.dataType).alias(f.name)
            for f in target.fields
        ]
    )
