"""Top rows per key, last rows per key, moving averages, running totals.

Nothing here gathers a whole key in one task: ranks are limited on the map side
(the plan shows WindowGroupLimit Partial), averages are summed in short stretches of a
global order, and running totals are cut into chunks of one.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from math import log10

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.session import stage

# Weight of the newest value in the moving average.
EMA_ALPHA = 0.1
# Above one row per key, ranks are limited in two steps: per key and bucket, then per key.
RANK_BUCKETS = 64
# Rows that a task sums up before they move, for a moving average.
STRETCH = 256


def top_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int, rank: str = "rank"
) -> DataFrame:
    """First `n` rows per key by `order`, with their rank.

    A map task keeps up to n rows of a key, so for n above one a key that is in every
    task would bring n rows per task to one reducer; a limit per (key, bucket) goes first.
    All rows of a task are in one bucket, so that a task still hands over n rows per key.
    """
    if n > 1:
        spread = df.withColumn("_bucket", F.spark_partition_id() % RANK_BUCKETS)
        near = W.partitionBy(*keys, "_bucket").orderBy(*order)
        df = spread.withColumn("_near", F.row_number().over(near)).where(F.col("_near") <= n).drop("_near", "_bucket")
    window = W.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(window)).where(F.col(rank) <= n)


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    return top_per_key(df, keys, order, 1, "_rank").drop("_rank")


def _chunks(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """`df` cut into chunks of the global order by keys and order, staged in the shared
    folder because every pass over the chunks must see the same cuts."""
    cut = df.repartitionByRange(*keys, *order).withColumn("_chunk", F.spark_partition_id())
    return stage(cut, "chunks")


def _power(alpha: float, times: Column) -> Column:
    return F.pow(F.lit(1 - alpha), times)


def _joined(parts: DataFrame, keys: Sequence[str], place: Sequence[str], alpha: float) -> DataFrame:
    """Folds of consecutive stretches as one fold per key, in the order of `place`."""
    after = W.partitionBy(*keys).orderBy(*[F.col(c).desc() for c in place]).rowsBetween(W.unboundedPreceding, -1)
    placed = parts.withColumn("_after", F.coalesce(F.sum("rows").over(after), F.lit(0)))
    seed = F.struct((F.col("_after") + F.col("seed_behind")).alias("behind"), F.col("seed").alias("x"))
    return (
        placed.groupBy(*keys)
        .agg(
            F.sum("rows").alias("rows"),
            F.sum(F.col("total") * _power(alpha, F.col("_after"))).alias("total"),
            F.max_by(F.when(F.col("seed").isNotNull(), seed), F.when(F.col("seed").isNotNull(), F.col("_after"))).alias("_first"),
        )
        .select(*keys, "rows", "total", F.col("_first.behind").alias("seed_behind"), F.col("_first.x").alias("seed"))
    )


def average_folds(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, alpha: float = EMA_ALPHA
) -> DataFrame:
    """Per key the fold of an exponential moving average over its rows in `order`
    (keys, rows, total, seed_behind, seed): how many rows, their weighted sum, and the first
    value that is not zero with the number of rows behind it. Rows without a value are left out.

    Rows move once, into ranges of the global order. There they are numbered as they lie and
    summed per key in stretches of some hundred rows, so a key with a third of all rows is
    many sums from many tasks; only those move again.
    """
    columns = dict.fromkeys([*keys, *order, value])
    rows = df.select(*columns).where(F.col(value).isNotNull()).withColumn("_x", F.col(value).cast("double"))
    sorted_rows = rows.repartitionByRange(*keys, *order).sortWithinPartitions(*keys, *order)
    # Weights within a stretch must not vanish, however heavy the newest value is.
    decay = -log10(1 - alpha) if alpha < 1 else 1e9
    stretch = max(1, min(STRETCH, int(250 / decay)))
    lying = F.monotonically_increasing_id()
    numbered = sorted_rows.select(*keys, "_x", lying.alias("_at")).select(
        *keys, "_x", "_at", F.expr(f"_at div {stretch}").alias("_stretch")
    )
    # Weighted as if the stretch were full; what the key lacks at its end is taken off below.
    missing = (F.col("_stretch") + 1) * stretch - 1 - F.col("_at")
    nonzero = F.col("_x") != 0
    summed = numbered.groupBy(*keys, "_stretch").agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum(F.lit(alpha) * F.col("_x") * _power(alpha, missing)).alias("_total"),
        F.max("_at").alias("_end"),
        F.min(F.when(nonzero, F.struct("_at", F.col("_x").alias("x")))).alias("_first"),
    )
    lacks = (F.col("_stretch") + 1) * stretch - 1 - F.col("_end")
    parts = summed.select(
        *keys,
        "_stretch",
        "rows",
        (F.col("_total") / _power(alpha, lacks)).alias("total"),
        (F.col("_end") - F.col("_first._at")).alias("seed_behind"),
        F.col("_first.x").alias("seed"),
    )
    return _joined(parts, keys, ["_stretch"], alpha)


def continued_folds(
    before: DataFrame, after: DataFrame, keys: Sequence[str], alpha: float = EMA_ALPHA
) -> DataFrame:
    """Folds of a log as one with those of the rows that follow it: a batch is added to what
    is stored without reading the log again. Every row of `after` lies behind all of its key
    in `before`."""
    both = before.withColumn("_part", F.lit(0)).unionByName(after.withColumn("_part", F.lit(1)))
    return _joined(both, keys, ["_part"], alpha)


def average_of(folds: DataFrame, keys: Sequence[str], alpha: float = EMA_ALPHA) -> DataFrame:
    """The moving average that folds stand for: (keys, moving_average)."""
    # The seed weighs 1 where any other row weighs alpha.
    lift = F.col("seed") * (1 - alpha) * _power(alpha, F.col("seed_behind"))
    return folds.select(*keys, (F.col("total") + F.coalesce(lift, F.lit(0.0))).alias("moving_average"))


def moving_average(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: str,
    alpha: float = EMA_ALPHA,
) -> DataFrame:
    """Exponential moving average after the last row of each key, `order` ascending.

    avg = alpha*x + (1-alpha)*avg, seeded by the first value that is not zero; rows
    without a value are left out. All rows count.
    """
    return average_of(average_folds(df, keys, order, value, alpha), keys, alpha)


def totals_at_end(df: DataFrame, keys: Sequence[str], totals: Mapping[str, Column], start: DataFrame | None = None) -> DataFrame:
    """What `totals` have come to after all rows, on top of `start`: where to go on."""
    ends = df.groupBy(*keys).agg(*[F.coalesce(F.sum(expr), F.lit(0)).alias(name) for name, expr in totals.items()])
    if start is None:
        return ends
    both = start.select(*keys, *totals).unionByName(ends)
    return both.groupBy(*keys).agg(*[F.sum(name).alias(name) for name in totals])


def running_totals(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    totals: Mapping[str, Column],
    start: DataFrame | None = None,
) -> DataFrame:
    """`totals` summed from the first row of each key up to the current one.

    `keys` + `order` must identify a row. Rows are range-partitioned by keys and
    order, so a key with a third of all rows spreads over a third of the chunks;
    the chunked rows are staged in the shared folder because both passes over them
    must see the same cuts. The first pass sums each (key, chunk); those few
    sums give every chunk its starting offset; the second pass runs inside chunks.
    `start` (see `totals_at_end`) holds what came before `df`, so that a log goes on where
    its last batch stopped.

    Staging is an action: this operator is not lazy.
    """
    adds = [expr.alias(f"_add_{name}") for name, expr in totals.items()]
    rows = _chunks(df.select("*", *adds), keys, order)
    names = list(totals)
    before = W.partitionBy(*keys).orderBy("_chunk").rowsBetween(W.unboundedPreceding, -1)
    sums = rows.groupBy(*keys, "_chunk").agg(
        *[F.sum(f"_add_{name}").alias(f"_sum_{name}") for name in names]
    )
    if start is not None:
        known = start.select(*keys, F.lit(-1).alias("_chunk"), *[F.col(n).alias(f"_sum_{n}") for n in names])
        sums = sums.unionByName(known)
    offsets = sums.select(
        *[F.col(key).alias(f"_key_{key}") for key in keys],
        F.col("_chunk").alias("_key_chunk"),
        *[
            F.coalesce(F.sum(f"_sum_{name}").over(before), F.lit(0)).alias(f"_base_{name}")
            for name in names
        ],
    )
    inside = (
        W.partitionBy(*keys, "_chunk")
        .orderBy(*order)
        .rowsBetween(W.unboundedPreceding, W.currentRow)
    )
    local = rows.select(
        *df.columns,
        "_chunk",
        *[F.sum(f"_add_{name}").over(inside).alias(f"_run_{name}") for name in names],
    )
    same = F.col("_chunk") == F.col("_key_chunk")
    for key in keys:
        same = same & F.col(key).eqNullSafe(F.col(f"_key_{key}"))
    return local.join(offsets, same).select(
        *df.columns,
        *[(F.col(f"_base_{name}") + F.col(f"_run_{name}")).alias(name) for name in names],
    )
