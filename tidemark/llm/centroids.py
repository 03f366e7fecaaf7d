"""Centroid clustering by an equal-average equal-variance nearest search, in whole numbers.

For vectors of k components, the squared distance of two is at least
(difference of sums)^2 / k + (difference of deviations)^2. Centroids are sorted by their sum,
that is by their mean; a vector looks outward from its own mean, a side ends where the first
term alone exceeds the best distance, a centroid is passed over where both terms do, and the
rest are measured exactly.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import Scratch, read
from tidemark.llm.vectors import arrays, scaled

SIZE, SCALE, CENTROIDS, ROUNDS, SEED = 64, 256, 40, 5, 2
# Entries of this size or more, scaled, have squared distances that no long holds.
LARGEST = 2.0**27 / SCALE
# Bounds are doubles and distances whole numbers: bounds reject only beyond their rounding.
SLACK, STEP = 1e-9, 0.5


def nearest(x: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Nearest centroid of every vector (the smaller number of equals), its squared distance,
    and how many distances were measured."""
    k = x.shape[1]
    sums, vector_sums = centroids.sum(axis=1), x.sum(axis=1)
    order = np.argsort(sums, kind="stable")

    def deviation(v: np.ndarray, total: np.ndarray) -> np.ndarray:
        return np.sqrt(((v - (total / k)[:, None]) ** 2).sum(axis=1))

    spread, vector_spread = deviation(centroids, sums)[order], deviation(x, vector_sums)
    means = sums[order].astype(np.float64)
    best = np.full(len(x), np.iinfo(np.int64).max)
    found = np.full(len(x), len(centroids))
    measured = 0

    def look(lines: np.ndarray, places: np.ndarray) -> np.ndarray:
        """Hold these vectors against the centroids at these places of the order; returns
        whether the side may go on, by the mean alone."""
        nonlocal measured
        most = best[lines].astype(np.float64) * (1 + SLACK) + STEP
        by_mean = (vector_sums[lines] - means[places]) ** 2 / k
        on = by_mean <= most
        close = on & (by_mean + (vector_spread[lines] - spread[places]) ** 2 <= most)
        near, number = lines[close], order[places[close]]
        measured += len(near)
        distance = ((x[near] - centroids[number]) ** 2).sum(axis=1)
        better = (distance < best[near]) | (distance == best[near]) & (number < found[near])
        best[near[better]], found[near[better]] = distance[better], number[better]
        return on

    up = np.searchsorted(means, vector_sums)
    down = up - 1
    above, below = np.arange(len(x)), np.arange(len(x))
    while len(above) or len(below):
        above = above[up[above] < len(order)]
        above = above[look(above, up[above])]
        up[above] += 1
        below = below[down[below] >= 0]
        below = below[look(below, down[below])]
        down[below] -= 1
    return found, best, measured


def first_centroids(rows: DataFrame, count: int, seed: int) -> np.ndarray:
    """The vectors with the smallest hash of seed and id, rows of null ids last."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
    first = rows.select(digest.alias("h"), "x").orderBy(F.asc_nulls_last("h"), "x").limit(count).collect()
    return np.array([r["x"] for r in first], dtype=np.int64)


def moved(rows: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """One round: every vector to its nearest centroid, every non-empty centroid to the
    componentwise floor of its vectors' mean. A task hands over one row per centroid and
    component, the driver sees as many."""
    count, size = centroids.shape

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = np.zeros(count, dtype=np.int64), np.zeros((count, size), dtype=np.int64)
        for _, x in arrays(batches, size):
            cluster, _, _ = nearest(x, centroids)
            n += np.bincount(cluster, minlength=count)
            np.add.at(total, cluster, x)
        if n.any():
            cell = np.arange(count * size, dtype=np.int32)
            columns = [cell // size, cell % size, np.repeat(n, size), total.ravel()]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["cluster", "dim", "n", "s"])

    parts = rows.mapInArrow(partial, "cluster int, dim int, n long, s long")
    total = F.sum(F.col("s").cast("decimal(38,0)")).alias("s")
    cells = parts.groupBy("cluster", "dim").agg(F.sum("n").alias("n"), total).where("n > 0").collect()
    out = centroids.copy()
    for cell in cells:
        out[cell["cluster"], cell["dim"]] = int(cell["s"]) // cell["n"]
    return out


def assigned(rows: DataFrame, centroids: np.ndarray) -> DataFrame:
    """(id, cluster, distance) of every vector."""
    schema = T.StructType(
        [rows.schema["id"], T.StructField("cluster", T.IntegerType()), T.StructField("distance", T.LongType())]
    )

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, x in arrays(batches, centroids.shape[1]):
            cluster, distance, _ = nearest(x, centroids)
            columns = [ids, pa.array(cluster.astype(np.int32)), pa.array(distance)]
            yield pa.RecordBatch.from_arrays(columns, schema.names)

    return rows.mapInArrow(assign, schema)


def sha256_of(centroid: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, centroid.tolist())).encode()).hexdigest()


def held(value: int) -> int | None:
    """The value where a long can hold it."""
    return value if value < 2**63 else None


def clustered(
    vectors: DataFrame,
    scratch: Scratch,
    count: int = CENTROIDS,
    rounds: int = ROUNDS,
    size: int = SIZE,
    seed: int = SEED,
    id_column: str = "vec_id",
    vector: str = "embedding",
) -> DataFrame:
    """id, cluster, distance, cluster_inertia, inertia and centroid_sha256 of every vector.

    Kept are vectors of exactly `size` entries, none null, non-finite or, scaled, of 2^27 or
    more. Fewer vectors than `count` give as many centroids; none give no rows. Rows may
    repeat: each is assigned on its own, and equal ones to the same cluster. Null ids hash
    last and stay null. Inertias beyond a long are null.
    """
    spark = vectors.sparkSession
    wide = F.size(vector) == size
    rows = scratch.stage(scaled(vectors.where(wide), id_column, vector, SCALE, bound=LARGEST), "scaled")
    centroids = first_centroids(rows, count, seed)
    if not len(centroids):
        centroids = np.zeros((1, size), dtype=np.int64)  # nothing is assigned to it
    else:
        for _ in range(rounds):
            centroids = moved(rows, centroids)
    found = scratch.stage(assigned(rows, centroids), "assigned")
    # One row per centroid, so `count` bounds what the driver sees and what is broadcast.
    per_cluster = found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()
    inertias = {r["cluster"]: int(r["s"]) for r in per_cluster}
    described = [
        (number, held(inertias[number]), held(sum(inertias.values())), sha256_of(centroids[number]))
        for number in sorted(inertias)
    ]
    per_cluster = spark.createDataFrame(
        described, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string"
    )
    return found.join(F.broadcast(per_cluster), "cluster").select(
        F.col("id").alias(id_column), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )


def op12_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All embeddings of 64 components in 40 clusters after five rounds."""
    return clustered(read(spark, sf_dir, "embeddings"), Scratch(spark))


def _round(number: int) -> str:
    """One round in SQL: distances to the centroids c{n}, the nearest, the centroids c{n+1}."""
    return f"""
    a{number} AS MATERIALIZED (
        SELECT row, k, dist FROM (
            SELECT v.row, c.k, sum((v.x - c.x) * (v.x - c.x)) AS dist
            FROM v JOIN c{number} c ON v.dim = c.dim GROUP BY v.row, c.k)
        QUALIFY row_number() OVER (PARTITION BY row ORDER BY dist, k) = 1),
    m{number} AS MATERIALIZED (
        SELECT a.k, v.dim, sum(v.x)::HUGEINT AS s, count(*)::HUGEINT AS n
        FROM a{number} a JOIN v ON a.row = v.row GROUP BY a.k, v.dim),
    c{number + 1} AS MATERIALIZED (
        SELECT c.k, c.dim, coalesce((m.s - ((m.s % m.n) + m.n) % m.n) // m.n, c.x)::BIGINT AS x
        FROM c{number} c LEFT JOIN m{number} m ON c.k = m.k AND c.dim = m.dim),"""


ORACLE = f"""
WITH kept AS MATERIALIZED (
        SELECT row_number() OVER (ORDER BY sha256('{SEED}:' || vec_id)) AS row, vec_id, embedding FROM embeddings
        WHERE len(embedding) = {SIZE} AND len(list_filter(embedding, lambda c: c IS NOT NULL AND isfinite(c))) = {SIZE}),
    v AS MATERIALIZED (
        SELECT row, i AS dim, floor({SCALE} * embedding[i]::DOUBLE)::BIGINT AS x
        FROM kept, range(1, {SIZE + 1}) r(i)),
    c0 AS MATERIALIZED (SELECT row - 1 AS k, dim, x FROM v WHERE row <= {CENTROIDS}),
    {"".join(map(_round, range(ROUNDS + 1)))}
    digests AS (
        SELECT k, sha256(string_agg(x::VARCHAR, ',' ORDER BY dim)) AS centroid_sha256 FROM c{ROUNDS} GROUP BY k)
SELECT vec_id, a.k::INTEGER AS cluster, dist::BIGINT AS distance,
       (sum(dist) OVER (PARTITION BY a.k))::BIGINT AS cluster_inertia, (sum(dist) OVER ())::BIGINT AS inertia,
       centroid_sha256
FROM a{ROUNDS} a JOIN kept USING (row) JOIN digests d ON a.k = d.k
"""
