"""Clustering against plain loops and the SQL; the search against all distances."""

import hashlib

import duckdb
import numpy as np

from check import rows_of
from tidemark.llm import centroids
from tidemark.llm.common import Scratch

FOLDER = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<float>, cluster string, x int"


def run(spark, vectors, ids=None, **how):
    ids = range(len(vectors)) if ids is None else ids
    rows = [(i, None if v is None else [None if c is None else float(c) for c in v], "own", 1) for i, v in zip(ids, vectors)]
    return centroids.clustered(spark.createDataFrame(rows, SCHEMA), Scratch(spark), **how)


def plain(vectors, ids, count, rounds):
    x = [[int(np.floor(256 * float(np.float32(c)))) for c in v] for v in vectors]
    order = sorted(range(len(x)), key=lambda i: (hashlib.sha256(f"2:{ids[i]}".encode()).hexdigest(), x[i]))
    middle = [list(x[i]) for i in order[:count]]

    def near(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), k) for k, c in enumerate(middle))

    for _ in range(rounds):
        found = [near(v)[1] for v in x]
        for k in range(len(middle)):
            own = [v for v, f in zip(x, found) if f == k]
            if own:
                middle[k] = [sum(c) // len(own) for c in zip(*own)]
    found = [near(v) for v in x]
    out = []
    for i, (distance, k) in zip(ids, found):
        own = sum(d for d, f in found if f == k)
        digest = hashlib.sha256(",".join(map(str, middle[k])).encode()).hexdigest()
        out.append((i, k, distance, own, sum(d for d, _ in found), digest))
    return out


def test_equals_plain_loops(spark):
    random = np.random.default_rng(1)
    vectors = random.normal(size=(150, 6)) * 0.2
    got = run(spark, vectors, count=7, rounds=3, size=6)
    assert sorted(map(tuple, got.collect())) == sorted(plain(vectors, range(150), 7, 3))


def test_hot_vector_ties_and_repeated_ids(spark):
    """A third of all rows is one vector, centroids start equal, ids repeat."""
    random = np.random.default_rng(2)
    vectors = np.round(random.normal(size=(90, 4)) * 2) / 256
    vectors[:30] = vectors[0]
    ids = [i // 2 for i in range(90)]
    got = run(spark, vectors, ids, count=9, rounds=4, size=4)
    assert sorted(map(tuple, got.collect())) == sorted(plain(vectors, ids, 9, 4))


def test_odd_rows_are_left_out(spark):
    good = np.random.default_rng(3).normal(size=(20, 4))
    odd = [None, [], [1.0] * 5, [None] * 4, [float("nan")] * 4, [float("-inf")] * 4, [1e30] * 4]
    got = run(spark, [*good, *odd], count=3, rounds=2, size=4)
    assert sorted(map(tuple, got.collect())) == sorted(plain(good, range(20), 3, 2))


def test_few_none_and_null_ids(spark):
    assert run(spark, [], size=4).collect() == []
    assert run(spark, [None, [1.0]], size=4).collect() == []
    few = run(spark, [[1.0] * 4, [2.0] * 4], count=40, size=4).collect()
    assert sorted(r["cluster"] for r in few) == [0, 1] and {r["inertia"] for r in few} == {0}
    null = run(spark, [[1.0] * 4, [2.0] * 4], ids=[None, None], count=1, size=4).collect()
    assert {r["vec_id"] for r in null} == {None} and len(null) == 2


def test_search_equals_all_distances():
    """Every bound is checked against the full table of distances, equal ones included."""
    for seed in range(30):
        random = np.random.default_rng(seed)
        wide = 10 ** (seed % 9)
        size, count = int(random.integers(1, 70)), int(random.integers(1, 45))
        x = random.integers(-3 * wide, 3 * wide + 1, size=(200, size))
        middle = np.vstack([random.integers(-3 * wide, 3 * wide + 1, size=(count, size)), x[:5]])
        middle = np.clip(middle, -(2**26), 2**26)
        x = np.clip(x, -(2**26), 2**26)
        every = ((x[:, None, :] - middle[None]) ** 2).sum(axis=2)
        found, best, _ = centroids.nearest(x, middle)
        assert (found == every.argmin(axis=1)).all() and (best == every.min(axis=1)).all()


def test_search_rejects_by_its_bounds():
    """Vectors of different means: most centroids are never measured."""
    random = np.random.default_rng(5)
    levels = random.integers(-5000, 5000, size=(300, 1))
    x = levels + random.integers(-20, 20, size=(300, 16))
    middle = np.linspace(-5000, 5000, 40).astype(np.int64)[:, None] + random.integers(-20, 20, size=(40, 16))
    found, best, measured = centroids.nearest(x, middle)
    assert measured < 300 * 5
    assert (found == ((x[:, None] - middle[None]) ** 2).sum(axis=2).argmin(axis=1)).all()


def test_query_equals_its_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{FOLDER}/embeddings.parquet'")
    cursor = con.execute(centroids.ORACLE)
    names = [d[0] for d in cursor.description]
    got = centroids.op12_centroids(spark, FOLDER)
    assert rows_of(got.columns, got.collect()) == rows_of(names, cursor.fetchall())
