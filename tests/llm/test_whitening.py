"""Whitening against numpy's own eigenvectors."""

import numpy as np
import pytest

from tidemark.llm import whitening
from tidemark.llm.common import Scratch

SCHEMA = "vec_id long, embedding array<float>, component string, x int"


def table(spark, vectors, ids=None):
    ids = range(len(vectors)) if ids is None else ids
    rows = [(i, None if v is None else [None if c is None else float(c) for c in v], "own", 1) for i, v in zip(ids, vectors)]
    return spark.createDataFrame(rows, SCHEMA)


def run(spark, vectors, ids=None, components=8):
    return whitening.whitened(table(spark, vectors, ids), Scratch(spark), components).collect()


def plain(vectors, components):
    x = np.floor(1024 * np.array(vectors, dtype=np.float32).astype(float)) + 100000
    n, d = x.shape
    y = x - x.mean(axis=0)
    values, axes = np.linalg.eigh(y.T @ y / n)
    values, axes = values[::-1][:components], axes[:, ::-1][:, :components]
    deviation = ((n * x.astype(np.int64) - x.astype(np.int64).sum(axis=0)) ** 2).sum(axis=1)
    return y @ axes / np.sqrt(values), values / np.trace(y.T @ y / n), deviation


def same(rows, vectors, components=8):
    want, explained, deviation = plain(vectors, components)
    got = np.full(want.shape, np.nan)
    for r in rows:
        got[r["vec_id"], r["component"] - 1] = r["whitened"]
        assert r["n"] == len(vectors)
        assert r["deviation"] == deviation[r["vec_id"]]
        assert r["explained"] == pytest.approx(explained[r["component"] - 1], rel=1e-10)
        assert r["identity_error"] < 1e-9
    for k in range(components):
        sign = np.sign(got[:, k] @ want[:, k])
        assert np.abs(got[:, k] * sign - want[:, k]).max() < 1e-7


def test_equals_plain_eigenvectors(spark):
    random = np.random.default_rng(3)
    vectors = random.normal(size=(400, 40)) @ random.normal(size=(40, 40))
    same(run(spark, vectors), vectors)


def test_close_spectrum(spark):
    """Nearly round clouds: the leading values lie within a few per cent."""
    vectors = np.random.default_rng(4).normal(size=(600, 48))
    same(run(spark, vectors), vectors)


def test_hot_vector_and_repeated_ids(spark):
    random = np.random.default_rng(5)
    vectors = np.vstack([np.tile(random.normal(size=12), (200, 1)), random.normal(size=(300, 12))])
    rows = run(spark, vectors, ids=[7] * 500, components=3)
    want = plain(vectors, 3)[0]
    got = sorted(abs(r["whitened"]) for r in rows if r["component"] == 1)
    assert np.allclose(got, np.sort(np.abs(want[:, 0])), atol=1e-8)


def test_odd_rows_are_left_out(spark):
    random = np.random.default_rng(6)
    good = random.normal(size=(50, 6))
    odd = [None, [], [1.0] * 5, [None] * 6, [float("nan")] * 6, [float("inf"), *[0.0] * 5], [3e30] * 6]
    same(run(spark, [*good, *odd], components=4), good, 4)


def test_without_variance_there_is_no_component(spark):
    assert run(spark, []) == []
    assert run(spark, [[1.0, 2.0, 3.0]]) == []
    assert run(spark, [[1.0, 2.0, 3.0]] * 9) == []
    line = run(spark, [[float(i), 2.0 * i, 0.0] for i in range(20)])
    assert {r["component"] for r in line} == {1}
    assert all(r["explained"] == pytest.approx(1) for r in line)


def test_null_ids_and_columns(spark):
    rows = run(spark, np.random.default_rng(8).normal(size=(30, 4)), ids=[None] * 30, components=2)
    assert len(rows) == 60 and {r["vec_id"] for r in rows} == {None}
    assert set(rows[0].asDict()) == {
        "vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error", "eigenvalue"
    }


def test_wide_numbers_stay_exact(spark):
    """Sums beyond 64 bits; a deviation that no long holds is null."""
    vectors = np.random.default_rng(9).normal(size=(40, 5)).astype(np.float32) * np.float32(2.0**35)
    rows = run(spark, vectors, components=2)
    assert {r["deviation"] for r in rows} == {None}
    assert rows[0]["identity_error"] < 1e-9
    x = np.array([[int(np.floor(1024 * float(c))) + 100000 for c in v] for v in vectors], dtype=object)
    exact = [int(sum(v * v for v in row)) for row in len(x) * x - x.sum(axis=0)]
    assert min(exact) > whitening.LONG_MOST
    moments = whitening.Moments(len(x), tuple(x.sum(axis=0)))
    assert whitening.deviations(whitening.from_mean(x.astype(np.int64), moments)) == [None] * len(x)


def test_the_filter_damps_and_keeps(spark):
    """Degree 8 on a diagonal matrix: one at the top, small on the damped interval."""
    values = np.array([10.0, 6.0, 2.0, 1.0, 0.5])
    eye = np.eye(5)
    out = np.diag(whitening.chebyshev(lambda b: values[:, None] * b, eye, values[:, None] * eye, (0.0, 2.0), 10.0, 8))
    assert out[0] == pytest.approx(1)
    assert np.abs(out[2:]).max() < 1e-8 and abs(out[1]) > 1e4 * np.abs(out[2:]).max()
