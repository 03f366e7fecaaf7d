"""Whitening of embeddings: Chebyshev-filtered subspace iteration over the covariance.

The covariance is never formed. A pass over the table multiplies it with a thin block:
every task centres its vectors, adds up their products with the block and hands over one
row per dimension. A polynomial of such passes damps the unwanted part of the spectrum, the
block is made orthonormal again, and Rayleigh-Ritz pairs are taken from it until their
residuals are as small as rounding allows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from decimal import Decimal
from math import ceil, log, sqrt
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import Scratch, read
from tidemark.llm.vectors import arrays, commonest_size, scaled

SCALE, SHIFT = 1024, 100_000
# Entries of this size or more (in units of 1 / SCALE) have no exact place in a double.
LARGEST = 2.0**53 / SCALE
# The block has so many columns per component wanted.
WIDTH = 3
MOST_DEGREE, MOST_ROUNDS = 16, 60
# Residuals, relative to the largest eigenvalue: what is aimed at, and what must be reached
# where rounding in the passes allows no better.
AIM, MUST = 1e-14, 1e-11
# Directions of less variance than this, relative to the largest, are no components.
FLAT = 1e-12
LONG_MOST = 2**63 - 1


class Moments(NamedTuple):
    """Number of vectors and their exact sums per dimension."""

    n: int
    sums: tuple[int, ...]


class Fit(NamedTuple):
    moments: Moments
    trace: float
    values: np.ndarray
    vectors: np.ndarray
    identity_error: float


def moments_of(rows: DataFrame, size: int) -> Moments:
    """Exact sums; a task hands over one row per dimension."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = 0, [0] * size
        for _, x in arrays(batches, size):
            n += len(x)
            narrow = np.abs(x).max() < 2**62 // len(x)
            part = x.sum(axis=0) if narrow else x.astype(object).sum(axis=0)
            sums = [a + int(b) for a, b in zip(sums, part)]
        if n:
            columns = [pa.array(range(size), pa.int32()), pa.array([n] * size), pa.array([str(s) for s in sums])]
            yield pa.RecordBatch.from_arrays(columns, ["dim", "n", "s"])

    parts = rows.mapInArrow(partial, "dim int, n long, s string")
    total = F.sum(F.col("s").cast("decimal(38,0)")).alias("s")
    found = sorted(parts.groupBy("dim").agg(F.sum("n").alias("n"), total).collect())
    return Moments(found[0]["n"], tuple(int(Decimal(r["s"])) for r in found))


def from_mean(x: np.ndarray, moments: Moments) -> np.ndarray:
    """n * x - sums, exact; as Python integers where 64 bits could overflow."""
    n, sums = moments
    if n * max(int(np.abs(x).max()), 1) + max(map(abs, sums)) < 2**62:
        return n * x - np.array(sums, dtype=np.int64)
    return n * x.astype(object) - np.array(sums, dtype=object)


def centred(x: np.ndarray, moments: Moments) -> np.ndarray:
    return from_mean(x, moments).astype(np.float64) / moments.n


def deviations(from_means: np.ndarray) -> list[int | None]:
    """Exact sums of squares; null where a long cannot hold one."""
    about = (from_means.astype(np.float64) ** 2).sum(axis=1)
    if about.max() < LONG_MOST / 2:
        whole = from_means.astype(np.int64)
        return (whole * whole).sum(axis=1).tolist()
    exact = (sum(int(v) ** 2 for v in row) for row in from_means)
    return [v if v <= LONG_MOST else None for v in exact]


def summed(rows: DataFrame, of: Callable[[np.ndarray], np.ndarray], size: int, shape: tuple[int, int]) -> np.ndarray:
    """The sum of `of(vectors)`, a matrix of this shape, over all batches of the table."""
    names = [f"c{i}" for i in range(shape[1])]

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for _, x in arrays(batches, size):
            total = of(x) if total is None else total + of(x)
        if total is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(shape[0]), pa.int32()), *map(pa.array, total.T)], ["line", *names]
            )

    parts = rows.mapInArrow(partial, "line int, " + ", ".join(f"{name} double" for name in names))
    lines = parts.groupBy("line").agg(*[F.sum(name).alias(name) for name in names]).collect()
    return np.array([tuple(line)[1:] for line in sorted(lines)]).reshape(shape)


def chebyshev(
    apply: Callable[[np.ndarray], np.ndarray],
    block: np.ndarray,
    image: np.ndarray,
    damped: tuple[float, float],
    top: float,
    degree: int,
) -> np.ndarray:
    """The Chebyshev polynomial of a matrix, times `block`: at most 1 / its growth on the
    `damped` interval, 1 at `top`. `image` is the matrix times `block`, so that the
    recurrence needs degree - 1 further products."""
    half, middle = (damped[1] - damped[0]) / 2, (damped[1] + damped[0]) / 2
    first = scale = half / (top - middle)
    before, now = block, (image - middle * block) * (scale / half)
    for _ in range(degree - 1):
        following = 1 / (2 / first - scale)
        step = (apply(now) - middle * now) * (2 * following / half) - (scale * following) * before
        before, now, scale = now, step, following
    return now


def leading(apply: Callable[[np.ndarray], np.ndarray], size: int, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """The `wanted` largest eigenvalues, falling, and their eigenvectors of a symmetric matrix
    without negative eigenvalues, of which only products with blocks are asked.

    The start is random (a fixed seed) and WIDTH times as wide as what is wanted, so that no
    leading direction is absent from it. One more column follows the other end of the
    spectrum: the narrower the damped interval, the fewer products. A pair is certified when
    its residual is at most AIM times the largest eigenvalue, or when it has stopped falling
    below MUST; an eigenvalue is then off by no more, a vector by that over its gap.
    """
    random = np.random.default_rng(11)
    wanted = min(wanted, size)
    width = min(size, WIDTH * wanted)
    block = np.linalg.qr(random.normal(size=(size, width)))[0]
    low = random.normal(size=size)
    floor, top, last = 0.0, 0.0, np.inf

    def both(now: np.ndarray) -> np.ndarray:
        """A product with the block; the low column moves on with the same pass."""
        nonlocal low, floor
        low = low / np.linalg.norm(low)
        images = apply(np.column_stack([now, low]))
        image, image_low = images[:, :-1], images[:, -1]
        quotient = low @ image_low
        floor = max(0.0, quotient - np.linalg.norm(image_low - quotient * low))
        moved = top * low - image_low
        low = moved if np.linalg.norm(moved) > 1e-6 * top else random.normal(size=size)
        return image

    for _ in range(MOST_ROUNDS):
        image = both(block)
        projected = block.T @ image
        values, turn = np.linalg.eigh((projected + projected.T) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        block, image, top = block @ turn, image @ turn, max(values[0], 0.0)
        if top == 0:
            return values[:0], block[:, :0]
        off = np.linalg.norm(image - block * values, axis=0)[:wanted].max() / top
        if off <= AIM or off <= MUST and off > last / 2:
            return values[:wanted], block[:, :wanted]
        last = off
        high = max(values[-1], 0.0)
        damped = min(floor, high - 1e-6 * top), high
        outside = max(2 * (values[wanted - 1] - damped[0]) / (high - damped[0]) - 1, 1 + 1e-9)
        growth = log(outside + sqrt(outside**2 - 1))
        degree = min(max(ceil(log(off / AIM) / growth), 4), MOST_DEGREE)
        block = np.linalg.qr(chebyshev(both, block, image, damped, top, degree))[0]
    raise ArithmeticError(f"residual {off:.1e} after {MOST_ROUNDS} rounds")


def fit(rows: DataFrame, size: int, components: int) -> Fit:
    """Moments, leading components of the covariance and how white they make the table."""
    moments = moments_of(rows, size)
    n = moments.n

    def squares(x: np.ndarray) -> np.ndarray:
        return (centred(x, moments) ** 2).sum(axis=0)[:, None]

    trace = float(summed(rows, squares, size, (size, 1)).sum() / n)

    def product(block: np.ndarray) -> np.ndarray:
        def of(x: np.ndarray) -> np.ndarray:
            y = centred(x, moments)
            return y.T @ (y @ block)

        return summed(rows, of, size, block.shape) / n

    values, vectors = leading(product, size, components)
    steep = values > FLAT * trace
    values, vectors = values[steep], vectors[:, steep]
    if not len(values):
        return Fit(moments, trace, values, vectors, 0.0)
    axes = vectors / np.sqrt(values)
    k = len(values)

    def spread(x: np.ndarray) -> np.ndarray:
        w = centred(x, moments) @ axes
        return np.vstack([w.T @ w, w.sum(axis=0)])

    total = summed(rows, spread, size, (k + 1, k)) / n
    covariance = total[:k] - np.outer(total[k], total[k])
    return Fit(moments, trace, values, vectors, float(np.abs(covariance - np.eye(k)).max()))


def whitened(
    vectors: DataFrame, scratch: Scratch, components: int = 8, id_column: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """One row per vector and component: id, component, n, deviation, whitened, explained,
    identity_error, and the component's eigenvalue.

    Vectors that are null or hold null or non-finite entries are left out, as are entries of
    2^43 or more, which have no exact scaled value, and vectors of another length than most
    have (the larger length of equals). Ids may repeat or be null: every row is its own.
    Directions without variance are no components, so an empty table, a single vector or
    equal vectors give no rows. `deviation` is null where a long cannot hold it. The driver
    holds blocks of dimensions times components; vectors stay in tasks.
    """
    id_type = vectors.schema[id_column].dataType
    names = ["component", "n", "deviation", "whitened", "explained", "identity_error", "eigenvalue"]
    types = [T.IntegerType(), T.LongType(), T.LongType(), *[T.DoubleType()] * 4]
    schema = T.StructType([T.StructField(n, t) for n, t in zip([id_column, *names], [id_type, *types])])
    rows = scratch.stage(scaled(vectors, id_column, vector, SCALE, SHIFT, LARGEST), "scaled")
    size = commonest_size(rows)
    nothing = vectors.sparkSession.createDataFrame([], schema)
    if not size:
        return nothing
    rows = rows.where(F.size("x") == size)
    fitted = fit(rows, size, components)
    k = len(fitted.values)
    if not k:
        return nothing
    axes, share = fitted.vectors / np.sqrt(fitted.values), fitted.values / fitted.trace

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, x in arrays(batches, size):
            exact = from_mean(x, fitted.moments)
            n = len(x)
            lines = np.repeat(np.arange(n), k)
            columns = [
                ids.take(pa.array(lines)),
                pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), n)),
                pa.array(np.full(n * k, fitted.moments.n)),
                pa.array(deviations(exact), pa.int64()).take(pa.array(lines)),
                pa.array((exact.astype(np.float64) / fitted.moments.n @ axes).ravel()),
                pa.array(np.tile(share, n)),
                pa.array(np.full(n * k, fitted.identity_error)),
                pa.array(np.tile(fitted.values, n)),
            ]
            yield pa.RecordBatch.from_arrays(columns, schema.names)

    return rows.mapInArrow(project, schema)


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All embeddings on their eight leading components."""
    return whitened(read(spark, sf_dir, "embeddings"), Scratch(spark))
