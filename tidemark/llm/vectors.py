"""Vectors of whole numbers out of a column of floats, and how tasks and the driver share them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def finite(vector: Column, bound: float = float("inf")) -> Column:
    """Whether there is a vector without null, NaN or infinite entries, all within `bound`."""
    inside = F.forall(vector, lambda c: c.isNotNull() & (F.abs(c) < F.lit(bound)))
    return vector.isNotNull() & F.coalesce(inside, F.lit(False))


def scaled(
    vectors: DataFrame, id_column: str, vector: str, scale: int, shift: int = 0, bound: float = float("inf")
) -> DataFrame:
    """(id, x): floor(scale * entry) + shift of every finite vector; other columns are left."""
    entries = F.col(vector).cast("array<double>")
    whole = F.transform(entries, lambda c: F.floor(c * F.lit(float(scale))).cast("long") + F.lit(shift))
    return vectors.where(finite(entries, bound)).select(F.col(id_column).alias("id"), whole.alias("x"))


def commonest_size(rows: DataFrame) -> int:
    """The length that most vectors have, the larger of equals; 0 without vectors."""
    sizes = rows.groupBy(F.size("x").alias("size")).agg(F.count("*").alias("n"))
    first = sizes.orderBy(F.desc("n"), F.desc("size")).first()
    return first["size"] if first else 0


def arrays(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[pa.Array, np.ndarray]]:
    """Ids and their vectors as a matrix, batch by batch."""
    for batch in batches:
        if batch.num_rows:
            flat = batch["x"].flatten().to_numpy(zero_copy_only=False)
            yield batch["id"], flat.reshape(batch.num_rows, size)
