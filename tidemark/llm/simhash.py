"""SimHash near-duplicates: fingerprints, pivot distance tables, components."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import Scratch, fresh, read
from tidemark.llm.components import connected

BITS = 64
SEED = 42
BLOCK = 1 << 16


def majority_bits(hashes: np.ndarray) -> int:
    """64-bit number whose bits are set in over half of the unsigned hashes; 0 for none."""
    counts = np.zeros(BITS, dtype=np.int64)
    for at in range(0, len(hashes), BLOCK):
        part = hashes[at : at + BLOCK].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view(np.int64)[0])


def fingerprint_of(text: str | None, words: int) -> int:
    """Signed 64-bit SimHash over word shingles; A-Z lower-cased, ASCII white space splits."""
    parts = (text or "").encode().lower().split()
    if len(parts) > words:
        shingles = map(b" ".join, zip(*(parts[i:] for i in range(words))))
        size = len(parts) - words + 1
    else:
        shingles, size = ([b" ".join(parts)], 1) if parts else ([], 0)
    digest = xxhash.xxh64_intdigest
    return majority_bits(np.fromiter((digest(s, SEED) for s in shingles), dtype="<u8", count=size))


def fingerprint(text: Column, words: int = 3) -> Column:
    @F.pandas_udf("long")
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint_of(t, words) for t in texts], dtype="int64")

    return run(text)


def _signed(mask: int) -> int:
    return mask - (1 << BITS) if mask >> (BITS - 1) else mask


def _masks(radius: int) -> list[int]:
    """Bits that stay when any `radius` of radius + 4 blocks are left out.

    Two fingerprints within the radius differ in at most that many blocks, so they agree
    on one of these masks: every link is found.
    """
    blocks = [sum(1 << int(b) for b in part) for part in np.array_split(np.arange(BITS), radius + 4)]
    full = (1 << BITS) - 1
    return [_signed(full ^ sum(gone)) for gone in combinations(blocks, radius)]


def links(fingerprints: DataFrame, radius: int = 2, pivots: int = 8) -> DataFrame:
    """(a, b), a < b: all pairs of the distinct numbers in `fp` within `radius` bits.

    Every fingerprint carries its row of the pivot distance table: its Hamming distances
    to `pivots` reference fingerprints. Pairs that agree on a mask are compared by the
    largest difference of these coordinates, which no true pair can have above the
    radius, and the survivors by their own distance. A pair comes out once, from the
    first mask it agrees on. Nulls are left out; an empty table gives no pair.
    """
    masks = _masks(radius)
    near = [f"d{i}" for i in range(pivots)]
    table = fingerprints.select("fp").filter("fp is not null").distinct()
    table = table.select(
        "fp",
        *(F.bit_count(F.col("fp").bitwiseXOR(F.xxhash64(F.lit(i)))).cast("byte").alias(d) for i, d in enumerate(near)),
        F.posexplode(F.array(*(F.col("fp").bitwiseAND(F.lit(m)) for m in masks))).alias("mask", "rest"),
    )
    a, b = table.alias("a"), table.alias("b")
    apart = F.greatest(*(F.abs(F.col(f"a.{d}").cast("int") - F.col(f"b.{d}")) for d in near))
    differ = F.col("a.fp").bitwiseXOR(F.col("b.fp"))
    first = F.coalesce(*(F.when(differ.bitwiseAND(F.lit(m)) == 0, F.lit(i)) for i, m in enumerate(masks)))
    tests = [
        F.col("a.mask") == F.col("b.mask"),
        F.col("a.rest") == F.col("b.rest"),
        F.col("a.fp") < F.col("b.fp"),
        apart <= radius,
        F.bit_count(differ) <= radius,
        first == F.col("a.mask"),
    ]
    pairs = a.join(b, reduce(lambda x, y: x & y, tests))
    return pairs.select(F.col("a.fp").alias("a"), F.col("b.fp").alias("b"))


def near_duplicates(
    docs: DataFrame, scratch: Scratch, words: int = 3, radius: int = 2, key: Sequence[str] = ("doc_id", "text")
) -> DataFrame:
    """(doc_id, k1, k2, fp, root, component_id), one row per row of `docs`.

    component_id is the smallest doc_id reachable over links of at most `radius` bits. A
    null or empty text has fingerprint zero and is linked like any other; repeated rows
    stay repeated; a null doc_id is kept and is never a component_id unless no member has
    an id. (k1, k2) names the row by its `key` columns, root the component by a fingerprint. Equal fingerprints are one node, so
    a group of copies of any size costs one row in the pair search.
    """
    prints = scratch.stage(
        docs.select(
            "doc_id",
            *row_key(*key),
            fingerprint(F.col("text"), words).alias("fp"),
        ),
        "fingerprints",
    )
    classes = scratch.stage(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "classes")
    found = connected(links(classes, radius), scratch)
    roots = classes.join(found, F.col("fp") == F.col("node"), "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    least = roots.groupBy("root").agg(F.min("least").alias("component_id"))
    member = roots.join(least, "root")
    return prints.join(member, "fp").select("doc_id", "k1", "k2", "fp", "root", "component_id")


def row_key(*columns: str) -> list[Column]:
    """Two hashes of the columns (by default id and text) that together name a row."""
    named = [F.col(f"`{c}`") for c in columns or ("doc_id", "text")]
    return [F.xxhash64(*named).alias("k1"), F.hash(*reversed(named)).alias("k2")]


def one_per_group(docs: DataFrame, scratch: Scratch, words: int = 3, radius: int = 2) -> DataFrame:
    """One row of `docs` per component: of its smallest doc_id; of rows that repeat that id,
    the one with the smallest row key over all columns (maps, which have no hash, aside).
    Same columns as `docs`."""
    key = [f.name for f in docs.schema.fields if not f.dataType.typeName().startswith("map")]
    k1, k2 = fresh("k1"), fresh("k2")
    member = near_duplicates(docs, scratch, words, radius, key)
    kept = member.groupBy("root").agg(
        F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "k1", "k2")).alias("first")
    )
    kept = kept.select(F.col("first.k1").alias(k1), F.col("first.k2").alias(k2))
    keyed = docs.select("*", *(c.alias(n) for c, n in zip(row_key(*key), (k1, k2))))
    return keyed.join(kept, [k1, k2], "left_semi").dropDuplicates([k1, k2]).select(*docs.columns)


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash components of all documents: 3-word shingles, at most 2 differing bits."""
    docs = read(spark, sf_dir, "documents")
    return near_duplicates(docs, Scratch(spark)).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )
