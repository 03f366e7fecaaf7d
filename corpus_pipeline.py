"""Documents -> packed training sequences: toxic, duplicate and leaked documents go, secrets
are masked, what stays is packed. Every stage works on all rows that the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import decontam, packing, secrets, simhash, toxicity
from tidemark.llm.common import Scratch, read


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the threshold of the toxicity model; null texts stay."""
    return toxicity.without_toxic(docs, read(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by SimHash (3-word shingles, 2 bits): the smallest id."""
    return simhash.one_per_group(docs, Scratch(spark))


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontam.without_leaks(docs, read(spark, sf_dir, "benchmark"), Scratch(spark))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, every secret span replaced by a mark, n_chars counted anew."""
    masked = secrets.redact(docs)
    n_chars = F.coalesce(F.length("text"), F.lit(0)).cast(docs.schema["n_chars"].dataType)
    return masked.withColumn("n_chars", n_chars).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of at most 1024 ids."""
    return packing.packed(docs, Scratch(spark))


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_leaks),
    ("secrets", mask_secrets),
    ("packing", pack),
]

# No stage but the masking can be said in SQL; tests hold the rows against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each written as Parquet and read by the next."""
    scratch, docs, before = Scratch(spark), read(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        after = scratch.stage(stage(spark, docs, sf_dir), name)
        if before is not None:
            scratch.drop(before)
        docs = before = after
    return STAGES[-1][1](spark, docs, sf_dir)
