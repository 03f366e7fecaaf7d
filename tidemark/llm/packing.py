"""Shortest-pack-first packing of token sequences over the histogram of their lengths."""

from __future__ import annotations

import base64
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import count
from math import isqrt

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import Scratch, read, text_or_empty

# The vocabulary of byte_bpe_50k.json as ranks; ids are the same, encoding is six times faster.
VOCABULARY = public_tokenizers.path("byte_bpe_50k.tiktoken")
# The same for texts that the fast encoder gives up on (very long runs of white space).
SAME_IDS = public_tokenizers.path("byte_bpe_50k.json")
END_TEXT, END_TEXT_ID, STOP_ID = "<|endoftext|>", 50256, 0


@lru_cache(maxsize=2)
def encoder(path: str):
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding(
        path, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={END_TEXT: END_TEXT_ID}
    )


@lru_cache(maxsize=2)
def slow_encoder(path: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def ids_of(text: str, vocabulary: str, same_ids: str) -> np.ndarray:
    try:
        return encoder(vocabulary).encode_to_numpy(text, allowed_special="all")
    except ValueError:
        return np.array(slow_encoder(same_ids).encode(text, add_special_tokens=False).ids, dtype=np.uint32)


def pieces(docs: DataFrame, limit: int, vocabulary: str = VOCABULARY, same_ids: str = SAME_IDS) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens, turn): every document's ids, then the
    stop id, cut every `limit` ids. Null texts are empty texts: one piece of the stop id.
    `turn` numbers the pieces of a task."""

    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "turn"]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turn = count()
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist()):
                ids = np.append(ids_of(text, vocabulary, same_ids), STOP_ID).astype("<u4")
                for at in range(0, len(ids), limit):
                    part = ids[at : at + limit]
                    rows.append((doc_id, at, len(part), zlib.crc32(part.tobytes()), len(ids), next(turn)))
            columns = [pa.array(c, pa.int64()) for c in zip(*rows)]
            if columns:
                yield pa.RecordBatch.from_arrays(columns, names)

    return docs.select(F.col("doc_id").cast("long"), text_or_empty().alias("text")).mapInArrow(
        cut, ", ".join(f"{name} long" for name in names)
    )


def pack(histogram: dict[int, int], limit: int) -> list[tuple[int, int, int, int, int]]:
    """Shortest-pack-first over length -> count; returns (length, first rank, end rank,
    first sequence, offset): these ranks of the length go to consecutive sequences.

    Lengths are placed longest first, each piece into the shortest pack so far that has
    room. Packs of one content are one pattern with a count, so the work depends on the
    number of different lengths only.
    """
    by_space: dict[int, list[tuple[int, tuple[int, ...]]]] = {}

    def add(count: int, pattern: tuple[int, ...]) -> None:
        if count:
            by_space.setdefault(limit - sum(pattern), []).append((count, pattern))

    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        for space in range(limit - 1, length - 1, -1):
            while left and by_space.get(space):
                count, pattern = by_space[space].pop()
                used = min(count, left)
                add(count - used, pattern)
                add(used, (*pattern, length))
                left -= used
        each = limit // length
        add(left // each, (length,) * each)
        add(1 if left % each else 0, (length,) * (left % each))
    slots, given, sequence = [], dict.fromkeys(histogram, 0), 0
    for count, pattern in (entry for space in sorted(by_space) for entry in by_space[space]):
        offset = 0
        for length in pattern:
            slots.append((length, given[length], given[length] + count, sequence, offset))
            given[length] += count
            offset += length
        sequence += count
    return slots


def packed(docs: DataFrame, scratch: Scratch, limit: int = 1024, vocabulary: str = VOCABULARY) -> DataFrame:
    """`pieces` with the sequence and offset that each gets.

    A piece's rank among those of its length is the count in the salts before its own plus
    its place in its salt, so a length that a third of all rows share is no single group:
    n pieces have some sqrt(n) salts, dealt by the pieces' turns in their tasks, so that
    repeated or null ids spread like others.
    The driver sees the histogram (at most `limit` rows), the tasks see the patterns
    (bounded by `limit` as well). Repeated rows are packed each on its own; an empty
    table gives no rows; only doc_id and text are read.
    """
    spark = docs.sparkSession
    cut = scratch.stage(pieces(docs, limit, vocabulary), "pieces")
    # As many salts as a salt of one length can have rows: neither side grows faster.
    salts = isqrt(cut.count()) + 1
    cut = cut.withColumn("salt", F.pmod("turn", F.lit(salts)))
    counts = scratch.stage(cut.groupBy("length", "salt").agg(F.count("*").alias("n")), "counts")
    histogram = {r.length: r.n for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    slots = spark.createDataFrame(
        pack(histogram, limit), "length long, rank_from long, rank_to long, first_sequence long, offset long"
    )
    up_to = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select("length", "salt", F.coalesce(F.sum("n").over(up_to), F.lit(0)).alias("before"))
    place = Window.partitionBy("length", "salt").orderBy("doc_id", "start", "ids_crc32", "doc_tokens", "turn")
    ranked = (
        cut.withColumn("place", F.row_number().over(place) - 1)
        .join(before, ["length", "salt"])
        .withColumn("rank", F.col("before") + F.col("place"))
    )
    at = F.broadcast(slots)
    found = ranked.join(
        at, (ranked["length"] == at["length"]) & F.col("rank").between(F.col("rank_from"), F.col("rank_to") - 1)
    )
    return found.select(
        "doc_id",
        "start",
        ranked["length"],
        "ids_crc32",
        "doc_tokens",
        (F.col("first_sequence") + F.col("rank") - F.col("rank_from")).alias("sequence_id"),
        "offset",
    )


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of at most 1024 ids."""
    return packed(read(spark, sf_dir, "documents"), Scratch(spark))
