"""Long repeated substrings: anchors, an enhanced suffix array, its common-prefix intervals.

Any window of `size` bytes is named by its anchor, the position in it of the k-gram with
the least hash. Equal windows have equal anchors, so they meet under the anchor's hash,
and all windows of one anchor form a context of fewer than 2 * `size` bytes. Contexts that
are equal as a whole are repeats as they stand; what differs is compared byte by byte in a
suffix array of the contexts that share an anchor.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import Scratch, read, text_or_empty
from tidemark.llm.simhash import row_key

GRAM = 64
SEGMENT = 1 << 20
CHUNK_CONTEXTS = 6_000
MOST_CONTEXTS = 30_000
BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
POSITION_BITS = 23


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return h ^ (h >> np.uint64(33))


@lru_cache(maxsize=1)
def byte_values() -> np.ndarray:
    return mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(BASES[0]))


@lru_cache(maxsize=4)
def powers(base: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """base^i and its inverse modulo 2^64, i < size."""
    out = []
    for b in (base, pow(base, -1, 1 << 64)):
        row = np.full(size, b, dtype=np.uint64)
        row[0] = 1
        out.append(np.multiply.accumulate(row))
    return out[0], out[1]


class RollingHash:
    """Hashes of any parts of a byte string, each in constant time."""

    def __init__(self, data: np.ndarray, base: int) -> None:
        size = 1 << max(len(data), 2).bit_length()
        up, self.down = powers(base, size)
        self.sums = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum(byte_values()[data] * up[: len(data)], out=self.sums[1:])

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mixed((self.sums[end] - self.sums[start]) * self.down[start])


def least_in_windows(keys: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every `width` consecutive keys, from running minima of blocks both ways."""
    blocks = -(-len(keys) // width)
    padded = np.full(blocks * width, np.iinfo(np.uint64).max, dtype=np.uint64)
    padded[: len(keys)] = keys
    grid = padded.reshape(blocks, width)
    forth = np.minimum.accumulate(grid, axis=1).ravel()
    back = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    count = len(keys) - width + 1
    return np.minimum(back[:count], forth[width - 1 : width - 1 + count])


def contexts_of(data: np.ndarray, ends: np.ndarray, size: int, gram: int) -> tuple[np.ndarray, ...]:
    """Contexts of all windows of a buffer of texts: start, length, anchor hash, own hash.

    `ends` are the texts' ends; no window spans two texts. Of equal k-grams in a window the
    leftmost is the anchor, so a window's anchor depends on its content alone.
    """
    none = np.empty(0, dtype=np.int64)
    count = len(data) - size + 1
    if count <= 0:
        return none, none, none.view(np.uint64), none.view(np.uint64)
    first = RollingHash(data, BASES[0])
    at = np.arange(len(data) - gram + 1)
    grams = first(at, at + gram)
    low = np.uint64((1 << POSITION_BITS) - 1)
    least = least_in_windows((grams & ~low) | at.astype(np.uint64), size - gram + 1)
    anchor = (least & low).astype(np.int64)
    starts = np.arange(count)
    inside = ends[np.searchsorted(ends, starts, side="right").clip(max=len(ends) - 1)] >= starts + size
    starts, anchor = starts[inside], anchor[inside]
    new = np.ones(len(starts), dtype=bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (starts[1:] != starts[:-1] + 1)
    heads = np.flatnonzero(new)
    if not len(heads):
        return none, none, none.view(np.uint64), none.view(np.uint64)
    begin, anchor = starts[heads], anchor[heads]
    last = starts[np.append(heads[1:], len(starts)) - 1]
    length = last + size - begin
    second = RollingHash(data, BASES[1])
    own = mixed(second(begin, begin + length) + (length * (2 * size) + anchor - begin).astype(np.uint64))
    return begin, length, grams[anchor], own


def _segments(texts: list[bytes], size: int) -> Iterator[list[tuple[int, int, bytes]]]:
    """(text number, offset, bytes), grouped to about SEGMENT bytes; a longer text comes in
    parts that overlap by one byte less than a window, so every window is in one part."""
    group, held = [], 0
    for i, text in enumerate(texts):
        for at in range(0, max(len(text) - size + 1, 0), SEGMENT):
            part = text[at : at + SEGMENT + size - 1]
            group.append((i, at, part))
            held += len(part)
            if held >= SEGMENT:
                yield group
                group, held = [], 0
    if group:
        yield group


def _anchors(batches: Iterator[pa.RecordBatch], size: int, gram: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        k1, k2, texts = (c.to_pylist() for c in batch.columns)
        k1, k2 = np.array(k1, dtype=np.int64), np.array(k2, dtype=np.int32)
        for group in _segments([t.encode() for t in texts], size):
            data = np.frombuffer(b"".join(part for *_, part in group), dtype=np.uint8)
            ends = np.cumsum([len(part) for *_, part in group])
            begin, length, anchor, own = contexts_of(data, ends, size, gram)
            which = np.searchsorted(ends, begin, side="right")
            owner = np.array([i for i, *_ in group])[which]
            shift = np.array([at for _, at, _ in group]) - (ends - np.diff(ends, prepend=0))
            columns = [k1[owner], k2[owner], begin + shift[which], length.astype(np.int32), anchor.view(np.int64), own.view(np.int64)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["k1", "k2", "begin", "length", "anchor", "own"])


ANCHORS = "k1 long, k2 int, begin long, length int, anchor long, own long"


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The wanted contexts' bytes out of the texts, a batch of at most some megabytes each."""
    schema = pa.schema([("anchor", pa.int64()), ("own", pa.int64()), ("data", pa.binary())])
    for batch in batches:
        rows, held = [], 0
        for text, wanted in zip(batch["text"].to_pylist(), batch["wanted"].to_pylist()):
            data = text.encode()
            for w in wanted:
                rows.append({"anchor": w["anchor"], "own": w["own"], "data": data[w["begin"] : w["begin"] + w["length"]]})
                held += w["length"]
            if held > SEGMENT:
                yield pa.RecordBatch.from_pylist(rows, schema)
                rows, held = [], 0
        yield pa.RecordBatch.from_pylist(rows, schema)


def window_hashes(contexts: list[bytes], size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, context number, offset) of every window of every context."""
    hashes, owners, offsets = [], [], []
    for at in range(0, len(contexts), 1000):
        part = contexts[at : at + 1000]
        lengths = np.array([len(c) for c in part])
        ends = np.cumsum(lengths)
        rolling = RollingHash(np.frombuffer(b"".join(part), dtype=np.uint8), BASES[0])
        counts = np.maximum(lengths - size + 1, 0)
        owner = np.repeat(np.arange(len(part)), counts)
        offset = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        start = (ends - lengths)[owner] + offset
        hashes.append(rolling(start, start + size))
        owners.append(owner + at)
        offsets.append(offset)
    return np.concatenate(hashes), np.concatenate(owners), np.concatenate(offsets)


def common_prefix(a: bytes, b: bytes) -> int:
    size = min(len(a), len(b))
    if a[:size] == b[:size]:
        return size
    x, y = np.frombuffer(a, np.uint8, size), np.frombuffer(b, np.uint8, size)
    return int(np.argmax(x != y))


def maximal_repeats(contexts: list[bytes], size: int) -> list[tuple[int, list[tuple[int, int]]]]:
    """(length, occurrences as (context, offset)): the maximal repeats of at least `size`.

    Suffixes that start with a repeated window and whose occurrences differ in the byte
    before it are sorted; a stack over the common prefixes of neighbours gives the tree of
    common-prefix intervals, from the deepest up. An interval whose suffixes have different
    bytes before them can be extended neither way: it is a maximal repeat with all its
    occurrences. Where a context begins, the byte before counts as different from any.
    """
    if not contexts:
        return []
    hashes, owners, offsets = window_hashes(contexts, size)
    order = np.argsort(hashes, kind="stable")
    hashes, owners, offsets = hashes[order], owners[order], offsets[order]
    before = np.array([contexts[i][o - 1] if o else -1 - i for i, o in zip(owners.tolist(), offsets.tolist())], dtype=np.int64)
    heads = np.flatnonzero(np.append(True, hashes[1:] != hashes[:-1])) if len(hashes) else np.empty(0, int)
    if not len(heads):
        return []
    differs = np.minimum.reduceat(before, heads) != np.maximum.reduceat(before, heads)
    sizes = np.diff(np.append(heads, len(hashes)))
    keep = np.repeat(differs & (sizes > 1), sizes)
    suffixes = sorted((contexts[i][o:], i, o, b) for i, o, b in zip(owners[keep].tolist(), offsets[keep].tolist(), before[keep].tolist()))
    found, stack = [], []  # stack: [common prefix, first suffix, byte before or None if they differ]
    for at in range(1, len(suffixes) + 1):
        shared = common_prefix(suffixes[at - 1][0], suffixes[at][0]) if at < len(suffixes) else 0
        first, left = at - 1, suffixes[at - 1][3]
        while stack and stack[-1][0] > shared:
            length, first, known = stack.pop()
            left = left if left == known else None
            if length >= size and left is None:
                found.append((length, [s[1:3] for s in suffixes[first:at]]))
        if stack and stack[-1][0] == shared:
            stack[-1][2] = left if left == stack[-1][2] else None
        elif shared:
            stack.append([shared, first, left])
    return found


def longest_cover(contexts: list[bytes], size: int) -> list[list[tuple[int, int]]]:
    """Per context the merged parts that its maximal repeats cover."""
    spans: list[list[tuple[int, int]]] = [[] for _ in contexts]
    seen = set()
    for length, occurrences in maximal_repeats(contexts, size):
        for place in occurrences:
            if place not in seen:  # deeper intervals come first and are longer
                seen.add(place)
                spans[place[0]].append((place[1], place[1] + length))
    return [merged(s) for s in spans]


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


SPANS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))


def _compare(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """Contexts sorted by anchor -> their covered parts; some whole groups at a time."""
    rows: list[tuple[int, int, bytes]] = []

    def flush(part: list) -> pa.RecordBatch:
        covers = longest_cover([data for *_, data in part], size)
        hit = [(a, o, [{"start": s, "end": e} for s, e in c]) for (a, o, _), c in zip(part, covers) if c]
        anchor, own, spans = ([r[i] for r in hit] for i in range(3))
        return pa.RecordBatch.from_arrays([pa.array(anchor, pa.int64()), pa.array(own, pa.int64()), pa.array(spans, SPANS)], ["anchor", "own", "spans"])

    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            if len(rows) >= CHUNK_CONTEXTS and row[0] != rows[-1][0]:
                yield flush(rows)
                rows = []
            rows.append(row)
    if rows:
        yield flush(rows)


def _windows(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """Digest per window, for anchors with more contexts than one task should hold."""
    for batch in batches:
        for anchor, own, data in zip(*(c.to_pylist() for c in batch.columns)):
            digests = [hashlib.blake2b(data[i : i + size], digest_size=16).digest() for i in range(len(data) - size + 1)]
            columns = [pa.array([anchor] * len(digests), pa.int64()), pa.array([own] * len(digests), pa.int64()), pa.array(range(len(digests)), pa.int32()), pa.array(digests, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["anchor", "own", "at", "digest"])


def repeated_spans(docs: DataFrame, scratch: Scratch, size: int = 400, gram: int = GRAM, most: int = MOST_CONTEXTS) -> DataFrame:
    """(k1, k2, spans): per distinct (doc_id, text) the byte ranges covered by a string of
    `size` bytes that starts anywhere else too. Rows without any are left out.

    Copies collapse before any byte is compared: equal contexts are counted under their
    hashes. Contexts that share an anchor go through the suffix array together, at most
    `most` of them; above that, the windows of such an anchor are counted one by one over
    all tasks, which needs no group in memory. A null text is empty; repeated rows are
    copies of each other; an empty table gives no rows.
    """
    keyed = docs.select(*row_key(), text_or_empty().alias("text")).filter(F.octet_length("text") >= size)
    found = scratch.stage(keyed.mapInArrow(lambda b: _anchors(b, size, gram), ANCHORS), "anchors")
    contexts = found.groupBy("anchor", "own").agg(
        F.count("*").alias("n"), F.min(F.struct("k1", "k2", "begin", "length")).alias("place")
    )
    contexts = scratch.stage(contexts, "contexts")
    groups = contexts.groupBy("anchor").agg(F.count("*").alias("kinds"))
    unlike = contexts.join(groups.filter("kinds > 1"), "anchor")
    wanted = unlike.groupBy("place.k1", "place.k2").agg(
        F.collect_list(F.struct("anchor", "own", "place.begin", "place.length", "kinds")).alias("wanted")
    )
    whole = contexts.filter("n > 1").select(
        "anchor", "own", F.array(F.struct(F.lit(0).alias("start"), F.col("place.length").alias("end"))).alias("spans")
    )
    data = "anchor long, own long, data binary"
    spans = "anchor long, own long, spans array<struct<start:int,end:int>>"
    pick = lambda test: F.filter("wanted", test)
    texts = keyed.join(wanted, ["k1", "k2"])
    few = texts.select("text", pick(lambda w: w["kinds"] <= most).alias("wanted")).filter("size(wanted) > 0")
    compared = (
        few.mapInArrow(_cut, data)
        .repartition("anchor")
        .sortWithinPartitions("anchor", "own")
        .mapInArrow(lambda b: _compare(b, size), spans)
    )
    covered = scratch.stage(compared, "compared").union(whole)
    if groups.filter(F.col("kinds") > most).limit(1).count():
        many = texts.select("text", pick(lambda w: w["kinds"] > most).alias("wanted")).filter("size(wanted) > 0")
        windows = many.mapInArrow(_cut, data).dropDuplicates(["anchor", "own"])
        windows = windows.mapInArrow(lambda b: _windows(b, size), "anchor long, own long, at int, digest binary")
        windows = scratch.stage(windows, "windows")
        again = windows.groupBy("digest").agg(F.count("*").alias("n")).filter("n > 1")
        part = F.struct(F.col("at").alias("start"), (F.col("at") + size).alias("end"))
        covered = covered.union(
            windows.join(again, "digest").groupBy("anchor", "own").agg(F.collect_list(part).alias("spans"))
        )
    at = lambda s: F.struct((F.col("begin") + s["start"]).alias("start"), (F.col("begin") + s["end"]).alias("end"))
    moved = found.join(covered, ["anchor", "own"]).select("k1", "k2", F.explode(F.transform("spans", at)).alias("s"))
    return moved.groupBy("k1", "k2").agg(F.collect_set("s").alias("spans"))


def _removed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    for batch in batches:
        rows = []
        for doc_id, text, spans in zip(*(c.to_pylist() for c in batch.columns)):
            data, kept, at, gone = text.encode(), hashlib.sha256(), 0, merged([(s["start"], s["end"]) for s in spans or ()])
            for start, end in gone:
                kept.update(data[at:start])
                at = end
            kept.update(data[at:])
            rows.append((doc_id, len(data), sum(e - s for s, e in gone), len(gone), kept.hexdigest()))
        types = [pa.int64()] * 4 + [pa.string()]
        columns = list(zip(*rows)) or [()] * 5
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)


def removed(docs: DataFrame, scratch: Scratch, size: int = 400, gram: int = GRAM, most: int = MOST_CONTEXTS) -> DataFrame:
    """Per row what is left without the ranges of `repeated_spans`, judged on the input."""
    spans = scratch.stage(repeated_spans(docs, scratch, size, gram, most), "spans")
    keyed = docs.select(F.col("doc_id").cast("long"), *row_key(), text_or_empty().alias("text"))
    joined = keyed.join(spans, ["k1", "k2"], "left").select("doc_id", "text", "spans")
    out = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    return joined.mapInArrow(_removed, out)


def op8_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without its bytes that are part of a repeated string of 400 bytes; the
    bytes left and the share removed are told beside the numbers they follow from."""
    left = F.col("n_bytes") - F.col("n_removed")
    share = F.coalesce(F.try_divide(F.col("n_removed").cast("double"), "n_bytes"), F.lit(0.0))
    return removed(read(spark, sf_dir, "documents"), Scratch(spark)).select(
        "*", left.alias("n_kept"), share.alias("removed_share"), (F.col("n_removed") > 0).cast("int").alias("has_repeat")
    )
