"""Language identification by cross-parsing against suffix automata of labelled text."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from math import log2

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.llm.common import fresh, read, stretch
from tidemark.operators.ranking import top_per_key

UNKNOWN = "und"
# The most frequent characters of the samples have a column in the table of moves, all others
# a sorted list; characters that no sample has are code 0 and match nothing.
COLUMNS = 64
SEGMENT = 1024
LANES = 4096


def automaton(codes: list[int]) -> list[dict[int, int]]:
    """Suffix automaton of a code sequence: per state, code -> state.

    Online construction: each code adds one state and at most one clone; every substring
    of the sequence, and nothing else, is a path from state 0.
    """
    moves: list[dict[int, int]] = [{}]
    link, length = [-1], [0]
    last = 0
    for code in codes:
        new = len(moves)
        moves.append({})
        length.append(length[last] + 1)
        link.append(0)
        at = last
        while at >= 0 and code not in moves[at]:
            moves[at][code] = new
            at = link[at]
        if at >= 0:
            target = moves[at][code]
            if length[target] != length[at] + 1:
                clone = len(moves)
                moves.append(moves[target].copy())
                length.append(length[at] + 1)
                link.append(link[target])
                link[target] = clone
                while at >= 0 and moves[at].get(code) == target:
                    moves[at][code] = clone
                    at = link[at]
                target = clone
            link[new] = target
        last = new
    return moves


@dataclass(frozen=True)
class Samples:
    """Bounded labelled text: language -> normalised text. All that a model is made of."""

    texts: tuple[tuple[str, str], ...]


def normalised(text: str) -> str:
    """Lower case, every run of other characters than letters one space."""
    return re.sub(r"[\W\d_]+", " ", text.lower())


class Model:
    def __init__(self, samples: Samples) -> None:
        common = Counter()
        for _, text in samples.texts:
            common.update(text)
        self.codes = np.zeros(0x110000, dtype=np.int32)
        for code, (c, _) in enumerate(sorted(common.items(), key=lambda e: (-e[1], e[0])), 1):
            self.codes[ord(c)] = code
        self.width = len(common) + 1
        self.langs = [lang for lang, _ in samples.texts]
        # Phrases get longer with the logarithm of the text learned from.
        self.weights = np.array([log2(max(len(text), 2)) for _, text in samples.texts])
        automata = [automaton(self.encode(text).tolist()) for _, text in samples.texts]
        # The automata one after the other, states numbered through.
        starts = np.cumsum([0, *(len(a) for a in automata)])
        self.roots = starts[:-1].astype(np.int64)
        self.moves = np.full((max(int(starts[-1]), 1), COLUMNS), -1, dtype=np.int32)
        rare = []
        for start, moves in zip(starts.tolist(), automata):
            for state, out in enumerate(moves, start):
                for code, to in out.items():
                    if code < COLUMNS:
                        self.moves[state, code] = to + start
                    else:
                        rare.append((state * self.width + code, to + start))
        self.moves = self.moves.ravel()
        rare.sort()
        self.rare = np.array([r[0] for r in rare] or [-1], dtype=np.int64)
        self.rare_moves = np.array([r[1] for r in rare] or [-1], dtype=np.int64)

    def encode(self, text: str) -> np.ndarray:
        return self.codes[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")]

    def _move(self, states: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """Where these states, a row per code, go by it; -1: nowhere."""
        to = self.moves[states * COLUMNS + np.where(codes < COLUMNS, codes, 0)[:, None]].astype(np.int64)
        rare = np.flatnonzero(codes >= COLUMNS)
        if len(rare):
            wanted = states[rare] * self.width + codes[rare, None]
            place = np.minimum(np.searchsorted(self.rare, wanted), len(self.rare) - 1)
            to[rare] = np.where(self.rare[place] == wanted, self.rare_moves[place], -1)
        return to

    def phrases(self, texts: list[str]) -> np.ndarray:
        """(text, language) -> phrases needed: the text is cut into longest matches.

        Texts are walked in segments of SEGMENT characters, many at a time: one step moves
        every segment of every text by a character in all automata. A segment's end ends
        its phrase, for all languages alike.
        """
        owners, segments = [], []
        for i, text in enumerate(texts):
            codes = self.encode(text)
            for at in range(0, len(codes), SEGMENT):
                segments.append(codes[at : at + SEGMENT])
                owners.append(i)
        total = np.zeros((len(texts), len(self.langs)), dtype=np.int64)
        order = sorted(range(len(segments)), key=lambda k: -len(segments[k]))
        for first in range(0, len(order), LANES):
            part = order[first : first + LANES]
            counts = self._walk([segments[k] for k in part])
            np.add.at(total, [owners[k] for k in part], counts)
        return total

    def _walk(self, segments: list[np.ndarray]) -> np.ndarray:
        """Phrases of segments given longest first."""
        sizes = np.array([len(s) for s in segments])
        block = np.zeros((sizes[0], len(segments)), dtype=np.int64)
        for k, segment in enumerate(segments):
            block[: len(segment), k] = segment
        counts = np.zeros((len(segments), len(self.langs)), dtype=np.int64)
        roots = np.broadcast_to(self.roots, counts.shape)
        states = roots.copy()
        live = len(segments)
        for step in range(sizes[0]):
            while sizes[live - 1] <= step:
                live -= 1
            codes, at, root = block[step, :live], states[:live], roots[:live]
            to = self._move(at, codes)
            miss = to < 0
            counts[:live] += miss | (at == root)  # a phrase begins with this character
            if miss.any():
                again = self._move(root, codes)
                # A character that the language never has is a phrase of its own.
                to = np.where(miss, np.where(again < 0, root, again), to)
            states[:live] = to
        return counts

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        clean = [normalised(t or "") for t in texts]
        known = [i for i, t in enumerate(texts) if t and any(map(str.isalpha, t))]
        langs, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
        if known and self.langs:
            counts = self.phrases([clean[i] for i in known]) * self.weights
            for i, row in zip(known, counts):
                order = np.lexsort((np.arange(len(row)), row))
                langs[i] = self.langs[order[0]]
                second = row[order[1]] if len(row) > 1 else 2 * row[order[0]]
                scores[i] = float(1 - row[order[0]] / second)
        return langs, scores


@lru_cache(maxsize=2)
def model_of(samples: Samples) -> Model:
    return Model(samples)


def learn(labelled: DataFrame, rows_per_lang: int = 64, chars_per_row: int = 500) -> Samples:
    """Bounded sample of (doc_id, text, lang): per language the `rows_per_lang` ids of lowest
    hash, and `chars_per_row` characters of one text of each, from a place that its id
    decides. Rows without lang, text or a letter are not taken; repeated ids count once.

    Estimates of the number of ids tell from which hash on none is needed, so few rows move,
    and a few hundred kilobytes reach the driver for any size of the table.
    """
    usable = labelled.filter(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    ids = usable.groupBy("lang").agg(F.approx_count_distinct(F.coalesce(F.xxhash64("doc_id"), F.lit(0))).alias("ids"))
    share = {r["lang"]: min(1.0, 4 * rows_per_lang / max(r["ids"], 1)) for r in ids.collect()}
    if not share:
        return Samples(())
    spark = labelled.sparkSession
    shares = spark.createDataFrame(list(share.items()), "lang string, share double")
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 32)) / float(1 << 32)
    low = usable.join(F.broadcast(shares), "lang").filter(place <= F.col("share"))
    heads = low.select("lang", "doc_id", stretch(chars_per_row).alias("head"))
    once = heads.groupBy("lang", "doc_id").agg(F.min("head").alias("head"))
    rows = top_per_key(once, ["lang"], [place, F.col("doc_id")], rows_per_lang, "place").collect()
    by_lang: dict[str, list[str]] = {}
    for row in sorted(rows, key=lambda r: (r.lang, r.place)):
        by_lang.setdefault(row.lang, []).append(normalised(row.head).strip())
    return Samples(tuple((lang, " ".join(texts)) for lang, texts in sorted(by_lang.items())))


def identify(docs: DataFrame, samples: Samples, keep: list[str], text: str = "text") -> DataFrame:
    """The `keep` columns with lang_pred and score, from the whole text alone.

    Null texts and texts without a letter give `und` and 0. Phrases are weighted by the
    logarithm of the length learned from; equal sums go to the language first in the
    alphabet; score is 1 - least / second least sum. The samples travel with the task; each worker builds the automata once.
    """
    body = fresh("text")
    out = StructType(list(docs.select(*keep).schema.fields)).add("lang_pred", "string").add("score", "double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = model_of(samples)
        for batch in batches:
            langs, scores = model.predict(batch[body].to_pylist())
            columns = [batch[name] for name in keep]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                [*keep, "lang_pred", "score"],
            )

    return docs.select(*keep, F.col(text).alias(body)).mapInArrow(run, out)


def op3_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document; a third of the documents is held out of the learning."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))
    docs = docs.withColumn("held_out", held)
    samples = learn(docs.filter(~F.col("held_out")))
    return identify(docs, samples, ["doc_id", "held_out"])
