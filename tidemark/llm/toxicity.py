"""Toxicity by weak supervision: voters, a generative label model, a linear classifier."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.llm.common import fresh, read, stretch
from tidemark.operators.ranking import first_per_key, top_per_key

WORD = re.compile(r"[^\W\d_]+")
PREFIXES = range(4, 8)
CACHED_WORDS = 400_000
THRESHOLD = 0.3
# What the pattern voters look at, as a share of the characters.
PATTERNS = ("letters in capitals", "exclamation marks", "digits", "signs", "characters per word")


def terms_of(word: str) -> list[str]:
    """The word itself (closed by $) and its prefixes."""
    return [word + "$", *(word[:k] for k in PREFIXES if len(word) >= k)]


@lru_cache(maxsize=1)
def kinds() -> np.ndarray:
    """Code point -> 0 other sign, 1 capital, 2 other letter, 3 digit, 4 white space, 5 `!`."""
    table = np.zeros(1 << 16, dtype=np.uint8)
    for point in range(1 << 16):
        c = chr(point)
        if c.isalpha():
            table[point] = 1 if c.isupper() else 2
        elif c.isdigit() or c.isspace():
            table[point] = 3 if c.isdigit() else 4
    table[ord("!")] = 5
    return table


def shape(text: str, words: int) -> list[float]:
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")
    other, capitals, small, digits, _, marks = np.bincount(kinds()[np.minimum(points, (1 << 16) - 1)], minlength=6)
    size = max(len(points), 1)
    letters = capitals + small
    return [capitals / size, marks / size, digits / size, (other + marks) / size, min(letters / max(words, 1), 30) / 30]


class Hits(dict):
    """word -> numbers of the lexicon terms it has; bounded, most words have none."""

    def __init__(self, terms: tuple[str, ...]) -> None:
        super().__init__()
        self.number = {t: i for i, t in enumerate(terms)}

    def __missing__(self, word: str) -> tuple[int, ...]:
        if len(self) > CACHED_WORDS:
            self.clear()
        found = tuple(self.number[t] for t in terms_of(word) if t in self.number)
        self[word] = found
        return found


def counts_of(texts: list[str | None], hits: Hits) -> tuple[np.ndarray, np.ndarray]:
    """(text, term) counts, and per text its number of words and its shape."""
    counts = np.zeros((len(texts), len(hits.number)))
    shapes = np.zeros((len(texts), 1 + len(PATTERNS)))
    for row, text in enumerate(texts):
        words = WORD.findall((text or "").lower())
        for found in filter(None, map(hits.__getitem__, words)):
            counts[row, found] += 1
        shapes[row] = [len(words), *shape(text or "", len(words))]
    return counts, shapes


def features(counts: np.ndarray, shapes: np.ndarray) -> np.ndarray:
    words = np.maximum(shapes[:, :1], 1)
    total = counts.sum(axis=1, keepdims=True)
    return np.hstack([
        np.log1p(counts),
        np.minimum(20 * counts / words, 1),
        np.log1p(total),
        np.minimum(4 * total / words, 1),
        shapes[:, 1:],
    ])


@dataclass(frozen=True)
class Model:
    """What scoring needs; travels with the task."""

    terms: tuple[str, ...]
    weights: tuple[float, ...]
    bias: float

    def score(self, texts: list[str | None], hits: Hits) -> np.ndarray:
        x = features(*counts_of(texts, hits))
        return 1 / (1 + np.exp(-np.clip(x @ np.array(self.weights) + self.bias, -30, 30)))


def lexicon(texts: list[str], toxic: np.ndarray, most: int) -> tuple[str, ...]:
    """Terms whose share of the words differs most between the two kinds of rows, by the
    likelihood ratio, among those at least four times as frequent in toxic rows and found
    in three of them. A prefix is left out where a chosen term has the same words."""
    used, rows = [Counter(), Counter()], Counter()
    for text, label in zip(texts, toxic):
        words = Counter(WORD.findall(text.lower()))
        terms = Counter()
        for word, n in words.items():
            for term in terms_of(word):
                terms[term] += n
        used[int(label)].update(terms)
        if label:
            rows.update(terms.keys())
    clean, bad = used
    all_clean = sum(n for t, n in clean.items() if t[-1] == "$") + 1
    all_bad = sum(n for t, n in bad.items() if t[-1] == "$") + 1
    ranked = []
    for term, n in bad.items():
        here, there = n / all_bad, (clean[term] + 0.5) / all_clean
        if rows[term] >= 3 and here >= 4 * there:
            both = (n + clean[term]) / (all_bad + all_clean)
            gain = n * np.log(here / both) + clean[term] * np.log(max(clean[term], 0.5) / all_clean / both)
            ranked.append((gain, term))
    chosen, seen = [], set()
    for _, term in sorted(ranked, key=lambda g: (-g[0], g[1])):
        key = (bad[term], clean[term], term[:4])
        if key not in seen:
            seen.add(key)
            chosen.append(term)
        if len(chosen) == most:
            break
    return tuple(chosen)


def votes_of(counts: np.ndarray, shapes: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    """(text, voter) in -1, 0, 1. A lexicon voter says toxic from half the density on that
    toxic rows with its term usually have, and abstains otherwise; one voter says clean
    where no term is found; a pattern voter says toxic beyond the 98th percentile of the
    clean rows and clean below their median."""
    density = counts / np.maximum(shapes[:, :1], 1)
    usual = np.array([np.median(d[(d > 0) & toxic]) if ((d > 0) & toxic).any() else 1.0 for d in density.T])
    lexical = (density >= usual / 2) & (counts > 0)
    none = -1 * (counts.sum(axis=1, keepdims=True) == 0)
    clean = shapes[~toxic, 1:] if (~toxic).any() else shapes[:, 1:]
    high, mid = np.percentile(clean, 98, axis=0), np.percentile(clean, 50, axis=0)
    pattern = (shapes[:, 1:] > high).astype(int) - (shapes[:, 1:] < mid)
    return np.hstack([lexical.astype(int), none, pattern])


def label_model(votes: np.ndarray, toxic: np.ndarray, weight: np.ndarray, rounds: int = 12) -> np.ndarray:
    """Posterior of toxic per row, by expectation maximisation.

    Each voter has a table of how often it says clean, nothing and toxic in either class;
    the given label is one more voter, so a wrong label can be outvoted. Voters that agree
    beyond what the class explains would count twice: their correlations within the
    classes are estimated in each round and a voter's evidence is divided by its share.
    """
    ballots = np.hstack([votes, np.where(toxic, 1, -1)[:, None]])
    posterior = np.where(toxic, 0.9, 0.1)
    onehot = np.stack([ballots == v for v in (-1, 0, 1)], axis=2).astype(float)
    for _ in range(rounds):
        log = np.empty((len(ballots), 2))
        apart = np.zeros_like(ballots, dtype=float)
        for k, share in enumerate((1 - posterior, posterior)):
            mass = weight * share
            table = (np.einsum("r,rvo->vo", mass, onehot) + 0.5) / (mass.sum() + 1.5)
            prior = np.log((mass.sum() + 1) / (weight.sum() + 2))
            evidence = np.einsum("rvo,vo->rv", onehot, np.log(table))
            log[:, k] = prior
            mean = mass @ ballots / max(mass.sum(), 1e-9)
            apart += share[:, None] * (ballots - mean)
            if k == 0:
                clean_evidence = evidence
        spread = np.sqrt(np.maximum((weight[:, None] * apart**2).sum(axis=0), 1e-9))
        correlation = np.abs((apart * weight[:, None]).T @ apart) / np.outer(spread, spread)
        share = 1 / np.maximum(np.minimum(correlation, 1).sum(axis=0), 1)
        share[-1] = 1
        ratio = log[:, 1] - log[:, 0] + (evidence - clean_evidence) @ share
        posterior = 1 / (1 + np.exp(-np.clip(ratio, -30, 30)))
    return posterior


def fit_linear(x: np.ndarray, target: np.ndarray, weight: np.ndarray, ridge: float = 1.0) -> tuple[np.ndarray, float]:
    """Logistic regression on soft labels by Newton steps."""
    x1 = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x1.shape[1])
    penalty = np.full(len(w), ridge)
    penalty[-1] = 1e-6
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(x1 @ w, -30, 30)))
        slope = x1.T @ (weight * (p - target)) + penalty * w
        curve = (x1 * (weight * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x1 + np.diag(penalty)
        step = np.linalg.solve(curve, slope)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return w[:-1], float(w[-1])


def fit(texts: list[str], labels: list[int], shares: dict[int, int], most_terms: int = 64) -> Model:
    """Model from a sample of labelled texts; `shares` are the label counts it stands for."""
    toxic = np.array(labels, dtype=bool)
    if not len(toxic):
        return Model((), (0.0,) * (2 + len(PATTERNS)), -30.0)
    terms = lexicon(texts, toxic, most_terms)
    counts, shapes = counts_of(texts, Hits(terms))
    all_rows = sum(shares.values())
    weight = np.array([shares[int(t)] / max((toxic == t).sum(), 1) for t in toxic]) * len(toxic) / all_rows
    posterior = label_model(votes_of(counts, shapes, toxic), toxic, weight)
    w, bias = fit_linear(features(counts, shapes), posterior, weight)
    return Model(terms, tuple(w), bias)


def learn(docs: DataFrame, labels: DataFrame, learn_from: Column, rows_per_class: int = 2000, chars_per_row: int = 5000) -> Model:
    """Model from at most `rows_per_class` labelled ids per class, those of lowest hash, and
    `chars_per_row` characters of one text of each, from a place that its id decides; only
    these reach the driver. `learn_from` says
    which doc_ids may be used. Labels other than 0 and 1 and null texts are not used."""
    usable = labels.filter(F.col("toxic").isin(0, 1)).select("doc_id", F.col("toxic").cast("int").alias("toxic"))
    usable = usable.filter(learn_from).distinct()
    picked = top_per_key(usable, ["toxic"], [F.xxhash64("doc_id"), F.col("doc_id")], rows_per_class)
    found = (
        docs.filter("text is not null")
        .join(F.broadcast(picked.select("doc_id", "toxic")), "doc_id")
        .select("doc_id", "toxic", stretch(chars_per_row).alias("head"))
    )
    # One text per picked label, however often its doc_id comes.
    rows = first_per_key(found, ["doc_id", "toxic"], [F.xxhash64("head"), F.col("head")]).collect()
    shares = {r.toxic: r.n for r in usable.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    rows.sort(key=lambda r: (r.doc_id, r.toxic, r.head))
    return fit([r.head for r in rows], [r.toxic for r in rows], shares)


@lru_cache(maxsize=2)
def hits_of(model: Model) -> Hits:
    return Hits(model.terms)


def score(docs: DataFrame, model: Model, keep: list[str], text: str = "text", name: str = "score") -> DataFrame:
    """The `keep` columns and the score of the whole text; null texts score as empty ones."""
    body = text if text in keep else fresh("text")
    out = StructType(list(docs.select(*keep).schema.fields)).add(name, "double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hits = hits_of(model)
        for batch in batches:
            values = model.score(batch[body].to_pylist(), hits)
            columns = [batch[column] for column in keep]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(values, pa.float64())], [*keep, name])

    extra = [] if text in keep else [F.col(text).alias(body)]
    return docs.select(*keep, *extra).mapInArrow(run, out)


def without_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of `docs` that score below the threshold, by a model learned from the
    labelled ones among them; same columns."""
    name = fresh("score")
    model = learn(docs, labels, not_held_out())
    return score(docs, model, docs.columns, name=name).filter(F.col(name) < threshold).select(*docs.columns)


def not_held_out() -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 != 2, F.lit(False))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document; a quarter of the documents is held out of the learning."""
    docs, labels = read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")
    model = learn(docs, labels, not_held_out())
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))
    scored = score(docs.withColumn("held_out", held), model, ["doc_id", "held_out"])
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
