import hashlib
import random
from collections import Counter

from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import repeats
from tidemark.llm.common import Scratch


def brute_cover(texts, size):
    windows = Counter(t[i : i + size] for t in texts for i in range(len(t) - size + 1))
    out = []
    for t in texts:
        gone = bytearray(len(t))
        for i in range(len(t) - size + 1):
            if windows[t[i : i + size]] > 1:
                gone[i : i + size] = b"\1" * size
        out.append(gone)
    return out


def rows_of(texts, size):
    out = []
    for t, gone in zip(texts, brute_cover(texts, size)):
        kept = bytes(b for b, g in zip(t, gone) if not g)
        runs = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out.append((len(t), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return out


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text("ab", max_size=40).map(str.encode), min_size=1, max_size=6), st.integers(3, 8))
def test_cover_of_contexts(contexts, size):
    got = repeats.longest_cover(contexts, size)
    for gone, spans in zip(brute_cover(contexts, size), got):
        mine = bytearray(len(gone))
        for s, e in spans:
            mine[s:e] = b"\1" * (e - s)
        assert mine == gone


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text("ab", max_size=25).map(str.encode), min_size=1, max_size=4), st.integers(3, 6))
def test_maximal_repeats_have_all_occurrences(contexts, size):
    for length, places in repeats.maximal_repeats(contexts, size):
        text = contexts[places[0][0]][places[0][1] :][:length]
        every = {(i, o) for i, c in enumerate(contexts) for o in range(len(c)) if c[o : o + length] == text}
        assert len(text) == length >= size and set(places) == every and len(every) > 1


def corpus(rng):
    words = [f"w{i}é" for i in range(3000)]
    prose = lambda n: " ".join(rng.choice(words) for _ in range(n))
    passage, line = prose(90), prose(70)
    texts = [None, "", "short", prose(700), passage, prose(50) + passage + prose(60), "a" * 3000, "ab" * 900 + prose(10)]
    copy = prose(800)
    texts += [copy, copy, copy[:2000] + "X" + copy[2000:], copy[1000:]]
    texts += [prose(rng.randrange(200)) + " " + line + " " + prose(rng.randrange(200)) for _ in range(40)]
    texts += [prose(30) + passage[i : i + 420] + prose(30) for i in range(0, 100, 7)]
    return texts


def test_documents_match_brute_force(spark, tmp_path, monkeypatch):
    texts = corpus(random.Random(1))
    docs = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "doc_id long, text string, begin int").repartition(4)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    want = rows_of([(t or "").encode() for t in texts], 400)
    found = repeats.op8_repeats(spark, str(tmp_path)).collect()
    got = {r[0]: tuple(r)[1:5] for r in found}
    assert [got[i] for i in range(len(texts))] == want
    for r in found:
        assert (r.n_kept, r.has_repeat) == (r.n_bytes - r.n_removed, int(r.n_removed > 0))
        assert r.removed_share == (r.n_removed / r.n_bytes if r.n_bytes else 0.0)
    assert sum(w[1] for w in want) > 20000


def test_hot_anchors_are_counted_by_window(spark):
    texts = corpus(random.Random(2))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r[0]: tuple(r)[1:] for r in repeats.removed(docs, Scratch(spark), most=2).collect()}
    assert [got[i] for i in range(len(texts))] == rows_of([(t or "").encode() for t in texts], 400)


def test_long_texts_null_ids_and_repeated_rows(spark, monkeypatch):
    rng = random.Random(3)
    monkeypatch.setattr(repeats, "SEGMENT", 1000)
    long = "".join(rng.choice("abcdefgh ") for _ in range(9000))
    rows = [(1, long), (2, "x" + long[3000:5000] + "y"), (None, "null " + long[:500]), (7, "row " * 200), (7, "row " * 200)]
    texts = [t.encode() for _, t in rows]
    schema = "doc_id long, text string"
    want = rows_of(texts, 400)
    begin = []
    import numpy as np

    for group in repeats._segments(texts, 400):
        ends = np.cumsum([len(p) for *_, p in group])
        begin.append(len(repeats.contexts_of(np.frombuffer(b"".join(p for *_, p in group), np.uint8), ends, 400, 64)[0]))
    assert len(begin) > 3 and sum(begin) > 20
    got = repeats.removed(spark.createDataFrame(rows, schema), Scratch(spark)).collect()
    assert sorted(tuple(r)[1:] for r in got) == sorted(want)
    assert repeats.removed(spark.createDataFrame([], schema), Scratch(spark)).count() == 0


def test_planted_passages_go_by_their_bytes_not_their_words(spark):
    rng = random.Random(4)
    words = {"ascii": [f"w{i}" for i in range(9000)], "wide": [f"é{i}ö" for i in range(9000)]}
    prose = lambda kind, n: " ".join(rng.choice(words[kind]) for _ in range(n))
    texts, sizes = [], []
    for kind in words:
        for n in range(51, 100, 4):
            passage = "<" + prose(kind, n) + ">"
            texts += [f"{prose(kind, 40)}{i}{passage}{i}{prose(kind, 40)}" for i in range(2)]
            sizes += [len(passage.encode())] * 2
        texts += [prose(kind, 300) for _ in range(10)]
        sizes += [0] * 10
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r[0]: tuple(r)[1:] for r in repeats.removed(docs, Scratch(spark)).collect()}
    assert [got[i][1] for i in range(len(texts))] == [n if n >= 400 else 0 for n in sizes]
    assert [got[i] for i in range(len(texts))] == rows_of([t.encode() for t in texts], 400)
    assert any(0 < n < 400 for n in sizes) and any(n >= 400 for n in sizes)
