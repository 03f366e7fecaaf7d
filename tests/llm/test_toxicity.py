import random
import zlib

import numpy as np

from tidemark.llm import toxicity


def rows(rng, n=900):
    neutral = [f"{a}{b}{c}" for a in "bdfgklm" for b in "aeiou" for c in ("rn", "st", "lk", "mp")]
    bad = ["grumble", "snarky", "bleeping", "rotten"]
    out = []
    for i in range(n):
        toxic = rng.random() < 0.2
        words = [rng.choice(neutral) for _ in range(rng.randrange(5, 80))]
        for _ in range(1 + len(words) // 10 if toxic else 0):
            words.insert(rng.randrange(len(words)), rng.choice(bad))
        out.append((i, " ".join(words), int(toxic) ^ (rng.random() < 0.03), int(toxic)))
    return out


def test_held_out_scores(spark, tmp_path):
    data = rows(random.Random(1))
    docs = [(i, t, "x") for i, t, *_ in data] + [(5000, None, "x"), (5001, "", "x"), (5002, "é! " * 40000, "x"), (None, "grumble rotten", "x")]
    spark.createDataFrame(docs + docs[:3], "doc_id long, text string, score string").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    labels = [(i, 1, y) for i, _, y, _ in data if i % 5] + [(7777, 0, 1), (3, None, None), (None, 1, 1), (6, 1, 9)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    got = toxicity.op6_toxicity(spark, str(tmp_path)).collect()
    assert len(got) == len(docs) + 3
    truth = {i: t for i, *_, t in data}
    held = [r for r in got if r.held_out and r.doc_id in truth]
    assert len(held) > 150
    assert np.mean([r.predicted == truth[r.doc_id] for r in held]) > 0.97
    for r in got:
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3)
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
    by_id = {r.doc_id: r for r in got}
    assert [by_id[i].predicted for i in (5000, 5001, 5002, None)] == [0, 0, 0, 1]


def test_label_model_outvotes_wrong_labels_and_shares_copied_votes():
    rng = np.random.default_rng(2)
    truth = rng.random(2000) < 0.3
    vote = lambda good: np.where(rng.random(2000) < good, np.where(truth, 1, -1), np.where(truth, -1, 1))
    given = np.where(rng.random(2000) < 0.1, ~truth, truth)
    strong = np.stack([vote(0.9) for _ in range(5)], axis=1)
    noise = vote(0.55)
    votes = np.hstack([strong, np.repeat(noise[:, None], 6, axis=1)])
    posterior = toxicity.label_model(votes, given, np.ones(2000))
    assert ((posterior > 0.5) == truth).mean() > 0.97 > (given == truth).mean()


def test_nothing_to_learn_from(spark):
    docs = spark.createDataFrame([(1, "words"), (2, None)], "doc_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    model = toxicity.learn(docs, labels, toxicity.not_held_out())
    assert {r.score < 0.01 for r in toxicity.score(docs, model, ["doc_id"]).collect()} == {True}
    one_class = toxicity.fit(["a few words", "more of them"], [0, 0], {0: 2})
    assert (one_class.score(["a few words"], toxicity.Hits(one_class.terms)) < 0.3).all()
    assert toxicity.score(docs.limit(0), model, ["doc_id"]).count() == 0


def test_a_repeated_id_reaches_the_driver_once(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(toxicity, "fit", lambda texts, labels, shares: seen.append((texts, labels)) or "model")
    docs = [(i, f"text {i}") for i in range(20)] + [(3, f"other {k}") for k in range(500)] + [(4, "text 4")] * 300
    labels = [(i, i % 2) for i in range(20)] + [(3, 1)] * 50 + [(4, 1)]
    toxicity.learn(
        spark.createDataFrame(docs, "doc_id long, text string").repartition(4),
        spark.createDataFrame(labels, "doc_id long, toxic int"),
        toxicity.F.lit(True),
    )
    texts, given = seen[0]
    assert len(texts) == 21 and texts.count("text 4") == 2 and sorted(given).count(1) == 11


def test_voters_against_plain_loops():
    """Votes of a small corpus, worked out word by word."""
    texts = ["bad bad good", "good good fine words here", "BAD! words 1", "fine", ""]
    toxic = np.array([True, False, True, False, False])
    hits = toxicity.Hits(("bad$", "fine$"))
    counts, shapes = toxicity.counts_of(texts, hits)
    assert counts.tolist() == [[t.lower().split().count("bad") + ("bad!" in t.lower().split()), t.lower().split().count("fine")] for t in texts]
    votes = toxicity.votes_of(counts, shapes, toxic)
    density = [2 / 3, 0, 1 / 2, 0, 0]
    usual = sorted([2 / 3, 1 / 2])
    usual = sum(usual) / 2
    assert votes[:, 0].tolist() == [int(d >= usual / 2 and d > 0) for d in density]
    assert votes[:, 2].tolist() == [-int(not any(w in t.lower() for w in ("bad", "fine"))) for t in texts]


def test_the_classifier_has_the_least_loss():
    """No small change of any weight makes the penalised loss smaller."""
    rng = np.random.default_rng(4)
    x, target, weight = rng.normal(size=(200, 4)), rng.random(200), rng.random(200) + 0.5
    w, bias = toxicity.fit_linear(x, target, weight)

    def loss(v):
        z = x @ v[:-1] + v[-1]
        return (weight * (np.logaddexp(0, z) - target * z)).sum() + 0.5 * (v[:-1] ** 2).sum() + 0.5e-6 * v[-1] ** 2

    best = np.append(w, bias)
    for k in range(len(best)):
        for step in (-1e-3, 1e-3):
            assert loss(best + step * np.eye(len(best))[k]) >= loss(best) - 1e-9
