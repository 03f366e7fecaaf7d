import random

from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import langid
from tidemark.llm.langid import Model, Samples

SYLLABLES = {"aa": ["ka", "lo", "mi"], "bb": ["sch", "ung", "er"], "cc": ["é", "que", "ou"]}


def prose(rng, lang, words):
    return " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randint(1, 4))) for _ in range(words))


def brute_phrases(sample, text):
    count = at = 0
    while at < len(text):
        size = 1
        while at + size < len(text) and text[at : at + size + 1] in sample:
            size += 1
        at += size
        count += 1
    return count


@settings(max_examples=80, deadline=None)
@given(st.text("abc ", min_size=1, max_size=40), st.lists(st.text("abcd ", max_size=50), min_size=1, max_size=4))
def test_phrases_are_longest_matches(sample, texts):
    model = Model(Samples((("x", sample), ("y", "abcabcab"))))
    got = model.phrases(texts)
    for text, row in zip(texts, got):
        for value, known in zip(row, (sample, "abcabcab")):
            assert value == brute_phrases(known, text)


def test_long_texts_are_walked_to_their_end():
    rng = random.Random(1)
    model = Model(Samples((("aa", prose(rng, "aa", 200)), ("bb", prose(rng, "bb", 200)))))
    text = langid.normalised(prose(rng, "aa", 2000) + prose(rng, "bb", 9000))
    whole = model.phrases([text])[0]
    parts = [text[i : i + langid.SEGMENT] for i in range(0, len(text), langid.SEGMENT)]
    assert (whole == sum(model.phrases([p])[0] for p in parts)).all()
    assert model.predict([text])[0] == ["bb"]


def test_held_out_accuracy_and_corner_cases(spark, tmp_path):
    rng = random.Random(2)
    rows = [(i, prose(rng, lang, 40), lang if i % 7 else None) for i, lang in enumerate(list(SYLLABLES) * 60)]
    rows += [(1000, None, "aa"), (1001, "", "aa"), (1002, "12 !? ²", "bb"), (None, "kalo lomi", "aa"), (3, rows[3][1], "aa")]
    docs = spark.createDataFrame([(*r, 1.0) for r in rows], "doc_id long, text string, lang string, score double")
    docs.repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    got = langid.op3_langid(spark, str(tmp_path)).collect()
    assert len(got) == len(rows)
    truth = {i: lang for i, lang in enumerate(list(SYLLABLES) * 60)}
    held = [r for r in got if r.held_out and r.doc_id in truth]
    assert len(held) > 40 and all(r.lang_pred == truth[r.doc_id] for r in held)
    by_id = {r.doc_id: r for r in got}
    assert [by_id[i].lang_pred for i in (1000, 1001, 1002)] == ["und"] * 3
    assert not by_id[None].held_out and by_id[None].lang_pred == "aa"
    assert all(0 <= r.score <= 1 for r in got)


def test_nothing_to_learn_from(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, lang string")
    samples = langid.learn(empty)
    docs = spark.createDataFrame([(1, "text")], "doc_id long, text string")
    assert [r.lang_pred for r in langid.identify(docs, samples, ["doc_id"]).collect()] == ["und"]
    assert langid.identify(docs.limit(0), samples, ["doc_id"]).count() == 0


# First letter and number of letters of sixteen scripts, some beyond the first plane.
SCRIPTS = [
    (0x61, 26), (0x3B1, 24), (0x430, 32), (0x561, 38), (0x5D0, 26), (0x627, 28), (0x905, 50), (0x985, 40), (0xE01, 44),
    (0x10D0, 33), (0x1200, 80), (0xAB70, 80), (0x3041, 80), (0x4E00, 3000), (0xAC00, 2000), (0x10A00, 40),
]


def test_every_script_is_learned():
    """Invented languages: per script two, of the same letters, some with thousands of them."""
    rng = random.Random(7)
    makers, samples = {}, []
    for first, count in SCRIPTS:
        letters = [c for c in map(chr, range(first, first + count)) if c.isalpha() and c == c.lower()]
        for twin in "ab":
            words = ["".join(rng.choice(letters) for _ in range(rng.randint(2, 5))) for _ in range(150)]
            name = f"{first:x}{twin}"
            makers[name] = lambda n, words=words: " ".join(rng.choice(words) for _ in range(n))
            samples.append((name, langid.normalised(makers[name](600))))
    model = Model(Samples(tuple(sorted(samples))))
    texts = [(name, make(40)) for name, make in makers.items() for _ in range(6)]
    langs, _ = model.predict([t for _, t in texts])
    assert sum(a == b for a, (b, _) in zip(langs, texts)) >= 0.99 * len(texts)
    assert model.phrases(["㐀㐁"])[0].tolist() == [2] * len(samples)  # letters of no sample


def test_a_rare_language_does_not_lose_to_a_large_one():
    rng = random.Random(8)
    shared = ["".join(rng.choice("abcdefghij") for _ in range(4)) for _ in range(60)]
    own = {lang: ["".join(rng.choice("abcdefghij") for _ in range(4)) for _ in range(60)] for lang in ("big", "rare")}
    say = lambda lang, n: " ".join(rng.choice(shared + own[lang] * 2) for _ in range(n))
    model = Model(Samples((("big", say("big", 6000)), ("rare", say("rare", 250)))))
    texts = [(lang, say(lang, 60)) for lang in own for _ in range(40)]
    langs, _ = model.predict([t for _, t in texts])
    right = {lang: sum(a == b for a, (b, _) in zip(langs, texts) if b == lang) for lang in own}
    assert min(right.values()) >= 38


def test_repeated_ids_are_learned_once(spark):
    rng = random.Random(9)
    texts = {i: prose(rng, "aa", 200) for i in range(300)}
    rows = [(i, t, "aa") for i, t in texts.items()]
    first = langid.learn(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    hot = rows + [rows[k] for k in range(20) for _ in range(200)] + [(None, "kalo lomi", "aa")] * 50
    again = langid.learn(spark.createDataFrame(hot, "doc_id long, text string, lang string").repartition(5))
    heads = lambda s: s.texts[0][1].count("kalo lomi")
    assert len(again.texts[0][1]) > 0.9 * len(first.texts[0][1]) and heads(again) < 70


def test_a_stretch_may_lie_anywhere(spark):
    docs = spark.createDataFrame([(i, "x" * 1000 + "y" * 1000, "aa") for i in range(64)], "doc_id long, text string, lang string")
    text = langid.learn(docs).texts[0][1]
    assert 0.25 < text.count("y") / len(text) < 0.75
