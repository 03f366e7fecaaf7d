import hashlib
import random

from pyspark.sql import functions as F

from tidemark.llm import fingerprints as fp


def prose(rng, words, line=9):
    return "".join(f"w{rng.randrange(3000)}" + ("\n" if i % line == line - 1 else " ") for i in range(words))


def test_query_follows_the_edit(spark, tmp_path):
    rng = random.Random(1)
    texts = [None, "", "é", "a😀b", "same text\nof two lines", "same text\nof two lines", prose(rng, 20000)]
    texts += [prose(rng, rng.randrange(60, 400)) for _ in range(40)]
    ids = rng.sample(range(-50, 5000), len(texts))
    rows = [(i, t, 1) for i, t in zip(ids, texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, th int").repartition(5)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in fp.op1_fingerprints(spark, str(tmp_path)).collect()}
    order = sorted((i, t or "") for i, t in zip(ids, texts))
    assert len(got) == len(order)
    wrong = 0
    for (i, text), (_, after) in zip(order, order[1:] + order[:1]):
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        assert got[i].n_chars == len(text)
        assert got[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert 0 <= got[i].near_edited <= 1 and 0 <= got[i].near_next <= 1
        if edited == text:
            assert got[i].fingerprint == got[i].edited_fingerprint and got[i].near_edited == 1
        if len(text) > 300:
            wrong += got[i].near_edited <= got[i].near_next
            assert got[i].fingerprint != got[i].edited_fingerprint
    assert wrong == 0
    by_text = {}
    for i, text in order:
        by_text.setdefault(text, set()).add(got[i].fingerprint)
    assert all(len(v) == 1 for v in by_text.values())
    assert len({v for s in by_text.values() for v in s}) == len(by_text)


def test_sums_do_not_mind_order_and_take_paragraphs_in_and_out(spark):
    rows = [("ab", "one two\nthree"), ("ba", "three\none two"), ("a", "one two"), ("b", "three"), ("c", "one two three")]
    df = spark.createDataFrame(rows, "name string, text string")
    got = fp.lanes(df, ["name"], "text")
    pick = lambda n: got.filter(F.col("name") == n).select(F.col("lanes").alias(n))
    row = (
        pick("ab").join(pick("ba")).join(pick("a")).join(pick("b")).join(pick("c"))
        .select("*", fp.added(F.col("a"), F.col("b")).alias("plus"), fp.removed(F.col("ab"), F.col("b")).alias("minus"))
        .first()
    )
    assert row.ab == row.ba == row.plus and row.minus == row.a and row.ab != row.c


def test_repeated_rows_null_ids_and_an_empty_table(spark):
    from tidemark.llm.common import Scratch

    rows = [(1, "x y"), (1, "x y"), (1, "other"), (None, "null id"), (2, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = fp.edited_fingerprints(docs, Scratch(spark)).collect()
    assert sorted((r.doc_id or 0, r.n_chars) for r in got) == [(0, 7), (1, 3), (1, 3), (1, 5), (2, 0)]
    by = {(r.doc_id, r.n_chars): r for r in got}
    assert by[1, 3].edited_sha256 == hashlib.sha256(b"x ").hexdigest()
    assert by[None, 7].near_edited > 0
    single = fp.edited_fingerprints(docs.filter("text = 'other'"), Scratch(spark)).first()
    assert single.near_next == 1
    assert fp.edited_fingerprints(docs.limit(0), Scratch(spark)).count() == 0


def test_an_id_of_many_texts_spreads_over_groups(spark, monkeypatch):
    from tidemark.llm.common import Scratch

    rng = random.Random(2)
    texts = [f"{i} " + prose(rng, rng.randrange(1, 40)) for i in range(400)]
    rows = [(None, t) for t in texts[:200]] + [(7, t) for t in texts[200:]] + [(7, texts[200])] * 3 + [(9, "the last")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    seen = []
    lanes = fp.lanes
    monkeypatch.setattr(fp, "lanes", lambda df, keys, text: seen.append((df, keys)) or lanes(df, keys, text))
    got = fp.edited_fingerprints(docs, Scratch(spark)).collect()
    first = spark.createDataFrame(rows, "k long, text string").select("k", F.min_by("text", F.xxhash64("text")).over(
        fp.Window.partitionBy("k")).alias("first")).distinct()
    first = {r.k: r.first for r in first.collect()}
    follows = {None: first[7], 7: first[9], 9: first[None]}
    edit = lambda k, t: t[: len(t) - len(t) // 2] + follows[k][: len(t) // 2]
    want = sorted(((k or 0, len(t), hashlib.sha256(edit(k, t).encode()).hexdigest()) for k, t in rows))
    assert sorted((r.doc_id or 0, r.n_chars, r.edited_sha256) for r in got) == want
    # What rows meet in holds few different texts.
    df, keys = seen[0]
    assert df.groupBy(*keys[:-1]).agg(F.countDistinct("th").alias("n")).agg(F.max("n")).first()[0] < 100
