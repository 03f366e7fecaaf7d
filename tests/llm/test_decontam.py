import random
import re

from tidemark.llm import decontam
from tidemark.llm.common import Scratch


def words(text):
    return re.findall(r"[^\W_]+", (text or "").lower())


def parts(ws):
    if not ws:
        return []
    return [tuple(ws[i : i + 5]) for i in range(max(len(ws) - 4, 1))]


def alike(a, b):
    a, b = set(parts(a)), set(parts(b))
    weight = lambda s: sum(len("".join(p)) for p in s)
    return weight(a & b) / weight(a | b) if a | b else 0.0


def brute(text, item):
    doc, it = words(text), words(item)
    if not it or not doc:
        return 0.0
    return max(alike(doc[i : i + len(it)], it) for i in range(max(len(doc) - len(it), 0) + 1))


def cases():
    rng = random.Random(1)
    vocabulary = [f"w{i}x" for i in range(500)]
    prose = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    items = [" ".join(prose(rng.randrange(14, 70))).capitalize() + "." for _ in range(25)] + ["one two", "", None, "Ünï çode fünf Wörter hier sechs"]
    docs = [None, "", "w1x", "one two", "says one  TWO, three"]
    for item in items[:25]:
        docs.append(" ".join(prose(40)) + "\n" + item.upper() + "\n" + " ".join(prose(rng.randrange(60))))
        changed = item.split(" ")
        changed[len(changed) // 2] = "other"
        docs.append(" ".join(prose(10)) + " " + " ".join(changed) + " " + " ".join(prose(10)))
        longer = item.split(" ")
        longer.insert(3, "extra")
        docs.append(" ".join(longer) + " " + " ".join(prose(10)))
        docs.append(" ".join(item.split(" ")[:10]) + " " + " ".join(prose(50)))
        docs.append(" ".join(prose(120)))
    docs.append(" ".join(prose(30000)) + " " + items[3] + " " + " ".join(prose(50)))
    docs.append(items[4] + " " + items[5] + " " + items[4])
    docs.append("ünï çode fünf wörter hier sechs")
    return docs, items


def test_leaks_match_brute_force(spark, tmp_path):
    docs, items = cases()
    table = [(i, t, "x") for i, t in enumerate(docs)]
    spark.createDataFrame(table, "doc_id long, text string, size string").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(list(enumerate(items)), "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = {(r.doc_id, r.item_id): r.similarity for r in decontam.op9_decontamination(spark, str(tmp_path)).collect()}
    want = {}
    for i, text in enumerate(docs):
        for j, item in enumerate(items):
            if len(text or "") < 5000 or j in (3, 4):
                value = brute(text, item)
                if value >= 0.8:
                    want[i, j] = value
    assert set(got) == set(want)
    assert len(want) > 35 and any(v < 1 for v in want.values())
    assert all(abs(got[k] - want[k]) < 1e-9 for k in want)


def test_clean_rows_stay_as_they_are(spark):
    docs, items = cases()
    table = [(i if i % 4 else None, t, i) for i, t in enumerate(docs)] + [(1, docs[0], 900), (7, docs[6], 901)]
    df = spark.createDataFrame(table, "doc_id long, text string, k1 long").repartition(3)
    benchmark = spark.createDataFrame([(j, t, 1) for j, t in enumerate(items)], "item_id long, text string, size int")
    kept = decontam.without_leaks(df, benchmark, Scratch(spark))
    assert kept.columns == df.columns
    leaked = {r.k1 for r in df.collect()} - {r.k1 for r in kept.collect()}
    texts = [r[1] for r in table]
    assert leaked == {r[2] for r in table if any(brute(r[1], t) >= 0.8 for t in items if len(r[1] or "") < 5000 or t == items[3])}
    assert decontam.without_leaks(df.limit(0), benchmark, Scratch(spark)).count() == 0
    assert decontam.without_leaks(df, benchmark.limit(0), Scratch(spark)).count() == len(texts)


def found(spark, tmp_path, docs, items):
    """(doc, item) -> similarity by position, of the query and of brute force."""
    spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(list(enumerate(items)), "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = {(r.doc_id, r.item_id): round(r.similarity, 9) for r in decontam.op9_decontamination(spark, str(tmp_path)).collect()}
    values = {(i, j): round(brute(d, t), 9) for i, d in enumerate(docs) for j, t in enumerate(items)}
    return got, {k: v for k, v in values.items() if v >= 0.8}


def test_windows_start_wherever_they_hold_a_probe(spark, tmp_path):
    rng = random.Random(2)
    prose = lambda n: [f"w{rng.randrange(3000)}x" for _ in range(n)]
    docs, items = [], []
    for _ in range(8):
        # A phrase said nine times: the places of the distinct shingles are not those of the words.
        item = prose(5) * 9 + prose(65)
        docs.append(" ".join(prose(150) + item + prose(90)))
        items.append(" ".join(item))
        # Sets have no order: the halves change places.
        item = prose(60)
        docs.append(" ".join(prose(70) + item[30:] + item[:30] + prose(20)))
        items.append(" ".join(item))
    got, want = found(spark, tmp_path, docs, items)
    assert len(want) == 16 and min(want.values()) < 1
    assert got == want


def test_pairs_at_the_threshold_are_all_found(spark, tmp_path):
    rng = random.Random(3)
    prose = lambda n: [f"w{rng.randrange(3000)}x" for _ in range(n)]
    docs, items = [], []
    for n in (30, 54, 104):
        for _ in range(25):
            item = prose(n)
            kept = n - (n - 4) // 5
            items.append(" ".join(item))
            # The document is the item's opening; the item's tail is replaced in a longer one.
            docs.append(" ".join(item[:kept]))
            docs.append(" ".join(prose(40) + item[: n - (n - 4) // 10] + prose(30)))
    # Exactly at the threshold: 20 of 25 shingles of one weight.
    even = [f"{i:04d}" for i in rng.sample(range(9999), 29)]
    items.append(" ".join(even))
    docs.append(" ".join(even[:24]))
    got, want = found(spark, tmp_path, docs, items)
    assert want[150, 75] == 0.8 and len(want) > 100
    assert got == want


def test_texts_under_one_item_id_are_items_of_their_own(spark):
    rng = random.Random(4)
    prose = lambda n, end: " ".join(f"w{rng.randrange(3000)}{end}" for _ in range(n))
    short, long = prose(30, "x"), prose(60, "extraordinarilylong")
    nulls = [prose(40, "y"), prose(40, "z")]
    items = [(0, short), (0, long), (0, short), (None, nulls[0]), (None, nulls[1]), (1, prose(30, "u"))]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    texts = [prose(20, "v") + " " + t + " " + prose(20, "v") for t in (short, long, *nulls)]
    docs = spark.createDataFrame([*enumerate(texts), (9, prose(80, "v"))], "doc_id long, text string")
    rows = decontam.leaks(docs, benchmark, Scratch(spark)).select("doc_id", "item_id", "similarity").collect()
    assert sorted(rows, key=lambda r: r.doc_id) == [(0, 0, 1.0), (1, 0, 1.0), (2, None, 1.0), (3, None, 1.0)]
    assert [r.doc_id for r in decontam.without_leaks(docs, benchmark, Scratch(spark)).collect()] == [9]


def test_a_very_long_item(spark):
    """20,000 words, once whole, once with a part changed: time grows with the length."""
    import time

    rng = random.Random(6)
    words_ = [f"w{rng.randrange(5000)}x" for _ in range(20_000)]
    changed = words_[:9000] + [f"v{i}y" for i in range(500)] + words_[9500:]
    other = " ".join(f"w{rng.randrange(5000)}x" for _ in range(20_000))
    texts = ["before it " + " ".join(words_) + " and after", " ".join(changed), other]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    benchmark = spark.createDataFrame([(1, " ".join(words_))], "item_id long, text string")
    start = time.time()
    got = {r.doc_id: round(r.similarity, 6) for r in decontam.leaks(docs, benchmark, Scratch(spark)).collect()}
    assert time.time() - start < 100
    assert got == {0: 1.0, 1: round(alike(changed, words_), 6)}
