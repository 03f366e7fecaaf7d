import random

import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.llm import simhash
from tidemark.llm.common import Scratch
from tidemark.llm.components import connected


def brute_fingerprint(text, words=3):
    import re

    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    parts = re.findall(r"[^\x20\x09-\x0D]+", text)
    shingles = [" ".join(parts[i : i + words]) for i in range(len(parts) - words + 1)] or (
        [" ".join(parts)] if parts else []
    )
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints, radius=2):
    root = {}
    for i in prints:
        seen, todo = {i}, [i]
        while todo:
            at = todo.pop()
            for j in prints:
                if j not in seen and (prints[at] ^ prints[j]).bit_count() <= radius:
                    seen.add(j)
                    todo.append(j)
        root[i] = min(seen)
    return root


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="aAbÉ \t\n\x0b\x1c é😀", max_size=60))
def test_fingerprint_is_the_bit_majority(text):
    assert simhash.fingerprint_of(text, 3) & (1 << 64) - 1 == brute_fingerprint(text)


def corpus():
    rng = random.Random(5)
    words = [f"w{i}" for i in range(400)]
    base = [rng.choice(words) for _ in range(300)]
    texts = [None, "", "one", "one two", " ".join(base), " ".join(base)]
    for _ in range(60):
        copy = base.copy()
        copy[rng.randrange(300)] = rng.choice(words)
        texts.append(" ".join(copy))
    texts += [" ".join(rng.choice(words) for _ in range(rng.randrange(3, 80))) for _ in range(40)]
    return texts


def test_components_match_brute_force(spark, tmp_path):
    texts = corpus()
    rows = [(i, t, i) for i, t in enumerate(texts)]
    rng = random.Random(1)
    rng.shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string, fp int").repartition(3)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = simhash.op2_simhash(spark, str(tmp_path)).collect()
    prints = {i: brute_fingerprint(t) for i, t in enumerate(texts)}
    want = brute_components(prints)
    assert sorted((r.doc_id, r.fingerprint, r.component_id) for r in got) == [
        (i, f"{prints[i]:016x}", want[i]) for i in prints
    ]
    assert len(set(want.values())) < len(texts) - 20


def test_links_are_all_pairs_within_the_radius(spark):
    rng = random.Random(2)
    prints = set()
    for _ in range(30):
        base = rng.getrandbits(64)
        for _ in range(8):
            flips = sum(1 << rng.randrange(64) for _ in range(rng.randrange(4)))
            prints.add(base ^ flips & (1 << 64) - 1)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    df = spark.createDataFrame([(p,) for p in signed + signed[:5] + [None]], "fp long")
    for radius in (1, 2, 3):
        got = sorted((r.a, r.b) for r in simhash.links(df, radius).collect())
        mask = (1 << 64) - 1
        want = [(a, b) for a in signed for b in signed if a < b and ((a ^ b) & mask).bit_count() <= radius]
        assert got == sorted(want)


def test_components_of_a_chain_a_hub_and_nothing(spark):
    chain = [(i, i + 1) for i in range(100, 160)]
    hub = [(7, i) for i in range(200, 260)] + [(259, 7), (7, 7), (None, 3)]
    links = spark.createDataFrame(chain + hub, "a long, b long")
    got = {r.node: r.root for r in connected(links, Scratch(spark)).collect()}
    assert got == {**dict.fromkeys(range(100, 161), 100), **dict.fromkeys(range(200, 260), 7), 7: 7}
    assert connected(links.limit(0), Scratch(spark)).count() == 0


def test_one_row_of_each_group_stays(spark):
    rows = [(3, "a b c d", "x"), (1, "a b c d", "y"), (1, "a b c d", "y"), (5, None, "z"), (None, "", "z"), (9, "q r s t u", "w")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, k1 string")
    got = simhash.one_per_group(docs, Scratch(spark))
    assert got.columns == docs.columns
    assert sorted((r.doc_id, r.k1) for r in got.collect()) == [(1, "y"), (5, "z"), (9, "w")]
    assert simhash.one_per_group(docs.limit(0), Scratch(spark)).count() == 0
    tags = spark.createDataFrame([(1, "a b", f"tag {i}") for i in range(20)], "doc_id long, text string, fp string")
    picked = {tuple(simhash.one_per_group(tags.repartition(n), Scratch(spark)).collect()) for n in (1, 3, 7)}
    assert len(picked) == 1 and len(picked.pop()) == 1
    nulls = spark.createDataFrame([(None, "m n o"), (None, "m n o"), (None, "p q r")], "doc_id long, text string")
    assert simhash.one_per_group(nulls, Scratch(spark)).count() == 2
    assert {r.component_id for r in simhash.near_duplicates(nulls, Scratch(spark)).collect()} == {None}
