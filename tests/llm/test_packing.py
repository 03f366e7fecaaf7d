import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from tidemark.llm import packing
from tidemark.llm.common import Scratch


def test_patterns_place_every_length_once():
    rng = random.Random(3)
    for limit in (1, 7, 64, 1024):
        histogram = Counter(rng.randint(1, limit) for _ in range(3000))
        histogram[max(1, limit // 3)] += 2000
        ends, used = dict.fromkeys(histogram, 0), defaultdict(list)
        for length, first, end, sequence, offset in packing.pack(dict(histogram), limit):
            assert first == ends[length]
            ends[length] = end
            for i in range(end - first):
                used[sequence + i].append((offset, length))
        assert ends == dict(histogram)
        for parts in used.values():
            at = 0
            for offset, length in sorted(parts):
                assert offset == at
                at += length
            assert at <= limit
        tokens = sum(k * n for k, n in histogram.items())
        assert tokens / (len(used) * limit) > 0.95 or len(used) <= -(-tokens // limit) + 2


def test_pieces_rebuild_the_documents(spark, tmp_path):
    rng = random.Random(4)
    texts = [None, "", "a", "naïve 😀   it's\n\n  end ", "x" * 3000, "before <|endoftext|> after"]
    texts += [" ".join(rng.choice(["the", "Schöpf", "1234", "!!"]) for _ in range(rng.randrange(2000))) for _ in range(60)]
    rows = [(i, t, 1) for i, t in enumerate(texts)] + [(4, "x" * 3000, 1), (None, "null id", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, length int").repartition(3)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = packing.op7_packing(spark, str(tmp_path)).collect()
    tokens = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in got:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
    for i, text in enumerate(texts):
        ids = np.array(tokens.encode(text or "", add_special_tokens=False).ids + [0], dtype="<u4")
        at = 0
        for r in sorted(by_doc[i], key=lambda r: r.start)[:: 2 if i == 4 else 1]:
            assert (r.start, r.doc_tokens) == (at, len(ids))
            assert r.ids_crc32 == zlib.crc32(ids[at : at + r.length].tobytes())
            at += r.length
        assert at == len(ids)
    assert None in by_doc
    for parts in by_sequence.values():
        at = 0
        for r in sorted(parts, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 1024
    assert len(by_sequence) == max(by_sequence) + 1


def test_ranks_of_one_length_and_an_empty_table(spark):
    docs = spark.createDataFrame([(i, "same text") for i in range(100)], "doc_id long, text string")
    got = packing.packed(docs, Scratch(spark), 8).collect()
    assert len({(r.sequence_id, r.offset) for r in got}) == len(got) == 100
    assert packing.packed(docs.limit(0), Scratch(spark)).count() == 0


def brute_pack(histogram, limit):
    """Shortest-pack-first piece by piece: longest first, each into the shortest pack with room."""
    packs = []
    for length in sorted(histogram, reverse=True):
        for _ in range(histogram[length]):
            fits = [p for p in packs if sum(p) + length <= limit and len(p) and p[-1] >= length]
            before = [p for p in fits if p[-1] != length or sum(p) > length * len(p)]
            yield_to = min(before or fits, key=sum, default=None)
            if yield_to is None:
                packs.append([length])
            else:
                yield_to.append(length)
    return packs


def test_as_few_sequences_as_piece_by_piece():
    rng = random.Random(5)
    for limit in (16, 64, 100):
        for _ in range(10):
            histogram = Counter(rng.randint(1, limit) for _ in range(200))
            slots = packing.pack(dict(histogram), limit)
            sequences = max(s[3] + s[2] - s[1] for s in slots)
            tokens = sum(k * n for k, n in histogram.items())
            assert -(-tokens // limit) <= sequences <= 1.03 * len(brute_pack(histogram, limit)) + 1


def test_white_space_that_the_fast_encoder_gives_up_on(spark):
    text = "start " + " " * 1_000_000 + " end"
    docs = spark.createDataFrame([(1, text), (2, "short")], "doc_id long, text string")
    got = packing.packed(docs, Scratch(spark)).collect()
    ids = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")).encode(text, add_special_tokens=False).ids
    whole = np.array([*ids, 0], dtype="<u4")
    parts = sorted((r for r in got if r.doc_id == 1), key=lambda r: r.start)
    assert sum(r.length for r in parts) == len(whole)
    for r in parts:
        assert r.ids_crc32 == zlib.crc32(whole[r.start : r.start + r.length].tobytes())


def test_null_ids_spread_over_the_salts(spark):
    docs = spark.createDataFrame([(None, "same text")] * 3000, "doc_id long, text string").repartition(4)
    cut = packing.pieces(docs, 1024)
    salts = cut.withColumn("salt", packing.F.pmod("turn", packing.F.lit(55))).groupBy("length", "salt").count()
    assert max(r["count"] for r in salts.collect()) < 120
    got = packing.packed(docs, Scratch(spark)).collect()
    assert len({(r.sequence_id, r.offset) for r in got}) == 3000
