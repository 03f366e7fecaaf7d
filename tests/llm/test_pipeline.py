import random
from collections import defaultdict

import corpus_pipeline
import public_tokenizers
from tokenizers import Tokenizer


def tables(spark, folder):
    rng = random.Random(4)
    vocabulary = [f"v{i}" for i in range(900)]
    prose = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [prose(30) for _ in range(5)]
    docs, kinds = [], {}
    for i in range(300):
        text, kind = prose(rng.randrange(40, 90)), "clean"
        if i % 6 == 1:
            text, kind = " ".join(w + (" grumble rotten" if k % 8 == 0 else "") for k, w in enumerate(text.split())), "toxic"
        elif i % 30 == 2:
            text, kind = text + " " + items[i % 5] + " end", "leak"
        elif i % 30 == 3:
            text, kind = text + " password = hunter2hunter2 end", "secret"
        elif i % 30 == 4:
            text, kind = docs[i - 4][1], "copy"
        docs.append((i, text, "en", "s", len(text)))
        kinds[i] = kind
    docs += [(300, None, None, None, None), (301, "", "en", "s", 0)]
    kinds[300], kinds[301] = "empty", "copy"
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(docs, schema).repartition(3).write.parquet(f"{folder}/documents.parquet")
    labels = [(i, 1, int(k == "toxic")) for i, k in kinds.items() if i % 2 or i % 3]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(list(enumerate(items)), "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return {d[0]: d[1] for d in docs}, kinds


def test_each_stage_takes_its_own_and_leaves_the_rest(spark, tmp_path):
    texts, kinds = tables(spark, tmp_path)
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    gone = {"toxicity": "toxic", "near_duplicates": "copy", "decontamination": "leak"}
    for nr, (name, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        after = stage(spark, docs, str(tmp_path))
        assert after.columns == docs.columns
        after.write.parquet(f"{tmp_path}/{nr}")
        after = spark.read.parquet(f"{tmp_path}/{nr}")
        ids = lambda df: {r.doc_id for r in df.select("doc_id").collect()}
        assert ids(docs) - ids(after) == {i for i in ids(docs) if kinds[i] == gone.get(name)}
        docs = after
    for row in docs.collect():
        if kinds[row.doc_id] == "secret":
            assert row.text == texts[row.doc_id].replace("password = hunter2hunter2", "[SECRET]")
        else:
            assert row.text == texts[row.doc_id]
        assert row.n_chars == len(row.text or "")
    tokens = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = {r.doc_id: len(tokens.encode(r.text or "", add_special_tokens=False).ids) + 1 for r in docs.collect()}
    got, used = defaultdict(int), defaultdict(int)
    for r in corpus_pipeline.run(spark, str(tmp_path)).collect():
        got[r.doc_id] += r.length
        used[r.sequence_id] += r.length
    assert got == want and max(used.values()) <= 1024
    assert corpus_pipeline.ORACLE_SQL is None


def test_an_empty_table_goes_through(spark, tmp_path):
    tables(spark, tmp_path)
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, str(tmp_path)) if docs.columns else docs
        assert docs.count() == 0
