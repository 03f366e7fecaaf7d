"""Encoding and decoding against the sentencepiece library, with and without a character map."""

import hashlib

import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from sentencepiece import sentencepiece_model_pb2

from tidemark.llm import pieces

FOLDER = "/root/testdata/sf0.001"
TEXTS = [
    "", " ", "   ", "Hello world", " leading", "trailing ", "a  b   c", "tabs\tand\nlines\r\n", "1234567890 12,5",
    "naïve café — “quoted” …", "日本語のテキスト 中文 한국어", "🙂👩‍👩‍👧 family", "\x00\x01\x7f", "<s></s><unk><0x41>", "▁▁x ▁",
    "ﬁne ＡＢＣ ① ½ é é  　 x", "​zero﻿width", "ѣ ꙮ 𐍈 ሀ", "x" * 500, " " * 500, "ab " * 300, "�",
]


def library(path):
    return sentencepiece.SentencePieceProcessor(model_file=path)


def spans_of(processor, text):
    return [(p.id, p.begin, p.end) for p in processor.encode(text, return_type="proto").pieces]


def mapped_model(folder, rule, squeeze, prefix, bytes_too=True):
    """The given model with the character map of a rule that the library has built in."""
    model = sentencepiece_model_pb2.ModelProto()
    with open(pieces.MODEL, "rb") as file:
        model.ParseFromString(file.read())
    rules = sentencepiece_model_pb2.ModelProto()
    rules.ParseFromString(sentencepiece.SentencePieceNormalizer(rule_name=rule).serialized_model_proto())
    model.normalizer_spec.precompiled_charsmap = rules.normalizer_spec.precompiled_charsmap
    model.normalizer_spec.remove_extra_whitespaces = squeeze
    model.normalizer_spec.add_dummy_prefix = prefix
    if not bytes_too:
        model.trainer_spec.byte_fallback = False
        kept = [p for p in model.pieces if p.type != pieces.BYTE]
        del model.pieces[:]
        model.pieces.extend(kept)
    path = f"{folder}/{rule}-{squeeze}-{prefix}-{bytes_too}.model"
    with open(path, "wb") as file:
        file.write(model.SerializeToString())
    return path


def equal(ours, theirs, text):
    ids, begins, ends = ours.encode(text)
    assert list(zip(ids.tolist(), begins.tolist(), ends.tolist())) == spans_of(theirs, text)
    assert ours.decode(ids.tolist()) == theirs.decode(ids.tolist())


@pytest.mark.parametrize("text", TEXTS)
def test_given_model_equals_the_library(text):
    equal(pieces.piece_model(pieces.MODEL), library(pieces.MODEL), text)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.characters(codec="utf-8"), max_size=60))
def test_any_text_equals_the_library(text):
    equal(pieces.piece_model(pieces.MODEL), library(pieces.MODEL), text)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 300), st.integers(0, 31999)), max_size=30))
def test_any_ids_decode_as_in_the_library(ids):
    assert pieces.piece_model(pieces.MODEL).decode(ids) == library(pieces.MODEL).decode(ids)


@pytest.mark.parametrize("squeeze", [True, False])
@pytest.mark.parametrize("prefix", [True, False])
@pytest.mark.parametrize("rule", ["nmt_nfkc", "nfkc_cf"])
def test_character_maps_equal_the_library(tmp_path, rule, prefix, squeeze):
    path = mapped_model(tmp_path, rule, squeeze, prefix)
    ours, theirs = pieces.PieceModel(path), library(path)
    for text in TEXTS:
        equal(ours, theirs, text)


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet=st.characters(codec="utf-8"), max_size=40), st.lists(st.integers(0, 31999), max_size=20))
def test_any_text_through_a_map(tmp_path_factory, text, ids):
    folder = tmp_path_factory.getbasetemp()
    path = mapped_model(folder, "nmt_nfkc", True, True)
    ours, theirs = pieces.PieceModel(path), library(path)
    equal(ours, theirs, text)
    assert ours.decode(ids) == theirs.decode(ids)


def test_unknown_characters_without_byte_pieces(tmp_path):
    path = mapped_model(tmp_path, "nmt_nfkc", True, True, bytes_too=False)
    ours, theirs = pieces.PieceModel(path), library(path)
    for text in TEXTS:
        ids, begins, ends = ours.encode(text)
        assert list(zip(ids.tolist(), begins.tolist(), ends.tolist())) == spans_of(theirs, text)


def test_spans_are_the_source_bytes():
    """Spans of a text cover it without gaps, in order."""
    text = "Größe: 12 € – 日本 🙂 x"
    _, begins, ends = pieces.piece_model(pieces.MODEL).encode(text)
    data = text.encode()
    assert b"".join(data[b:e] for b, e in zip(begins, ends)) == data


def test_long_texts(spark):
    """A word of 300,000 letters, as many spaces, and a long text of words."""
    for text in ("ab" * 150_000, " " * 300_000, "the quick brown fox " * 20_000):
        ids, _, ends = pieces.piece_model(pieces.MODEL).encode(text)
        assert ids.tolist() == library(pieces.MODEL).encode(text)
        assert ends[-1] == len(text)


def test_other_models_are_refused(tmp_path):
    model = sentencepiece_model_pb2.ModelProto()
    with open(pieces.MODEL, "rb") as file:
        model.ParseFromString(file.read())
    model.pieces[300].type = 4
    (tmp_path / "own.model").write_bytes(model.SerializeToString())
    with pytest.raises(ValueError):
        pieces.PieceModel(str(tmp_path / "own.model"))


def test_operator_keeps_rows(spark):
    rows = [(1, "Hello world", 7), (1, "Hello world", 8), (None, None, None), (2, "", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids int")
    got = pieces.encoded(docs).withColumn("back", pieces.decoded(pieces.F.col("ids"))).collect()
    assert len(got) == 4
    assert [r["back"] for r in got] == ["Hello world", "Hello world", "", ""]
    assert got[0]["ids"] == library(pieces.MODEL).encode("Hello world") and got[2]["ids"] == []
    assert pieces.encoded(docs.limit(0)).collect() == []


def test_batches_are_cut_by_ids(spark, monkeypatch):
    monkeypatch.setattr(pieces, "IDS_PER_BATCH", 5)
    docs = spark.createDataFrame([(i, f"text number {i}") for i in range(50)], "doc_id long, text string").coalesce(1)
    got = {r["doc_id"]: r["ids"] for r in pieces.encoded(docs).collect()}
    assert got == {i: library(pieces.MODEL).encode(f"text number {i}") for i in range(50)}


def test_query_equals_the_library(spark):
    theirs = library(pieces.MODEL)
    texts = {r["doc_id"]: r["text"] or "" for r in pieces.read(spark, FOLDER, "documents").collect()}
    rows = pieces.op13_pieces(spark, FOLDER).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = theirs.encode(texts[r["doc_id"]])
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(theirs.decode(ids).encode()).hexdigest()
