"""Piece encoding and decoding against the sentencepiece library."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from strataforge.llm import pieces

PATH = public_tokenizers.path("piece_bpe_32k.model")
DATA = pieces.read_model(PATH)
ODD = ["a", "b", "e", "n", "t", " ", "  ", "\n", "\r", "\t", "▁", "é", "日本", "", "\U0001F600", "0", ";", ")", "}", "*/", "ing", "the",
       "\x00", "́", "​", "�", "<s>", "<0x41>", "==", "\xa0"]


@pytest.fixture(scope="module")
def lib():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


def ids_of(m, text):
    return np.frombuffer(m.encode(text), np.int32).tolist()


def test_encoding_equals_the_library(lib):
    m, rng = pieces.model(DATA), random.Random(5)
    for k in range(8000):
        text = " " * (rng.randint(0, 70) if k % 7 == 0 else 0) + "".join(rng.choice(ODD) for _ in range(rng.choice([1, 4, 12, 60])))
        assert ids_of(m, text) == lib.encode(text), repr(text)


@settings(max_examples=400, deadline=None)
@given(st.text(max_size=80))
def test_any_text(text):
    text = text.encode("utf-8", "ignore").decode()
    m, lib = pieces.model(DATA), sentencepiece.SentencePieceProcessor(model_file=PATH)
    ids = ids_of(m, text)
    assert ids == lib.encode(text)
    assert m.decode(np.array(ids, np.int64)) == lib.decode(ids)


def test_decoding_of_any_ids_equals_the_library(lib):
    m, rng = pieces.model(DATA), random.Random(6)
    for _ in range(6000):
        ids = [rng.choice([rng.randrange(32000), rng.randrange(3), rng.randrange(3, 259), rng.randrange(131, 259), 259, 28705])
               for _ in range(rng.randint(0, 8))]
        assert m.decode(np.array(ids, np.int64)) == lib.decode(ids), ids


def test_long_texts_without_blanks(lib):
    m = pieces.model(DATA)
    for text in ("a" * 30_000, " " * 20_000, "abcdefg" * 4_000, "=" * 9_999 + "-" * 9_999, "\U0001F600" * 3000, "the" * 7000 + "\n" * 5000):
        assert ids_of(m, text) == lib.encode(text)


def test_forgetting_changes_nothing(lib):
    m = pieces.PieceModel(DATA)
    m.known.most = 3
    texts = ["one two three four five six seven"] * 3 + ["six five four one"]
    assert [ids_of(m, t) for t in texts] == lib.encode(texts)
    assert len(m.known) <= 3 and len(m.known.old) <= 3


def test_other_models_are_refused():
    from sentencepiece import sentencepiece_model_pb2
    proto = sentencepiece_model_pb2.ModelProto()
    proto.ParseFromString(DATA)
    proto.normalizer_spec.remove_extra_whitespaces = True
    with pytest.raises(ValueError):
        pieces.PieceModel(proto.SerializeToString())


def test_table(spark, frame, lib):
    texts = [None, "", "x", "  two  words ", "a\nb▁c", "\U0001F600", "x", "long " * 30_000]
    rows = [(k if k < 6 else 2, t) for k, t in enumerate(texts)]
    docs = frame(rows).selectExpr("*", "1 AS ids", "'a' AS decoded").unionByName(frame([(None, "no id")]).selectExpr("*", "1 AS ids", "'a' AS decoded"))
    got = sorted(tuple(r) for r in pieces.digest(pieces.round_trip(docs, DATA)).collect())

    def want(i, t):
        ids = lib.encode(t or "")
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        return i, len(ids), sha(",".join(map(str, ids))), sha(lib.decode(ids))
    assert got == sorted(want(*r) for r in rows)
    encoded = pieces.encode(docs, DATA)
    assert sorted(map(tuple, pieces.decode(encoded, DATA).collect())) == sorted((i, lib.decode(lib.encode(t or ""))) for i, t in rows)
    assert pieces.digest(pieces.round_trip(docs.limit(0), DATA)).collect() == []


def test_ids_outside_the_model_are_unknown(spark, lib):
    rows = spark.createDataFrame([(1, [264, None, 99_999]), (2, None), (3, [])], "doc_id long, ids array<int>")
    assert {r.doc_id: r.text for r in pieces.decode(rows, DATA).collect()} == {1: lib.decode([264, 0, 0]), 2: "", 3: ""}
