"""Token alignment against plain encodings and all pairs of overlapping tokens."""

import hashlib
import random
from collections import Counter

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from strataforge.llm import alignment, pieces

A_PATH, B_PATH = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
A, B = pieces.read_model(A_PATH), pieces.read_model(B_PATH)
ODD = ["a", "e", "n", "t", " ", "  ", "\n", "\r", "\t", "▁", "é", "日本", "", "\U0001F600", "0", "12", ";", ")", "*/", "ing", "the", "\x00",
       "́", "\xa0", "　", "\x1c", "\x85", "<|endoftext|>", "'s", "'", "==", "​", "ſ"]


@pytest.fixture(scope="module")
def brute():
    t = Tokenizer.from_file(A_PATH)
    t.encode_special_tokens = True
    sp = sentencepiece.SentencePieceProcessor(model_file=B_PATH)
    alphabet = alignment._byte_alphabet()

    def one(text):
        """(a ids, b ids, groups, links as (b, a)); None where a side does not give the text back."""
        if not text:
            return None
        raw = (" " + text).encode()
        a, b = t.encode(" " + text, add_special_tokens=False).ids, sp.encode(text)
        xs = [bytes(alphabet[c] for c in t.id_to_token(i)) for i in a]
        ys = [bytes([int(sp.id_to_piece(i)[3:5], 16)]) if sp.is_byte(i) else sp.id_to_piece(i).replace("▁", " ").encode() for i in b]
        if b"".join(xs) != raw or b"".join(ys) != raw:
            return None
        spans = lambda parts: [(sum(map(len, parts[:k])), sum(map(len, parts[:k + 1]))) for k in range(len(parts))]
        sx, sy = spans(xs), spans(ys)
        links = [(y, x) for x, (p, q) in zip(a, sx) for y, (u, v) in zip(b, sy) if max(p, u) < min(q, v)]
        cuts, out, before = sorted({e for _, e in sx} & {e for _, e in sy}), [], 0
        for c in cuts:
            out.append(",".join(str(i) for i, (_, e) in zip(a, sx) if before < e <= c) + "|"
                       + ",".join(str(i) for i, (_, e) in zip(b, sy) if before < e <= c))
            before = c
        return a, b, out, links
    return one


def random_texts(seed, n):
    rng = random.Random(seed)
    return ["".join(rng.choice(ODD) for _ in range(rng.choice([1, 3, 10, 40]))) for _ in range(n)]


def test_texts_against_all_pairs(brute):
    m = alignment.aligner(A, B)
    for text in random_texts(3, 4000):
        got, want = m.document(text), brute(text)
        assert (got is None) == (want is None), repr(text)
        if want:
            a, b, out, links = want
            keys = memoryview(got[3]).cast("I").tolist()
            assert got[:3] == (len(a), len(b), len(out)) and got[4] == ";".join(out), repr(text)
            assert sorted((k >> 16, k & 0xFFFF) for k in keys) == sorted(links), repr(text)


def test_table_with_corpus_counts(spark, frame, brute):
    texts = random_texts(4, 120) + [None, "", "mark ▁ here", "<|endoftext|>", "the the the", "the the the", "word " * 4000]
    rows = [(k, t) for k, t in enumerate(texts)] + [(5, texts[5])]
    docs = frame(rows).selectExpr("*", "1 AS pairs", "2 AS block").unionByName(frame([(None, "no id")]).selectExpr("*", "1 AS pairs", "2 AS block"))
    got = sorted(tuple(r[c] for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"))
                 for r in alignment.digest(alignment.align(docs, A, B)).collect())
    found = [(i, brute(t)) for i, t in rows]
    count = Counter(link for _, f in found if f for link in f[3])
    highest = {}
    for (b, _), n in count.items():
        highest[b] = max(highest.get(b, 0), n)
    want = []
    for i, f in found:
        if f is None:
            want.append((i, 0, 0, 0, 0, 0, 0, ""))
        else:
            a, b, out, links = f
            want.append((i, len(a), len(b), len(out), len(links), sum(count[x] == highest[x[0]] for x in links), sum(count[x] for x in links),
                         hashlib.sha256(";".join(out).encode()).hexdigest()))
    assert got == sorted(want)


def test_nothing(spark, frame):
    for rows in ([], [(1, None), (2, "")]):
        got = alignment.digest(alignment.align(frame(rows) if rows else frame([(1, "x")]).limit(0), A, B)).collect()
        assert [tuple(sorted(r.asDict().items())) for r in got] == [
            tuple(sorted({"doc_id": r.doc_id, "n_a": 0, "n_b": 0, "n_groups": 0, "n_links": 0, "n_best": 0, "count_sum": 0, "groups_sha256": ""}.items()))
            for r in got] and len(got) == len(rows)


def test_groups_of_a_general_list():
    # ends 2, 5, 6 against 3, 4, 6: one group, five overlaps
    n, links, text = alignment.groups([1, 2, 3], [7, 8, 9], [2, 3, 1], [3, 1, 2])
    assert (n, text) == (1, "1,2,3|7,8,9")
    assert sorted((k >> 16, k & 0xFFFF) for k in links) == [(7, 1), (7, 2), (8, 2), (9, 2), (9, 3)]
