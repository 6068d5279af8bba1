"""Repeated passages against brute force."""

import random

import numpy as np
import pyarrow as pa
from brute import passages, words

from strataforge.llm import arrays, blocks, substring_dedup


def corpus(seed=1):
    rng = random.Random(seed)
    vocab = ["the", "of", "The", "é😀", "x", "yy"]
    shared = [[rng.choice(vocab + [f"w{i}" for i in range(50)]) for _ in range(rng.randint(5, 60))] for _ in range(15)]
    rows = [(3, None), (4, ""), (5, " \t\n"), (6, "one word"), (7, " ".join("abcdefghijklm")), (8, "\n".join("abcdefghijklm"))]
    for i in range(120):
        w = []
        for _ in range(rng.randint(0, 6)):
            w += rng.choice(shared)[rng.randint(0, 5):] if rng.random() < 0.6 else [f"u{rng.randrange(10**6)}" for _ in range(rng.randint(1, 30))]
        if rng.random() < 0.2:
            w += ["the"] * rng.randint(10, 60)
        rows.append((100 + i * 7 % 840, rng.choice([" ", "\n", " \x0b "]).join(w) + rng.choice(["", " "])))
    return rows


def run(df):
    return sorted((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in substring_dedup.digest(substring_dedup.repeated_passages(df)).collect())


def test_matches_brute_force(frame):
    rows = corpus()
    assert run(frame(rows)) == passages(rows)


def test_documents_table(spark):
    d = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    assert run(d) == passages([(r.doc_id, r.text) for r in d.collect()])


def test_runs_and_text(frame):
    text = " ".join(f"w{i}" for i in range(20))
    rows = {r.doc_id: r for r in substring_dedup.repeated_passages(frame([(1, text), (2, f"a  b {text}\nc"), (3, "z")])).collect()}
    assert rows[2].kept_text == "a b c" and [(r.start, r.end) for r in rows[2].repeats] == [(2, 22)]
    assert rows[1].kept_text == text and rows[1].repeats == [] and rows[3].kept_text == "z"


def test_edges(frame):
    assert run(frame([])) == []
    text = " ".join(f"w{i}" for i in range(20))
    got = run(frame([(None, text), (2, text), (2, text), (5, "the " * 300000), (6, "the " * 20)]))
    assert [g[:3] for g in got] == [(2, 20, 0), (2, 20, 0), (5, 300000, 0), (6, 20, 20)]


def test_words_and_packing():
    texts = ["", "a", " a b ", "é\x0bü\x1cx", None, " q"]
    t = arrays.Texts.of(pa.array(texts))
    w = arrays.Words(t)
    assert [t.data[a:b].tobytes().decode() for a, b in zip(w.starts, w.ends)] == [x for s in texts for x in words(s)]
    assert list(w.counts) == [len(words(s)) for s in texts]
    rng = np.random.default_rng(1)
    for n in (0, 1, 2, 1000):
        k = np.unique(rng.integers(0, 2**64 - 1, n, np.uint64))
        assert np.array_equal(blocks.unpack(blocks.pack(k)), k)
        assert blocks.cuts(k, 7)[-1] == len(k)
    v = rng.integers(0, 2**63, 500, np.uint64)
    for size in (1, 2, 5, 9, 64):
        assert np.array_equal(arrays.sliding_min(v, size), [v[i:i + size].min() for i in range(501 - size)])
