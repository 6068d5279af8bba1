"""The n-gram model against a dictionary version, and its tries."""

import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from brute import lower_az, words
from pyspark.sql import functions as F

from strataforge.llm import lm_score
from strataforge.llm.queries import QUERIES


def model(rows, training):
    """(doc_id -> tokens, known, N, base, score), with the same 8-bit codes."""
    toks = {i: [*words(lower_az(t)), "</s>"] for i, t in rows}
    c1, c2, c3 = Counter(), defaultdict(Counter), defaultdict(Counter)
    for i, t in toks.items():
        if training(i):
            h = ["<s>", *t]
            c1.update(t)
            for a, b in zip(h, h[1:]):
                c2[a][b] += 1
            for a, b, c in zip(h, h[1:], h[2:]):
                c3[a, b][c] += 1
    n, v, d = sum(c1.values()), len(c1), lm_score.DISCOUNT
    q = lambda x: float(lm_score._VALUE[lm_score.quantise(np.array([x]))[0]])

    def part(table, h, w, below):
        if not table.get(h):
            return below
        total = sum(table[h].values())
        own = q((table[h][w] - d) / total) if table[h][w] else 0.0
        return own + q(d * len(table[h]) / total) * below

    out = {}
    for i, t in toks.items():
        h, base, full = ["<s>", *t], 0.0, 0.0
        for k in range(1, len(h)):
            p = (c1[h[k]] + 1) / (n + v + 1)
            base += math.log10(p)
            p = part(c2, h[k - 1], h[k], p)
            if k > 1:
                p = part(c3, (h[k - 2], h[k - 1]), h[k], p)
            full += math.log10(p)
        out[i] = (len(t), sum(c1[w] > 0 for w in t), n, base, full)
    return out


def same(got, want):
    assert set(got) == set(want)
    for i, w in want.items():
        assert got[i][:3] == w[:3]
        assert got[i][3:] == pytest.approx(w[3:], rel=1e-9, abs=1e-9)


def test_matches_dictionaries(frame):
    rng = random.Random(3)
    vocab = ["the", "The", "of", "é😀"] + [f"w{i}" for i in range(30)]
    rows = [(0, None), (1, ""), (2, " \n"), (3, "one")] + [
        (10 + i, " ".join(rng.choice(vocab) for _ in range(rng.randint(1, 60)))) for i in range(150)]
    got = {r.doc_id: tuple(r)[1:] for r in lm_score.score(frame(rows), F.col("doc_id") % 3 != 0).collect()}
    same(got, model(rows, lambda i: i % 3 != 0))


def test_documents_table(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    held = lambda i: zlib.crc32(str(i).encode()) % 7 == 2
    got = QUERIES["op1_lm_score"](spark, sf).collect()
    assert all(r.held_out == held(r.doc_id) for r in got)
    same({r.doc_id: (r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in got}, model(rows, lambda i: not held(i)))
    out = [r for r in got if r.held_out]
    assert sum(r.score for r in out) > sum(r.base_score for r in out)


def test_edges(frame):
    assert lm_score.score(frame([]), F.lit(True)).collect() == []
    got = lm_score.score(frame([(None, "a"), (1, "a b"), (1, "a b"), (2, None)]), F.lit(False)).collect()
    assert sorted(tuple(r) for r in got) == [(1, 3, 0, 0, 0.0, 0.0)] * 2 + [(2, 1, 0, 0, 0.0, 0.0)]
    long = lm_score.score(frame([(5, "word " * 300000)]), F.lit(True)).first()
    assert (long.n_tokens, long.n_known, long.train_tokens) == (300001, 300001, 300001) and long.score > -1000


def test_elias_fano_round_trip():
    rng = np.random.default_rng(2)
    for v in ([0], [0, 0, 0], [5], [0, 1, 2, 3], np.sort(rng.integers(0, 10**9, 5000)), np.cumsum(rng.integers(0, 4, 3000))):
        v = np.asarray(v, np.int64)
        data = np.frombuffer(b"xx" + lm_score.EliasFano.encode(v), np.uint8)
        ef, end = lm_score.EliasFano.view(data, 2)
        assert end == len(data) and np.array_equal(ef.get(np.arange(len(v))), v)


def test_trie_file_is_memory_mapped(frame, tmp_path):
    rows = [(i, f"a b c{i % 5} a b") for i in range(50)]
    shards = lm_score.train(frame(rows)).collect()
    words = pairs = triples = 0
    for r in shards:
        (tmp_path / str(r.shard)).write_bytes(r.trie)
        t = lm_score.Trie.open(str(tmp_path / str(r.shard)))
        assert isinstance(t.counts, np.memmap) or not len(t.words)
        words, pairs, triples = words + len(t.words), pairs + len(t.next2), triples + len(t.next3)
    # a b c0-c4 end begin; begin-a a-b b-c* c*-a b-end; begin-a-b a-b-c* b-c*-a c*-a-b a-b-end
    assert (words, pairs, triples) == (9, 1 + 1 + 5 + 5 + 1, 1 + 5 + 5 + 5 + 1)


def test_counts_beyond_32_bits():
    big = np.array([3, (1 << 32) + 5, 1 << 40], np.int64)
    assert lm_score._smalls(lm_score._small(big), 1)[0].tolist() == big.tolist()
    none = np.zeros(0, np.int64)
    data = lm_score.Trie.build(np.array([7, 8, 9], np.uint64), big, none.astype(np.uint64), none, none.astype(np.uint64), none)
    trie = lm_score.Trie.view(np.frombuffer(data, np.uint8))
    assert trie.counts[trie.find1(np.array([8, 9], np.uint64))].tolist() == big[1:].tolist()
