"""Repeated byte strings against brute force."""

import random

import pytest
from brute import byte_strings

from strataforge.llm import suffix_dedup


def corpus(seed=1, length=60):
    rng = random.Random(seed)
    letters = "abcdefé "
    piece = lambda n: "".join(rng.choice(letters) for _ in range(n))
    shared = [piece(rng.randint(length // 2, 5 * length)) for _ in range(8)]
    rows = [(1, None), (2, ""), (3, "ab" * 200), (4, "a" * 300), (5, "x" * (length - 1)), (6, "a" * length)]
    for i in range(150):
        t = ""
        for _ in range(rng.randint(0, 4)):
            s = rng.choice(shared)
            a = rng.randint(0, len(s) // 2)
            t += s[a:rng.randint(a, len(s))] if rng.random() < 0.7 else piece(rng.randint(1, 2 * length))
        rows.append((10 + i * 13 % 151, t))
    rows += [(1000, rows[20][1]), (1001, rows[20][1])]
    return rows


def run(df, **kw):
    return sorted(tuple(r) for r in suffix_dedup.digest(suffix_dedup.repeated_bytes(df, **kw)).collect())


@pytest.mark.parametrize("crowd", [3, 512])
@pytest.mark.parametrize("keep_first", [False, True])
def test_matches_brute_force(frame, crowd, keep_first):
    rows = corpus(seed=crowd)
    got = run(frame(rows), length=60, seed=8, keep_first=keep_first, crowd=crowd, chunk=16)
    assert got == byte_strings(rows, 60, keep_first)


def test_left_and_right_partners_differ(frame):
    """An anchor whose left side matches one document and whose right side another has no common string."""
    rng = random.Random(5)
    a, b = ("".join(rng.choice("abcdefgh") for _ in range(45)) for _ in range(2))
    rows = [(1, a + b), (2, "z" * 70 + a + b[:14]), (3, a[-14:] + b + "y" * 70), (4, a + b[:20]), (5, a[-15:] + b)]
    assert run(frame(rows), length=60, seed=8, keep_first=False) == byte_strings(rows, 60)


def test_documents_table(spark):
    d = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    assert run(d, keep_first=False) == byte_strings([(r.doc_id, r.text) for r in d.collect()])


def test_edges(frame):
    assert run(frame([]), keep_first=False) == []
    rng = random.Random(3)
    t = "".join(rng.choice("abcd") for _ in range(500))
    got = run(frame([(None, t), (1, t), (1, t), (2, "q" * 300000)]), keep_first=False)
    assert [g[:4] for g in got] == [(1, 500, 500, 1), (1, 500, 500, 1), (2, 300000, 300000, 1)]
    assert [g[2] for g in run(frame([(1, t), (2, t)]))] == [0, 500]


@pytest.mark.parametrize("seed, letters, length", [(1, "\0ab", 20), (5, "\0a", 60)])
def test_zero_bytes(frame, seed, letters, length):
    """Contexts that end in padding lie among those that go on with zero bytes; no repeat may be lost there."""
    rng = random.Random(seed)
    piece = lambda n: "".join(rng.choice(letters) for _ in range(n))
    shared = [piece(rng.randint(length // 2, 4 * length)) for _ in range(6)]
    rows = []
    for i in range(240):
        t = ""
        for _ in range(rng.randint(0, 4)):
            s = rng.choice(shared)
            a = rng.randint(0, len(s) // 2)
            t += s[a:rng.randint(a, len(s))] if rng.random() < 0.7 else "\0" * rng.randint(0, length) + piece(rng.randint(1, 2 * length))
        rows.append((i, t))
    for keep_first in (False, True):
        got = run(frame(rows), length=length, seed=8, keep_first=keep_first)
        assert got == byte_strings(rows, length, keep_first)


def test_planted_passages_by_bytes(frame):
    """Passages of over 50 words in three documents each: removed whole from 400 bytes on, else left."""
    rng = random.Random(7)
    words = lambda n: " ".join("".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 9))) for _ in range(n))
    planted = [words(rng.randint(51, 80)) for _ in range(40)]
    rows = [(i, f"{words(60)} {planted[i % 40]} {words(60)}") for i in range(120)] + [(i, words(170)) for i in range(120, 160)]
    got = run(frame(rows), keep_first=False)
    assert got == byte_strings(rows, 400)
    assert {len(p) >= 400 for p in planted} == {False, True}
    assert all(g[2] >= len(planted[i % 40]) for i, g in enumerate(got[:120]) if len(planted[i % 40]) >= 400)
    assert not any(g[2] for g in got[120:])
