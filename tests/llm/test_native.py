"""Exact dedup, mixing and decontamination on small odd inputs; the catalogue twins run on sf0.001."""

import math

import pytest
from brute import lower_az, sha, words

from strataforge.llm import decontam, exact_dedup, mixing
from strataforge.llm.queries import ORACLE, QUERIES


def _norm(v):
    return None if v is None or (isinstance(v, float) and math.isnan(v)) else v


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, "/root/testdata/sf0.001")
    cur = duck.execute(ORACLE[name])
    cols = [d[0] for d in cur.description]
    assert sorted(cols) == sorted(df.columns)
    got = sorted(tuple(map(_norm, r)) for r in df.select(*cols).collect())
    assert got == sorted(tuple(map(_norm, r)) for r in cur.fetchall())


def test_exact_groups(frame):
    rows = [(1, "A b"), (2, "a B"), (3, None), (4, ""), (5, "É"), (6, "é"), (9, "x"), (9, "x"), (None, "x")] + [(100 + i, "hot") for i in range(500)]
    got = {(r.doc_id, r.text_sha256): (r.keep_id, r.group_size, r.kept)
           for r in exact_dedup.exact_groups(frame(rows), max_heavy=8, tracked=64).collect()}
    assert len(got) == 506 + 1
    assert got[1, sha("a b")] == (2, 2, False) and got[2, sha("a b")] == (2, 2, True)
    assert got[3, sha("")] == (4, 2, False) and got[5, sha("É")] == (5, 1, True) and got[9, sha("x")] == (9, 2, True)
    assert got[100, sha("hot")] == (599, 500, False) and got[599, sha("hot")][2]
    assert exact_dedup.exact_groups(frame([])).collect() == []


def test_drop_exact_judges_repeated_ids_by_text(frame):
    rows = [(7, "a"), (9, "a"), (7, "b"), (None, "a")]
    assert sorted((r.doc_id, r.text) for r in exact_dedup.drop_exact(frame(rows)).collect()) == [(7, "b"), (9, "a")]


def targets(sizes):
    """Water level by repeated sharing."""
    w = {s: mixing.WEIGHTS[i % 3] for i, s in enumerate(sorted(sizes, key=lambda s: (s is None, s or "")))}
    got, open_, left = {}, set(sizes), float(sum(sizes.values()))
    while open_:
        share = {s: left * w[s] / sum(w[x] for x in open_) for s in open_}
        over = {s for s in open_ if share[s] > 3 * sizes[s]}
        if not over:
            return got | share
        for s in over:
            got[s] = 3.0 * sizes[s]
            left -= got[s]
        open_ -= over
    return got


def test_mix_targets_and_takings(frame):
    rows, n = [], 0
    for s, docs, size in (("a", 3, 2), ("b", 200, 30), (None, 40, 7), ("c", 90, 50), ("d", 5, 1), ("", 30, 11), ("é", 0, 0)):
        for i in range(docs):
            rows.append((n, " ".join(["w"] * (size + i % 3)), "en", s))
            n += 1
    rows += [(n, None, "en", "a"), (n + 1, "", "en", "zero"), (None, "w", "en", "a")]
    got = mixing.mix(frame(rows), ranges=8).collect()
    sizes = {}
    for i, t, _, s in rows[:-1]:
        sizes[s] = sizes.get(s, 0) + len(words(t))
    want = targets(sizes)
    taken = {}
    assert len(got) == len(rows) - 1
    for r in got:
        assert r.target == pytest.approx(want[r.source], rel=1e-9) and r.source_size == sizes[r.source]
        assert 0 <= r.taken <= 3 * r.size
        taken[r.source] = taken.get(r.source, 0) + r.taken
    assert all(abs(taken[s] - want[s]) <= 1 for s in want)
    assert sorted(map(tuple, got), key=str) == sorted(map(tuple, mixing.mix(frame(rows).repartition(5)).collect()), key=str)
    assert mixing.mix(frame([])).collect() == []


def test_mix_prefers_heavy_documents(frame, spark):
    rows = [(i, "w " * 10, "en", s) for i, s in enumerate(["a"] * 400 + ["b"] * 400)]
    q = spark.createDataFrame([(i, 4.0 if i % 2 else 1.0) for i in range(800)] + [(1, None), (3, -1.0)], "i long, q double")
    got = {r.doc_id: r.taken for r in mixing.mix(frame(rows), q).collect()}
    b = range(400, 800)
    assert sum(got[i] for i in b if i % 2) > 1.5 * sum(got[i] for i in b if not i % 2)


def test_decontamination_small(frame, spark):
    item = [f"q{i}" for i in range(40)]
    edited = item[:20] + ["zz"] + item[21:]
    rows = [(1, "x y " + " ".join(item) + " z"), (2, " ".join(item).upper()), (3, " ".join(item[:39])), (4, "a " * 50 + " ".join(edited)),
            (5, None), (6, ""), (7, " ".join(item[:8]) + " other words follow here and so on"), (8, "tiny one"), (9, "a tiny one"),
            (1, "x y " + " ".join(item) + " z"), (10, "the " * 50000), (None, " ".join(item))]
    bench = spark.createDataFrame([(100, " ".join(item)), (101, " ".join(item)), (102, None), (103, "Tiny  one"), (None, "a b c d e f")],
                                  "item_id long, text string")
    got = {(r.doc_id, r.item_id): (r.start, round(r.similarity, 3)) for r in decontam.contaminated(frame(rows), bench).collect()}
    assert {k for k in got if k[1] == 100} == {(1, 100), (2, 100), (3, 100), (4, 100)}
    assert got[1, 100] == (2, 1.0) == got[1, 101] and got[3, 100] == (0, 0.972) and got[4, 100] == (50, round(31 / 41, 3))
    assert got[8, 103] == (0, 1.0) and (9, 103) not in got and len(got) == 9
    assert decontam.contaminated(frame([]), bench).collect() == [] and decontam.contaminated(frame(rows), bench.limit(0)).collect() == []
    assert sorted(r.doc_id for r in decontam.drop_contaminated(frame(rows), bench).collect()) == [5, 6, 7, 9, 10]


def test_every_fingerprint_within_the_radius_shares_a_block():
    import random
    rng = random.Random(1)
    for _ in range(2000):
        a = rng.getrandbits(64)
        b = a
        for bit in rng.sample(range(64), rng.randint(0, decontam.RADIUS)):
            b ^= 1 << bit
        parts = lambda x: [(x >> (k * decontam.BITS)) & (2**decontam.BITS - 1) for k in range(decontam.BLOCKS)]
        assert any(x ^ y in decontam.MASKS for x, y in zip(parts(a), parts(b)))
    assert lower_az("ÉA") == "Éa"


def test_equal_rows_are_dropped_but_one(spark, frame):
    docs = frame([(1, "a b"), (1, "a b"), (1, "A b"), (1, "c"), (2, "x"), (2, "x")])
    assert sorted((r.doc_id, r.text.lower()) for r in exact_dedup.drop_exact(docs).collect()) == [(1, "a b"), (1, "c"), (2, "x")]
