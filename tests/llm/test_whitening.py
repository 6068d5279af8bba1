"""Whitening against plain numpy with fractions."""

from fractions import Fraction

import numpy as np

from strataforge.llm import whitening

ROWS = "vec_id long, embedding array<float>, label int"


def brute(vectors):
    """n, S, and the exact covariance matrix of the integer vectors."""
    x = [[int(np.floor(float(c) * 1024)) + 100_000 for c in v] for v in vectors]
    n, d = len(x), len(x[0])
    s = [sum(r[i] for r in x) for i in range(d)]
    cov = [[sum(Fraction(r[i] * n - s[i]) * (r[j] * n - s[j]) for r in x) / n ** 3 for j in range(d)] for i in range(d)]
    return x, n, s, np.array([[float(c) for c in r] for r in cov])


def check(got, vectors, ids, top=8):
    x, n, s, cov = brute(vectors)
    values, axes = np.linalg.eigh(cov)
    values, axes = values[::-1], axes[:, ::-1]
    k = min(top, int((values > values[0] * 1e-9).sum()))
    by = {}
    for r in got:
        by.setdefault(r.vec_id, {}).setdefault(r.component, []).append(r)
    assert len(got) == len(ids) * k
    centred = (np.array(x, float) - np.array(s) / n) @ axes[:, :k] / np.sqrt(values[:k])
    sign = {}
    for i, row, w in zip(ids, x, centred):
        for c in range(k):
            r = by[i][c + 1][0]
            assert r.n == n and r.deviation == sum((n * v - t) ** 2 for v, t in zip(row, s))
            assert abs(r.explained - values[c] / np.trace(cov)) < 1e-9 and r.identity_error < 1e-6
            if abs(w[c]) > 1e-6:
                sign.setdefault(c, np.sign(w[c] * r.whitened))
                assert abs(r.whitened * sign[c] - w[c]) < 1e-6 * max(1, abs(w[c]))


def test_against_fractions(spark):
    rng = np.random.default_rng(1)
    v = (rng.normal(size=(60, 12)) @ rng.normal(size=(12, 12)) * 0.3).astype(np.float32)
    rows = [(i, [float(c) for c in r], 0) for i, r in enumerate(v)]
    bad = [(100, None, 1), (101, [None] * 12, 1), (102, [float("nan")] * 12, 1), (103, [float("inf")] + [0.0] * 11, 1), (104, [], 1),
           (105, [1.0, 2.0], 1)]
    df = spark.createDataFrame(rows + bad, ROWS).withColumnsRenamed({"label": "v"}).repartition(5)
    check(whitening.whiten(df).collect(), v, range(60))


def test_large_values_stay_exact(spark):
    rng = np.random.default_rng(2)
    v = [[float(np.float32(c)) for c in r] for r in rng.normal(size=(30, 4)) * 3e6]
    df = spark.createDataFrame([(i, r, 0) for i, r in enumerate(v)], ROWS)
    f = whitening.fit(whitening.vectors(df))
    assert np.array_equal(f.covariance, brute(v)[3])
    y = np.array([[1 << 40, -5], [(1 << 40) - 7, 3]], np.int64)
    high, mixed, low = whitening.square_sums(y)
    for k, (i, j) in enumerate([(0, 0), (0, 1), (1, 1)]):
        want = sum((int(r[i]) + (int(r[j]) if i != j else 0)) ** 2 for r in y)
        assert (int(high[k]) << 42) + (int(mixed[k]) << 22) + int(low[k]) == want


def test_deviation_beyond_64_bits_is_null(spark):
    df = spark.createDataFrame([(1, [9e8, 0.0], 0), (2, [-9e8, 1.0], 0), (3, [0.0, 0.0], 0)] * 2000, ROWS)
    got = {r.vec_id: r for r in whitening.whiten(df).collect() if r.component == 1}
    assert got[1].deviation is None and got[1].n == 6000


def test_repeated_rows_and_null_ids(spark):
    v = [[1.0, 2.0], [3.0, -1.0], [0.5, 0.25], [0.5, 0.25]]
    df = spark.createDataFrame([(None, v[0], 0), (1, v[1], 0), (2, v[2], 0), (2, v[3], 0)], ROWS)
    got = whitening.whiten(df).collect()
    assert len(got) == 8 and sum(r.vec_id is None for r in got) == 2
    x, n, s, cov = brute(v)
    assert {r.n for r in got} == {4}


def test_no_variance_and_no_rows(spark):
    same = spark.createDataFrame([(1, [1.0, 2.0], 0), (2, [1.0, 2.0], 0)], ROWS)
    assert whitening.whiten(same).collect() == []
    assert whitening.whiten(same.limit(0)).collect() == []
    assert whitening.whiten(spark.createDataFrame([(1, None, 0)], ROWS)).collect() == []
    line = spark.createDataFrame([(i, [float(i), 2.0 * i, 5.0], 0) for i in range(5)], ROWS)
    got = whitening.whiten(line).collect()
    assert {r.component for r in got} == {1} and abs(got[0].explained - 1) < 1e-9
