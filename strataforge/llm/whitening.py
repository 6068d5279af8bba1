"""Whitening of embeddings by polarisation.

With integer vectors x, count n and sums S, the covariance of two dimensions is
half of (variance of their sum - variance of one - variance of the other). So
the only squares that are summed are those of centred dimensions and of centred
sums of two dimensions, all in whole numbers: values are centred by the whole
part of the mean before they are squared, and what the fraction of the mean
leaves is put right exactly afterwards. The d (d + 1) / 2 sums come to the
driver as exact integers, the covariance matrix is rounded once, and its unit
eigenvectors (numpy's eigh) go back to all rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: x = floor(SCALE * c) + SHIFT
SCALE, SHIFT = 1024, 100_000
#: Values beyond are set to it: x stays exact in 64 bits whatever the entry (about a thousand million).
LARGEST = 1 << 40
#: Squares are summed in two limbs of so many bits once values need more; rows summed at a time.
LIMB, ROWS = 21, 1 << 12
COMPONENTS = 8


def vectors(table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, v array<double>): rows whose vector is not null and has neither null nor non-finite entries.

    Vectors of another length than the commonest (of equals, the longest) and
    empty ones cannot be set beside the rest and are left out too.
    """
    v = F.col(vector_col).cast("array<double>")
    rows = (table.select(F.col(id_col).cast("long").alias("vec_id"), v.alias("v"))
            .where(F.col("v").isNotNull() & (F.size("v") > 0)
                   & F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))))
    common = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).limit(1).collect()
    return rows.where(F.size("v") == (common[0].d if common else 0))


def whole(batch: pa.RecordBatch, d: int) -> np.ndarray:
    """x of a batch's vectors, one row each."""
    flat = batch.column(batch.schema.get_field_index("v")).flatten().to_numpy(zero_copy_only=False)
    x = np.floor(np.clip(flat * SCALE, -LARGEST, LARGEST)).astype(np.int64) + SHIFT
    return x.reshape(-1, d)


def _parts(batches: Iterator[pa.RecordBatch], d: int) -> Iterator[np.ndarray]:
    for b in batches:
        for k in range(0, b.num_rows, ROWS):
            yield whole(b.slice(k, ROWS), d)


class Fit:
    """Exact sums of the fit list, and the components made of them."""

    def __init__(self, n: int, sums: list[int], squares: dict[tuple[int, int], int]):
        """``squares``: of each pair i < j (i == j: one dimension), the sum of squares of y_i + y_j (y_i), y = x - sums // n."""
        d = len(sums)
        self.n, self.sums = n, sums
        self.mean = [s // n for s in sums]
        self.rest = [s - n * m for s, m in zip(sums, self.mean)]
        # sum of (n (y_i + y_j) - (r_i + r_j))^2 over n, where sum of y is r: n * squares - r^2
        spread = {(i, j): n * q - (self.rest[i] + (self.rest[j] if i != j else 0)) ** 2 for (i, j), q in squares.items()}
        self.variance = [Fraction(spread[i, i], n * n) for i in range(d)]
        self.covariance = np.empty((d, d))
        for i in range(d):
            self.covariance[i, i] = float(self.variance[i])
            for j in range(i + 1, d):
                both = Fraction(spread[i, j] - spread[i, i] - spread[j, j], 2 * n * n)
                self.covariance[i, j] = self.covariance[j, i] = float(both)
        values, axes = np.linalg.eigh(self.covariance)
        trace = float(sum(self.variance))
        some = values > max(values.max(initial=0.0), 0.0) * d * np.finfo(float).eps * 16
        order = np.argsort(-values, kind="stable")
        order = order[some[order]]
        #: eigenvalues by falling size (those without variance left out), unit eigenvectors as columns, shares of the trace
        self.values, self.axes = values[order], axes[:, order]
        self.explained = self.values / trace if trace > 0 else self.values

    def whitened(self, x: np.ndarray, k: int) -> np.ndarray:
        """Rows' coordinates on the first k components, over the components' standard deviations."""
        y = (x - np.array(self.mean, np.int64)).astype(float) - np.array(self.rest, float) / self.n
        return y @ (self.axes[:, :k] / np.sqrt(self.values[:k]))

    def deviation(self, x: np.ndarray) -> list[int | None]:
        """Per row the sum over dimensions of (n x - S)^2; None beyond 64 bits."""
        y = x - np.array(self.mean, np.int64)
        far = int(np.abs(y).max(initial=0)) * self.n + self.n
        if far * far * len(self.mean) < 1 << 63:
            return ((self.n * y - np.array(self.rest, np.int64)) ** 2).sum(1).tolist()
        wide = ((self.n * y.astype(object) - np.array(self.rest, object)) ** 2).sum(1)
        return [int(v) if v < 1 << 63 else None for v in wide]


def square_sums(y: np.ndarray) -> tuple[np.ndarray, ...]:
    """Limbs (high, mixed, low) of the sums of squares of each dimension and each sum of two, row by row of the upper triangle.

    The sum is high * 2^(2 LIMB) + mixed * 2^(LIMB + 1) + low."""
    d = y.shape[1]
    small = int(np.abs(y).max(initial=0)) * 2 < 1 << LIMB
    high, mixed, low = [], [], []
    for i in range(d):
        v = np.concatenate([y[:, i:i + 1], y[:, i:i + 1] + y[:, i + 1:]], axis=1)
        if small:
            low.append(np.einsum("ij,ij->j", v, v))
            continue
        h, r = v >> LIMB, v & ((1 << LIMB) - 1)
        high.append(np.einsum("ij,ij->j", h, h))
        mixed.append(np.einsum("ij,ij->j", h, r))
        low.append(np.einsum("ij,ij->j", r, r))
    none = np.zeros(d * (d + 1) // 2, np.int64)
    return tuple(np.concatenate(p) if p else none for p in (high, mixed, low))


def fit(rows: DataFrame) -> Fit | None:
    """The fit of ``vectors`` rows, in two passes; None without rows. One task sends d sums, then d (d + 1) / 2."""
    head = rows.limit(1).collect()
    if not head:
        return None
    d = len(head[0].v)

    def sums(batches: Iterator[pa.RecordBatch]):
        n, total = 0, np.zeros(d, object)
        for x in _parts(batches, d):
            n, total = n + len(x), total + x.sum(0)
        yield _exact(np.arange(d + 1), [[n, *map(int, total)]], ["s"])

    got = {r.k: int(r.s) for r in rows.select("v").mapInArrow(sums, "k int, s decimal(38,0)").groupBy("k").agg(F.sum("s").alias("s")).collect()}
    n, totals = got[0], [got[k + 1] for k in range(d)]
    mean = np.array([s // n for s in totals], np.int64)

    def squares(batches: Iterator[pa.RecordBatch]):
        limbs = np.zeros((3, d * (d + 1) // 2), object)
        for x in _parts(batches, d):
            limbs += np.array(square_sums(x - mean))
        value = (limbs[0] << 2 * LIMB) + (limbs[1] << LIMB + 1) + limbs[2]
        yield _exact(np.arange(len(value)), [value], ["s"])

    found = {r.k: int(r.s) for r in rows.select("v").mapInArrow(squares, "k int, s decimal(38,0)").groupBy("k").agg(F.sum("s").alias("s")).collect()}
    return Fit(n, totals, {pair: found[k] for k, pair in enumerate((i, j) for i in range(d) for j in range(i, d))})


def _exact(keys: np.ndarray, columns: list, names: list[str]) -> pa.RecordBatch:
    from decimal import Decimal

    return pa.RecordBatch.from_arrays([pa.array(keys.astype(np.int32)), *(pa.array([Decimal(int(v)) for v in c], pa.decimal128(38, 0)) for c in columns)],
                                      ["k", *names])


OUT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def whiten(table: DataFrame, components: int = COMPONENTS, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error), a row per kept row and component.

    Rows with a null vector, or a null or non-finite entry, are dropped
    (``vectors``); a null id stays null, and repeated rows count as often as
    they occur. Components without variance (as many as the vectors' rank lacks)
    cannot be whitened and are left out; fewer than two different vectors, or
    none, give no rows. Entries beyond about 10^9 count as that. ``deviation``
    is null where it passes 64 bits. ``identity_error`` is the largest absolute
    entry of the covariance of the returned components minus the identity.
    """
    rows = vectors(table, id_col, vector_col)
    f = fit(rows)
    if f is None or not len(f.values):
        return table.sparkSession.createDataFrame([], OUT)
    d, k = len(f.sums), min(components, len(f.values))

    def products(batches: Iterator[pa.RecordBatch]):
        total, first = np.zeros((k, k)), np.zeros(k)
        for x in _parts(batches, d):
            w = f.whitened(x, k)
            total, first = total + w.T @ w, first + w.sum(0)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(k * k + k, dtype=np.int32)), pa.array(np.concatenate([total.ravel(), first]))], ["k", "s"])

    got = {r.k: r.s for r in rows.select("v").mapInArrow(products, "k int, s double").groupBy("k").agg(F.sum("s").alias("s")).collect()}
    second = np.array([got[i] for i in range(k * k)]).reshape(k, k) / f.n
    first = np.array([got[k * k + i] for i in range(k)]) / f.n
    error = float(np.abs(second - np.outer(first, first) - np.eye(k)).max())

    def out(batches: Iterator[pa.RecordBatch]):
        for b in batches:
            for at in range(0, b.num_rows, ROWS):
                part = b.slice(at, ROWS)
                x = whole(part, d)
                m = len(x)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(np.repeat(np.arange(m), k))), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                     pa.array(np.full(m * k, f.n)), pa.array([v for v in f.deviation(x) for _ in range(k)], pa.int64()),
                     pa.array(f.whitened(x, k).ravel()), pa.array(np.tile(f.explained[:k], m)), pa.array(np.full(m * k, error))],
                    ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.mapInArrow(out, OUT)
