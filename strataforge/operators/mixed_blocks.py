"""Mixed models whose largest factor has very many levels.

The model and its fixed point are those of ``model.fit_mixed``. The normal
equations X'WX are summed as a distributed sparse matrix with one row per level
of the largest factor: every cell has one such level, so that block of the
matrix is diagonal and is eliminated exactly (Schur complement). What reaches
the driver is the block of the other coefficients (q x q, q = 2 + the levels of
the other factors) and sums of that size over all levels; no task sends a matrix
of all levels and nothing of that size is inverted.

One pass weighs the cells: buckets of cells meet the rows of their levels, and
their sparse sums are added by (level, column). Cells of a level with more than
``cells_per_task`` are dealt over several buckets. Between passes only the level
rows are read: the eliminated sums for one precision of the largest factor are
one job.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ENTRIES = "g string, j int, v double"
#: Levels whose effects are also kept on the driver's Fit; more stay in its frame only.
LOCAL_LEVELS = 100_000
#: Numbers in the level rows up to which the driver eliminates them itself.
LOCAL_NUMBERS = 200_000
#: Numbers of a dense piece of the level rows inside a task.
DENSE = 4_000_000
MOST_SMALL = 4_000


def _weights(n: np.ndarray, psi: np.ndarray, var: np.ndarray) -> np.ndarray:
    c = np.sqrt(psi * psi + np.maximum(var, 0.0))
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(c > 1e-8, n * np.tanh(c / 2.0) / (2.0 * c), n / 4.0)


def _dense(table: pa.Table, q: int) -> np.ndarray:
    """Level rows (lists j, v) as a matrix."""
    out = np.zeros((table.num_rows, q))
    js, vs = table.column("j").combine_chunks(), table.column("v").combine_chunks()
    size = np.diff(js.offsets.to_numpy())
    out[np.repeat(np.arange(table.num_rows), size), js.flatten().to_numpy()] = vs.flatten().to_numpy()
    return out


class Posterior:
    """Means and covariance of the small block, and the precision of the largest factor's effects."""

    def __init__(self, mean: np.ndarray, cov: np.ndarray, tau: float):
        self.mean, self.cov, self.tau = mean, cov, tau

    def levels(self, kap: np.ndarray, d: np.ndarray, c: np.ndarray):
        """Of levels with right sides kap, diagonal d and rows c: mean, variance, and covariance with the small block."""
        full = d + self.tau
        u = c @ self.cov
        return (kap - c @ self.mean) / full, 1.0 / full + np.einsum("ij,ij->i", u, c) / full ** 2, -u / full[:, None]


def _entries(level_names: list, d: np.ndarray, c: np.ndarray, small: np.ndarray) -> pa.Table:
    """Sums of a piece as rows: (level, column, value), column -1 for the diagonal, no level for the small block."""
    at, j = np.nonzero(c)
    si, sj = np.nonzero(small)
    q = small.shape[0]
    names = pa.array(level_names, pa.string())
    g = pa.concat_arrays([names, names.take(pa.array(at)), pa.nulls(len(si), pa.string())])
    return pa.table([g, pa.array(np.concatenate([np.full(len(d), -1), j, si * q + sj]).astype(np.int32)),
                     pa.array(np.concatenate([d, c[at, j], small[si, sj]]))], ["g", "j", "v"])


def _weighed(cells: pa.Table, rows: pa.Table | None, post: Posterior | None, q: int, k: int) -> pa.Table:
    """Sparse sums of the cells of a bucket under the last posterior (first pass: at psi = 0)."""
    g = cells.column("g").combine_chunks().dictionary_encode()
    names, level = g.dictionary, g.indices.to_numpy()
    order = np.argsort(level, kind="stable")
    x, n = (cells.column(c).to_numpy()[order] for c in ("x", "n"))
    small = [cells.column(f"i{i}").to_numpy()[order] for i in range(k)]
    level = level[order]
    idx = np.column_stack([np.zeros(len(x), np.int64), np.ones(len(x), np.int64), *small])
    val = np.column_stack([np.ones(len(x)), x, *[np.ones(len(x))] * k])
    step, block, out = max(1, DENSE // q), np.zeros((q, q)), []
    if rows is not None:
        place = {name: i for i, name in enumerate(rows.column("g").to_pylist())}
        at = np.array([place[name] for name in names.to_pylist()])
    for lo in range(0, len(names), step):
        hi = min(lo + step, len(names))
        cut = slice(*np.searchsorted(level, [lo, hi]))
        lev, ii, vv, nn = level[cut] - lo, idx[cut], val[cut], n[cut]
        if rows is None:
            w = nn / 4.0
        else:
            part = rows.take(pa.array(at[lo:hi]))
            mean, var, cross = post.levels(part.column("kap").to_numpy(), part.column("d").to_numpy(), _dense(part, q))
            psi = (vv * post.mean[ii]).sum(1) + mean[lev]
            spread = (np.einsum("bk,bkl,bl->b", vv, post.cov[ii[:, :, None], ii[:, None, :]], vv)
                      + 2 * (vv * cross[lev[:, None], ii]).sum(1) + var[lev])
            w = _weights(nn, psi, spread)
        c = np.zeros((hi - lo, q))
        for a in range(ii.shape[1]):
            np.add.at(c, (lev, ii[:, a]), w * vv[:, a])
            np.add.at(block, (ii[:, a][:, None], ii), (w * vv[:, a])[:, None] * vv)
        out.append(_entries(names[lo:hi].to_pylist(), np.bincount(lev, w, hi - lo), c, np.zeros((q, q))))
    out.append(_entries([], np.zeros(0), np.zeros((0, q)), block))
    return pa.concat_tables(out)


def _eliminated(rows: pa.Table, tau: float, q: int) -> np.ndarray:
    """Sums over levels that eliminate them, end to end: of cc'/D, cc'/D^2, c b/D, c b/D^2, 1/D and b^2/D^2, D = d + tau."""
    total, step = np.zeros(2 * q * q + 2 * q + 2), max(1, DENSE // q)
    for lo in range(0, rows.num_rows, step):
        part = rows.slice(lo, step)
        c, b = _dense(part, q), part.column("kap").to_numpy()
        full = part.column("d").to_numpy() + tau
        one, two = c / full[:, None], c / full[:, None] ** 2
        total += np.concatenate([(c.T @ one).ravel(), (c.T @ two).ravel(), one.T @ b, two.T @ b, [(1 / full).sum(), ((b / full) ** 2).sum()]])
    return total


def _moments(level_rows: DataFrame | pa.Table, tau: float, q: int) -> dict[str, np.ndarray]:
    """``_eliminated`` of all level rows, by name."""
    def partial(batches: Iterator[pa.RecordBatch]):
        total = sum((_eliminated(pa.Table.from_batches([b]), tau, q) for b in batches), np.zeros(2 * q * q + 2 * q + 2))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total), dtype=np.int32)), pa.array(total)], ["k", "s"])

    if isinstance(level_rows, pa.Table):
        total = _eliminated(level_rows, tau, q)
    else:
        got = level_rows.mapInArrow(partial, "k int, s double").groupBy("k").agg(F.sum("s").alias("s")).toArrow()
        total = np.zeros(2 * q * q + 2 * q + 2)
        total[got.column("k").to_numpy()] = got.column("s").to_numpy()
    parts = np.split(total, np.cumsum([q * q, q * q, q, q, 1]))
    return dict(zip(("m1", "m2", "r1", "r2", "s1", "s2"), (parts[0].reshape(q, q), parts[1].reshape(q, q), *parts[2:])))


def fit_blocks(spark: SparkSession, cell_df: DataFrame, factors: Sequence[str], covariate: str, max_iter: int = 200,
               tol: float = 1e-6, fixed_precision: float = 1e-4, prior_a: float = 1e-3, prior_b: float = 1e-3,
               min_variance: float = 1e-4, cells_per_task: int = 250_000, inner_iter: int = 12, local_numbers: int = LOCAL_NUMBERS):
    """M1 / M2 by block elimination of the factor with the most levels; see ``model.fit_mixed``.

    ``cell_df`` is read once per pass and should be materialised. The effects of
    the largest factor come as a distributed frame (``Fit.level_frames``), and
    on the driver too while they are at most ``LOCAL_LEVELS``. Up to
    ``local_numbers`` numbers the summed level rows are eliminated on the driver
    (fewer jobs, the same sums)."""
    from strataforge.operators.model import Fit

    count = cell_df.agg(*[F.count_distinct(g).alias(g) for g in factors]).first()
    big = max(factors, key=lambda g: count[g])
    others = [g for g in factors if g != big]
    if sum(count[g] for g in others) > MOST_SMALL:
        raise ValueError(f"factors beside the largest have more than {MOST_SMALL} levels together")
    levels = {g: [r[0] for r in cell_df.select(g).distinct().orderBy(g).collect()] for g in others}
    offsets, q = {}, 2
    for g in others:
        offsets[g], q = q, q + len(levels[g])
    k, n_levels = len(others), count[big]

    half = F.col("s") - F.col("n") / 2
    lv = (cell_df.groupBy(F.col(big).cast("string").alias("g")).agg(F.sum(half).alias("kap"), F.count(F.lit(1)).alias("cells"))
          .withColumn("k", F.ceil(F.col("cells") / cells_per_task).cast("int")).checkpoint(eager=True))
    parts = max(1, -(-int(lv.agg(F.sum("cells")).first()[0]) // cells_per_task))
    x = cell_df.select(F.col(big).cast("string").alias("g"), F.col(covariate).cast("double").alias("x"), "s", "n", *others)
    for i, g in enumerate(others):
        at = spark.createDataFrame([(v, offsets[g] + j) for j, v in enumerate(levels[g])], f"`{g}` {dict(cell_df.dtypes)[g]}, i{i} int")
        x = x.join(F.broadcast(at), g)           # at most MOST_SMALL levels
    bucket = lambda sub: F.pmod(F.xxhash64("g", sub), F.lit(parts)).cast("int").alias("bucket")
    sub = F.pmod(F.xxhash64("x", *[f"i{i}" for i in range(k)]), F.col("k"))
    x = (x.join(lv.select("g", "k"), "g").withColumn("sub", sub.cast("int"))
         .select(bucket(F.col("sub")), "g", "x", "s", "n", *[f"i{i}" for i in range(k)]).checkpoint(eager=True))
    b = np.zeros(q)
    sums = x.agg(F.sum(half).alias("a"), F.sum(half * F.col("x")).alias("b")).first()
    b[:2] = sums["a"], sums["b"]
    for i in range(k):
        for r in x.groupBy(f"i{i}").agg(F.sum(half).alias("v")).collect():
            b[r[0]] = r["v"]

    tau = {g: 1.0 for g in factors}
    post = rows = None
    converged = singular = False
    it = 0
    for it in range(1, max_iter + 1):
        if post is None:
            entries = x.groupBy("bucket").applyInArrow(lambda t: _weighed(t, None, None, q, k), ENTRIES)
        else:
            last = post
            entries = x.groupBy("bucket").cogroup(rows.groupBy("bucket")).applyInArrow(
                lambda t, r: _weighed(t, r, last, q, k), ENTRIES)
        total = entries.groupBy("g", "j").agg(F.sum("v").alias("v")).checkpoint(eager=True)
        small = np.zeros(q * q)
        for r in total.where(F.col("g").isNull()).collect():
            small[r.j] = r.v
        small = small.reshape(q, q)
        rows = (total.where(F.col("g").isNotNull()).groupBy("g")      # at most q + 1 entries a level
                .agg(F.max(F.when(F.col("j") < 0, F.col("v"))).alias("d"),
                     F.array_sort(F.collect_list(F.when(F.col("j") >= 0, F.struct("j", "v")))).alias("c"))
                .join(lv.select("g", "kap", "k"), "g")
                .select("g", "kap", "d", F.transform("c", lambda e: e["j"]).alias("j"), F.transform("c", lambda e: e["v"]).alias("v"),
                        F.explode(F.sequence(F.lit(0), F.col("k") - 1)).alias("sub"))
                .select(bucket(F.col("sub")), "sub", "g", "kap", "d", "j", "v").checkpoint(eager=True))
        own = rows.where("sub = 0")
        level_rows = own.toArrow() if n_levels * q <= local_numbers else own
        before = None if post is None else post.mean
        moved = 0.0
        for _ in range(inner_iter):
            m = _moments(level_rows, tau[big], q)
            for _local in range(50):      # the small block's precisions settle without reading levels
                prec = np.full(q, fixed_precision)
                for g in others:
                    prec[offsets[g]:offsets[g] + len(levels[g])] = tau[g]
                cov = np.linalg.inv(small + np.diag(prec) - m["m1"])
                mean = cov @ (b - m["r1"])
                step = 0.0
                for g in others:
                    at = slice(offsets[g], offsets[g] + len(levels[g]))
                    ss = float(mean[at] @ mean[at] + np.trace(cov[at, at]))
                    new = (len(levels[g]) / 2.0 + prior_a) / (ss / 2.0 + prior_b)
                    step, tau[g] = max(step, abs(new - tau[g]) / max(tau[g], 1e-12)), new
                moved = max(moved, step) if _local == 0 else moved
                if step < 1e-8:
                    break
            ss = float(m["s2"][0] - 2 * mean @ m["r2"] + mean @ m["m2"] @ mean + m["s1"][0] + np.sum(cov * m["m2"]))
            new = (n_levels / 2.0 + prior_a) / (ss / 2.0 + prior_b)
            step = abs(new - tau[big]) / max(tau[big], 1e-12)
            post = Posterior(mean, cov, tau[big])
            moved, tau[big] = max(moved, step), new
            if step < tol / 10:
                break
        if before is not None and float(np.max(np.abs(post.mean - before))) < tol and moved < 10 * tol:
            converged = True
            break
        if all(1.0 / t < min_variance for t in tau.values()):
            singular = True
            break

    def effects(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for lo in range(0, batch.num_rows, max(1, DENSE // q)):
                part = pa.Table.from_batches([batch.slice(lo, max(1, DENSE // q))])
                mean, var, _ = post.levels(part.column("kap").to_numpy(), part.column("d").to_numpy(), _dense(part, q))
                yield pa.RecordBatch.from_arrays([part.column("g").combine_chunks(), pa.array(mean), pa.array(np.sqrt(var))], ["level", "m", "s"])

    frame = own.mapInArrow(effects, "level string, m double, s double").checkpoint(eager=True)
    fit = Fit("mixed" if len(factors) > 1 else "mixed_area", ["(Intercept)", covariate], post.mean[:2].copy(), post.cov[:2, :2].copy(),
              {g: 1.0 / tau[g] for g in factors}, dict(levels), {}, {}, it, converged)
    sd = np.sqrt(np.maximum(np.diag(post.cov), 0.0))
    for g in others:
        at = slice(offsets[g], offsets[g] + len(levels[g]))
        fit.level_means[g], fit.level_sds[g] = post.mean[at], sd[at]
    fit.level_frames[big] = frame
    if n_levels <= LOCAL_LEVELS:
        got = frame.orderBy("level").collect()
        fit.levels[big] = [r.level for r in got]
        fit.level_means[big], fit.level_sds[big] = (np.array([r[c] for r in got]) for c in ("m", "s"))
    fit.singular = singular
    return fit
