"""Binomial models and covariate preparation
(F21-F23, A12, J4).

Fitting works on *cells*: the survey collapsed to one row per distinct
(factor levels, covariates) with successes ``s`` and trials ``n``, which is
exact for binomial data and bounded by the number of strata, not by the
number of respondents.

M1 is mean-field variational inference with Polya-Gamma augmentation
(Polson, Scott and Windle 2013; the variational form used for crossed
random intercepts by Goplerud 2022). Each pass is ONE Spark job over the
cells: every task scores its Arrow batches with numpy against the broadcast
posterior (mean ``m``, covariance ``V``) and emits its partial X'WX; the
partials are added up (P(P+1)/2 numbers, P = 2 + total levels, at most
``DENSE_LEVELS``; more levels: ``mixed_blocks``) and reach the driver, which solves the small system and updates the variances. Between
passes the exact (m, V) and variance updates are repeated on the driver with
the pass's weights fixed (a coordinate-ascent schedule with the same fixed
point), which cuts the number of data passes from ~30-100 to ~5.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strataforge.operators.mixed_blocks import fit_blocks
from strataforge.session import ensure_checkpoint_dir

#: Levels of all factors together up to which the normal equations are solved as one dense matrix.
DENSE_LEVELS = 500


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ----------------------------------------------------------- covariates

def zscore(df: DataFrame, col: str, out: str | None = None) -> DataFrame:
    """(x - mean) / sample sd; mean and sd are scalar subqueries
    (computed once, no join)."""
    stats = df.select(F.avg(col).alias("m"), F.stddev_samp(col).alias("s"))
    m = stats.select("m").scalar()
    s = stats.select("s").scalar()
    return df.withColumn(out or f"{col}_z", F.try_divide(F.col(col) - m, s))


def max_normalise(df: DataFrame, col: str, out: str | None = None) -> DataFrame:
    """x / max(x)."""
    mx = df.select(F.max(col)).scalar()
    return df.withColumn(out or f"{col}_norm", F.try_divide(F.col(col), mx))


def median_fill(df: DataFrame, cols: Sequence[str], source: DataFrame | None = None) -> DataFrame:
    """Nulls take the column median of ``source`` (default: ``df``)."""
    from strataforge.operators.sampling import exact_quantiles

    src = source if source is not None else df
    out = df
    for c in cols:
        med = exact_quantiles(src, c, [0.5])[0]      # distributed exact median, one number back
        out = out.withColumn(c, F.coalesce(F.col(c), F.lit(med).cast("double")))
    return out


def attach_covariates(df: DataFrame, cov: DataFrame, key: str, fill_median: Sequence[str] = ()) -> DataFrame:
    """J4 + A12: left join area covariates (one row per area), then fill
    misses with the covariate medians."""
    from strataforge.operators.joins import join_bounded
    out = join_bounded(df, cov, key, "left")
    return median_fill(out, list(fill_median), cov) if fill_median else out


# ----------------------------------------------------------- cells

def cells(df: DataFrame, outcome: str, factors: Sequence[str], covariates: Sequence[str]) -> DataFrame:
    """Collapse 0/1 outcomes to (factors, covariates, s, n); rows with a
    null outcome or key are left out (complete cases)."""
    keys = list(factors) + list(covariates)
    d = df.where(F.col(outcome).isNotNull())
    for k in keys:
        d = d.where(F.col(k).isNotNull())
    return d.groupBy(*keys).agg(F.sum(F.col(outcome).cast("double")).alias("s"),
                                F.count(F.lit(1)).cast("double").alias("n"))


@dataclass
class Fit:
    model_type: str
    terms: list[str]
    mean: np.ndarray
    cov: np.ndarray
    variances: dict = field(default_factory=dict)
    levels: dict = field(default_factory=dict)
    level_means: dict = field(default_factory=dict)
    level_sds: dict = field(default_factory=dict)
    iterations: int = 0
    converged: bool = True
    fallback_cov: bool = False
    singular: bool = False
    fallback_reason: str = ""
    #: covariance of all coefficients in the order intercept, covariate, levels by factor (dense fits)
    full_cov: np.ndarray | None = None
    #: (level, m, s) of factors with many levels, as distributed frames
    level_frames: dict = field(default_factory=dict)

    def level_table(self, spark: SparkSession, factor: str) -> DataFrame:
        """Fitted effect per level of one factor (mean, posterior sd)."""
        if factor in self.level_frames:
            return self.level_frames[factor]
        rows = [(str(v), float(self.level_means[factor][i]), float(self.level_sds[factor][i]))
                for i, v in enumerate(self.levels.get(factor, []))]
        return spark.createDataFrame(rows, "level string, m double, s double")

    def coefficient_table(self, spark: SparkSession) -> DataFrame:
        """One row per fixed effect (mean, sd) and per random
        level (mean), plus the variance of each grouping factor."""
        rows = [("fixed", t, None, float(self.mean[i]), float(np.sqrt(max(self.cov[i, i], 0.0))))
                for i, t in enumerate(self.terms)]
        rows += [("variance", g, None, float(v), None) for g, v in self.variances.items()]
        df = spark.createDataFrame(rows, "kind string, term string, level string, estimate double, sd double")
        for g in self.variances:
            df = df.unionAll(self.level_table(spark, g).select(
                F.lit("random").alias("kind"), F.lit(g).alias("term"), "level", F.col("m").alias("estimate"), F.lit(None).cast("double").alias("sd")))
        # explicit flags instead of silent fallbacks (Q19)
        return df.withColumns({"model_type": F.lit(self.model_type), "converged": F.lit(bool(self.converged)),
                               "singular": F.lit(bool(self.singular)), "iterations": F.lit(int(self.iterations)),
                               "fallback_cov": F.lit(bool(self.fallback_cov)),
                               "fallback_reason": F.lit(self.fallback_reason)})


def _design_indices(factors, levels):
    offsets, off = {}, 2
    for g in factors:
        offsets[g] = off
        off += len(levels[g])
    return offsets, off


def fit_mixed(spark: SparkSession, cell_df: DataFrame, factors: Sequence[str], covariate: str,
              max_iter: int = 200, tol: float = 1e-6, fixed_precision: float = 1e-4,
              prior_a: float = 1e-3, prior_b: float = 1e-3, min_variance: float = 1e-4,
              cells_per_task: int = 250_000, inner_iter: int = 50) -> Fit:
    """M1 / M2: logit P = b0 + b1 x + sum_g a_g[level], a_g ~ N(0, s_g^2).

    Cells are checkpointed (reliable, ``spark.checkpoint.dir``) so every
    pass rereads the same collapsed table. One factor alone, or more levels
    than ``DENSE_LEVELS``, go through ``mixed_blocks`` (the same fixed point
    with the largest factor eliminated level by level)."""
    factors = list(factors)
    ensure_checkpoint_dir(spark)
    cell_df = cell_df.checkpoint(eager=True)     # the collapsed survey, read once per pass
    n_levels = sum(cell_df.agg(*[F.count_distinct(g).alias(g) for g in factors]).first()) if factors else 0
    if len(factors) == 1 or n_levels > DENSE_LEVELS:
        return fit_blocks(spark, cell_df, factors, covariate, max_iter, tol, fixed_precision, prior_a, prior_b, min_variance, cells_per_task)
    levels = {g: [r[0] for r in cell_df.select(g).distinct().orderBy(g).collect()] for g in factors}
    offsets, P = _design_indices(factors, levels)
    lvl_maps = {g: F.create_map(*[x for i, v in enumerate(levels[g]) for x in (F.lit(v), F.lit(offsets[g] + i))])
                for g in factors}
    idx_cols = [F.element_at(lvl_maps[g], F.col(g)).alias(f"__i{k}") for k, g in enumerate(factors)]
    # cells are an aggregate (bounded by the strata count): size the pass by
    # cells per task, not by the shuffle-partition default
    n_cells = cell_df.count()
    parts = max(1, -(-n_cells // cells_per_task))
    prepared = (cell_df.select(F.col(covariate).cast("double").alias("__x"), "s", "n", *idx_cols)
                       .repartition(parts).checkpoint(eager=True))

    K = len(factors)
    kappa = prepared.agg(F.sum(F.col("s") - F.col("n") / 2).alias("k0"),
                         F.sum((F.col("s") - F.col("n") / 2) * F.col("__x")).alias("k1")).first()
    b = np.zeros(P)
    b[0], b[1] = kappa["k0"], kappa["k1"]
    per_level = (prepared.select(F.explode(F.array(*[F.col(f"__i{k}") for k in range(K)])).alias("i"),
                                 (F.col("s") - F.col("n") / 2).alias("kap"))
                 .groupBy("i").agg(F.sum("kap").alias("kap")).collect())   # one row per level
    for r in per_level:
        b[int(r["i"])] += r["kap"]

    tau = {g: 1.0 for g in factors}
    m = np.zeros(P)
    V = np.eye(P)
    sc = spark.sparkContext
    converged = singular = False
    it = 0
    for it in range(1, max_iter + 1):
        bm, bV = sc.broadcast(m), sc.broadcast(V)

        def xtwx(batches, K=K, P=P, bm=bm, bV=bV):
            import pandas as pd
            mm, VV = bm.value, bV.value
            A = np.zeros((P, P))
            for pdf in batches:
                if len(pdf) == 0:
                    continue
                idx = np.column_stack([np.zeros(len(pdf), dtype=np.int64), np.ones(len(pdf), dtype=np.int64)]
                                      + [pdf[f"__i{k}"].to_numpy(dtype=np.int64) for k in range(K)])
                val = np.column_stack([np.ones(len(pdf)), pdf["__x"].to_numpy(dtype=float)]
                                      + [np.ones(len(pdf))] * K)
                psi = (val * mm[idx]).sum(axis=1)
                var = np.einsum("bk,bkl,bl->b", val, VV[idx[:, :, None], idx[:, None, :]], val)
                c = np.sqrt(psi * psi + np.maximum(var, 0.0))
                n = pdf["n"].to_numpy(dtype=float)
                with np.errstate(divide="ignore", invalid="ignore"):
                    w = np.where(c > 1e-8, n * np.tanh(c / 2.0) / (2.0 * c), n / 4.0)
                wv = val * w[:, None]
                for a in range(idx.shape[1]):
                    np.add.at(A, (idx[:, a][:, None], idx), wv[:, a][:, None] * val)
            ii, jj = np.nonzero(np.triu(A))
            yield pd.DataFrame({"i": ii.astype(np.int32), "j": jj.astype(np.int32), "v": A[ii, jj]})

        # the partials of the tasks are added before they reach the driver
        parts = (prepared.mapInPandas(xtwx, "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v"))).toArrow()
        A = np.zeros((P, P))
        np.add.at(A, (parts.column("i").to_numpy(), parts.column("j").to_numpy()), parts.column("v").to_numpy())
        A = A + np.triu(A, 1).T
        # With this pass's X'WX fixed, the (m, V) and tau updates are exact
        # block updates that need no data: iterate them on the driver until
        # tau settles, then make the next pass (same fixed point, fewer jobs).
        for _inner in range(inner_iter):
            prec = np.zeros(P)
            prec[:2] = fixed_precision
            for g in factors:
                o, L = offsets[g], len(levels[g])
                prec[o:o + L] = tau[g]
            Q = A + np.diag(prec)
            try:
                V_new = np.linalg.inv(Q)
            except np.linalg.LinAlgError:
                V_new = np.linalg.pinv(Q)
            m_new = V_new @ b
            change = 0.0
            for g in factors:
                o, L = offsets[g], len(levels[g])
                ss = float(m_new[o:o + L] @ m_new[o:o + L] + np.trace(V_new[o:o + L, o:o + L]))
                t_new = (L / 2.0 + prior_a) / (ss / 2.0 + prior_b)
                change = max(change, abs(t_new - tau[g]) / max(tau[g], 1e-12))
                tau[g] = t_new
            if change < 1e-6:
                break
        delta = float(np.max(np.abs(m_new - m)))
        m, V = m_new, V_new
        bm.unpersist()
        bV.unpersist()
        if delta < tol:
            converged = True
            break
        if all(1.0 / t < min_variance for t in tau.values()):
            singular = True   # every variance has collapsed: no group structure to fit
            break
    variances = {g: 1.0 / tau[g] for g in factors}
    level_means = {g: m[offsets[g]:offsets[g] + len(levels[g])] for g in factors}
    dv = np.sqrt(np.maximum(np.diag(V), 0.0))
    level_sds = {g: dv[offsets[g]:offsets[g] + len(levels[g])] for g in factors}
    fit = Fit("mixed" if len(factors) > 1 else "mixed_area", ["(Intercept)", covariate], m[:2].copy(),
              V[:2, :2].copy(), variances, levels, level_means, level_sds, it, converged)
    fit.singular = singular
    fit.full_cov = V
    return fit


def fixed_point_residuals(spark: SparkSession, fit: Fit, cell_df: DataFrame, factors: Sequence[str], covariate: str,
                          fixed_precision: float = 1e-4, prior_a: float = 1e-3, prior_b: float = 1e-3) -> DataFrame:
    """(term, level, residual) of a dense ``fit_mixed``: for each coefficient
    the mean over its trials of s - n/2 - w psi, less its prior's pull; for each
    factor (row ``<factor> precision``) the relative error of its precision. All
    are 0 at the fixed point.

    Computed from the cells by joins with the levels' means and, per cell, the
    covariance of its coefficients (a map of the levels' places; the covariance
    has at most (2 + ``DENSE_LEVELS``)^2 numbers)."""
    x = cell_df.select(F.col(covariate).cast("double").alias("x"), "s", "n", *[F.col(g).cast("string").alias(g) for g in factors])
    offset = 2
    psi = F.lit(float(fit.mean[0])) + F.lit(float(fit.mean[1])) * F.col("x")
    places = [F.lit(0), F.lit(1)]
    for g in factors:
        rows = [(str(v), offset + i, float(fit.level_means[g][i])) for i, v in enumerate(fit.levels[g])]
        x = x.join(F.broadcast(spark.createDataFrame(rows, f"`{g}` string, `{g}_i` int, `{g}_m` double")), g)
        psi, places = psi + F.col(f"{g}_m"), [*places, F.col(f"{g}_i")]
        offset += len(rows)
    cov = spark.createDataFrame([(i, fit.full_cov[i].tolist()) for i in range(offset)], "i int, row array<double>")
    x = x.withColumn("psi", psi).withColumn("at", F.array(*places)).withColumn("val", F.array(F.lit(1.0), "x", *[F.lit(1.0)] * len(factors)))
    keyed = x.withColumn("cell", F.struct("x", "s", "n", *factors))
    # per cell: sum over its coefficients i of val_i * (sum over j of val_j cov[i, j])
    each = keyed.select("cell", "at", "val", F.posexplode("at").alias("p", "i")).join(F.broadcast(cov), "i")
    inner = F.aggregate(F.zip_with("at", "val", lambda a, v: F.element_at("row", a + 1) * v), F.lit(0.0), lambda s, v: s + v)
    spread = each.groupBy("cell").agg(F.sum(F.element_at("val", F.col("p") + 1) * inner).alias("var"))
    c = F.sqrt(F.col("psi") * F.col("psi") + F.greatest("var", F.lit(0.0)))
    w = F.when(c > 1e-8, F.col("n") * F.tanh(c / 2) / (2 * c)).otherwise(F.col("n") / 4)
    score = keyed.join(spread, "cell").withColumn("__r", F.col("s") - F.col("n") / 2 - w * F.col("psi"))
    score = score.select(F.col("x").alias("__x"), F.col("n").alias("__n"), "__r", *factors).checkpoint(eager=True)
    b0, b1 = (float(v) for v in fit.mean)
    out = score.agg(((F.sum("__r") - fixed_precision * b0) / F.sum("__n")).alias("a"), ((F.sum(F.col("__r") * F.col("__x")) - fixed_precision * b1) / F.sum("__n")).alias("b"))
    out = out.select(F.explode(F.array(F.struct(F.lit(fit.terms[0]).alias("term"), F.col("a").alias("residual")),
                                       F.struct(F.lit(fit.terms[1]).alias("term"), F.col("b").alias("residual")))).alias("v"))
    out = out.select("v.term", F.lit(None).cast("string").alias("level"), "v.residual")
    for g in factors:
        lt = fit.level_table(spark, g)
        one = (score.groupBy(F.col(g).alias("level")).agg(F.sum("__r").alias("__r"), F.sum("__n").alias("__n")).join(F.broadcast(lt), "level")
               .select(F.lit(g).alias("term"), "level", ((F.col("__r") - F.col("m") / fit.variances[g]) / F.col("__n")).alias("residual")))
        ss = F.sum(F.col("m") * F.col("m") + F.col("s") * F.col("s")) / 2 + prior_b
        precision = lt.agg((ss / (F.count(F.lit(1)) / 2 + prior_a) / fit.variances[g] - 1).alias("residual"))
        out = out.unionByName(one).unionByName(precision.select(F.lit(f"{g} precision").alias("term"), F.lit(None).cast("string").alias("level"), "residual"))
    return out


def fit_glm(spark: SparkSession, cell_df: DataFrame, covariate: str, max_iter: int = 50) -> Fit:
    """M3: plain logistic regression on cells with Spark ML's distributed
    IRLS (label = s / n, weight = n); covariance from one X'WX aggregation
    at the fitted means."""
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import GeneralizedLinearRegression

    d = cell_df.where(F.col("n") > 0).select((F.col("s") / F.col("n")).alias("label"), "n",
                                             F.col(covariate).cast("double").alias("x"))
    d = VectorAssembler(inputCols=["x"], outputCol="features").transform(d)
    model = GeneralizedLinearRegression(family="binomial", link="logit", weightCol="n", maxIter=max_iter,
                                        labelCol="label").fit(d)
    b0, b1 = float(model.intercept), float(model.coefficients[0])
    eta = F.lit(b0) + F.lit(b1) * F.col("x")
    p = F.lit(1.0) / (F.lit(1.0) + F.exp(-eta))
    w = F.col("n") * p * (F.lit(1.0) - p)
    r = d.agg(F.sum(w).alias("a"), F.sum(w * F.col("x")).alias("b"), F.sum(w * F.col("x") * F.col("x")).alias("c")).first()
    info = np.array([[r["a"], r["b"]], [r["b"], r["c"]]])
    try:
        cov, bad = np.linalg.inv(info), False
    except np.linalg.LinAlgError:
        cov, bad = 1e-4 * np.eye(2), True
    return Fit("glm", ["(Intercept)", covariate], np.array([b0, b1]), cov, fallback_cov=bad)


def fit_with_fallback(spark: SparkSession, cell_df: DataFrame, factors: Sequence[str], area: str,
                      covariate: str, min_variance: float = 1e-6, **kw) -> Fit:
    """M4: mixed model -> area-only mixed model -> plain logistic. A fit
    that fails numerically or does not converge falls through; a fit whose
    variances are all ~0 (singular) goes straight to the plain model. The
    reasons stay in ``fallback_reason``; any other error is raised."""
    reasons: list[str] = []
    for fs in (list(factors), [area]):
        try:
            f = fit_mixed(spark, cell_df, fs, covariate, **kw)
        except (np.linalg.LinAlgError, ArithmeticError) as e:  # numerical failure -> next model
            reasons.append(f"{'+'.join(fs)}: {e}")
            continue
        if f.singular or all(v < min_variance for v in f.variances.values()):
            reasons.append(f"{'+'.join(fs)}: singular")
            break          # singular -> plain model, as a singular mixed fit is dropped
        if not f.converged:
            reasons.append(f"{'+'.join(fs)}: not converged")
            continue
        f.fallback_reason = "; ".join(reasons)
        return f
    f = fit_glm(spark, cell_df, covariate)
    f.fallback_reason = "; ".join(reasons)
    return f
