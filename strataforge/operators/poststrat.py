"""Posterior draws and poststratification (SURVEY §2.10 M6-M10, J13, J16,
G8, G9, A10, A14, F35, F36).

Plan shape (§4.3.1): strata x draws repeats each stratum once per draw id
and joins the draw table on the id (broadcast hash join; the draw table has
``n_draws`` rows, a bounded parameter; no cross join), the three
stage probabilities sit in one row so the product is made once, and
``groupBy(area, draw)`` combines partial sums map-side, collapsing strata x
draws to areas x draws before the shuffle. Quantiles then run over at most
``n_draws`` values per area, so no group is unbounded.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strataforge.functions.hashing import normal
from strataforge.functions.numeric import inv_logit

MAX_BROADCAST_DRAWS = 100_000


def cholesky_factor(cov, ridge: float = 1e-8, fallback: float = 1e-4) -> tuple[np.ndarray, bool]:
    """Lower factor of ``cov + ridge*I``; when that is not positive
    definite the factor of ``fallback*I`` is used and the flag is set (Q19)."""
    cov = np.asarray(cov, dtype=float)
    p = cov.shape[0]
    try:
        return np.linalg.cholesky(cov + ridge * np.eye(p)), False
    except np.linalg.LinAlgError:
        return math.sqrt(fallback) * np.eye(p), True


def coefficient_draws(spark: SparkSession, terms: Sequence[str], mean: Sequence[float],
                      cov=None, n_draws: int = 500, seed: int = 2026,
                      ridge: float = 1e-8) -> DataFrame:
    """``n_draws`` multivariate normal coefficient vectors, one row per
    draw (``draw`` 1..n) and one column per term. beta = mean + L z with z
    keyed-hash normals of (seed, term index, draw). The covariance is small
    (terms x terms) and factored on the driver."""
    p = len(terms)
    L, _ = cholesky_factor(np.zeros((p, p)) if cov is None else cov, ridge)
    d = spark.range(1, n_draws + 1).select(F.col("id").cast("int").alias("draw"))
    z = [normal(seed, F.lit(k), "draw") for k in range(p)]
    cols = []
    for j, t in enumerate(terms):
        e = F.lit(float(mean[j]))
        for k in range(j + 1):
            if L[j, k] != 0.0:
                e = e + F.lit(float(L[j, k])) * z[k]
        cols.append(e.alias(t))
    return d.select("draw", *cols)


def linear_predictor(draws: DataFrame, design: dict[str, Column]) -> Column:
    """Sum over terms of draw coefficient x covariate (intercept is a
    covariate equal to 1)."""
    e = None
    for term, x in design.items():
        part = draws[term] * x
        e = part if e is None else e + part
    return e


def with_draws(strata: DataFrame, draws: DataFrame, n_draws: int | None = None) -> DataFrame:
    """J13 without a cross join: each stratum row is repeated once per draw
    id (``explode(sequence)``) and the draw table (``n_draws`` rows) is joined
    on the id, broadcast up to ``MAX_BROADCAST_DRAWS`` rows."""
    n = int(n_draws) if n_draws is not None else int(draws.agg(F.max("draw")).first()[0])
    # The strata table is small in bytes, so AQE may have coalesced it into
    # very few partitions; the explode multiplies its rows by n. Spread it
    # first (an explicit repartition(n) is never coalesced by AQE).
    spark = strata.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    rep = strata.repartition(parts).withColumn("draw", F.explode(F.sequence(F.lit(1), F.lit(n))))
    return rep.join(F.broadcast(draws) if n <= MAX_BROADCAST_DRAWS else draws, "draw")


def cell_draws(strata: DataFrame, draws: DataFrame, design: dict[str, Column],
               out_col: str = "p", re_sd: dict[str, float] | None = None,
               stratum_key: Sequence = (), re_mode: str = "level",
               seed: int = 7, keep: Sequence[str] | None = None, n_draws: int | None = None) -> DataFrame:
    """M6: probability per (stratum, draw).

    ``re_mode='cell'`` (the reference, Q1): one independent normal per cell
    and draw with variance = sum of the factors' variances.
    ``re_mode='level'`` (default): one normal per (factor, level, draw)
    shared by every cell of that level; computed from the hash of the level
    value, so no join is needed.
    """
    keep = list(keep) if keep is not None else strata.columns
    j = with_draws(strata, draws, n_draws)
    lp = None
    for term, x in design.items():
        part = F.col(term) * x
        lp = part if lp is None else lp + part
    re_sd = {g: s for g, s in (re_sd or {}).items() if s is not None and s > 0}
    if re_sd:
        if re_mode == "cell":
            sd = math.sqrt(sum(s * s for s in re_sd.values()))
            lp = lp + F.lit(sd) * normal(seed, *stratum_key, "draw")
        elif re_mode == "level":
            for g, s in re_sd.items():
                lp = lp + F.lit(s) * normal(seed, F.lit(g), F.col(g), "draw")
        else:
            raise ValueError(re_mode)
    return j.select(*keep, "draw", inv_logit(lp).alias(out_col))


def stage_shares(p_turnout: Column, p_first: Column, p_second: Column,
                 scale: str = "population",
                 names: Sequence[str] = ("AITC", "NDA", "OTHER")) -> dict[str, Column]:
    """Shares of three choices (``names``) from the sequential stages.
    ``population`` multiplies by turnout (reference); ``votes`` does not."""
    a = p_first
    b = (F.lit(1.0) - p_first) * p_second
    o = (F.lit(1.0) - p_first) * (F.lit(1.0) - p_second)
    if scale == "population":
        a, b, o = p_turnout * a, p_turnout * b, p_turnout * o
    return dict(zip(names, (a, b, o)))


def poststratify(cells: DataFrame, area, weight: str, values: Sequence[str],
                 draw: str = "draw") -> DataFrame:
    """A14 (+J5, J6): per (area, draw): sum(N*p) / sum(N). Null products are
    skipped in the numerator only; a zero population gives null."""
    area = [area] if isinstance(area, str) else list(area)
    aggs = [F.sum(F.col(weight) * F.col(v)).alias(f"__num_{v}") for v in values]
    g = cells.groupBy(*area, draw).agg(F.sum(weight).alias("__pop"), *aggs)
    return g.select(*area, draw, *[F.try_divide(F.col(f"__num_{v}"), F.col("__pop")).alias(v)
                                   for v in values])


def normalise_draws(ps: DataFrame, values: Sequence[str]) -> DataFrame:
    """Q2 ``scale='votes'``: each draw's population-scale shares divided by
    their sum (for turnout-weighted shares that sum is the draw's turnout),
    so intervals are shares of votes, comparable with official results."""
    tot = None
    for v in values:
        c = F.coalesce(F.col(v), F.lit(0.0))
        tot = c if tot is None else tot + c
    return ps.withColumns({v: F.try_divide(F.col(v), F.nullif(tot, F.lit(0.0))) for v in values})


def to_long(df: DataFrame, ids: Sequence[str], values: Sequence[str],
            name_col: str = "choice", value_col: str = "share") -> DataFrame:
    return df.unpivot(list(ids), list(values), name_col, value_col)


def summarise_draws(long: DataFrame, group: Sequence[str], value: str = "share",
                    scale: float = 100.0, probs=(0.025, 0.5, 0.975),
                    fill_missing: bool = True) -> DataFrame:
    """A10 + M10: median and interval (R type 7 = linear interpolation,
    exactly what ``percentile`` computes); a null draw first takes its
    group's median (only when the group has some non-null draw)."""
    from pyspark.sql import Window

    group = list(group)
    v = F.col(value)
    if fill_missing:
        # a window over one group's draws (at most n_draws rows), not a join
        # back, so the draw pipeline is not computed twice
        med = F.percentile(value, 0.5).over(Window.partitionBy(*group))
        long = long.select(*group, F.coalesce(v, med).alias(value))
    q = F.percentile(value, list(probs))
    out = long.groupBy(*group).agg(q.alias("__q"))
    names = ["ci_low", "median", "ci_high"] if len(probs) == 3 else [f"q{i}" for i in range(len(probs))]
    return out.select(*group, *[(F.col("__q")[i] * scale).alias(n) for i, n in enumerate(names)])


def argmax_name(names: Sequence[str], cols: Sequence[Column], all_zero_null: bool = False) -> Column:
    """Name of the largest value, first on ties; NaN counts as lowest;
    an all-null row gives null. An all-zero row names the first column (the
    reference rule, Q14) unless ``all_zero_null``."""
    vals = F.array(*[F.nanvl(c.cast("double"), F.lit(None).cast("double")) for c in cols])
    mx = F.array_max(vals)
    pos = F.array_position(vals, mx)
    ok = (pos > 0) & (mx != 0) if all_zero_null else (pos > 0)
    return F.when(ok, F.element_at(F.array(*[F.lit(n) for n in names]), pos.cast("int")))


def seat_table(summary: DataFrame, area: str, choices: Sequence[str],
               rescale: bool = True) -> DataFrame:
    """M9 wide part: pivot the known choices (X3) to ``median_X``,
    ``ci_low_X``, ``ci_high_X``; rescale medians to sum to 100 (nullif
    guard, Q18); winner by arg-max of the medians (W8)."""
    wide = (summary.groupBy(area).pivot("choice", list(choices))
                   .agg(F.first("median").alias("median"), F.first("ci_low").alias("ci_low"),
                        F.first("ci_high").alias("ci_high")))
    ren = {}
    for ch in choices:
        for m in ("median", "ci_low", "ci_high"):
            ren[f"{ch}_{m}"] = f"{m}_{ch}"
    wide = wide.withColumnsRenamed(ren)
    if rescale:
        tot = None
        for ch in choices:
            c = F.coalesce(F.col(f"median_{ch}"), F.lit(0.0))
            tot = c if tot is None else tot + c
        wide = wide.withColumns({f"median_{ch}": F.try_divide(F.col(f"median_{ch}"), F.nullif(tot, F.lit(0.0))) * 100
                                 for ch in choices})
    return wide.withColumn("winner", argmax_name(choices, [F.col(f"median_{ch}") for ch in choices]))
