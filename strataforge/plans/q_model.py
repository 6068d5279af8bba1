"""Phase 6 queries: covariates from past results (F21-F23, A12, J4),
model fits (M1-M5, rows only: iterative), posterior draws, stage shares and
the seat forecast (G8, G9, J6, J13, J16, M6-M10, F35, F36, J7, J9)."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from strataforge.functions import numeric as N
from strataforge.functions.hashing import dlit, normal_pair, normal_pair_sql, normal_sql, uniform_sql
from strataforge.functions import text as T
from strataforge.operators import frame, match, model, poststrat, results, sampling
from strataforge.operators.joins import join_bounded
from strataforge.plans import catalogue, q_results
from strataforge.plans.catalogue import register, r6, cte
from strataforge.plans.derived import roll, survey, SURVEY_SQL
from strataforge.plans.q_frame import draws_sql
from strataforge.session import ensure_checkpoint_dir

# Fixed parameters: seeds of the survey labels, draw counts, stage
# coefficients (intercept, covariate) with their covariances, and the
# random-effect spreads used by the oracle forecasts.
TURNOUT_SEED = 2026
CHOICE_SEED = 2027
FORECAST_DRAWS = 500
STAGE_COEF = {
    "t": ((0.4, 0.3), ((0.0100, 0.0010), (0.0010, 0.0040)), 11),
    "a": ((-0.2, 0.5), ((0.0090, 0.0000), (0.0000, 0.0030)), 12),
    "n": ((0.1, 0.4), ((0.0080, -0.0010), (-0.0010, 0.0050)), 13),
}
RE_SD = {"eroll_no": 0.3, "age_band": 0.2}
NOISE_SEED = 99
FACTORS = ("constituency_name", "gender", "age_band", "area_type", "R", "G", "SG")


# ----------------------------------------------------------- past results

def past(spark, sf_dir, drop_seats=()):
    """Past result per seat from RESULT buckets (seats with number % 6 == 0
    have no NDA or other votes, so NDA_cond is 0/0 -> 0.5). The per-seat
    table is checkpointed once (one row per seat): the z-score and median
    statistics then read it instead of re-running the result join."""
    ensure_checkpoint_dir(spark)
    bl = q_results.bucket_long(spark, sf_dir)
    w = results.wide_by_key(bl, "constituency", "bucket", {"v": "total_votes"}, keys=q_results.BUCKETS)
    k = F.regexp_extract("constituency", r"(\d+)", 1).cast("int")
    zero = k % 6 == 0
    w = w.select(F.col("constituency").alias("constituency_name"),
                 F.col("`AITC+_v`").cast("double").alias("aitc_votes"),
                 F.when(zero, 0.0).otherwise(F.col("BJP_v").cast("double")).alias("nda_votes"),
                 F.when(zero, 0.0).otherwise(F.col("Other_v").cast("double")).alias("other_votes"))
    for s in drop_seats:
        w = w.where(F.col("constituency_name") != s)
    w = w.checkpoint(eager=True)
    tot = F.col("aitc_votes") + F.col("nda_votes") + F.col("other_votes")
    w = w.withColumn("total_votes", tot).select(
        "constituency_name", "total_votes",
        (F.col("aitc_votes") / tot).alias("AITC_2021"), (F.col("nda_votes") / tot).alias("NDA_2021"),
        (F.col("other_votes") / tot).alias("OTHER_2021"))
    w = w.withColumn("NDA_cond_2021", N.safe_ratio(F.col("NDA_2021"), F.col("NDA_2021") + F.col("OTHER_2021"), 0.5))
    w = model.max_normalise(w, "total_votes", "turnout_2021")
    for c in ("AITC_2021", "NDA_cond_2021", "turnout_2021"):
        w = model.zscore(w, c, f"{c}_z")
    return w


def past_sql(drop=()) -> dict:
    d = dict(q_results.BASE_SQL)
    keys = list(d)
    d = {k: d[k] for k in keys[: keys.index("bl") + 1]}
    where = (" WHERE constituency NOT IN (" + ", ".join(f"'{s}'" for s in drop) + ")") if drop else ""
    d["pw"] = f"""SELECT constituency AS constituency_name,
        CAST(max(CASE WHEN bucket = 'AITC+' THEN total_votes END) AS DOUBLE) AS aitc_votes,
        CASE WHEN CAST(regexp_extract(constituency, '(\\d+)', 1) AS INTEGER) % 6 = 0 THEN 0.0
             ELSE CAST(max(CASE WHEN bucket = 'BJP' THEN total_votes END) AS DOUBLE) END AS nda_votes,
        CASE WHEN CAST(regexp_extract(constituency, '(\\d+)', 1) AS INTEGER) % 6 = 0 THEN 0.0
             ELSE CAST(max(CASE WHEN bucket = 'Other' THEN total_votes END) AS DOUBLE) END AS other_votes
      FROM bl{where} GROUP BY constituency"""
    d["p1"] = """SELECT constituency_name, aitc_votes + nda_votes + other_votes AS total_votes,
        aitc_votes / (aitc_votes + nda_votes + other_votes) AS AITC_2021,
        nda_votes / (aitc_votes + nda_votes + other_votes) AS NDA_2021,
        other_votes / (aitc_votes + nda_votes + other_votes) AS OTHER_2021 FROM pw"""
    d["p2"] = """SELECT *, CASE WHEN NDA_2021 + OTHER_2021 = 0 THEN 0.5 ELSE NDA_2021 / (NDA_2021 + OTHER_2021) END
                   AS NDA_cond_2021, total_votes / (SELECT max(total_votes) FROM p1) AS turnout_2021 FROM p1"""
    d["past"] = """SELECT *,
        (AITC_2021 - (SELECT avg(AITC_2021) FROM p2)) / (SELECT stddev_samp(AITC_2021) FROM p2) AS AITC_2021_z,
        (NDA_cond_2021 - (SELECT avg(NDA_cond_2021) FROM p2)) / (SELECT stddev_samp(NDA_cond_2021) FROM p2) AS NDA_cond_2021_z,
        (turnout_2021 - (SELECT avg(turnout_2021) FROM p2)) / (SELECT stddev_samp(turnout_2021) FROM p2) AS turnout_2021_z
      FROM p2"""
    return d


@register("zscore", cte(**past_sql()) + """
SELECT constituency_name, round(AITC_2021_z, 6) AS AITC_2021_z, round(NDA_cond_2021_z, 6) AS NDA_cond_2021_z,
       round(turnout_2021_z, 6) AS turnout_2021_z FROM past""")
def zscore(spark, sf_dir):
    """z-scores with the sample sd (scalar subqueries, no join)."""
    p = past(spark, sf_dir)
    return p.select("constituency_name", *[r6(c).alias(c) for c in ("AITC_2021_z", "NDA_cond_2021_z", "turnout_2021_z")])


@register("max_norm", cte(**past_sql()) + "SELECT constituency_name, round(turnout_2021, 6) AS turnout_2021 FROM past")
def max_norm(spark, sf_dir):
    """turnout proxy = votes / largest seat's votes (Q5)."""
    return past(spark, sf_dir).select("constituency_name", r6("turnout_2021").alias("turnout_2021"))


@register("safe_ratio", cte(**past_sql()) + "SELECT constituency_name, round(NDA_cond_2021, 6) AS NDA_cond_2021 FROM past")
def safe_ratio(spark, sf_dir):
    """NDA / (NDA + other), 0/0 -> 0.5."""
    return past(spark, sf_dir).select("constituency_name", r6("NDA_cond_2021").alias("NDA_cond_2021"))


MISSING = ("SEAT-3", "SEAT-11")


@register("median_fill", cte(**past_sql(MISSING), s=SURVEY_SQL, areas="SELECT DISTINCT constituency_name FROM s") + """
SELECT a.constituency_name,
  round(coalesce(p.turnout_2021_z, (SELECT quantile_cont(turnout_2021_z, 0.5) FROM past)), 6) AS turnout_2021_z,
  round(coalesce(p.AITC_2021_z, (SELECT quantile_cont(AITC_2021_z, 0.5) FROM past)), 6) AS AITC_2021_z
FROM areas a LEFT JOIN past p ON a.constituency_name = p.constituency_name""")
def median_fill(spark, sf_dir):
    """J4 left join of area covariates onto the survey's areas, A12 misses
    filled with the covariate medians."""
    p = past(spark, sf_dir, MISSING).select("constituency_name", "turnout_2021_z", "AITC_2021_z")
    areas = survey(spark, sf_dir).select("constituency_name").distinct()
    out = model.attach_covariates(areas, p, "constituency_name", ["turnout_2021_z", "AITC_2021_z"])
    return out.select("constituency_name", r6("turnout_2021_z").alias("turnout_2021_z"),
                      r6("AITC_2021_z").alias("AITC_2021_z"))


# ----------------------------------------------------------- survey labels

def labelled_survey(spark, sf_dir):
    """Entry C step 1: repair, hard labels (G1 turnout, G2 party), the
    three stage outcomes (P13) and the area covariates (J4 + A12)."""
    s = survey(spark, sf_dir).withColumn("p_will_vote", N.percent_repair("p_will_vote"))
    s = s.dropna(subset=["p_will_vote", "p_aitc", "p_nda"])
    s = s.withColumn("p_other", N.row_sum("p_lf", "p_inc", "p_nota"))
    pct = N.row_sum("p_aitc", "p_nda", "p_other") > 5
    s = s.withColumns({c: F.when(pct, F.col(c) / 100.0).otherwise(F.col(c)) for c in ("p_aitc", "p_nda", "p_other")})
    s = s.withColumns(N.row_normalise(["p_aitc", "p_nda", "p_other"]))
    s = s.withColumn("voted", sampling.bernoulli(F.col("p_will_vote"), TURNOUT_SEED, "resp_id"))
    s = s.withColumn("vote_draw", sampling.categorical({"AITC": "p_aitc", "NDA": "p_nda", "OTHER": "p_other"},
                                                       CHOICE_SEED, "resp_id"))
    v = F.col("voted") == 1
    s = s.withColumn("voted_AITC", F.when(v & (F.col("vote_draw") == "AITC"), 1)
                     .when(v & F.col("vote_draw").isNotNull(), 0))
    s = s.withColumn("voted_NDA_cond", F.when(v & (F.col("vote_draw") == "NDA"), 1)
                     .when(v & (F.col("vote_draw") == "OTHER"), 0))
    cov = past(spark, sf_dir).select("constituency_name", "turnout_2021_z", "AITC_2021_z", "NDA_cond_2021_z")
    return model.attach_covariates(s, cov, "constituency_name", ["turnout_2021_z", "AITC_2021_z", "NDA_cond_2021_z"])


def _fit_table(spark, sf_dir, factors, kind):
    s = labelled_survey(spark, sf_dir)
    c = model.cells(s, "voted", list(factors), ["turnout_2021_z"])
    if kind == "glm":
        f = model.fit_glm(spark, c, "turnout_2021_z")
    elif kind == "chain":
        f = model.fit_with_fallback(spark, c, list(factors), "constituency_name", "turnout_2021_z")
    else:
        f = model.fit_mixed(spark, c, list(factors), "turnout_2021_z")
    return f.coefficient_table(spark)


def glm_sql() -> str:
    """Newton's method on the cells, 25 steps from zero."""
    parts = dict(
        **past_sql(), s=SURVEY_SQL,
        r="""SELECT resp_id, constituency_name, CASE WHEN p_will_vote > 1 THEN p_will_vote / 100 ELSE p_will_vote END AS pw
             FROM s WHERE p_will_vote IS NOT NULL AND p_aitc IS NOT NULL AND p_nda IS NOT NULL""",
        y=f"""SELECT coalesce(p.turnout_2021_z, (SELECT quantile_cont(turnout_2021_z, 0.5) FROM past)) AS x,
                     CAST({uniform_sql(TURNOUT_SEED, "r.resp_id")} < r.pw AS INTEGER) AS y
              FROM r LEFT JOIN past p ON r.constituency_name = p.constituency_name""",
        cells="SELECT x, count(*)::DOUBLE AS n, sum(y)::DOUBLE AS s FROM y GROUP BY x",
        it="""SELECT 0 AS k, 0.0::DOUBLE AS b0, 0.0::DOUBLE AS b1 UNION ALL
              SELECT k + 1, b0 + (c * g0 - b * g1) / (a * c - b * b), b1 + (a * g1 - b * g0) / (a * c - b * b)
              FROM (SELECT k, b0, b1, sum(n * p * (1 - p)) AS a, sum(n * p * (1 - p) * x) AS b, sum(n * p * (1 - p) * x * x) AS c,
                           sum(s - n * p) AS g0, sum(x * (s - n * p)) AS g1
                    FROM (SELECT it.k, it.b0, it.b1, x, n, s, 1 / (1 + exp(-(it.b0 + it.b1 * x))) AS p FROM it, cells WHERE it.k < 25)
                    GROUP BY k, b0, b1)""",
        fit="""SELECT b0, b1, c / (a * c - b * b) AS v0, a / (a * c - b * b) AS v1
               FROM (SELECT b0, b1, sum(n * p * (1 - p)) AS a, sum(n * p * (1 - p) * x) AS b, sum(n * p * (1 - p) * x * x) AS c
                     FROM (SELECT it.b0, it.b1, x, n, 1 / (1 + exp(-(it.b0 + it.b1 * x))) AS p FROM it, cells WHERE it.k = 25)
                     GROUP BY b0, b1)""")
    flags = ("'glm' AS model_type, true AS converged, false AS singular, CAST(0 AS INTEGER) AS iterations, false AS fallback_cov, "
             "'' AS fallback_reason")
    return cte(**parts).replace("WITH ", "WITH RECURSIVE ", 1) + f"""
SELECT 'fixed' AS kind, '(Intercept)' AS term, CAST(NULL AS VARCHAR) AS level, round(b0, 6) AS estimate, round(sqrt(v0), 6) AS sd, {flags} FROM fit
UNION ALL SELECT 'fixed', 'turnout_2021_z', NULL, round(b1, 6), round(sqrt(v1), 6), {flags} FROM fit"""


@register("glm_fit", glm_sql())
def glm_fit(spark, sf_dir):
    """M3: plain logistic regression of stage-0 turnout on the area
    covariate (Spark ML IRLS on cells); the oracle takes Newton steps."""
    return _fit_table(spark, sf_dir, (), "glm").withColumns({"estimate": r6("estimate"), "sd": r6("sd")})


def labelled_sql() -> dict:
    """CTEs of the stage-0 outcome: ``y`` (resp_id, factors, x, y) with complete cases."""
    return dict(
        **past_sql(), s=SURVEY_SQL,
        r="""SELECT *, CASE WHEN p_will_vote > 1 THEN p_will_vote / 100 ELSE p_will_vote END AS pw
             FROM s WHERE p_will_vote IS NOT NULL AND p_aitc IS NOT NULL AND p_nda IS NOT NULL""",
        y=f"""SELECT r.*, coalesce(p.turnout_2021_z, (SELECT quantile_cont(turnout_2021_z, 0.5) FROM past)) AS x,
                     CAST({uniform_sql(TURNOUT_SEED, "r.resp_id")} < r.pw AS INTEGER) AS y
              FROM r LEFT JOIN past p ON r.constituency_name = p.constituency_name""")


def area_fit_sql(steps: int = 400, precision: str = "1e-4::DOUBLE", prior: str = "1e-3::DOUBLE") -> str:
    """The variational fixed point of the area model by plain steps: weights,
    then precision, then coefficients, with each area's effect eliminated."""
    def solved(rows: str) -> str:      # rows: k, tau, g, d, c, e, b, bx; one k
        return f"""(SELECT *, d * v00 + c * v01 AS u0, d * v01 + c * v11 AS u1, v00 * h0 + v01 * h1 AS m0, v01 * h0 + v11 * h1 AS m1
              FROM (SELECT *, s11 / det AS v00, -s01 / det AS v01, s00 / det AS v11
                    FROM (SELECT *, s00 * s11 - s01 * s01 AS det
                          FROM (SELECT *, {precision} + sum(d - d * d / (d + tau)) OVER () AS s00, sum(c - d * c / (d + tau)) OVER () AS s01,
                                       {precision} + sum(e - c * c / (d + tau)) OVER () AS s11, sum(b - d * b / (d + tau)) OVER () AS h0,
                                       sum(bx - c * b / (d + tau)) OVER () AS h1 FROM {rows}))))"""
    level = "SELECT *, (b - d * m0 - c * m1) / (d + tau) AS ma, 1 / (d + tau) + (u0 * d + u1 * c) / ((d + tau) * (d + tau)) AS va FROM "
    unnested = "(SELECT k, tau, l.g AS g, l.d AS d, l.c AS c, l.e AS e, l.b AS b, l.bx AS bx FROM (SELECT k, tau, unnest(lv) AS l FROM {}))"
    row = "list({'g': g, 'd': d, 'c': c, 'e': e, 'b': b, 'bx': bx})"
    parts = dict(
        **labelled_sql(),
        cells="SELECT constituency_name AS g, x, count(*)::DOUBLE AS n, sum(y)::DOUBLE AS s FROM y WHERE constituency_name IS NOT NULL GROUP BY ALL",
        it=f"""SELECT 0 AS k, 1.0::DOUBLE AS tau, {row} AS lv
               FROM (SELECT g, sum(n / 4) AS d, sum(n / 4 * x) AS c, sum(n / 4 * x * x) AS e, sum(s - n / 2) AS b, sum((s - n / 2) * x) AS bx
                     FROM cells GROUP BY g)
               UNION ALL
               SELECT k + 1, t, {row} FROM (
                 SELECT k, t, g, sum(w) AS d, sum(w * x) AS c, sum(w * x * x) AS e, any_value(b) AS b, any_value(bx) AS bx FROM (
                   SELECT *, n * tanh(z / 2) / (2 * z) AS w FROM (
                     SELECT q.*, cells.x, cells.n, sqrt(pow(m0 + m1 * x + ma, 2) + v00 + 2 * x * v01 + x * x * v11
                                                        - 2 * (u0 + x * u1) / (d + tau) + va) AS z
                     FROM (SELECT *, (count(*) OVER () / 2 + {prior}) / (sum(ma * ma + va) OVER () / 2 + {prior}) AS t
                           FROM ({level} {solved(unnested.format(f"(SELECT * FROM it WHERE k < {steps})"))})) q
                     JOIN cells ON cells.g = q.g)) GROUP BY k, t, g) GROUP BY k, t""",
        f=f"{level} {solved(unnested.format(f'(SELECT * FROM it WHERE k = {steps})'))}")
    flags = "'mixed_area' AS model_type, true AS converged, false AS singular, false AS fallback_cov, '' AS fallback_reason"
    null = "CAST(NULL AS VARCHAR)"
    return cte(**parts).replace("WITH ", "WITH RECURSIVE ", 1) + f"""
SELECT 'fixed' AS kind, '(Intercept)' AS term, {null} AS level, round(any_value(m0), 4) AS estimate, round(sqrt(any_value(v00)), 4) AS sd, {flags} FROM f
UNION ALL SELECT 'fixed', 'turnout_2021_z', {null}, round(any_value(m1), 4), round(sqrt(any_value(v11)), 4), {flags} FROM f
UNION ALL SELECT 'variance', 'constituency_name', {null}, round(any_value(1 / tau), 4), CAST(NULL AS DOUBLE), {flags} FROM f
UNION ALL SELECT 'random', 'constituency_name', g, round(ma, 4), CAST(NULL AS DOUBLE), {flags} FROM f"""


@register("mixed_fit")
def mixed_fit(spark, sf_dir):
    """M1 + M4 + M5: crossed random intercepts for seven factors by the
    distributed variational fit, with the fallback chain."""
    return _fit_table(spark, sf_dir, FACTORS, "chain")


@register("mixed_fit_area_only", area_fit_sql())
def mixed_fit_area_only(spark, sf_dir):
    """M2: the reduced model with the area intercept only, areas eliminated
    block by block; the oracle steps to the same fixed point."""
    t = _fit_table(spark, sf_dir, ("constituency_name",), "mixed").drop("iterations")
    return t.withColumns({c: F.round(c, 4) for c in ("estimate", "sd")})


def residual_sql() -> str:
    """Every coefficient of the seven-factor model, with residual 0."""
    one = " UNION ALL ".join(
        f"SELECT DISTINCT '{g}' AS term, CAST({q} AS VARCHAR) AS level FROM c" for g, q in ((f, f'"{f}"') for f in FACTORS))
    full = " AND ".join(f'"{f}" IS NOT NULL' for f in FACTORS)
    return cte(**labelled_sql(), c=f"SELECT * FROM y WHERE x IS NOT NULL AND {full}") + f"""
SELECT term, level, 0.0::DOUBLE AS residual FROM ({one})
UNION ALL SELECT '(Intercept)', CAST(NULL AS VARCHAR), 0.0 UNION ALL SELECT 'turnout_2021_z', NULL, 0.0
UNION ALL SELECT g || ' precision', NULL, 0.0 FROM (VALUES {", ".join(f"('{g}')" for g in FACTORS)}) t(g)"""


@register("mixed_fit_residual", residual_sql())
def mixed_fit_residual(spark, sf_dir):
    """M1: how far the fit is from its own fixed point, per coefficient and
    precision, recomputed from the cells with plain joins and aggregates (per
    trial, four places)."""
    x = "turnout_2021_z"
    c = model.cells(labelled_survey(spark, sf_dir), "voted", list(FACTORS), [x]).checkpoint(eager=True)
    f = model.fit_mixed(spark, c, list(FACTORS), x)
    return model.fixed_point_residuals(spark, f, c, list(FACTORS), x).withColumn("residual", F.round("residual", 4) + 0.0)


# ----------------------------------------------------------- draws

def _survey_mean_cov_sql() -> dict:
    return dict(
        s=SURVEY_SQL,
        x="""SELECT CASE WHEN rs > 5 THEN p_aitc / 100 ELSE p_aitc END AS a, CASE WHEN rs > 5 THEN p_nda / 100 ELSE p_nda END AS b
             FROM (SELECT *, coalesce(p_aitc, 0) + coalesce(p_nda, 0) AS rs FROM s) WHERE p_aitc IS NOT NULL AND p_nda IS NOT NULL""",
        st="""SELECT avg(a) AS ma, avg(b) AS mb, var_samp(a) / count(*) AS vaa, covar_samp(a, b) / count(*) AS vab,
                     var_samp(b) / count(*) AS vbb FROM x""",
        ch="""SELECT ma, mb, sqrt(vaa + 1e-8::DOUBLE) AS l11, vab / sqrt(vaa + 1e-8::DOUBLE) AS l21,
                     sqrt(vbb + 1e-8::DOUBLE - (vab / sqrt(vaa + 1e-8::DOUBLE)) * (vab / sqrt(vaa + 1e-8::DOUBLE))) AS l22 FROM st""",
    )


@register("coef_draws", cte(**_survey_mean_cov_sql()) + f"""
SELECT CAST(d AS INTEGER) AS draw,
       round(ma + l11 * {normal_sql(5, '0', 'd')}, 6) AS mu_aitc,
       round(mb + l21 * {normal_sql(5, '0', 'd')} + l22 * {normal_sql(5, '1', 'd')}, 6) AS mu_nda
FROM range(1, 501) r(d), ch""")
def coef_draws(spark, sf_dir):
    """500 multivariate normal draws of the mean answer shares (mean and
    covariance of the mean from the survey; Cholesky of the 2x2 covariance
    on the driver, ridge 1e-8)."""
    s = survey(spark, sf_dir).where(F.col("p_aitc").isNotNull() & F.col("p_nda").isNotNull())
    pct = N.row_sum("p_aitc", "p_nda") > 5
    x = s.select(F.when(pct, F.col("p_aitc") / 100).otherwise(F.col("p_aitc")).alias("a"),
                 F.when(pct, F.col("p_nda") / 100).otherwise(F.col("p_nda")).alias("b"))
    n = F.count(F.lit(1))
    st = x.agg(F.avg("a").alias("ma"), F.avg("b").alias("mb"), (F.var_samp("a") / n).alias("vaa"),
               (F.covar_samp("a", "b") / n).alias("vab"), (F.var_samp("b") / n).alias("vbb")).first()   # one row
    cov = [[st["vaa"], st["vab"]], [st["vab"], st["vbb"]]]
    d = poststrat.coefficient_draws(spark, ["mu_aitc", "mu_nda"], [st["ma"], st["mb"]], cov, 500, 5)
    return d.select("draw", r6("mu_aitc").alias("mu_aitc"), r6("mu_nda").alias("mu_nda"))


def _frame_strata(spark, sf_dir, past_df=None):
    """Poststratification frame: strata with a known area type (as the
    reference drops blank area types), N = n_individuals, covariates."""
    fr = frame.stratification_frame(roll(spark, sf_dir)).where(F.col("area_type").isNotNull())
    cov = (past_df if past_df is not None else past(spark, sf_dir)).select("constituency_name", "turnout_2021_z", "AITC_2021_z", "NDA_cond_2021_z",
                                     "AITC_2021", "NDA_2021", "OTHER_2021")
    return model.attach_covariates(fr, cov, "constituency_name",
                                   ["turnout_2021_z", "AITC_2021_z", "NDA_cond_2021_z"])


FRAME_KEY_COLS = ("eroll_no", "gender", "age_band", "area_type", "R", "G", "SG")


def _noise_key():
    return [F.coalesce(F.col(c).cast("string"), F.lit("~")) for c in FRAME_KEY_COLS]


def _noise_key_sql():
    return [f"coalesce(CAST({c} AS VARCHAR), '~')" if c not in ("R", "G", "SG") else f'coalesce("{c}", \'~\')'
            for c in FRAME_KEY_COLS]


def stage_draw_tables(spark):
    return {k: poststrat.coefficient_draws(spark, [f"{k}0", f"{k}1"], mean, cov, FORECAST_DRAWS, seed)
            for k, (mean, cov, seed) in STAGE_COEF.items()}


def three_stage_cells(spark, sf_dir, past_df=None, keys: bool = True):
    """M6 x 3 + M8: the three stage probabilities in one row per (stratum,
    draw), then the three shares (population scale, reference). The noise
    key string is built once per stratum, before the expansion by draws;
    with ``keys=False`` the expanded rows carry only what poststratification
    reads."""
    st = _frame_strata(spark, sf_dir, past_df)
    st = st.withColumn("__nk", F.concat_ws("|", *_noise_key()))
    if not keys:
        st = st.select("eroll_no", "constituency_name", "n_individuals", "turnout_2021_z", "AITC_2021_z",
                       "NDA_cond_2021_z", "__nk")
    d = stage_draw_tables(spark)
    draws = d["t"].join(d["a"], "draw").join(d["n"], "draw")
    sd = float(np.sqrt(sum(v * v for v in RE_SD.values())))
    cov_of = {"t": "turnout_2021_z", "a": "AITC_2021_z", "n": "NDA_cond_2021_z"}
    j = poststrat.with_draws(st, draws, FORECAST_DRAWS)
    # same digest input as concat_ws(seed, key columns..., draw)
    z1, z2 = normal_pair(NOISE_SEED, F.col("__nk"), "draw")
    z3, _ = normal_pair(NOISE_SEED + 1, F.col("__nk"), "draw")
    noise = {"t": z1, "a": z2, "n": z3}
    ps = {}
    for k in ("t", "a", "n"):
        lp = F.col(f"{k}0") + F.col(f"{k}1") * F.col(cov_of[k]) + F.lit(sd) * noise[k]
        ps[k] = N.inv_logit(lp)
    shares = poststrat.stage_shares(ps["t"], ps["a"], ps["n"], "population")
    kept = list(FRAME_KEY_COLS[1:]) if keys else []
    return j.select("eroll_no", "constituency_name", "n_individuals", "draw", *kept,
                    ps["t"].alias("p_t"), *[v.alias(k) for k, v in shares.items()])


def _cells_sql() -> dict:
    d = past_sql()
    d["sf0"] = "SELECT * FROM (" + _strat_frame_inner() + ")"
    d["sf"] = """SELECT f.*, p.turnout_2021_z, p.AITC_2021_z, p.NDA_cond_2021_z FROM sf0 f
                 LEFT JOIN past p ON f.constituency_name = p.constituency_name WHERE f.area_type IS NOT NULL"""
    d["sfx"] = """SELECT * REPLACE (
        coalesce(turnout_2021_z, (SELECT quantile_cont(turnout_2021_z, 0.5) FROM past)) AS turnout_2021_z,
        coalesce(AITC_2021_z, (SELECT quantile_cont(AITC_2021_z, 0.5) FROM past)) AS AITC_2021_z,
        coalesce(NDA_cond_2021_z, (SELECT quantile_cont(NDA_cond_2021_z, 0.5) FROM past)) AS NDA_cond_2021_z) FROM sf"""
    for k, (mean, cov, seed) in STAGE_COEF.items():
        d[f"d{k}"] = draws_sql([f"{k}0", f"{k}1"], mean, cov, FORECAST_DRAWS, seed)
    sd = float(np.sqrt(sum(v * v for v in RE_SD.values())))
    key = _noise_key_sql()
    z1, z2 = normal_pair_sql(NOISE_SEED, *key, "r.draw")
    z3, _ = normal_pair_sql(NOISE_SEED + 1, *key, "r.draw")
    noise = {"t": z1, "a": z2, "n": z3}
    lp = {}
    for k, c in (("t", "turnout_2021_z"), ("a", "AITC_2021_z"), ("n", "NDA_cond_2021_z")):
        z = noise[k]
        lp[k] = f"1.0::DOUBLE / (1.0::DOUBLE + exp(-(d{k}.{k}0 + d{k}.{k}1 * {c} + {dlit(sd)} * {z})))"
    d["cl0"] = f"""SELECT r.*, {lp['t']} AS p_t, {lp['a']} AS p_a, {lp['n']} AS p_n
        FROM (SELECT sfx.*, CAST(g.draw AS INTEGER) AS draw FROM sfx, range(1, {FORECAST_DRAWS + 1}) g(draw)) r
        JOIN dt ON dt.draw = r.draw JOIN da ON da.draw = r.draw JOIN dn ON dn.draw = r.draw"""
    d["cl"] = """SELECT *, p_t * p_a AS "AITC", p_t * ((1.0 - p_a) * p_n) AS "NDA",
                        p_t * ((1.0 - p_a) * (1.0 - p_n)) AS "OTHER" FROM cl0"""
    return d


def _strat_frame_inner() -> str:
    from strataforge.plans.q_frame import STRAT_FRAME_SQL
    return STRAT_FRAME_SQL.replace("round(weighted_n, 6) AS weighted_n", "weighted_n").replace(
        "round(weighted_n / sum(weighted_n) OVER (PARTITION BY eroll_no), 6) AS stratum_share",
        "weighted_n / sum(weighted_n) OVER (PARTITION BY eroll_no) AS stratum_share")


@register("stage_shares", cte(**_cells_sql()) + """
SELECT eroll_no, gender, age_band, area_type, "R", "G", "SG",
  round(avg("AITC"), 6) AS mean_aitc, round(avg("NDA"), 6) AS mean_nda, round(avg("OTHER"), 6) AS mean_other,
  round(max(abs("AITC" + "NDA" + "OTHER" - p_t)), 6) AS max_sum_error
FROM cl GROUP BY eroll_no, gender, age_band, area_type, "R", "G", "SG" """)
def stage_shares(spark, sf_dir):
    """Shares (1-a)n etc. times turnout; per stratum the mean
    share over draws and the largest |sum - turnout| (property: 0)."""
    c = three_stage_cells(spark, sf_dir)
    return c.groupBy(*FRAME_KEY_COLS).agg(
        r6(F.avg("AITC")).alias("mean_aitc"), r6(F.avg("NDA")).alias("mean_nda"), r6(F.avg("OTHER")).alias("mean_other"),
        r6(F.max(F.abs(F.col("AITC") + F.col("NDA") + F.col("OTHER") - F.col("p_t")))).alias("max_sum_error"))


@register("cell_draws", cte(**_cells_sql()) + """
SELECT eroll_no, gender, age_band, area_type, "R", "G", "SG",
  round(avg(p_t), 6) AS mean_p, round(min(p_t), 6) AS min_p, round(max(p_t), 6) AS max_p
FROM cl GROUP BY eroll_no, gender, age_band, area_type, "R", "G", "SG" """)
def cell_draws(spark, sf_dir):
    """M6 + J13 + J16 + G9 (cell noise, Q1 reference mode): stage-0
    probability per stratum and draw, summarised per stratum."""
    c = three_stage_cells(spark, sf_dir)
    return c.groupBy(*FRAME_KEY_COLS).agg(r6(F.avg("p_t")).alias("mean_p"), r6(F.min("p_t")).alias("min_p"),
                                           r6(F.max("p_t")).alias("max_p"))


def seat_forecast_from_cells(spark, sf_dir, c, past_df=None, scale: str = "population"):
    ps = poststrat.poststratify(c, "constituency_name", "n_individuals", ["AITC", "NDA", "OTHER"])
    if scale == "votes":
        ps = poststrat.normalise_draws(ps, ["AITC", "NDA", "OTHER"])
    summ = poststrat.summarise_draws(poststrat.to_long(ps, ["constituency_name", "draw"], ["AITC", "NDA", "OTHER"]),
                                     ["constituency_name", "choice"])
    wide = poststrat.seat_table(summ, "constituency_name", ["AITC", "NDA", "OTHER"])
    pastv = (past_df if past_df is not None else past(spark, sf_dir)).select(
        "constituency_name", "AITC_2021", "NDA_2021", "OTHER_2021")
    wide = wide.join(pastv, "constituency_name", "left")     # both one row per seat; AQE sizes it
    surveyed = survey(spark, sf_dir).select(F.col("constituency_name").alias("__s")).distinct()
    wide = wide.join(surveyed, F.col("constituency_name") == F.col("__s"), "left") \
               .withColumn("surveyed", F.col("__s").isNotNull()).drop("__s")
    return wide.select(
        "constituency_name", *[r6(f"{m}_{c}").alias(f"{m}_{c}") for c in ("AITC", "NDA", "OTHER")
                               for m in ("median", "ci_low", "ci_high")],
        "winner",
        r6(F.col("median_AITC") - F.col("AITC_2021") * 100).alias("aitc_swing"),
        r6(F.col("median_NDA") - F.col("NDA_2021") * 100).alias("nda_swing"),
        r6(F.col("median_OTHER") - F.col("OTHER_2021") * 100).alias("other_swing"),
        r6(F.col("median_AITC") - F.col("median_NDA")).alias("margin"), "surveyed")


@register("seat_forecast_votes", cte(**_cells_sql(),
    ps0="""SELECT constituency_name, draw, sum(n_individuals * "AITC") / sum(n_individuals) AS a,
              sum(n_individuals * "NDA") / sum(n_individuals) AS n, sum(n_individuals * "OTHER") / sum(n_individuals) AS o
          FROM cl GROUP BY constituency_name, draw""",
    ps="""SELECT constituency_name, draw, a / (a + n + o) AS a, n / (a + n + o) AS n, o / (a + n + o) AS o FROM ps0""",
    q="""SELECT constituency_name, quantile_cont(a, [0.025, 0.5, 0.975]) AS qa, quantile_cont(n, [0.025, 0.5, 0.975]) AS qn,
                quantile_cont(o, [0.025, 0.5, 0.975]) AS qo FROM ps GROUP BY constituency_name""",
    m="""SELECT *, qa[2] * 100 / (qa[2] * 100 + qn[2] * 100 + qo[2] * 100) * 100 AS ma,
                qn[2] * 100 / (qa[2] * 100 + qn[2] * 100 + qo[2] * 100) * 100 AS mn,
                qo[2] * 100 / (qa[2] * 100 + qn[2] * 100 + qo[2] * 100) * 100 AS mo FROM q""",
    s2=SURVEY_SQL) + """
SELECT m.constituency_name,
  round(ma, 6) AS median_AITC, round(qa[1] * 100, 6) AS ci_low_AITC, round(qa[3] * 100, 6) AS ci_high_AITC,
  round(mn, 6) AS median_NDA, round(qn[1] * 100, 6) AS ci_low_NDA, round(qn[3] * 100, 6) AS ci_high_NDA,
  round(mo, 6) AS median_OTHER, round(qo[1] * 100, 6) AS ci_low_OTHER, round(qo[3] * 100, 6) AS ci_high_OTHER,
  CASE WHEN ma >= mn AND ma >= mo THEN 'AITC' WHEN mn >= mo THEN 'NDA' ELSE 'OTHER' END AS winner,
  round(ma - p.AITC_2021 * 100, 6) AS aitc_swing, round(mn - p.NDA_2021 * 100, 6) AS nda_swing,
  round(mo - p.OTHER_2021 * 100, 6) AS other_swing, round(ma - mn, 6) AS margin,
  m.constituency_name IN (SELECT constituency_name FROM s2) AS surveyed
FROM m LEFT JOIN past p ON m.constituency_name = p.constituency_name""")
def seat_forecast_votes(spark, sf_dir):
    """M9 with Q2 ``scale='votes'``: each draw's shares are normalised to
    sum to one (turnout-weighted shares of votes) before the median and
    interval, so intervals compare with official vote shares."""
    p = past(spark, sf_dir)
    return seat_forecast_from_cells(spark, sf_dir, three_stage_cells(spark, sf_dir, p, keys=False), p, "votes")


CHOICE_OF_BUCKET = {"AITC+": "AITC", "BJP": "NDA", "Other": "OTHER"}


def _forecast_check_sql() -> str:
    one = " UNION ALL ".join(
        f"""SELECT '{c}' AS choice, truth, winner, {a} AS a, ci_low_{c} AS lo, ci_high_{c} AS hi FROM j"""
        for a, c in (("a", "AITC"), ("j", "NDA"), ("o", "OTHER")))
    return f"""WITH fc AS ({catalogue.ORACLE["seat_forecast_votes"]}),
    off AS ({q_results.base("win")} SELECT constituency, a, j, o, CASE winner WHEN 'AITC+' THEN 'AITC' WHEN 'BJP' THEN 'NDA' ELSE 'OTHER' END AS truth FROM win),
    j AS (SELECT fc.*, off.a, off.j, off.o, off.truth FROM fc JOIN off ON fc.constituency_name = off.constituency),
    x AS ({one})
    SELECT choice, CAST(sum(CASE WHEN truth = choice THEN 1 ELSE 0 END) AS BIGINT) AS seats,
           CAST(sum(CASE WHEN truth = choice AND winner = choice THEN 1 ELSE 0 END) AS BIGINT) AS hits,
           CAST(sum(CASE WHEN a BETWEEN lo AND hi THEN 1 ELSE 0 END) AS BIGINT) AS inside,
           round(avg(CASE WHEN a BETWEEN lo AND hi THEN 1 ELSE 0 END), 6) AS coverage, round(avg(hi - lo), 6) AS mean_width,
           round(avg(greatest(a - hi, 0)) + avg(greatest(lo - a, 0)), 6) AS mean_miss FROM x GROUP BY choice"""


@register("forecast_check", _forecast_check_sql())
def forecast_check(spark, sf_dir):
    """J11 + J10 + A15 + A16 end to end: the vote-share forecast against the
    official bucket result. Official names come in another spelling (lower
    case, blanks, an area code); they are cleaned (F5, F6) and matched to the
    forecast's names, then seats won, hits and interval coverage per choice."""
    fc = seat_forecast_votes(spark, sf_dir)
    off = q_results.bucket_wide(spark, sf_dir).withColumn(
        "name", F.concat(F.lit("  "), F.lower("constituency"), F.lit(" - 07 ")))
    off = off.select(T.strip_trailing_code("name").alias("name"), "winner",
                     *[F.col(f"`{b}_vote_share`").alias(f"actual_{c}") for b, c in CHOICE_OF_BUCKET.items()])
    pairs = match.best_match(fc, off, "constituency_name", "name")
    truth = F.when(F.col("official") == "AITC+", "AITC").when(F.col("official") == "BJP", "NDA").otherwise("OTHER")
    j = (fc.join(pairs.select(F.col("left_name").alias("constituency_name"), F.col("right_name").alias("name")), "constituency_name")
         .join(off.withColumnRenamed("winner", "official"), "name").withColumn("truth", truth))
    choices = list(CHOICE_OF_BUCKET.values())
    cover = results.interval_check(j, ["constituency_name"], choices)
    won = F.explode(F.array(*[F.struct(F.lit(c).alias("choice"), (F.col("truth") == c).cast("int").alias("is"),
                                       ((F.col("truth") == c) & (F.col("winner") == c)).cast("int").alias("hit")) for c in choices]))
    seats = j.select(won.alias("w")).groupBy("w.choice").agg(F.sum("w.is").cast("bigint").alias("seats"),
                                                             F.sum("w.hit").cast("bigint").alias("hits"))
    return seats.join(cover, "choice").select("choice", "seats", "hits", "inside",
                                              *[r6(c).alias(c) for c in ("coverage", "mean_width", "mean_miss")])


@register("seat_forecast", cte(**_cells_sql(),
    ps="""SELECT constituency_name, draw, sum(n_individuals * "AITC") / sum(n_individuals) AS a,
              sum(n_individuals * "NDA") / sum(n_individuals) AS n, sum(n_individuals * "OTHER") / sum(n_individuals) AS o
          FROM cl GROUP BY constituency_name, draw""",
    q="""SELECT constituency_name, quantile_cont(a, [0.025, 0.5, 0.975]) AS qa, quantile_cont(n, [0.025, 0.5, 0.975]) AS qn,
                quantile_cont(o, [0.025, 0.5, 0.975]) AS qo FROM ps GROUP BY constituency_name""",
    m="""SELECT *, qa[2] * 100 / (qa[2] * 100 + qn[2] * 100 + qo[2] * 100) * 100 AS ma,
                qn[2] * 100 / (qa[2] * 100 + qn[2] * 100 + qo[2] * 100) * 100 AS mn,
                qo[2] * 100 / (qa[2] * 100 + qn[2] * 100 + qo[2] * 100) * 100 AS mo FROM q""",
    s2=SURVEY_SQL) + """
SELECT m.constituency_name,
  round(ma, 6) AS median_AITC, round(qa[1] * 100, 6) AS ci_low_AITC, round(qa[3] * 100, 6) AS ci_high_AITC,
  round(mn, 6) AS median_NDA, round(qn[1] * 100, 6) AS ci_low_NDA, round(qn[3] * 100, 6) AS ci_high_NDA,
  round(mo, 6) AS median_OTHER, round(qo[1] * 100, 6) AS ci_low_OTHER, round(qo[3] * 100, 6) AS ci_high_OTHER,
  CASE WHEN ma >= mn AND ma >= mo THEN 'AITC' WHEN mn >= mo THEN 'NDA' ELSE 'OTHER' END AS winner,
  round(ma - p.AITC_2021 * 100, 6) AS aitc_swing, round(mn - p.NDA_2021 * 100, 6) AS nda_swing,
  round(mo - p.OTHER_2021 * 100, 6) AS other_swing, round(ma - mn, 6) AS margin,
  m.constituency_name IN (SELECT constituency_name FROM s2) AS surveyed
FROM m LEFT JOIN past p ON m.constituency_name = p.constituency_name""")
def seat_forecast(spark, sf_dir):
    """M9 (+M10, J6, F36, J7, J9): poststratified shares per seat and draw,
    median and 95 % interval, medians rescaled to 100, winner, swing against
    the past result, margin and the surveyed flag; fixed coefficients."""
    p = past(spark, sf_dir)          # one per-seat table for covariates and swings
    return seat_forecast_from_cells(spark, sf_dir, three_stage_cells(spark, sf_dir, p, keys=False), p)


# ----------------------------------------------------------- end to end

STAGES = (("t", "voted", "turnout_2021_z"), ("a", "voted_AITC", "AITC_2021_z"), ("n", "voted_NDA_cond", "NDA_cond_2021_z"))
MRP_DRAWS = 500
MRP_SEED = 3030


def stage_fits(spark, sf_dir, factors=FACTORS):
    """M7: turnout on all rows, first party among voters, second party among
    voters not choosing the first; each stage filters its own rows and runs
    the M4 chain on its cells. The labelled survey is materialised once."""
    s = labelled_survey(spark, sf_dir).checkpoint(eager=True)
    fits = {}
    for k, outcome, cov in STAGES:
        c = model.cells(s, outcome, list(factors), [cov])
        fits[k] = model.fit_with_fallback(spark, c, list(factors), "constituency_name", cov)
    return fits


def level_effects(spark, st, fits, g, n_draws, seed):
    """Random effect of every level of factor ``g`` in every draw for the
    three stages: fitted mean + posterior sd x normal, or N(0, s_g^2) for a
    level the survey never saw. One row per (level, draw): levels x draws,
    bounded by the factor's level list and the draw count, so it is
    broadcast; no per-cell hashing."""
    lv = st.select(F.col(g).alias("level")).distinct()
    cols = []
    for i, (k, _, _) in enumerate(STAGES):
        f = fits[k]
        if g not in f.variances:
            cols.append(F.lit(0.0).alias(f"e_{k}"))
            continue
        lt = f.level_table(spark, g).select("level", F.col("m").alias(f"m_{k}"), F.col("s").alias(f"s_{k}"))
        lv = lv.join(F.broadcast(lt), "level", "left")   # the fit's level list: size known on the driver
        z = normal_pair(seed + 100 + 10 * i, F.lit(g), F.col("level"), "draw")[0]
        sd_unseen = float(np.sqrt(f.variances[g]))
        cols.append((F.coalesce(F.col(f"m_{k}"), F.lit(0.0)) + F.coalesce(F.col(f"s_{k}"), F.lit(sd_unseen)) * z)
                    .alias(f"e_{k}"))
    eff = lv.withColumn("draw", F.explode(F.sequence(F.lit(1), F.lit(n_draws)))).select(
        F.col("level").alias(g), "draw", *cols)
    return eff.select(g, "draw", *[F.col(f"e_{k}").alias(f"e_{k}_{g}") for k, _, _ in STAGES])


def mrp_cells(spark, sf_dir, fits, n_draws=MRP_DRAWS, re_mode="level", seed=MRP_SEED):
    """M6 for the three fitted stages: fixed-effect draws from each fit's
    posterior (G8), random effects either shared per level (``level``:
    fitted mean + posterior sd, unseen levels N(0, s_g^2); one small table
    per factor joined on (level, draw)) or, as the reference, one cell-level
    normal with the summed variances (``cell``, Q1)."""
    st = _frame_strata(spark, sf_dir)
    for g in FACTORS:
        st = st.withColumn(g, F.col(g).cast("string"))
    st = st.checkpoint(eager=True)
    draws = None
    for i, (k, _, _) in enumerate(STAGES):
        f = fits[k]
        d = poststrat.coefficient_draws(spark, [f"{k}0", f"{k}1"], f.mean, f.cov, n_draws, seed + i)
        draws = d if draws is None else draws.join(d, "draw")
    j = poststrat.with_draws(st, draws, n_draws)
    lp = {k: F.col(f"{k}0") + F.col(f"{k}1") * F.col(cov) for k, _, cov in STAGES}
    if re_mode == "level":
        for g in FACTORS:
            if not any(g in fits[k].variances for k, _, _ in STAGES):
                continue
            eff = level_effects(spark, st, fits, g, n_draws, seed)
            j = join_bounded(j, eff, [g, "draw"], "left")     # levels x draws, size checked
            lp = {k: e + F.coalesce(F.col(f"e_{k}_{g}"), F.lit(0.0)) for k, e in lp.items()}
    else:
        key = _noise_key()
        for i, (k, _, _) in enumerate(STAGES):
            if fits[k].variances:
                sd = float(np.sqrt(sum(fits[k].variances.values())))
                lp[k] = lp[k] + F.lit(sd) * normal_pair(seed + 100 + 10 * i, *key, "draw")[0]
    ps = {k: N.inv_logit(e) for k, e in lp.items()}
    shares = poststrat.stage_shares(ps["t"], ps["a"], ps["n"], "population")
    return j.select("constituency_name", "n_individuals", "draw", *[v.alias(k) for k, v in shares.items()])


@register("mrp_forecast")
def mrp_forecast(spark, sf_dir):
    """Entry C end to end (M7 + M6 + M9): three fitted stages on the survey,
    posterior draws poststratified over the roll frame, seat table with
    intervals, winner, swing and surveyed flag. Rows only (model fits are
    iterative)."""
    fits = stage_fits(spark, sf_dir)
    # library defaults: level-shared effects (Q1), vote-share
    # intervals (Q2); the oracle queries keep the reference's choices
    out = seat_forecast_from_cells(spark, sf_dir, mrp_cells(spark, sf_dir, fits), scale="votes")
    types = [(k, fits[k].model_type) for k, _, _ in STAGES]
    return out.withColumn("models", F.lit(",".join(f"{k}:{t}" for k, t in types)))


def electors(spark, sf_dir):
    """Electors per seat from the roll: the sum of each booth's first known
    head count (A2 + aggregate), one row per seat."""
    r = roll(spark, sf_dir)
    b = frame.first_non_null(r, ["eroll_no", "booth_no"], "total_individuals", "voter_id")
    return b.groupBy("eroll_no").agg(F.sum("total_individuals").alias("electors")).select(
        F.concat(F.lit("SEAT-"), F.col("eroll_no").cast("string")).alias("constituency_name"), "electors")


def _turnout_electors_sql() -> str:
    from strataforge.plans.derived import ROLL_SQL
    from strataforge.plans.q_frame import BOOTH_SQL
    d = past_sql()
    d["roll"] = ROLL_SQL
    d["booth"] = BOOTH_SQL
    d["el"] = """SELECT 'SEAT-' || CAST(eroll_no AS VARCHAR) AS constituency_name, sum(ti) AS electors
                 FROM booth GROUP BY eroll_no"""
    return cte(**d) + """
SELECT p.constituency_name, round(p.turnout_2021, 6) AS turnout_max,
       round(p.total_votes / e.electors, 6) AS turnout_electors
FROM past p LEFT JOIN el e ON p.constituency_name = e.constituency_name"""


@register("turnout_electors", _turnout_electors_sql())
def turnout_electors(spark, sf_dir):
    """Q5 both ways: the reference's turnout proxy (F23, votes / largest
    seat's votes) beside votes / electors, electors summed from the roll's
    booth head counts (J7 left join, one row per seat on both sides)."""
    p = past(spark, sf_dir)
    e = electors(spark, sf_dir)
    j = p.join(e, "constituency_name", "left")
    return j.select("constituency_name", r6("turnout_2021").alias("turnout_max"),
                    r6(F.try_divide(F.col("total_votes"), F.col("electors"))).alias("turnout_electors"))
