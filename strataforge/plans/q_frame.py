"""Phase 1 queries: the poststratification slice and the frame build."""

from __future__ import annotations

from pyspark.sql import functions as F

from strataforge.functions.bins import right_closed_bins, band_order, fix_values
from strataforge.functions.hashing import normal_sql, dlit
from strataforge.functions.text import regex_capture, strip_all
from strataforge.operators import clean, frame, poststrat
from strataforge.plans.catalogue import register, r6, cte
from strataforge.plans.derived import roll, ROLL_SQL
from strataforge.sources.tables import table

AGE_BAND_SQL = """CASE WHEN age > 18 AND age <= 25 THEN '18-25' WHEN age > 25 AND age <= 35 THEN '26-35'
 WHEN age > 35 AND age <= 45 THEN '36-45' WHEN age > 45 AND age <= 60 THEN '46-60'
 WHEN age > 60 THEN '60+' END"""

# Fixed parameters of the slice: coefficient means and covariance of
# (intercept, age band ordinal, urban flag), draw count and seed.
SLICE_TERMS = ("b_intercept", "b_age", "b_urban")
SLICE_MEAN = (-0.3, 0.12, -0.25)
SLICE_COV = ((0.0100, 0.0010, 0.0000),
             (0.0010, 0.0025, 0.0005),
             (0.0000, 0.0005, 0.0064))
SLICE_DRAWS = 500
SLICE_SEED = 2026


def draws_sql(terms, mean, cov, n_draws, seed) -> str:
    """Oracle twin of ``poststrat.coefficient_draws``."""
    L, _ = poststrat.cholesky_factor(cov)
    cols = []
    for j, t in enumerate(terms):
        e = dlit(mean[j])
        for k in range(j + 1):
            if L[j, k] != 0.0:
                e += f" + {dlit(L[j, k])} * {normal_sql(seed, str(k), 'draw')}"
        cols.append(f"{e} AS {t}")
    return f"SELECT CAST(d AS INTEGER) AS draw, {', '.join(cols)} FROM range(1, {n_draws + 1}) t(d)"


def slice_strata(spark, sf_dir):
    rows = roll(spark, sf_dir).withColumn("age_band", right_closed_bins(F.col("age")))
    strata = rows.groupBy("eroll_no", "age_band", "area_type", "R").agg(F.count(F.lit(1)).alias("n"))
    return frame.share_within(strata, "eroll_no", "n", "stratum_share")


def poststrat_slice(spark, sf_dir):
    """Poststratified share per area with a 95 % interval from coefficient
    draws: strata (A1) -> share (W2) -> x draws (J13) -> linear predictor,
    inverse logit (J16, F20) -> sum N p / sum N with both sums in one
    aggregate (A14, J5) -> quantiles (A10) -> winner (W8)."""
    strata = slice_strata(spark, sf_dir)
    draws = poststrat.coefficient_draws(spark, SLICE_TERMS, SLICE_MEAN, SLICE_COV,
                                        SLICE_DRAWS, SLICE_SEED)
    design = {"b_intercept": F.lit(1.0),
              "b_age": band_order(F.col("age_band")).cast("double"),
              "b_urban": F.when(F.col("area_type") == "Urb", 1.0).otherwise(0.0)}
    cells = poststrat.cell_draws(strata, draws, design, "A", keep=["eroll_no", "stratum_share"])
    cells = cells.withColumn("B", F.lit(1.0) - F.col("A"))
    ps = poststrat.poststratify(cells, "eroll_no", "stratum_share", ["A", "B"])
    summ = poststrat.summarise_draws(poststrat.to_long(ps, ["eroll_no", "draw"], ["A", "B"]),
                                     ["eroll_no", "choice"])
    wide = poststrat.seat_table(summ, "eroll_no", ["A", "B"])
    return wide.select("eroll_no", *[r6(c).alias(c) for c in wide.columns if c not in ("eroll_no", "winner")],
                       "winner")


def _poststrat_slice_sql() -> str:
    q = "[0.025, 0.5, 0.975]"
    return cte(
        roll=ROLL_SQL,
        strata=f"""SELECT eroll_no, age_band, area_type, "R", count(*) AS n
                   FROM (SELECT *, {AGE_BAND_SQL} AS age_band FROM roll) GROUP BY ALL""",
        sh="SELECT *, n / sum(n) OVER (PARTITION BY eroll_no) AS w FROM strata",
        draws=draws_sql(SLICE_TERMS, SLICE_MEAN, SLICE_COV, SLICE_DRAWS, SLICE_SEED),
        cells=f"""SELECT s.eroll_no, s.w, d.draw,
                    1.0::DOUBLE / (1.0::DOUBLE + exp(-(d.b_intercept * 1.0::DOUBLE
                      + d.b_age * CAST(CASE s.age_band WHEN '18-25' THEN 1 WHEN '26-35' THEN 2
                          WHEN '36-45' THEN 3 WHEN '46-60' THEN 4 WHEN '60+' THEN 5 END AS DOUBLE)
                      + d.b_urban * (CASE WHEN s.area_type = 'Urb' THEN 1.0 ELSE 0.0 END)))) AS p
                  FROM sh s CROSS JOIN draws d""",
        ps="""SELECT eroll_no, draw, sum(w * p) / sum(w) AS a, sum(w * (1 - p)) / sum(w) AS b
              FROM cells GROUP BY eroll_no, draw""",
        qs=f"""SELECT eroll_no, quantile_cont(a, {q}) AS qa, quantile_cont(b, {q}) AS qb
               FROM ps GROUP BY eroll_no""",
        m="""SELECT eroll_no, qa, qb, qa[2] * 100 / (qa[2] * 100 + qb[2] * 100) * 100 AS ma,
                    qb[2] * 100 / (qa[2] * 100 + qb[2] * 100) * 100 AS mb FROM qs""",
    ) + """SELECT eroll_no, round(ma, 6) AS median_A, round(qa[1] * 100, 6) AS ci_low_A,
              round(qa[3] * 100, 6) AS ci_high_A, round(mb, 6) AS median_B,
              round(qb[1] * 100, 6) AS ci_low_B, round(qb[3] * 100, 6) AS ci_high_B,
              CASE WHEN ma >= mb THEN 'A' ELSE 'B' END AS winner FROM m"""


register("poststrat_slice", _poststrat_slice_sql())(poststrat_slice)


@register("age_bands", cte(roll=ROLL_SQL) + f"""
SELECT voter_id, age, {AGE_BAND_SQL} AS age_band,
       CASE WHEN age >= 18 AND age <= 25 THEN '18-25' ELSE {AGE_BAND_SQL} END AS age_band_incl,
       CASE WHEN age >= 60 THEN '60+' ELSE {AGE_BAND_SQL} END AS age_band_fixed
FROM roll""")
def age_bands(spark, sf_dir):
    """F16 right-closed bands (age 18 has none, Q9), the include-lowest
    variant, and the F17 fix-up ``"60"`` -> ``"60+"``."""
    r = roll(spark, sf_dir)
    band = right_closed_bins(F.col("age"))
    return r.select("voter_id", "age", band.alias("age_band"),
                    right_closed_bins(F.col("age"), include_lowest=True).alias("age_band_incl"),
                    fix_values(F.when(F.col("age") >= 60, F.lit("60")).otherwise(band), {"60": "60+"})
                    .alias("age_band_fixed"))


MODE_SQL = """SELECT eroll_no, booth_no, area_type AS m FROM (
  SELECT eroll_no, booth_no, area_type,
         row_number() OVER (PARTITION BY eroll_no, booth_no ORDER BY count(*) DESC, area_type) AS rn
  FROM roll WHERE area_type IS NOT NULL GROUP BY eroll_no, booth_no, area_type) WHERE rn = 1"""


@register("group_mode_fill", cte(roll=ROLL_SQL, modes=MODE_SQL) + """
SELECT r.voter_id, r.eroll_no, r.booth_no, coalesce(r.area_type, m.m, 'Unknown') AS area_type
FROM roll r LEFT JOIN modes m ON r.eroll_no = m.eroll_no AND r.booth_no = m.booth_no""")
def group_mode_fill(spark, sf_dir):
    """A3 mode per booth (ties -> smallest), J2 fill, W7 literal fallback."""
    r = roll(spark, sf_dir).select("voter_id", "eroll_no", "booth_no", "area_type")
    return frame.fill_from_group_mode(r, ["eroll_no", "booth_no"], "area_type", fallback="Unknown")


BOOTH_SQL = """SELECT eroll_no, booth_no, arg_min(total_individuals, voter_id) AS ti FROM roll
  WHERE total_individuals IS NOT NULL AND booth_no IS NOT NULL AND eroll_no IS NOT NULL
  GROUP BY eroll_no, booth_no"""


@register("booth_weights", cte(roll=ROLL_SQL, booth=BOOTH_SQL) + """
SELECT eroll_no, booth_no, round(ti / sum(ti) OVER (PARTITION BY eroll_no), 6) AS booth_weight FROM booth""")
def booth_weights(spark, sf_dir):
    """A2 first non-null head count per booth, W1 area total, W2 share."""
    w = frame.booth_weights(roll(spark, sf_dir))
    return w.select("eroll_no", "booth_no", r6("booth_weight").alias("booth_weight"))


STRAT_FRAME_SQL = cte(
    roll=ROLL_SQL,
    r=f"SELECT *, {AGE_BAND_SQL} AS age_band FROM roll",
    modes=MODE_SQL,
    f="""SELECT r.* EXCLUDE (area_type), coalesce(r.area_type, m.m) AS area_type
         FROM r LEFT JOIN modes m ON r.eroll_no = m.eroll_no AND r.booth_no = m.booth_no""",
    booth=BOOTH_SQL.replace("FROM roll", "FROM f"),
    bw="SELECT eroll_no, booth_no, ti / sum(ti) OVER (PARTITION BY eroll_no) AS booth_weight FROM booth",
    x="""SELECT f.*, bw.booth_weight FROM f LEFT JOIN bw
         ON f.eroll_no = bw.eroll_no AND f.booth_no = bw.booth_no""",
    fr="""SELECT eroll_no, constituency_name, gender, age_band, area_type, "R", "G", "SG",
                 count(booth_weight) AS n_individuals, coalesce(sum(booth_weight), 0) AS weighted_n
          FROM x GROUP BY ALL""",
) + """SELECT eroll_no, constituency_name, gender, age_band, area_type, "R", "G", "SG", n_individuals,
       round(weighted_n, 6) AS weighted_n,
       round(weighted_n / sum(weighted_n) OVER (PARTITION BY eroll_no), 6) AS stratum_share FROM fr"""


@register("stratification_frame", STRAT_FRAME_SQL)
def stratification_frame(spark, sf_dir):
    """Entry A as one lazy plan."""
    fr = frame.stratification_frame(roll(spark, sf_dir))
    out = fr.select(*[r6(c).alias(c) if c in ("weighted_n", "stratum_share") else c for c in fr.columns])
    return out.orderBy("eroll_no", F.desc("stratum_share"))   # O1 at the sink


def seat_dim(spark, sf_dir):
    """Seat dimension from nation: Number as text, name, reservation; keys
    divisible by 5 appear twice (the later copy must win); key 24 is absent."""
    n = table(spark, sf_dir, "nation", "n_nationkey", "n_name", "n_regionkey").where(F.col("n_nationkey") != 24)
    res = F.when(F.col("n_regionkey") == 1, "SC").when(F.col("n_regionkey") == 2, "ST")
    base = n.select(F.concat(F.lit(" "), F.col("n_nationkey").cast("string")).alias("Number"),
                    F.col("n_name").alias("name"), res.alias("reservation"), F.lit(0).alias("load_order"))
    dup = (n.where(F.col("n_nationkey") % 5 == 0)
            .select(F.col("n_nationkey").cast("string").alias("Number"),
                    F.concat(F.col("n_name"), F.lit(" (new)")).alias("name"),
                    F.lit("SC").alias("reservation"), F.lit(1).alias("load_order")))
    return base.unionByName(dup).withColumn("Number", strip_all(F.col("Number")))


SEAT_DIM_SQL = """
SELECT trim(CAST(n_nationkey AS VARCHAR)) AS "Number", n_name AS name,
       CASE WHEN n_regionkey = 1 THEN 'SC' WHEN n_regionkey = 2 THEN 'ST' END AS reservation, 0 AS load_order
FROM nation WHERE n_nationkey <> 24
UNION ALL
SELECT CAST(n_nationkey AS VARCHAR), n_name || ' (new)', 'SC', 1 FROM nation
WHERE n_nationkey <> 24 AND n_nationkey % 5 = 0"""

# Segment code -> label decode used by ``seat_lookup_default``.
SEGMENT_LABELS = {"AUTOMOBILE": "Auto", "BUILDING": "Build", "FURNITURE": "Furn", "HOUSEHOLD": "Home"}


@register("seat_lookup_default", cte(
    dim=SEAT_DIM_SQL,
    d1="""SELECT "Number", arg_max(name, load_order) AS name, arg_max(reservation, load_order) AS reservation
          FROM dim GROUP BY "Number" """,
    c="""SELECT c_custkey, c_mktsegment,
                CASE WHEN c_custkey % 9 = 0 THEN 'EROLL_' ELSE 'eroll-' END || CAST(c_nationkey AS VARCHAR) AS folder
         FROM customer""") + """
SELECT c.c_custkey, c.folder, coalesce(regexp_extract(c.folder, 'eroll-(\\d+)', 1), '') AS eroll_num,
       coalesce(d1.name, '') AS constituency_name, coalesce(d1.reservation, '') AS reservation,
       CASE c.c_mktsegment WHEN 'AUTOMOBILE' THEN 'Auto' WHEN 'BUILDING' THEN 'Build'
            WHEN 'FURNITURE' THEN 'Furn' WHEN 'HOUSEHOLD' THEN 'Home' ELSE 'Unknown' END AS segment_label
FROM c LEFT JOIN d1 ON regexp_extract(c.folder, 'eroll-(\\d+)', 1) = d1."Number" """)
def seat_lookup_default(spark, sf_dir):
    """J1 text-keyed lookup (last duplicate wins, miss -> ""), F4 capture
    (miss -> ""), P12 decode with default."""
    c = table(spark, sf_dir, "customer", "c_custkey", "c_nationkey", "c_mktsegment")
    c = c.select("c_custkey", "c_mktsegment",
                 F.concat(F.when(F.col("c_custkey") % 9 == 0, "EROLL_").otherwise("eroll-"),
                          F.col("c_nationkey").cast("string")).alias("folder"))
    c = c.withColumn("eroll_num", regex_capture("folder", r"eroll-(\d+)", 1, miss_null=False))
    out = frame.lookup_left(c, seat_dim(spark, sf_dir).withColumnRenamed("name", "constituency_name"),
                            [("eroll_num", "Number")], defaults={"constituency_name": "", "reservation": ""},
                            order_col="load_order")
    return out.select("c_custkey", "folder", "eroll_num", "constituency_name", "reservation",
                      clean.decode_map("c_mktsegment", SEGMENT_LABELS, "Unknown").alias("segment_label"))


@register("conform_columns", """
SELECT c_custkey, c_name, '' AS c_phone, c_nationkey, 'customer' AS source FROM customer""")
def conform_columns(spark, sf_dir):
    """P1 conform to a column list (missing -> blank, order kept), P16
    constant column."""
    c = table(spark, sf_dir, "customer").withColumn("source", F.lit("customer"))
    return clean.conform(c, ["c_custkey", "c_name", "c_phone", "c_nationkey", "source"])


@register("drop_rename", """
SELECT s_suppkey, s_name AS supplier_name, s_nationkey AS constituency_name FROM supplier""")
def drop_rename(spark, sf_dir):
    """P2 drop if present, P3 rename incl. the conditional alias
    ``constituency`` -> ``constituency_name``."""
    s = table(spark, sf_dir, "supplier").withColumnRenamed("s_nationkey", "constituency")
    s = clean.drop_if_present(s, ["s_acctbal", "not_there"])
    return clean.rename(s, {"s_name": "supplier_name"}, aliases={"constituency": "constituency_name"})
