"""Phase 3 queries: keyed-hash draws and sampling (G1-G7, J14, W3, W4,
W6, W9, W10, A4, X4, P9, O2, S11)."""

from __future__ import annotations

from pyspark.sql import functions as F

from strataforge.functions import numeric as N
from strataforge.functions.hashing import uniform_sql
from strataforge.operators import frame, sampling
from strataforge.plans.catalogue import register, cte
from strataforge.plans.derived import roll, survey, SURVEY_SQL
from strataforge.plans.q_frame import STRAT_FRAME_SQL
from strataforge.sources.tables import table

# Fixed parameters: seeds and sizes of the catalogue draws.
TURNOUT_SEED = 2026
CLASS_SEED = 77
SAMPLE_SEED = 42
SAMPLE_N = 5000
GUARANTEED_N = 50_000
GROUP_PCT = 0.05
PAGES_K = 3
SPLIT_SEED = 42

STRATA = ("eroll_no", "constituency_name", "gender", "age_band", "area_type", "R", "G", "SG")


@register("bernoulli_draw", cte(s=SURVEY_SQL) + f"""
SELECT resp_id, CASE WHEN pw IS NOT NULL THEN CAST({uniform_sql(TURNOUT_SEED, 'resp_id')} < pw AS INTEGER) END AS will_vote
FROM (SELECT resp_id, CASE WHEN p_will_vote > 1 THEN p_will_vote / 100 ELSE p_will_vote END AS pw FROM s)""")
def bernoulli_draw(spark, sf_dir):
    """G1 from the repaired probability; null stays null."""
    s = survey(spark, sf_dir)
    return s.select("resp_id", sampling.bernoulli(N.percent_repair("p_will_vote"), TURNOUT_SEED, "resp_id")
                    .alias("will_vote"))


def _class_sql():
    w = {k: f"greatest(coalesce({c}, 0), 0)" for k, c in (("AITC", "p_aitc"), ("NDA", "p_nda"), ("LF", "p_lf"))}
    a, b, c = w["AITC"], w["NDA"], w["LF"]
    u = uniform_sql(CLASS_SEED, "resp_id")
    return cte(s=SURVEY_SQL, x=f"SELECT resp_id, {a} AS a, {b} AS b, {c} AS c FROM s") + f"""
SELECT resp_id, CASE WHEN a + b + c <= 0 THEN NULL WHEN {u} * (a + b + c) < a THEN 'AITC'
  WHEN {u} * (a + b + c) < a + b THEN 'NDA' WHEN {u} * (a + b + c) < a + b + c THEN 'LF' ELSE 'LF' END AS choice
FROM x"""


@register("class_draw", _class_sql())
def class_draw(spark, sf_dir):
    """One class from three weights (negatives/null -> 0, all zero ->
    null)."""
    s = survey(spark, sf_dir)
    return s.select("resp_id", sampling.categorical({"AITC": "p_aitc", "NDA": "p_nda", "LF": "p_lf"},
                                                    CLASS_SEED, "resp_id").alias("choice"))


def stratum_key():
    return F.concat_ws("|", F.col("eroll_no").cast("string"),
                       *[F.coalesce(F.col(c), F.lit("~")) for c in ("gender", "age_band", "area_type", "R", "G", "SG")])


KEY_SQL = """concat_ws('|', CAST(eroll_no AS VARCHAR), coalesce(gender, '~'), coalesce(age_band, '~'),
  coalesce(area_type, '~'), "R", "G", "SG")"""


def frame_with_key(spark, sf_dir):
    """The frame with its stratum key, materialised once: the sampling
    queries read it for the draws and again to attach the drawn strata."""
    from strataforge.session import ensure_checkpoint_dir
    ensure_checkpoint_dir(spark)
    return frame.stratification_frame(roll(spark, sf_dir)).withColumn("stratum_key", stratum_key()).checkpoint(eager=True)


def _weighted_sql(n_expr: str, extra_ctes: dict | None = None, tail: str = "") -> dict:
    u = uniform_sql(SAMPLE_SEED, "d")
    parts = {"sf": STRAT_FRAME_SQL,
             "v": f"SELECT *, {KEY_SQL} AS stratum_key FROM sf WHERE n_individuals > 0",
             "c": """SELECT *, CAST(sum(n_individuals) OVER (ORDER BY stratum_key ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS hi
                     FROM v""",
             "tot": "SELECT CAST(sum(n_individuals) AS DOUBLE) AS w FROM v"}
    parts.update(extra_ctes or {})
    parts["d"] = f"SELECT CAST(d AS INTEGER) AS draw, {u} * tot.w AS t FROM range(1, {n_expr} + 1) r(d), tot"
    parts["m"] = "SELECT d.draw, c.stratum_key, c.eroll_no FROM d JOIN c ON d.t >= c.hi - c.n_individuals AND d.t < c.hi"
    return parts


@register("weighted_sample", cte(**_weighted_sql(str(SAMPLE_N))) + "SELECT draw, stratum_key, eroll_no FROM m")
def weighted_sample(spark, sf_dir):
    """G3 + J14 + W10: 5,000 draws with replacement, p proportional to
    n_individuals, over the whole frame."""
    fr = frame_with_key(spark, sf_dir).where(F.col("n_individuals") > 0)
    d = sampling.weighted_draws(spark, fr, "stratum_key", "n_individuals", SAMPLE_N, SAMPLE_SEED)
    return sampling.attach_draws(fr.select("stratum_key", "eroll_no"), d, "stratum_key", SAMPLE_N).select(
        "draw", "stratum_key", "eroll_no")


def _guaranteed_sql():
    g = """SELECT stratum_key, eroll_no FROM (SELECT *, row_number() OVER (PARTITION BY eroll_no
             ORDER BY n_individuals DESC, stratum_key) AS rn FROM v) WHERE rn = 1"""
    parts = _weighted_sql(f"(SELECT {GUARANTEED_N} - count(*) FROM g)", {"g": g})
    return cte(**parts) + """SELECT 'guaranteed' AS source, 0 AS draw, stratum_key, eroll_no FROM g
UNION ALL SELECT 'weighted', draw, stratum_key, eroll_no FROM m"""


@register("guaranteed_sample", _guaranteed_sql())
def guaranteed_sample(spark, sf_dir):
    """The largest stratum of every area (W3, ties by key), then the
    rest of the budget by weighted draws (G3), stacked."""
    fr = frame_with_key(spark, sf_dir).where(F.col("n_individuals") > 0).select(
        "stratum_key", "eroll_no", "n_individuals")
    g = sampling.top_per_group(fr, "eroll_no", -F.col("n_individuals"), "stratum_key")
    n_areas = g.count()   # one row per area
    d = sampling.weighted_draws(spark, fr, "stratum_key", "n_individuals", GUARANTEED_N - n_areas, SAMPLE_SEED)
    w = sampling.attach_draws(fr.select("stratum_key", "eroll_no"), d, "stratum_key", GUARANTEED_N - n_areas)
    return (g.select(F.lit("guaranteed").alias("source"), F.lit(0).alias("draw"), "stratum_key", "eroll_no")
             .unionByName(w.select(F.lit("weighted").alias("source"), "draw", "stratum_key", "eroll_no")))


def _sample_rows(spark, sf_dir):
    fr = frame_with_key(spark, sf_dir).where(F.col("n_individuals") > 0)
    d = sampling.weighted_draws(spark, fr, "stratum_key", "n_individuals", SAMPLE_N, SAMPLE_SEED)
    return sampling.attach_draws(fr, d, "stratum_key", SAMPLE_N).select(*STRATA)


_DEDUPE_SQL = cte(**_weighted_sql(str(SAMPLE_N)),
                  rows=f"SELECT {', '.join(f'v.{c}' for c in ('eroll_no', 'constituency_name', 'gender', 'age_band', 'area_type'))}, "
                       'v."R", v."G", v."SG" FROM m JOIN v ON m.stratum_key = v.stratum_key',
                  dd="""SELECT eroll_no, constituency_name, gender, age_band, area_type, "R", "G", "SG",
                          CAST(count(*) AS INTEGER) AS dup_count FROM rows
                        WHERE eroll_no IS NOT NULL AND constituency_name IS NOT NULL AND gender IS NOT NULL
                          AND age_band IS NOT NULL AND area_type IS NOT NULL AND "R" IS NOT NULL AND "G" IS NOT NULL
                          AND "SG" IS NOT NULL GROUP BY ALL""")


@register("dedupe_counts", _DEDUPE_SQL + "SELECT * FROM dd")
def dedupe_counts(spark, sf_dir):
    """A4: identical sampled rows counted; rows with a null vanish (Q11)."""
    return sampling.count_duplicates(_sample_rows(spark, sf_dir))


@register("repeat_rows", _DEDUPE_SQL + """
SELECT eroll_no, constituency_name, gender, age_band, area_type, "R", "G", "SG"
FROM dd, range(dup_count) r(i)""")
def repeat_rows(spark, sf_dir):
    """Expand each counted row back to dup_count copies."""
    d = sampling.count_duplicates(_sample_rows(spark, sf_dir))
    return sampling.repeat_rows(d, "dup_count").drop("dup_count")


@register("chunks", _DEDUPE_SQL + f"""
SELECT {KEY_SQL} AS stratum_key, dup_count, CAST(ntile(4) OVER (ORDER BY {KEY_SQL}) + 8 AS INTEGER) AS chunk FROM dd""")
def chunks(spark, sf_dir):
    """W6 + S11: 4 near-equal chunks numbered from 9, in key order (global
    row numbers by range partition offsets, no single-partition window)."""
    d = sampling.count_duplicates(_sample_rows(spark, sf_dir)).withColumn("stratum_key", stratum_key())
    c = sampling.chunk_ids(d.select("stratum_key", "dup_count"), "stratum_key", 4, start=9)
    return c.select("stratum_key", "dup_count", "chunk")


LI_KEY = "CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR)"


@register("fraction_per_group", f"""
WITH x AS (SELECT l_orderkey, l_linenumber, l_suppkey, {LI_KEY} AS k FROM lineitem),
r AS (SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY {uniform_sql(SAMPLE_SEED, 'k')}, k) AS rk,
             count(*) OVER (PARTITION BY l_suppkey) AS n FROM x)
SELECT l_orderkey, l_linenumber, l_suppkey FROM r
WHERE rk <= least(greatest(ceil(n * {GROUP_PCT}), 1), n)""")
def fraction_per_group(spark, sf_dir):
    """ceil(5 %) per supplier, at least 1, by keyed hash order."""
    li = table(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", "l_suppkey").withColumn(
        "k", F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")))
    s = sampling.sample_per_group(li, "l_suppkey", "k", SAMPLE_SEED, GROUP_PCT)
    return s.select("l_orderkey", "l_linenumber", "l_suppkey")


CONV_KEY = "CAST(conv_id AS VARCHAR) || '-' || CAST(turn AS VARCHAR)"


@register("k_pages", f"""
WITH p AS (SELECT conv_id, turn, {CONV_KEY} AS k,
                  row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS i,
                  count(*) OVER (PARTITION BY conv_id) AS total FROM conversations),
e AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY {uniform_sql(SAMPLE_SEED, 'k')}, k) AS rk
      FROM p WHERE i >= 2 AND i < total - 2)
SELECT conv_id, turn, false AS is_header FROM e WHERE rk <= {PAGES_K}
UNION ALL SELECT conv_id, turn, true FROM p WHERE i = 0""")
def k_pages(spark, sf_dir):
    """G6 + W9: per document the first member apart, plus up to k random
    members from positions 2 .. total-3 (head and tail excluded). Positions
    come from ``group_positions`` (no window over a whole document)."""
    c = table(spark, sf_dir, "conversations", "conv_id", "turn").withColumn(
        "k", F.concat_ws("-", F.col("conv_id").cast("string"), F.col("turn").cast("string")))
    p = (sampling.group_positions(c, "conv_id", "turn")
                 .withColumnsRenamed({"__pos": "i", "__size": "total"}))
    elig = p.where((F.col("i") >= 2) & (F.col("i") < F.col("total") - 2))
    r = sampling.hash_rank(elig, "conv_id", "k", SAMPLE_SEED)
    chosen = r.where(F.col("__rank") <= PAGES_K).select("conv_id", "turn", F.lit(False).alias("is_header"))
    head = p.where(F.col("i") == 0).select("conv_id", "turn", F.lit(True).alias("is_header"))
    return chosen.unionByName(head)


@register("stratified_split", f"""
WITH r AS (SELECT doc_id, quality, row_number() OVER (PARTITION BY quality ORDER BY {uniform_sql(SPLIT_SEED, 'doc_id')}, doc_id) AS rk,
                  count(*) OVER (PARTITION BY quality) AS n FROM labels)
SELECT doc_id, quality, CASE WHEN rk <= round(n * 0.85) THEN 'train' ELSE 'validation' END AS split FROM r""")
def stratified_split(spark, sf_dir):
    """85 / 15 per class."""
    lab = table(spark, sf_dir, "labels", "doc_id", "quality")
    s = sampling.stratified_split(lab, "quality", "doc_id", SPLIT_SEED, 0.85)
    return s.select("doc_id", "quality", "split")


@register("row_slice", """
SELECT s_suppkey, s_name, row_pos FROM (
  SELECT s_suppkey, s_name, row_number() OVER (ORDER BY s_suppkey) - 1 AS row_pos FROM supplier)
WHERE row_pos >= 10 AND row_pos < 30""")
def row_slice(spark, sf_dir):
    """P9 by key order with distributed row numbers."""
    s = table(spark, sf_dir, "supplier", "s_suppkey", "s_name")
    return sampling.row_slice(s, "s_suppkey", 10, 30)


@register("numeric_name_sort", """
SELECT s_suppkey, name, coalesce(TRY_CAST(nullif(regexp_extract(name, '#(\\d+)', 1), '') AS BIGINT), 0) AS num
FROM (SELECT s_suppkey, CASE WHEN s_suppkey % 7 = 0 THEN 'Supplier-X' ELSE s_name END AS name FROM supplier)
ORDER BY num, name""")
def numeric_name_sort(spark, sf_dir):
    """O2: sort by the number inside a name; no number sorts as 0."""
    s = table(spark, sf_dir, "supplier", "s_suppkey", "s_name").select(
        "s_suppkey", F.when(F.col("s_suppkey") % 7 == 0, F.lit("Supplier-X")).otherwise(F.col("s_name")).alias("name"))
    num = F.coalesce(F.nullif(F.regexp_extract("name", r"#(\d+)", 1), F.lit("")).try_cast("bigint"), F.lit(0).cast("bigint"))
    return s.withColumn("num", num).orderBy("num", "name")
