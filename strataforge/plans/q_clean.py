"""Phase 2 queries: filters, recodes, probability repair, number and text
clean-up (P4-P15, F1-F19, F37, A25)."""

from __future__ import annotations

from pyspark.sql import functions as F

from strataforge.functions import numeric as N
from strataforge.functions import text as T
from strataforge.functions.hashing import uniform, uniform_sql
from strataforge.operators import clean
from strataforge.plans.catalogue import register, r6, cte
from strataforge.plans.derived import roll, survey, ROLL_SQL, SURVEY_SQL
from strataforge.sources.tables import table

# Fixed parameters of the catalogue queries.
NATION_LIST = ("NATION_1", "NATION_3", "NATION_7", "NATION_20")
TYPE_MAP = {"ECONOMY": "ECO", "STANDARD": "STD"}
STATUS_DECODE = {"F": "Filled", "O": "Open"}
VALID_BRANDS = ("Brand#1", "Brand#2", "Brand#3")
VOTE_SEED = 2026


@register("complete_cases", cte(roll=ROLL_SQL) + """
SELECT voter_id, area_type, gender, booth_no FROM roll
WHERE area_type IS NOT NULL AND gender IS NOT NULL AND booth_no IS NOT NULL""")
def complete_cases(spark, sf_dir):
    """P4."""
    r = roll(spark, sf_dir).select("voter_id", "area_type", "gender", "booth_no")
    return clean.complete_cases(r, ["area_type", "gender", "booth_no"])


@register("list_filter", "SELECT n_nationkey, n_name FROM nation WHERE n_name IN ("
          + ", ".join(f"'{v}'" for v in NATION_LIST) + ")")
def list_filter(spark, sf_dir):
    """P5 (pushed to the parquet scan as an ``In`` filter)."""
    n = table(spark, sf_dir, "nation", "n_nationkey", "n_name")
    return n.where(clean.in_list("n_name", NATION_LIST))


@register("contains_filter", cte(roll=ROLL_SQL) + """
SELECT voter_id, gender, coalesce(contains(lower(gender), 'ma'), false) AS has_ma FROM roll""")
def contains_filter(spark, sf_dir):
    """Case-insensitive contains, null -> false."""
    r = roll(spark, sf_dir)
    return r.select("voter_id", "gender", clean.contains_ci("gender", "MA").alias("has_ma"))


@register("numeric_filter", cte(roll=ROLL_SQL) + """
SELECT voter_id, total_individuals FROM roll WHERE total_individuals > 500""")
def numeric_filter(spark, sf_dir):
    """P7."""
    return roll(spark, sf_dir).select("voter_id", "total_individuals").where(F.col("total_individuals") > 500)


@register("prefix_filter", "SELECT n_nationkey, n_name FROM nation WHERE starts_with(n_name, 'NATION_1')")
def prefix_filter(spark, sf_dir):
    """P15."""
    n = table(spark, sf_dir, "nation", "n_nationkey", "n_name")
    return n.where(clean.starts_with("n_name", "NATION_1"))


@register("masked_update", """
SELECT o_orderkey, CASE WHEN o_totalprice > 400000 AND o_orderstatus = 'F' THEN '0-CRIT'
       ELSE o_orderpriority END AS o_orderpriority FROM orders""")
def masked_update(spark, sf_dir):
    """P10."""
    o = table(spark, sf_dir, "orders", "o_orderkey", "o_totalprice", "o_orderstatus", "o_orderpriority")
    o = clean.masked_update(o, (F.col("o_totalprice") > 400000) & (F.col("o_orderstatus") == "F"),
                            "o_orderpriority", "0-CRIT")
    return o.select("o_orderkey", "o_orderpriority")


@register("replace_map", """
SELECT p_partkey, CASE p_type WHEN 'ECONOMY' THEN 'ECO' WHEN 'STANDARD' THEN 'STD' ELSE p_type END AS p_type
FROM part""")
def replace_map(spark, sf_dir):
    """Mapping, unmatched unchanged."""
    p = table(spark, sf_dir, "part", "p_partkey", "p_type")
    return p.select("p_partkey", clean.replace_map("p_type", TYPE_MAP).alias("p_type"))


@register("decode_map", """
SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'Filled' WHEN 'O' THEN 'Open' ELSE 'Unknown' END AS status
FROM orders""")
def decode_map(spark, sf_dir):
    """Decode with a default."""
    o = table(spark, sf_dir, "orders", "o_orderkey", "o_orderstatus")
    return o.select("o_orderkey", clean.decode_map("o_orderstatus", STATUS_DECODE, "Unknown").alias("status"))


@register("collapse_other", """
SELECT p_partkey, CASE WHEN p_brand IN ('Brand#1', 'Brand#2', 'Brand#3') THEN p_brand ELSE 'O' END AS brand
FROM part""")
def collapse_other(spark, sf_dir):
    """P14."""
    p = table(spark, sf_dir, "part", "p_partkey", "p_brand")
    return p.select("p_partkey", clean.collapse_other("p_brand", VALID_BRANDS).alias("brand"))


@register("three_way_flag", """
SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 1 WHEN o_orderstatus = 'O' THEN 0 END AS flag
FROM orders""")
def three_way_flag(spark, sf_dir):
    """1 / 0 / null."""
    o = table(spark, sf_dir, "orders", "o_orderkey", "o_orderstatus")
    return o.select("o_orderkey", clean.three_way(F.col("o_orderstatus") == "F",
                                                  F.col("o_orderstatus") == "O").alias("flag"))


def _variants(vals):
    return ", ".join(f"'{v}'" for v in vals)


@register("typo_recode", cte(roll=ROLL_SQL) + f"""
SELECT voter_id, gender,
       CASE WHEN gender IS NULL THEN NULL
            WHEN lower(trim(gender)) IN ({_variants(clean.MALE_VARIANTS)}) THEN 'Male'
            WHEN lower(trim(gender)) IN ({_variants(clean.FEMALE_VARIANTS)}) THEN 'Female'
            ELSE gender END AS gender_clean
FROM roll""")
def typo_recode(spark, sf_dir):
    """F18 (with F1 strip and F2 lower)."""
    r = roll(spark, sf_dir)
    return r.select("voter_id", "gender", clean.recode_gender("gender").alias("gender_clean"))


@register("percent_repair", cte(s=SURVEY_SQL) + """
SELECT resp_id, round(CASE WHEN p_will_vote > 1 THEN p_will_vote / 100 ELSE p_will_vote END, 6) AS p_will_vote
FROM s""")
def percent_repair(spark, sf_dir):
    """x > 1 is a percent; null kept."""
    s = survey(spark, sf_dir)
    return s.select("resp_id", r6(N.percent_repair("p_will_vote")).alias("p_will_vote"))


@register("row_normalise", cte(
    s=SURVEY_SQL,
    t="""SELECT resp_id, p_aitc, p_nda, p_lf,
                coalesce(p_aitc, 0) + coalesce(p_nda, 0) + coalesce(p_lf, 0) AS rs FROM s""") + """
SELECT resp_id,
       round(coalesce(p_aitc, 0) / CASE WHEN rs = 0 THEN 1 ELSE rs END, 6) AS p_aitc,
       round(coalesce(p_nda, 0) / CASE WHEN rs = 0 THEN 1 ELSE rs END, 6) AS p_nda,
       round(coalesce(p_lf, 0) / CASE WHEN rs = 0 THEN 1 ELSE rs END, 6) AS p_lf
FROM t""")
def row_normalise(spark, sf_dir):
    """F15 (+F13): divide by the row sum, a zero sum by 1."""
    s = survey(spark, sf_dir)
    exprs = N.row_normalise(["p_aitc", "p_nda", "p_lf"])
    return s.select("resp_id", *[r6(e).alias(k) for k, e in exprs.items()])


PROB_COLS = ("p_aitc", "p_nda", "p_lf", "p_inc", "p_nota")


def with_will_vote(s):
    """G1 turnout label from the repaired probability (null -> null)."""
    p = N.percent_repair("p_will_vote")
    return s.withColumn("will_vote", F.when(p.isNotNull(), (uniform(VOTE_SEED, "resp_id") < p).cast("int")))


def _prob_audit_sql() -> str:
    rs = " + ".join(f"coalesce({c}, 0)" for c in PROB_COLS)
    rs2 = " + ".join(f"coalesce(s_{c}, 0)" for c in PROB_COLS)
    scaled = ", ".join(f"CASE WHEN rs > 5 THEN {c} / 100 ELSE {c} END AS s_{c}" for c in PROB_COLS)
    final = " + ".join(
        f"coalesce(CASE WHEN coalesce(will_vote = 1, false) = false THEN 0.0 WHEN rs2 > 0 THEN s_{c} / rs2 ELSE s_{c} END, 0)"
        for c in PROB_COLS)
    u = uniform_sql(VOTE_SEED, "resp_id")
    return cte(
        s=SURVEY_SQL,
        v=f"""SELECT *, CASE WHEN pw IS NOT NULL THEN CAST({u} < pw AS INTEGER) END AS will_vote
              FROM (SELECT *, CASE WHEN p_will_vote > 1 THEN p_will_vote / 100 ELSE p_will_vote END AS pw FROM s)""",
        a=f"SELECT *, {rs} AS rs FROM v",
        b=f"SELECT *, {scaled} FROM a",
        c=f"SELECT *, {rs2} AS rs2 FROM b",
        d=f"SELECT *, {final} AS rs_after FROM c",
    ) + """SELECT count(*) AS n_rows,
       CAST(sum(CASE WHEN rs > 1.05 THEN 1 ELSE 0 END) AS BIGINT) AS above_before,
       CAST(sum(CASE WHEN rs < 0.95 THEN 1 ELSE 0 END) AS BIGINT) AS below_before,
       CAST(sum(CASE WHEN rs_after > 1.05 THEN 1 ELSE 0 END) AS BIGINT) AS above_after,
       CAST(sum(CASE WHEN will_vote = 1 AND rs2 > 0 AND rs_after < 0.95 THEN 1 ELSE 0 END) AS BIGINT) AS below_after_voters,
       CAST(sum(CASE WHEN will_vote = 1 THEN 1 ELSE 0 END) AS BIGINT) AS voters,
       round(avg(CASE WHEN will_vote = 1 AND rs2 > 0 THEN rs_after END), 6) AS mean_sum_voters
FROM d"""


@register("prob_audit", _prob_audit_sql())
def prob_audit(spark, sf_dir):
    """A25 audit around F14: sums outside 0.95-1.05 before and after the
    scoped normalisation (voters only, non-voters zeroed)."""
    s = with_will_vote(survey(spark, sf_dir))
    before = N.row_sum(*PROB_COLS)
    scaled = {c: F.when(before > 5, F.col(c) / 100.0).otherwise(F.col(c)) for c in PROB_COLS}
    s2 = N.row_sum(*scaled.values())
    fixed = N.row_normalise_scoped(list(PROB_COLS), F.col("will_vote") == 1)
    after = N.row_sum(*fixed.values())
    x = s.select(before.alias("rs"), s2.alias("rs2"), after.alias("rs_after"), "will_vote")
    voter = F.col("will_vote") == 1
    return x.agg(F.count(F.lit(1)).alias("n_rows"),
                 F.count_if(F.col("rs") > 1.05).alias("above_before"),
                 F.count_if(F.col("rs") < 0.95).alias("below_before"),
                 F.count_if(F.col("rs_after") > 1.05).alias("above_after"),
                 F.count_if(voter & (F.col("rs2") > 0) & (F.col("rs_after") < 0.95)).alias("below_after_voters"),
                 F.count_if(voter).alias("voters"),
                 r6(F.avg(F.when(voter & (F.col("rs2") > 0), F.col("rs_after")))).alias("mean_sum_voters"))


LI_TEXT_SQL = """SELECT l_orderkey, l_linenumber, l_quantity, l_discount, l_suppkey,
  CASE WHEN l_linenumber = 3 THEN 'n/a' ELSE CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) END AS qty_text,
  CAST(CAST(round(l_discount * 100) AS INTEGER) AS VARCHAR) || '%' AS pct_text,
  '|' || CAST(CAST(l_quantity AS BIGINT) * 1000 AS VARCHAR) AS margin_text,
  CASE WHEN l_linenumber = 4 THEN 'x' || CAST(l_orderkey AS VARCHAR)
       ELSE format('{:,}', l_orderkey * 37 + l_partkey) END AS votes_text
FROM lineitem"""


def _li_text(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", "l_quantity", "l_discount",
               "l_suppkey", "l_partkey")
    return li.select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_discount", "l_suppkey",
        F.when(F.col("l_linenumber") == 3, F.lit("n/a"))
         .otherwise(F.col("l_quantity").cast("bigint").cast("string")).alias("qty_text"),
        F.concat(F.round(F.col("l_discount") * 100).cast("int").cast("string"), F.lit("%")).alias("pct_text"),
        F.concat(F.lit("|"), (F.col("l_quantity").cast("bigint") * 1000).cast("string")).alias("margin_text"),
        F.when(F.col("l_linenumber") == 4, F.concat(F.lit("x"), F.col("l_orderkey").cast("string")))
         .otherwise(F.format_number(F.col("l_orderkey") * 37 + F.col("l_partkey"), 0)).alias("votes_text"),
    )


@register("coerce_numbers", cte(t=LI_TEXT_SQL) + """
SELECT l_orderkey, l_linenumber,
       coalesce(TRY_CAST(qty_text AS DOUBLE), 0) AS qty,
       coalesce(TRY_CAST(replace(votes_text, ',', '') AS BIGINT), 0) AS votes,
       round(least(greatest(l_discount * 100 - 5, 0), 3), 6) AS clipped,
       CAST(ceil(l_quantity / 7) AS BIGINT) AS q_ceil, round(abs(l_discount - 0.05), 6) AS dev,
       round(sqrt(l_quantity), 6) AS q_sqrt
FROM t""")
def coerce_numbers(spark, sf_dir):
    """F8 text -> number (bad -> 0), F9 ``"1,234"`` -> 1234 (bad -> 0), F19
    clip / ceil / abs / sqrt."""
    t = _li_text(spark, sf_dir)
    return t.select("l_orderkey", "l_linenumber", N.to_double_or_zero("qty_text").alias("qty"),
                    N.count_text_to_long("votes_text").alias("votes"),
                    r6(N.clamp(F.col("l_discount") * 100 - 5, 0.0, 3.0)).alias("clipped"),
                    F.ceil(F.col("l_quantity") / 7).cast("bigint").alias("q_ceil"),
                    r6(F.abs(F.col("l_discount") - 0.05)).alias("dev"),
                    r6(F.sqrt("l_quantity")).alias("q_sqrt"))


@register("decorated_numbers", cte(t=LI_TEXT_SQL) + r"""
SELECT l_orderkey, l_linenumber,
       TRY_CAST(regexp_replace(pct_text, '[%|,\s]', '', 'g') AS DOUBLE) AS pct,
       TRY_CAST(regexp_replace(margin_text, '[%|,\s]', '', 'g') AS DOUBLE) AS margin
FROM t""")
def decorated_numbers(spark, sf_dir):
    """``"82.16%"`` and ``"|39250"`` to numbers."""
    t = _li_text(spark, sf_dir)
    return t.select("l_orderkey", "l_linenumber", N.decorated_number("pct_text").alias("pct"),
                    N.decorated_number("margin_text").alias("margin"))


NATIVE_SQL = f"""SELECT l_orderkey, l_linenumber,
  CASE WHEN l_linenumber = 2 THEN translate(CAST(l_orderkey AS VARCHAR), '{T.ASCII_DIGITS}', '{T.BENGALI_DIGITS}')
       ELSE CAST(l_orderkey AS VARCHAR) END AS key_text,
  'Roll 2026 part ' || CAST(l_linenumber AS VARCHAR) || ' of ' ||
  CASE WHEN l_linenumber = 2 THEN translate(CAST(l_orderkey % 100000 AS VARCHAR), '{T.ASCII_DIGITS}', '{T.BENGALI_DIGITS}')
       ELSE CAST(l_orderkey % 100000 AS VARCHAR) END ||
  ' pin 700' || CAST(l_suppkey % 1000 AS VARCHAR) || ' year 2025' AS header_text
FROM lineitem"""


def _native(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", "l_suppkey")
    bn = lambda c: F.translate(c, T.ASCII_DIGITS, T.BENGALI_DIGITS)
    two = F.col("l_linenumber") == 2
    k = F.col("l_orderkey").cast("string")
    k5 = (F.col("l_orderkey") % 100000).cast("string")
    return li.select("l_orderkey", "l_linenumber",
                     F.when(two, bn(k)).otherwise(k).alias("key_text"),
                     F.concat(F.lit("Roll 2026 part "), F.col("l_linenumber").cast("string"), F.lit(" of "),
                              F.when(two, bn(k5)).otherwise(k5), F.lit(" pin 700"),
                              (F.col("l_suppkey") % 1000).cast("string"), F.lit(" year 2025"))
                     .alias("header_text"))


@register("native_digits", cte(t=NATIVE_SQL) + f"""
SELECT l_orderkey, key_text, translate(key_text, '{T.BENGALI_DIGITS}', '{T.ASCII_DIGITS}') AS key_ascii FROM t""")
def native_digits(spark, sf_dir):
    """F10."""
    t = _native(spark, sf_dir)
    return t.select("l_orderkey", "key_text", T.ascii_digits("key_text").alias("key_ascii"))


@register("max_number_in_text", cte(t=NATIVE_SQL) + f"""
SELECT l_orderkey, l_linenumber, coalesce(CAST(list_max(list_filter(
         list_transform(regexp_extract_all(translate(header_text, '{T.BENGALI_DIGITS}', '{T.ASCII_DIGITS}'),
                        '\\b(\\d+)\\b', 1), lambda x: TRY_CAST(x AS BIGINT)),
         lambda n: n > 0 AND n < 99999 AND n NOT IN (2025, 2026))) AS VARCHAR), '') AS total_individuals
FROM t""")
def max_number_in_text(spark, sf_dir):
    """largest head count in a header text."""
    t = _native(spark, sf_dir)
    return t.select("l_orderkey", "l_linenumber", T.max_number_in_text("header_text").alias("total_individuals"))


TITLE_SQL = "array_to_string(list_transform(regexp_extract_all({x}, '(\\p{{L}}+|[^\\p{{L}}]+)', 1), lambda r: upper(r[1]) || lower(r[2:])), '')"


@register("title_case", """
SELECT p_partkey, replace(p_name, ' ', '-') || ' - ' || CAST(p_size AS VARCHAR) AS raw_name,
       """ + TITLE_SQL.format(x="regexp_replace(replace(p_name, ' ', '-') || ' - ' || CAST(p_size AS VARCHAR), '\\s*-\\s*\\d+\\s*$', '')")
          + """ AS clean_name FROM part""")
def title_case(spark, sf_dir):
    """F5 strip a trailing code, then F3 title case at every letter run."""
    p = table(spark, sf_dir, "part", "p_partkey", "p_name", "p_size")
    raw = F.concat(F.regexp_replace("p_name", " ", "-"), F.lit(" - "), F.col("p_size").cast("string"))
    return p.select("p_partkey", raw.alias("raw_name"), T.title_case(T.strip_trailing_code(raw)).alias("clean_name"))


@register("match_key", """
SELECT s_suppkey, replace(replace(lower(trim(' ' || s_name || '-Dist. ')), '-', ' '), '.', '') AS key
FROM supplier""")
def match_key(spark, sf_dir):
    """F6 name key."""
    s = table(spark, sf_dir, "supplier", "s_suppkey", "s_name")
    return s.select("s_suppkey", T.match_key(F.concat(F.lit(" "), F.col("s_name"), F.lit("-Dist. "))).alias("key"))


@register("strip_code", """
SELECT p_partkey, regexp_replace(p_name || ' -' || CAST(p_size AS VARCHAR) || ' ', '\\s*-\\s*\\d+\\s*$', '') AS name
FROM part""")
def strip_code(spark, sf_dir):
    """F5."""
    p = table(spark, sf_dir, "part", "p_partkey", "p_name", "p_size")
    raw = F.concat(F.col("p_name"), F.lit(" -"), F.col("p_size").cast("string"), F.lit(" "))
    return p.select("p_partkey", T.strip_trailing_code(raw).alias("name"))
