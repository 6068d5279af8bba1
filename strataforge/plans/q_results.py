"""Phase 4 queries: official results (A13, F9, X1-X3, X5, P14, W8, A23,
O3-O6, J7, J11, J12, A15-A17, P8, F37)."""

from __future__ import annotations

from pyspark.sql import functions as F

from strataforge.functions.hashing import uniform, uniform_sql
from strataforge.functions.numeric import decorated_number
from strataforge.operators import results
from strataforge.plans.catalogue import register, r6, cte
from strataforge.plans.derived import result, RESULT_SQL
from strataforge.sources.tables import table

# Fixed parameters: party -> bucket map of the catalogue, bucket order, seeds.
AITC_PLUS = ("Brand#1", "Brand#2", "Brand#3", "Brand#4", "Brand#5", "Brand#6", "Brand#7", "Brand#8")
BJP_ONLY = ("Brand#9", "Brand#10", "Brand#11", "Brand#12", "Brand#13", "Brand#14", "Brand#15", "Brand#16")
BUCKETS = ("AITC+", "BJP", "Other")
PRED_SEED = 314
INTERVAL_SEED = 315


def official_long(spark, sf_dir):
    """Long official result with vote counts as text (``"1,234"``; a few
    unreadable)."""
    r = result(spark, sf_dir)
    txt = F.when(F.col("candidate").startswith("red"), F.lit("n/a")).otherwise(F.format_number("votes", 0))
    return r.select("constituency", "party", "candidate", txt.alias("total_votes"),
                    F.col("candidate").alias("row_pos"))


def collapsed(spark, sf_dir):
    c = results.collapse_to_party(official_long(spark, sf_dir))
    return results.with_vote_share(c)


def bucket_of():
    p = F.col("party")
    return F.when(p.isin(*AITC_PLUS), "AITC+").when(p.isin(*BJP_ONLY), "BJP").otherwise("Other")


def bucket_long(spark, sf_dir):
    return results.bucket_rollup(collapsed(spark, sf_dir), bucket_of(), BUCKETS)


def bucket_wide(spark, sf_dir):
    w = results.wide_by_key(bucket_long(spark, sf_dir), "constituency", "bucket",
                            {"candidate": "candidate", "total_votes": "total_votes", "vote_share": "vote_share"},
                            keys=BUCKETS)
    return w.withColumn("winner", results.winner_of(BUCKETS, [f"{b}_vote_share" for b in BUCKETS]))


_IN = lambda vals: ", ".join(f"'{v}'" for v in vals)

BASE_SQL = dict(
    res=RESULT_SQL,
    ol="""SELECT constituency, party, candidate,
                 CASE WHEN starts_with(candidate, 'red') THEN 'n/a' ELSE format('{:,}', votes) END AS total_votes
          FROM res""",
    pv="SELECT *, coalesce(TRY_CAST(replace(total_votes, ',', '') AS BIGINT), 0) AS v FROM ol",
    col0="""SELECT constituency, party, candidate, v AS votes FROM (
              SELECT *, row_number() OVER (PARTITION BY constituency, party ORDER BY v DESC, candidate) AS rn FROM pv)
            WHERE rn = 1""",
    col="""SELECT *, round(votes * 100.0 / sum(votes) OVER (PARTITION BY constituency), 2) AS vote_share FROM col0""",
    b=f"""SELECT *, CASE WHEN party IN ({_IN(AITC_PLUS)}) THEN 'AITC+' WHEN party IN ({_IN(BJP_ONLY)}) THEN 'BJP'
                     ELSE 'Other' END AS bucket FROM col""",
    agg="""SELECT constituency, bucket, CAST(sum(votes) AS BIGINT) AS total_votes, round(sum(vote_share), 2) AS vote_share
           FROM b GROUP BY ALL""",
    top="""SELECT constituency, bucket, CASE WHEN votes = 0 OR candidate IS NULL THEN '' ELSE candidate END AS candidate
           FROM (SELECT *, row_number() OVER (PARTITION BY constituency, bucket ORDER BY votes DESC, party) AS rn FROM b)
           WHERE rn = 1""",
    grid="""SELECT constituency, bucket FROM (SELECT DISTINCT constituency FROM col),
            (VALUES ('AITC+'), ('BJP'), ('Other')) t(bucket)""",
    bl="""SELECT g.constituency, g.bucket, coalesce(top.candidate, '') AS candidate,
                 coalesce(agg.total_votes, 0) AS total_votes, coalesce(agg.vote_share, 0.0) AS vote_share
          FROM grid g LEFT JOIN agg USING (constituency, bucket) LEFT JOIN top USING (constituency, bucket)""",
    bw="""SELECT constituency,
            max(CASE WHEN bucket = 'AITC+' THEN vote_share END) AS a,
            max(CASE WHEN bucket = 'BJP' THEN vote_share END) AS j,
            max(CASE WHEN bucket = 'Other' THEN vote_share END) AS o FROM bl GROUP BY constituency""",
    win="""SELECT *, CASE WHEN a >= j AND a >= o THEN 'AITC+' WHEN j >= o THEN 'BJP' ELSE 'Other' END AS winner,
              a - j AS margin FROM bw""",
)


def base(*names) -> str:
    keys = list(BASE_SQL)
    upto = max(keys.index(n) for n in names)
    return cte(**{k: BASE_SQL[k] for k in keys[: upto + 1]})


@register("top_candidate_per_party", base("col0") + "SELECT constituency, party, candidate, votes FROM col0")
def top_candidate_per_party(spark, sf_dir):
    """A13 + F9: top candidate per party and seat; ties -> first seen."""
    return results.collapse_to_party(official_long(spark, sf_dir))


BRANDS = tuple(f"Brand#{i}" for i in range(1, 26))
_WIDE = ", ".join(f"""max(CASE WHEN party = '{b}' THEN {v} END) AS "{b}_{n}\"""" for b in BRANDS
                  for n, v in (("candidate", "candidate"), ("total_votes", "votes"), ("vote_share", "vote_share")))


@register("wide_results", base("col") + f"SELECT constituency, {_WIDE} FROM col GROUP BY constituency")
def wide_results(spark, sf_dir):
    """Long -> wide with the party list found in the data (sorted),
    three values per party."""
    return results.wide_by_key(collapsed(spark, sf_dir), "constituency", "party",
                               {"candidate": "candidate", "total_votes": "votes", "vote_share": "vote_share"})


@register("suffix_unpivot", base("col") + """
SELECT s.constituency, p.party, col.votes AS total_votes
FROM (SELECT DISTINCT constituency FROM col) s CROSS JOIN (SELECT DISTINCT party FROM col) p
LEFT JOIN col ON col.constituency = s.constituency AND col.party = p.party""")
def suffix_unpivot(spark, sf_dir):
    """Wide -> long over the columns found by suffix."""
    w = wide_results(spark, sf_dir)
    return results.unpivot_by_suffix(w, ["constituency"], "_total_votes", "party", "total_votes")


@register("bucket_rollup", base("bl") + "SELECT * FROM bl")
def bucket_rollup(spark, sf_dir):
    """X5 (+P14 bucket map, A13 top member)."""
    return bucket_long(spark, sf_dir)


@register("argmax_columns", base("win") + """
SELECT constituency, a AS "AITC+_vote_share", j AS "BJP_vote_share", o AS "Other_vote_share", winner FROM win""")
def argmax_columns(spark, sf_dir):
    """Winner across bucket columns, first on ties."""
    w = bucket_wide(spark, sf_dir)
    return w.select("constituency", *[f"`{b}_vote_share`" for b in BUCKETS], "winner")


@register("seat_totals", base("win") + """
SELECT CASE WHEN grouping(winner) = 1 THEN 'TOTAL' ELSE winner END AS winner, count(*) AS seats,
       round(count(*) * 100.0 / (SELECT count(*) FROM win), 2) AS share
FROM win GROUP BY ROLLUP (winner)""")
def seat_totals(spark, sf_dir):
    """Seats per winner, share, TOTAL line."""
    return results.seat_counts(bucket_wide(spark, sf_dir))


@register("closest_seats", base("win") + """
SELECT constituency, round(margin, 6) AS margin, winner FROM win ORDER BY abs(margin), constituency LIMIT 15""")
def closest_seats(spark, sf_dir):
    """O3: the 15 seats with the smallest absolute margin (top-k is the
    feature; Spark plans ``TakeOrderedAndProject``)."""
    w = bucket_wide(spark, sf_dir).withColumn("margin", F.col("`AITC+_vote_share`") - F.col("BJP_vote_share"))
    return w.orderBy(F.abs("margin"), "constituency").limit(15).select("constituency", r6("margin").alias("margin"),
                                                                        "winner")


@register("filtered_by_margin", base("win") + """
SELECT constituency, round(margin, 6) AS margin FROM win WHERE winner = 'Other' ORDER BY margin""")
def filtered_by_margin(spark, sf_dir):
    """One winner's seats ordered by margin."""
    w = bucket_wide(spark, sf_dir).withColumn("margin", F.col("`AITC+_vote_share`") - F.col("BJP_vote_share"))
    return w.where(F.col("winner") == "Other").orderBy("margin").select("constituency", r6("margin").alias("margin"))


@register("head_preview", base("col") + """
SELECT constituency, party, candidate, votes FROM col ORDER BY votes DESC, constituency, party LIMIT 10""")
def head_preview(spark, sf_dir):
    """O5 + O6: counts in descending order, first rows as a preview."""
    return collapsed(spark, sf_dir).orderBy(F.desc("votes"), "constituency", "party").limit(10).select(
        "constituency", "party", "candidate", "votes")


@register("parent_area_join", cte(
    res=RESULT_SQL,
    seat="SELECT constituency, seat_no, CAST(sum(votes) AS BIGINT) AS votes FROM res GROUP BY ALL",
    child="""SELECT s.constituency, s.votes, r.r_name AS parent_seat FROM seat s
             JOIN nation n ON s.seat_no = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey""",
    parent="""SELECT parent_seat, '|' || CAST(sum(votes) AS VARCHAR) AS margin_text FROM child GROUP BY parent_seat""") + """
SELECT c.constituency, c.parent_seat, TRY_CAST(regexp_replace(p.margin_text, '[%|,\\s]', '', 'g') AS DOUBLE) AS parent_votes,
       round(c.votes / TRY_CAST(regexp_replace(p.margin_text, '[%|,\\s]', '', 'g') AS DOUBLE), 6) AS share_of_parent
FROM child c LEFT JOIN parent p ON c.parent_seat = p.parent_seat""")
def parent_area_join(spark, sf_dir):
    """J12 + J7: child seats rolled to their parent seat's result (a
    decorated text total, F37) by a left join on the parent name; the
    parent table has one row per parent."""
    r = result(spark, sf_dir)
    seat = r.groupBy("constituency", "seat_no").agg(F.sum("votes").cast("bigint").alias("votes"))
    n = table(spark, sf_dir, "nation", "n_nationkey", "n_regionkey")
    rg = table(spark, sf_dir, "region", "r_regionkey", "r_name")
    child = (seat.join(n, seat.seat_no == n.n_nationkey).join(rg, F.col("n_regionkey") == rg.r_regionkey)
                 .select("constituency", "votes", F.col("r_name").alias("parent_seat")))
    parent = child.groupBy("parent_seat").agg(F.concat(F.lit("|"), F.sum("votes").cast("string")).alias("margin_text"))
    j = child.join(parent, "parent_seat", "left").withColumn("parent_votes", decorated_number("margin_text"))
    return j.select("constituency", "parent_seat", "parent_votes",
                    r6(F.col("votes") / F.col("parent_votes")).alias("share_of_parent"))


def _pred_sql() -> str:
    u = uniform_sql(PRED_SEED, "constituency")
    return f"""SELECT constituency, winner AS truth,
                 CASE WHEN {u} < 1.0 / 3 THEN 'AITC+' WHEN {u} < 2.0 / 3 THEN 'BJP' ELSE 'Other' END AS pred FROM win"""


def predictions(spark, sf_dir):
    """Hashed stand-in forecast joined to the outcome by seat."""
    w = bucket_wide(spark, sf_dir)
    u = uniform(PRED_SEED, "constituency")
    pred = w.select("constituency", F.when(u < 1.0 / 3, "AITC+").when(u < 2.0 / 3, "BJP").otherwise("Other").alias("pred"))
    return w.select("constituency", F.col("winner").alias("truth")).join(pred, "constituency")


@register("accuracy", base("win") + ", p AS (" + _pred_sql() + """)
SELECT truth, count(*) AS n, CAST(sum(CASE WHEN truth = pred THEN 1 ELSE 0 END) AS BIGINT) AS hits FROM p GROUP BY truth
UNION ALL
SELECT 'ALL', count(*), CAST(sum(CASE WHEN truth = pred THEN 1 ELSE 0 END) AS BIGINT) FROM p""")
def accuracy(spark, sf_dir):
    """A15 + J11: hits per true class and overall."""
    p = predictions(spark, sf_dir)
    per = results.per_class_hits(p, "truth", "pred")
    allrow = results.accuracy(p, "truth", "pred").select(F.lit("ALL").alias("truth"),
                                                         (F.col("hits") + F.col("misses")).alias("n"), "hits")
    return per.unionByName(allrow)


def _interval_sql() -> str:
    u1 = uniform_sql(INTERVAL_SEED, "constituency", "bucket")
    u2 = uniform_sql(INTERVAL_SEED + 1, "constituency", "bucket")
    return base("bl") + f""", iv AS (
  SELECT bucket AS choice, vote_share AS a,
         round(vote_share + ({u1} - 0.5) * 6 - (1 + 2 * {u2}), 2) AS lo,
         round(vote_share + ({u1} - 0.5) * 6 + (1 + 2 * {u2}), 2) AS hi FROM bl)
SELECT choice, CAST(sum(CASE WHEN a BETWEEN lo AND hi THEN 1 ELSE 0 END) AS BIGINT) AS inside,
       round(avg(CASE WHEN a BETWEEN lo AND hi THEN 1 ELSE 0 END), 6) AS coverage,
       round(avg(hi - lo), 6) AS mean_width,
       round(avg(greatest(a - hi, 0)) + avg(greatest(lo - a, 0)), 6) AS mean_miss
FROM iv GROUP BY choice"""


@register("interval_coverage", _interval_sql())
def interval_coverage(spark, sf_dir):
    """A16 + P8: interval hits per choice (inclusive bounds), mean width,
    mean overshoot + mean undershoot over all rows."""
    bl = bucket_long(spark, sf_dir)
    u1 = uniform(INTERVAL_SEED, "constituency", "bucket")
    u2 = uniform(INTERVAL_SEED + 1, "constituency", "bucket")
    c = F.col("vote_share") + (u1 - 0.5) * 6
    half = 1 + 2 * u2
    x = bl.select("constituency", "bucket", F.col("vote_share").alias("actual"),
                  F.round(c - half, 2).alias("ci_low"), F.round(c + half, 2).alias("ci_high"))
    wide = results.wide_by_key(x, "constituency", "bucket",
                               {"actual": "actual", "ci_low": "ci_low", "ci_high": "ci_high"}, keys=BUCKETS)
    chk = results.interval_check(wide, ["constituency"], BUCKETS, actual="`{c}_actual`",
                                 low="`{c}_ci_low`", high="`{c}_ci_high`")
    return chk.select("choice", "inside", *[r6(c).alias(c) for c in ("coverage", "mean_width", "mean_miss")])


@register("class_share", base("ol") + """
, x AS (SELECT regexp_extract(candidate, '^(\\w+) ', 1) AS class FROM ol),
g AS (SELECT class, count(*) AS n FROM x WHERE class <> '' GROUP BY class)
SELECT class, n, round(n / (SELECT sum(n) FROM g), 6) AS share FROM g""")
def class_share(spark, sf_dir):
    """class = regex prefix of the text, counts and share of the
    matched total."""
    c = results.class_share(official_long(spark, sf_dir), "candidate", r"^(\w+) ")
    return c.select("class", "n", r6("share").alias("share"))


@register("multi_measure_pivot", base("bl") + """
SELECT constituency,
  max(CASE WHEN bucket = 'AITC+' THEN vote_share END) AS "median_AITC+",
  max(CASE WHEN bucket = 'AITC+' THEN vote_share - 1 END) AS "ci_low_AITC+",
  max(CASE WHEN bucket = 'AITC+' THEN vote_share + 1 END) AS "ci_high_AITC+",
  max(CASE WHEN bucket = 'BJP' THEN vote_share END) AS "median_BJP",
  max(CASE WHEN bucket = 'BJP' THEN vote_share - 1 END) AS "ci_low_BJP",
  max(CASE WHEN bucket = 'BJP' THEN vote_share + 1 END) AS "ci_high_BJP",
  max(CASE WHEN bucket = 'Other' THEN vote_share END) AS "median_Other",
  max(CASE WHEN bucket = 'Other' THEN vote_share - 1 END) AS "ci_low_Other",
  max(CASE WHEN bucket = 'Other' THEN vote_share + 1 END) AS "ci_high_Other"
FROM bl GROUP BY constituency""")
def multi_measure_pivot(spark, sf_dir):
    """Long (seat, choice, three measures) -> wide on known keys, names
    turned from ``X_median`` to ``median_X``."""
    bl = bucket_long(spark, sf_dir).select(
        "constituency", F.col("bucket").alias("choice"), F.col("vote_share").alias("median"),
        (F.col("vote_share") - 1).alias("ci_low"), (F.col("vote_share") + 1).alias("ci_high"))
    w = results.wide_by_key(bl, "constituency", "choice", {"median": "median", "ci_low": "ci_low", "ci_high": "ci_high"},
                            keys=BUCKETS)
    return w.withColumnsRenamed({f"{b}_{m}": f"{m}_{b}" for b in BUCKETS for m in ("median", "ci_low", "ci_high")})
