"""Phase 2 queries: profiles, cross tables, set operations (A5-A9, A11,
A18, A19, A21, A24, A26, A28, U1-U5, J9, P17, F38)."""

from __future__ import annotations

from pyspark.sql import functions as F

from strataforge.operators import profile
from strataforge.plans.catalogue import register, r6, cte
from strataforge.plans.derived import roll, ROLL_SQL
from strataforge.sources.tables import table


@register("value_counts", cte(roll=ROLL_SQL) + """
SELECT gender, count(*) AS n FROM roll GROUP BY gender""")
def value_counts(spark, sf_dir):
    """A5 with nulls kept."""
    return profile.value_counts(roll(spark, sf_dir), "gender", dropna=False)


@register("describe", """
SELECT 'o_totalprice' AS "column", count(o_totalprice) AS count, round(avg(o_totalprice), 6) AS mean,
       round(stddev_samp(o_totalprice), 6) AS std, min(o_totalprice) AS min,
       round(quantile_cont(o_totalprice, 0.25), 6) AS p25, round(quantile_cont(o_totalprice, 0.5), 6) AS p50,
       round(quantile_cont(o_totalprice, 0.75), 6) AS p75, max(o_totalprice) AS max FROM orders
UNION ALL
SELECT 'o_custkey', count(o_custkey), round(avg(o_custkey), 6), round(stddev_samp(o_custkey), 6),
       CAST(min(o_custkey) AS DOUBLE), round(quantile_cont(o_custkey, 0.25), 6), round(quantile_cont(o_custkey, 0.5), 6),
       round(quantile_cont(o_custkey, 0.75), 6), CAST(max(o_custkey) AS DOUBLE) FROM orders""")
def describe(spark, sf_dir):
    """A7 (count, mean, sample sd, min, linear quartiles, max)."""
    o = table(spark, sf_dir, "orders", "o_totalprice", "o_custkey")
    d = profile.describe(o, ["o_totalprice", "o_custkey"])
    return d.select("column", "count", *[r6(c).alias(c) for c in ("mean", "std")], "min",
                    *[r6(c).alias(c) for c in ("p25", "p50", "p75")], "max")


@register("null_profile", cte(roll=ROLL_SQL) + """
SELECT "column", n_null FROM (
  SELECT count(*) FILTER (WHERE booth_no IS NULL) AS booth_no,
         count(*) FILTER (WHERE total_individuals IS NULL) AS total_individuals,
         count(*) FILTER (WHERE area_type IS NULL) AS area_type,
         count(*) FILTER (WHERE gender IS NULL) AS gender,
         count(*) FILTER (WHERE age IS NULL) AS age FROM roll)
UNPIVOT (n_null FOR "column" IN (booth_no, total_individuals, area_type, gender, age))""")
def null_profile(spark, sf_dir):
    """Null count per column in one pass."""
    return profile.null_counts(roll(spark, sf_dir), ["booth_no", "total_individuals", "area_type", "gender", "age"])


@register("named_aggs", """
SELECT o_orderpriority, count(*) AS rows, round(sum(o_totalprice), 6) AS total, round(avg(o_totalprice), 6) AS mean
FROM orders GROUP BY o_orderpriority""")
def named_aggs(spark, sf_dir):
    """A9 (+A11): count / sum / mean per group; ordered at the sink."""
    o = table(spark, sf_dir, "orders", "o_orderpriority", "o_totalprice")
    g = profile.named_aggs(o, "o_orderpriority", "o_totalprice")
    return g.select("o_orderpriority", "rows", r6("total").alias("total"), r6("mean").alias("mean"))


@register("distinct_counts", cte(roll=ROLL_SQL) + """
SELECT "column", n_distinct FROM (
  SELECT count(DISTINCT gender) AS gender, count(DISTINCT area_type) AS area_type,
         count(DISTINCT booth_no) AS booth_no, count(DISTINCT "R") AS "R" FROM roll)
UNPIVOT (n_distinct FOR "column" IN (gender, area_type, booth_no, "R"))""")
def distinct_counts(spark, sf_dir):
    """Distinct non-null values."""
    return profile.distinct_counts(roll(spark, sf_dir), ["gender", "area_type", "booth_no", "R"])


@register("dup_count", cte(roll=ROLL_SQL) + """
SELECT CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS duplicates, count(*) AS distinct_rows FROM (
  SELECT eroll_no, gender, area_type, "R", count(*) AS n FROM roll GROUP BY ALL)""")
def dup_count(spark, sf_dir):
    """Rows beyond the first of each identical group."""
    r = roll(spark, sf_dir).select("eroll_no", "gender", "area_type", "R")
    return profile.duplicate_rows(r)


@register("group_size_summary", """
SELECT count(n) AS count, round(avg(n), 6) AS mean, round(stddev_samp(n), 6) AS std,
       CAST(min(n) AS DOUBLE) AS min, round(quantile_cont(n, 0.5), 6) AS p50, CAST(max(n) AS DOUBLE) AS max
FROM (SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey)""")
def group_size_summary(spark, sf_dir):
    """Group sizes, then A7 over them."""
    o = table(spark, sf_dir, "orders", "o_custkey")
    sizes = o.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))
    d = profile.describe(sizes, ["n"])
    return d.select("count", r6("mean").alias("mean"), r6("std").alias("std"), "min",
                    r6("p50").alias("p50"), "max")


@register("crosstab_margins", """
SELECT CASE WHEN grouping(o_orderstatus) = 1 THEN 'All' ELSE o_orderstatus END AS o_orderstatus,
       CASE WHEN grouping(o_orderpriority) = 1 THEN 'All' ELSE o_orderpriority END AS o_orderpriority,
       count(*) AS n
FROM orders GROUP BY CUBE (o_orderstatus, o_orderpriority)""")
def crosstab_margins(spark, sf_dir):
    """Cross table with margins (``cube`` + ``grouping_id``)."""
    o = table(spark, sf_dir, "orders", "o_orderstatus", "o_orderpriority")
    return profile.crosstab_margins(o, "o_orderstatus", "o_orderpriority")


SETS_SQL = """
a AS (SELECT DISTINCT upper(trim('nation_' || CAST(c_nationkey AS VARCHAR))) AS name FROM customer),
b AS (SELECT DISTINCT upper(trim(' nation_' || CAST(s_nationkey AS VARCHAR) || ' ')) AS name FROM supplier),
c AS (SELECT DISTINCT upper(trim(n_name)) AS name FROM nation),
u AS (SELECT name, 'a' AS src FROM a UNION ALL SELECT name, 'b' FROM b UNION ALL SELECT name, 'c' FROM c)
"""


def _sets(spark, sf_dir):
    from strataforge.functions.text import strip_all
    c = table(spark, sf_dir, "customer", "c_nationkey")
    s = table(spark, sf_dir, "supplier", "s_nationkey")
    n = table(spark, sf_dir, "nation", "n_name")
    up = lambda e: F.upper(strip_all(e)).alias("name")
    return {"a": c.select(up(F.concat(F.lit("nation_"), F.col("c_nationkey").cast("string")))),
            "b": s.select(up(F.concat(F.lit(" nation_"), F.col("s_nationkey").cast("string"), F.lit(" ")))),
            "c": n.select(up(F.col("n_name")))}


@register("set_overlap", "WITH " + SETS_SQL + """
SELECT name, max(CASE WHEN src = 'a' THEN 1 ELSE 0 END) AS in_a, max(CASE WHEN src = 'b' THEN 1 ELSE 0 END) AS in_b,
       max(CASE WHEN src = 'c' THEN 1 ELSE 0 END) AS in_c,
       CAST(count(DISTINCT src) = 3 AS INTEGER) AS in_all
FROM u GROUP BY name""")
def set_overlap(spark, sf_dir):
    """U2 intersection of name sets after trim + upper, U3 each set minus
    the common part, as one presence table."""
    return profile.presence(_sets(spark, sf_dir))


@register("anti_members", """
SELECT DISTINCT c_nationkey FROM customer
WHERE c_nationkey NOT IN (SELECT s_nationkey FROM supplier WHERE s_acctbal > 5000)""")
def anti_members(spark, sf_dir):
    """Members of one set missing from another (``left_anti``)."""
    c = table(spark, sf_dir, "customer", "c_nationkey").distinct()
    s = table(spark, sf_dir, "supplier", "s_nationkey", "s_acctbal").where(F.col("s_acctbal") > 5000)
    return c.join(s, c.c_nationkey == s.s_nationkey, "left_anti")


@register("semi_members", """
SELECT n_nationkey, n_name, n_nationkey IN (SELECT s_nationkey FROM supplier WHERE s_acctbal > 5000) AS surveyed
FROM nation""")
def semi_members(spark, sf_dir):
    """Flag by membership (left join on the distinct key set +
    ``isNotNull``), the ``%in%`` of the reference."""
    n = table(spark, sf_dir, "nation", "n_nationkey", "n_name")
    s = (table(spark, sf_dir, "supplier", "s_nationkey", "s_acctbal").where(F.col("s_acctbal") > 5000)
         .select(F.col("s_nationkey").alias("__k")).distinct())
    return n.join(s, n.n_nationkey == s["__k"], "left").select(
        "n_nationkey", "n_name", F.col("__k").isNotNull().alias("surveyed"))


@register("union_by_name", """
SELECT c_custkey AS id, c_name AS name, c_acctbal AS acctbal, NULL::INTEGER AS nationkey FROM customer
UNION ALL BY NAME
SELECT s_suppkey AS id, s_name AS name, NULL::DOUBLE AS acctbal, s_nationkey AS nationkey FROM supplier""")
def union_by_name(spark, sf_dir):
    """Stack by name, missing columns null."""
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"),
                                                F.col("c_acctbal").alias("acctbal"))
    s = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"),
                                                F.col("s_nationkey").alias("nationkey"))
    return profile.union_by_name(c, s)


@register("union_levels", """
SELECT level, CAST(row_number() OVER (ORDER BY level) AS INTEGER) AS level_id FROM (
  SELECT c_mktsegment AS level FROM customer UNION SELECT o_orderpriority FROM orders)""")
def union_levels(spark, sf_dir):
    """U4: union of distinct values with a sorted id."""
    c = table(spark, sf_dir, "customer", "c_mktsegment")
    o = table(spark, sf_dir, "orders", "o_orderpriority")
    return profile.level_ids((c, "c_mktsegment"), (o, "o_orderpriority"))


@register("corr_line", """
SELECT round(pow(corr(l_quantity, l_extendedprice), 2), 6) AS r2,
       round(regr_slope(l_extendedprice, l_quantity), 6) AS slope,
       round(regr_intercept(l_extendedprice, l_quantity), 6) AS intercept, count(*) AS n_pairs
FROM lineitem WHERE l_quantity IS NOT NULL AND l_extendedprice IS NOT NULL""")
def corr_line(spark, sf_dir):
    """A19 R squared and A26 OLS line."""
    li = table(spark, sf_dir, "lineitem", "l_quantity", "l_extendedprice")
    c = profile.corr_line(li, "l_quantity", "l_extendedprice")
    return c.select(*[r6(x).alias(x) for x in ("r2", "slope", "intercept")], "n_pairs")


@register("frame_profile", """
SELECT position, "column", dtype, non_null, rows FROM (
  SELECT 1 AS position, 'o_orderkey' AS "column", 'bigint' AS dtype, count(o_orderkey) AS non_null, count(*) AS rows FROM orders
  UNION ALL SELECT 2, 'o_custkey', 'bigint', count(o_custkey), count(*) FROM orders
  UNION ALL SELECT 3, 'o_orderstatus', 'string', count(o_orderstatus), count(*) FROM orders
  UNION ALL SELECT 4, 'o_totalprice', 'double', count(o_totalprice), count(*) FROM orders
  UNION ALL SELECT 5, 'o_orderpriority', 'string', count(o_orderpriority), count(*) FROM orders)""")
def frame_profile(spark, sf_dir):
    """Shape, names, types and non-null counts as one table."""
    return profile.frame_profile(table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderstatus",
                                       "o_totalprice", "o_orderpriority"))


@register("id_range", """
SELECT s_suppkey, s_name FROM supplier
WHERE CAST(regexp_extract(s_name, '#(\\d+)', 1) AS BIGINT) BETWEEN 10 AND 40""")
def id_range(spark, sf_dir):
    """Keep ids parsed from a name within an inclusive range."""
    s = table(spark, sf_dir, "supplier", "s_suppkey", "s_name")
    sid = F.regexp_extract("s_name", r"#(\d+)", 1).try_cast("bigint")
    return s.where(sid.between(10, 40))


@register("distinct_sorted", "SELECT DISTINCT n_regionkey FROM nation ORDER BY 1")
def distinct_sorted(spark, sf_dir):
    """U5."""
    return table(spark, sf_dir, "nation", "n_regionkey").distinct().orderBy("n_regionkey")


@register("shared_levels", """
WITH lv AS (SELECT level, CAST(row_number() OVER (ORDER BY level) AS INTEGER) AS level_id FROM (
   SELECT CAST(c_nationkey AS VARCHAR) AS level FROM customer UNION SELECT CAST(s_nationkey AS VARCHAR) FROM supplier))
SELECT s_suppkey, lv.level, lv.level_id FROM supplier JOIN lv ON CAST(s_nationkey AS VARCHAR) = lv.level""")
def shared_levels(spark, sf_dir):
    """one sorted level list from two tables, ids joined onto one of
    them (the id table has one row per level)."""
    c = table(spark, sf_dir, "customer", "c_nationkey")
    s = table(spark, sf_dir, "supplier", "s_suppkey", "s_nationkey")
    lv = profile.level_ids((c, "c_nationkey"), (s, "s_nationkey"))
    return s.join(lv, s.s_nationkey.cast("string") == lv.level).select("s_suppkey", "level", "level_id")
