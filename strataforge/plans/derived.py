"""Test tables derived from the driver's parquet tables.

The driver tables hold no nulls, typos or roll-like records, so the
catalogue derives them by rule. Each derivation exists twice: as a Spark
plan here and as DuckDB SQL (``*_SQL``) for the oracle; the two are written
independently and must agree row for row.

ROLL   labelled voter rows: orders joined to customer.
SURVEY synthetic respondents with answer probabilities: events.
RESULT candidate vote totals per seat: lineitem, orders, customer, part.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataforge.functions.hashing import uniform, uniform_sql
from strataforge.sources.tables import table

# Fixed values for the derived tables (seeds and category lists).
SURVEY_SEEDS = {"p_will_vote": 101, "p_aitc": 102, "p_nda": 103, "p_lf": 104,
                "p_inc": 105, "p_nota": 106}
SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")
PRIORITIES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")
STATUSES = ("F", "O", "P")
AGE_BANDS = ("18-25", "26-35", "36-45", "46-60", "60+")


def seat_name(c) -> F.Column:
    return F.concat(F.lit("SEAT-"), c.cast("string"))


def roll(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")
    c = table(spark, sf_dir, "customer", "c_custkey", "c_nationkey", "c_mktsegment")
    j = o.join(c, o.o_custkey == c.c_custkey)
    k = F.col("o_orderkey")
    booth = F.col("c_custkey") % 8
    base_gender = (F.when(F.col("o_orderstatus") == "F", "female")
                   .when(F.col("o_orderstatus") == "O", "male").otherwise("Female"))
    gender = (F.when(k % 11 == 0, "Maie").when(k % 11 == 1, "fermain").when(k % 11 == 2, "Male")
              .when(k % 11 == 3, F.lit(None).cast("string")).when(k % 11 == 4, "Mais")
              .when(k % 11 == 5, " x ").otherwise(base_gender))
    return j.select(
        k.alias("voter_id"),
        F.col("c_nationkey").alias("eroll_no"),
        seat_name(F.col("c_nationkey")).alias("constituency_name"),
        F.when(k % 101 == 0, F.lit(None)).otherwise(booth).cast("int").alias("booth_no"),
        F.when(k % 13 == 0, F.lit(None))
         .otherwise(100 + (F.col("c_nationkey") * 8 + booth) * 7 % 900).cast("double")
         .alias("total_individuals"),
        F.when(k % 7 == 0, F.lit(None).cast("string"))
         .when((F.col("c_custkey") + k) % 3 == 0, "Urb").otherwise("Rur").alias("area_type"),
        gender.alias("gender"),
        (15 + F.col("o_custkey") % 70).cast("int").alias("age"),
        F.col("c_mktsegment").alias("R"),
        F.col("o_orderpriority").alias("G"),
        F.col("o_orderstatus").alias("SG"),
    )


ROLL_SQL = """
SELECT o_orderkey AS voter_id,
       c_nationkey AS eroll_no,
       'SEAT-' || CAST(c_nationkey AS VARCHAR) AS constituency_name,
       CAST(CASE WHEN o_orderkey % 101 = 0 THEN NULL ELSE c_custkey % 8 END AS INTEGER) AS booth_no,
       CAST(CASE WHEN o_orderkey % 13 = 0 THEN NULL
                 ELSE 100 + (c_nationkey * 8 + c_custkey % 8) * 7 % 900 END AS DOUBLE) AS total_individuals,
       CASE WHEN o_orderkey % 7 = 0 THEN NULL
            WHEN (c_custkey + o_orderkey) % 3 = 0 THEN 'Urb' ELSE 'Rur' END AS area_type,
       CASE o_orderkey % 11 WHEN 0 THEN 'Maie' WHEN 1 THEN 'fermain' WHEN 2 THEN 'Male'
            WHEN 3 THEN NULL WHEN 4 THEN 'Mais' WHEN 5 THEN ' x '
            ELSE CASE o_orderstatus WHEN 'F' THEN 'female' WHEN 'O' THEN 'male' ELSE 'Female' END
       END AS gender,
       CAST(15 + o_custkey % 70 AS INTEGER) AS age,
       c_mktsegment AS "R", o_orderpriority AS "G", o_orderstatus AS "SG"
FROM orders JOIN customer ON o_custkey = c_custkey
"""


def _pick(values, idx) -> F.Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (idx + 1).cast("int"))


def survey(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events", "event_id", "user_id")
    k = F.col("event_id")
    area = F.col("user_id") % 25
    probs = []
    for name, seed in SURVEY_SEEDS.items():
        u = uniform(seed, "event_id")
        if name == "p_lf":
            u = F.when(k % 17 == 0, F.lit(None).cast("double")).otherwise(u)
        if name == "p_will_vote":
            u = F.when(k % 23 == 0, F.lit(None).cast("double")).otherwise(u)
        probs.append(F.when(k % 10 == 0, u * 100).otherwise(u).alias(name))
    return e.select(
        k.alias("resp_id"),
        area.cast("int").alias("eroll_no"),
        seat_name(area).alias("constituency_name"),
        F.when(k % 2 == 0, "female").otherwise("male").alias("gender"),
        _pick(AGE_BANDS, F.col("user_id") % 5).alias("age_band"),
        F.when(k % 3 == 0, "Urb").otherwise("Rur").alias("area_type"),
        _pick(SEGMENTS, k % 5).alias("R"),
        _pick(PRIORITIES, (k / 5).cast("bigint") % 5).alias("G"),
        _pick(STATUSES, (k / 25).cast("bigint") % 3).alias("SG"),
        *probs,
    )


def _survey_sql() -> str:
    probs = []
    for name, seed in SURVEY_SEEDS.items():
        u = uniform_sql(seed, "event_id")
        if name == "p_lf":
            u = f"(CASE WHEN event_id % 17 = 0 THEN NULL ELSE {u} END)"
        if name == "p_will_vote":
            u = f"(CASE WHEN event_id % 23 = 0 THEN NULL ELSE {u} END)"
        probs.append(f"CASE WHEN event_id % 10 = 0 THEN {u} * 100 ELSE {u} END AS {name}")
    seg = ", ".join(f"'{v}'" for v in SEGMENTS)
    pri = ", ".join(f"'{v}'" for v in PRIORITIES)
    sta = ", ".join(f"'{v}'" for v in STATUSES)
    band = ", ".join(f"'{v}'" for v in AGE_BANDS)
    return f"""
SELECT event_id AS resp_id,
       CAST(user_id % 25 AS INTEGER) AS eroll_no,
       'SEAT-' || CAST(user_id % 25 AS VARCHAR) AS constituency_name,
       CASE WHEN event_id % 2 = 0 THEN 'female' ELSE 'male' END AS gender,
       [{band}][user_id % 5 + 1] AS age_band,
       CASE WHEN event_id % 3 = 0 THEN 'Urb' ELSE 'Rur' END AS area_type,
       [{seg}][event_id % 5 + 1] AS "R",
       [{pri}][(event_id // 5) % 5 + 1] AS "G",
       [{sta}][(event_id // 25) % 3 + 1] AS "SG",
       {", ".join(probs)}
FROM events
"""


SURVEY_SQL = _survey_sql()


def result(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidate totals: seat = customer nation, party = part brand,
    candidate = part name, votes = summed quantity. Aggregated before any
    further use, so the big lineitem side shrinks to seats x candidates."""
    li = table(spark, sf_dir, "lineitem", "l_orderkey", "l_partkey", "l_quantity")
    o = table(spark, sf_dir, "orders", "o_orderkey", "o_custkey")
    c = table(spark, sf_dir, "customer", "c_custkey", "c_nationkey")
    p = table(spark, sf_dir, "part", "p_partkey", "p_brand", "p_name")
    j = (li.join(o, li.l_orderkey == o.o_orderkey)
           .join(c, F.col("o_custkey") == c.c_custkey)
           .join(p, F.col("l_partkey") == p.p_partkey))
    return (j.groupBy("c_nationkey", "p_brand", "p_name")
             .agg(F.sum("l_quantity").cast("bigint").alias("votes"))
             .select(F.col("c_nationkey").alias("seat_no"),
                     seat_name(F.col("c_nationkey")).alias("constituency"),
                     F.col("p_brand").alias("party"), F.col("p_name").alias("candidate"), "votes"))


RESULT_SQL = """
SELECT c_nationkey AS seat_no, 'SEAT-' || CAST(c_nationkey AS VARCHAR) AS constituency,
       p_brand AS party, p_name AS candidate, CAST(sum(l_quantity) AS BIGINT) AS votes
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
     JOIN customer ON o_custkey = c_custkey
     JOIN part ON l_partkey = p_partkey
GROUP BY c_nationkey, p_brand, p_name
"""
