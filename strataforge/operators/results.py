"""Official results: collapse, reshape, bucket and compare (SURVEY §2.4
A13, A15-A17, A23; §2.7 X1, X2, X5; §2.5 W8; §2.3 J7, J11, J12).

Wide tables exist only at the edge: everything stays long (seat, party,
value) until a sink pivots it; the pivot of unknown keys first collects the
distinct key list, which is the party list (bounded by the data's parties,
not its rows).
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataforge.functions.numeric import count_text_to_long
from strataforge.operators.poststrat import argmax_name


def collapse_to_party(long: DataFrame, seat: str = "constituency", party: str = "party",
                      candidate: str = "candidate", votes_text: str = "total_votes",
                      order: str = "row_pos") -> DataFrame:
    """A13 + F9: per (seat, party) the candidate with the most votes; votes
    parse from ``"1,234"`` text, unreadable -> 0; ties keep the first row
    seen (smallest ``order``). An aggregate, not a window, so a seat or party
    with very many rows combines map-side."""
    x = long.withColumn("__v", count_text_to_long(votes_text))
    best = x.groupBy(seat, party).agg(
        F.min_by(F.struct(F.col(candidate).alias("candidate"), F.col("__v").alias("votes")),
                 F.struct((-F.col("__v")).alias("a"), F.col(order).alias("b"))).alias("__r"))
    return best.select(seat, party, F.col("__r.candidate").alias(candidate), F.col("__r.votes").alias("votes"))


def with_vote_share(df: DataFrame, seat: str = "constituency", votes: str = "votes",
                    out: str = "vote_share", digits: int = 2) -> DataFrame:
    """Share of the seat's votes in percent, rounded."""
    from pyspark.sql import Window
    # the input is one row per (seat, party): a window over a seat's parties
    # is bounded and avoids recomputing the collapse for a totals branch
    tot = F.sum(votes).over(Window.partitionBy(seat))
    return df.withColumn(out, F.round(F.try_divide(F.col(votes) * 100.0, tot), digits))


def wide_by_key(long: DataFrame, seat: str, key: str, values: dict[str, str],
                keys: Sequence[str] | None = None) -> DataFrame:
    """Long -> wide; one ``{key}_{name}`` column per key value and
    measure. ``keys=None`` discovers (and sorts) the key values first."""
    if keys is None:
        keys = sorted(r[0] for r in long.select(key).distinct().collect())  # the key list, not the rows
    aggs = [F.first(F.col(src), ignorenulls=True).alias(name) for name, src in values.items()]
    wide = long.groupBy(seat).pivot(key, list(keys)).agg(*aggs)
    if len(values) == 1:   # Spark names a single measure by the key alone
        name = next(iter(values))
        wide = wide.withColumnsRenamed({str(k): f"{k}_{name}" for k in keys})
    return wide


def unpivot_by_suffix(wide: DataFrame, ids: Sequence[str], suffix: str, key: str = "party",
                      value: str = "value") -> DataFrame:
    """Wide -> long over the columns ending in ``suffix``; the key is the
    name without the suffix (names with ``+`` or ``#`` need no quoting as
    Column objects)."""
    cols = [c for c in wide.columns if c.endswith(suffix)]
    keys = [c[: -len(suffix)] for c in cols]
    arr = F.array(*[F.struct(F.lit(k).alias(key), F.col(f"`{c}`").alias(value)) for k, c in zip(keys, cols)])
    return wide.select(*ids, F.inline(arr))


def bucket_rollup(collapsed: DataFrame, bucket_of: Column, buckets: Sequence[str],
                  seat: str = "constituency", party: str = "party", candidate: str = "candidate",
                  votes: str = "votes", share: str = "vote_share") -> DataFrame:
    """X5 (+P14, A13): member parties -> bucket totals per seat: summed
    votes, share summed then rounded to 2, and the candidate of the member
    with most votes (first party in sorted order on ties); "" when that
    member has 0 votes or no name. Seats with no member in a bucket get
    "", 0, 0.0. Output is long (seat, bucket, ...)."""
    x = collapsed.withColumn("bucket", bucket_of)
    top = F.min_by(F.struct(F.col(candidate).alias("c"), F.col(votes).alias("v")),
                   F.struct((-F.col(votes)).alias("a"), F.col(party).alias("b")))
    # one aggregate per seat with the known buckets as columns: a bucket with
    # no member is simply null, so no separate seats x buckets grid is built
    wide = x.groupBy(seat).pivot("bucket", list(buckets)).agg(
        F.sum(votes).cast("bigint").alias("t"), F.round(F.sum(share), 2).alias("s"), top.alias("top"))
    long = wide.select(seat, F.inline(F.array(*[
        F.struct(F.lit(b).alias("bucket"), F.col(f"`{b}_t`").alias("t"), F.col(f"`{b}_s`").alias("s"),
                 F.col(f"`{b}_top`").alias("top")) for b in buckets])))
    cand = F.when(F.col("top").isNull() | (F.col("top.v") == 0) | F.col("top.c").isNull(), F.lit("")) \
            .otherwise(F.col("top.c"))
    return long.select(seat, "bucket", cand.alias("candidate"),
                       F.coalesce("t", F.lit(0).cast("bigint")).alias("total_votes"),
                       F.coalesce("s", F.lit(0.0)).alias("vote_share"))


def winner_of(names: Sequence[str], cols: Sequence[str], all_zero_null: bool = False) -> Column:
    """W8 across named columns (first on ties; an all-zero row names the
    first column, as ``idxmax`` does, or null with ``all_zero_null``)."""
    return argmax_name(names, [F.col(f"`{c}`") for c in cols], all_zero_null)


def seat_counts(df: DataFrame, winner: str = "winner", total_label: str = "TOTAL") -> DataFrame:
    """Seats per winner with share, plus a TOTAL line (``rollup``)."""
    g = df.rollup(winner).agg(F.count(F.lit(1)).alias("seats"), F.grouping_id().alias("__g"))
    tot = df.select(F.count(F.lit(1)).alias("__all")).scalar()
    return (g.withColumn("__all", tot)
             .select(F.when(F.col("__g") == 1, F.lit(total_label)).otherwise(F.col(winner)).alias(winner),
                     "seats", F.round(F.col("seats") * 100.0 / F.col("__all"), 2).alias("share")))


def accuracy(df: DataFrame, truth: str, pred: str) -> DataFrame:
    """Hits, misses and hit share overall."""
    hit = (F.col(truth) == F.col(pred)).cast("int")
    return df.agg(F.sum(hit).cast("bigint").alias("hits"), F.sum(1 - hit).cast("bigint").alias("misses"),
                  F.avg(hit).alias("accuracy"))


def per_class_hits(df: DataFrame, truth: str, pred: str) -> DataFrame:
    """Hits per true class."""
    hit = (F.col(truth) == F.col(pred)).cast("int")
    return df.groupBy(truth).agg(F.count(F.lit(1)).alias("n"), F.sum(hit).cast("bigint").alias("hits"))


def interval_check(df: DataFrame, ids: Sequence[str], choices: Sequence[str],
                   actual: str = "actual_{c}", low: str = "ci_low_{c}", high: str = "ci_high_{c}") -> DataFrame:
    """A16 (+P8): per choice, count and share of actual values inside
    [low, high] (inclusive), mean width, and mean overshoot plus mean
    undershoot taken over all rows (clipped at 0)."""
    parts = []
    for c in choices:
        a, lo, hi = F.col(actual.format(c=c)), F.col(low.format(c=c)), F.col(high.format(c=c))
        parts.append(df.select(*ids, F.lit(c).alias("choice"), a.alias("a"), lo.alias("lo"), hi.alias("hi")))
    long = reduce(DataFrame.unionByName, parts)
    inside = F.col("a").between(F.col("lo"), F.col("hi")).cast("int")
    return long.groupBy("choice").agg(
        F.sum(inside).cast("bigint").alias("inside"), F.avg(inside).alias("coverage"),
        F.avg(F.col("hi") - F.col("lo")).alias("mean_width"),
        (F.avg(F.greatest(F.col("a") - F.col("hi"), F.lit(0.0)))
         + F.avg(F.greatest(F.col("lo") - F.col("a"), F.lit(0.0)))).alias("mean_miss"))


def class_share(df: DataFrame, text: str, pattern: str, out: str = "class") -> DataFrame:
    """class = regex capture of ``text`` (rows without a match are
    dropped), counts and share of the matched total."""
    x = df.select(F.regexp_extract(F.col(text), pattern, 1).alias(out)).where(F.col(out) != "")
    g = x.groupBy(out).agg(F.count(F.lit(1)).alias("n"))
    tot = g.select(F.sum("n")).scalar()
    return g.select(out, "n", (F.col("n") / tot).alias("share"))
