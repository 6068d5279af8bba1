"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Every source gets a word budget. Whole epochs are taken first; what is left
of the budget goes to documents in the order of exponential keys
``-ln(u) / weight`` (a weighted sample without replacement), whose sizes are
prefix-summed up to the budget. No source is sorted in one task: key ranges
are summed per (source, range) with a map-side combine, the range in which
the budget ends is found from at most ``RANGES`` sums per source, and only
that range is sorted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strataforge.functions.hashing import uniform
from strataforge.llm.common import n_words
from strataforge.operators.joins import join_bounded
from strataforge.session import ensure_checkpoint_dir

WEIGHTS = (5.0, 2.0, 1.0)
MAX_EPOCHS = 3
SEED = 8
#: Key ranges per source; the sorted range holds about 1 / RANGES of a source.
RANGES = 16_384
#: Above so many sources their table is joined by shuffle, not broadcast.
MAX_BROADCAST_SOURCES = 50_000


def cycle_weight(rank: Column, weights=WEIGHTS) -> Column:
    """Weight of the 1-based ``rank``, repeating."""
    return F.element_at(F.array(*[F.lit(w) for w in weights]), ((rank - 1) % len(weights) + 1).cast("int"))


def targets(sizes: DataFrame, weights=WEIGHTS, cap: int = MAX_EPOCHS) -> DataFrame:
    """Word budget per source from (src, src_null, source_size).

    Sources in code-point order, null last, weigh ``weights`` repeating and
    share the sum of all sizes; a source stops at ``cap`` times its size and
    the excess is shared again by weight. In closed form: with sources in the
    order of cap / weight, the level is the first at which the next source
    stays under its cap. One row per source.
    """
    every = Window.partitionBy()
    order = Window.orderBy("ratio", "src_null", "src")
    t = (sizes.withColumn("rank", F.row_number().over(Window.orderBy("src_null", "src")))
         .withColumn("w", cycle_weight(F.col("rank"), weights))
         .withColumn("ceiling", F.col("source_size") * cap)
         .withColumn("ratio", F.col("ceiling") / F.col("w"))
         .withColumn("cap_before", F.coalesce(F.sum("ceiling").over(order.rowsBetween(Window.unboundedPreceding, -1)),
                                              F.lit(0)))
         .withColumn("w_left", F.sum("w").over(order.rowsBetween(0, Window.unboundedFollowing)))
         .withColumn("total", F.sum("source_size").over(every))
         .withColumn("level", (F.col("total") - F.col("cap_before")) / F.col("w_left"))
         .withColumn("level", F.min(F.when(F.col("level") <= F.col("ratio"), F.struct("ratio", "level")))
                     .over(every)["level"]))
    return t.select("src", "src_null", "source_size",
                    F.least(F.col("ceiling").cast("double"), F.col("w") * F.col("level")).alias("target"))


def mix(docs: DataFrame, quality: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text",
        source_col: str = "source", weights=WEIGHTS, cap: int = MAX_EPOCHS, seed: int = SEED,
        ranges: int = RANGES) -> DataFrame:
    """(doc_id, source, size, source_size, target, taken) per document.

    ``quality`` is (id, weight) with positive weights; missing, null and
    non-positive weights count as 1, of repeated ids the largest counts.
    ``taken`` = whole epochs x size, plus the size again for documents the
    weighted sample picks; the document at which the budget ends gives the
    words that are missing, so a source's sum is its target rounded down.
    Null sources are one source; empty texts take 0. The keys are a hash of
    (seed, id), so reruns agree; equal keys go by id.
    """
    spark = docs.sparkSession
    ensure_checkpoint_dir(spark)
    sized = (docs.where(F.col(id_col).isNotNull())
             .select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(source_col), F.lit("")).alias("src"),
                     F.col(source_col).isNull().alias("src_null"), n_words(F.col(text_col)).alias("size")))
    if quality is None:
        sized = sized.withColumn("weight", F.lit(1.0))
    else:
        q = quality.groupBy(F.col(quality.columns[0]).cast("long").alias("doc_id")).agg(
            F.max(F.col(quality.columns[1]).cast("double")).alias("weight"))
        sized = (sized.join(q, "doc_id", "left")
                 .withColumn("weight", F.when(F.col("weight") > 0, F.col("weight")).otherwise(1.0)))
    key = -F.log(uniform(seed, F.col("doc_id"))) / F.col("weight")
    sized = (sized.withColumn("key", key)
             .withColumn("range", F.floor(F.col("key") / (F.col("key") + 1) * ranges).cast("int"))
             .checkpoint())
    sums = (sized.groupBy("src", "src_null", "range").agg(F.sum("size").alias("words")).checkpoint())
    src = targets(sums.groupBy("src", "src_null").agg(F.sum("words").alias("source_size")), weights, cap)
    src = (src.withColumn("epochs", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size")))
                          .otherwise(0).cast("long"))
           .withColumn("epochs", F.least("epochs", F.lit(cap)))
           .withColumn("rest", F.floor(F.when(F.col("epochs") < cap, F.col("target") - F.col("epochs") * F.col("source_size"))
                                       .otherwise(0.0)).cast("long"))
           .checkpoint())
    ahead = Window.partitionBy("src", "src_null").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    end = (join_bounded(sums, src, ["src", "src_null"], "inner", MAX_BROADCAST_SOURCES)
           .withColumn("before", F.coalesce(F.sum("words").over(ahead), F.lit(0)))
           .where((F.col("before") <= F.col("rest")) & (F.col("before") + F.col("words") > F.col("rest")))
           .groupBy("src", "src_null").agg(F.min("range").alias("end"), F.min_by("before", "range").alias("before")))
    src = src.join(end, ["src", "src_null"], "left")
    rows = join_bounded(sized, src, ["src", "src_null"], "inner", MAX_BROADCAST_SOURCES)
    sure = rows.where("end IS NULL OR range <> end").withColumn(
        "extra", F.when(F.col("range") < F.col("end"), F.col("size")).otherwise(0))
    inside = Window.partitionBy("src", "src_null").orderBy("key", "doc_id").rowsBetween(Window.unboundedPreceding, -1)
    last = (rows.where("range = end")
            .withColumn("extra", F.col("rest") - F.col("before") - F.coalesce(F.sum("size").over(inside), F.lit(0)))
            .withColumn("extra", F.greatest(F.lit(0), F.least("size", "extra"))))
    return sure.unionByName(last).select(
        "doc_id", F.when(~F.col("src_null"), F.col("src")).alias("source"), "size", "source_size", "target",
        (F.col("epochs") * F.col("size") + F.col("extra")).cast("long").alias("taken"))
