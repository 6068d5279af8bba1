"""Benchmark passages in documents, by SimHash over item-sized windows.

A window is as long as a benchmark item and starts where a five-word shingle
it shares with some item of that length would put the item. Windows at other
starts are not looked at: a passage whose words were moved against the item on
both sides of every start looked at (words inserted in its middle and changed
at both ends) can be at the threshold between two of them and be missed.
Windows and items get 64-bit SimHash fingerprints of their shingles. Items
are indexed by ``BLOCKS`` blocks of their fingerprint, each with all values
within ``RADIUS // BLOCKS`` flips: by the pigeonhole principle every
fingerprint within ``RADIUS`` bits meets its item in some block. Candidates
within the radius are verified by the exact similarity of the shingle
multisets (shared over joint counts). At the threshold two sets differ in 11
of 64 bits with a standard deviation of 3, so the radius of 23 is four
deviations away.

Everything is DataFrame expressions and joins. The item tables grow with the
benchmark only; they are broadcast when their counted rows stay under
``MAX_BROADCAST`` and shuffled otherwise.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataforge.llm.common import WORD, id_text, lower_az
from strataforge.operators.joins import join_bounded
from strataforge.session import ensure_checkpoint_dir

SHINGLE = 5
#: Similarity in hundredths.
THRESHOLD = 75
RADIUS, BLOCKS = 23, 8
BITS = 64 // BLOCKS
#: Rows of an item table that may be broadcast (a few longs each).
MAX_BROADCAST = 500_000
#: All values of a block within RADIUS // BLOCKS flips, as masks.
MASKS = [sum(1 << b for b in flips) for n in range(RADIUS // BLOCKS + 1) for flips in combinations(range(BITS), n)]


def words(text: Column) -> Column:
    return F.regexp_extract_all(lower_az(text), F.lit(WORD), F.lit(0))


def shingles(column: str) -> Column:
    """Hash of every five words; with fewer, of the whole sequence; without words, none."""
    five = ", ".join(f"get({column}, i + {j})" for j in range(SHINGLE))
    return F.expr(f"CASE WHEN size({column}) >= {SHINGLE} THEN transform(sequence(0, size({column}) - {SHINGLE}), i -> xxhash64({five})) "
                  f"WHEN size({column}) > 0 THEN array(xxhash64({column})) ELSE CAST(array() AS array<bigint>) END")


def fingerprint(column: str) -> Column:
    """64-bit SimHash of an array of hashes: the majority of every bit."""
    return F.expr(f"aggregate(sequence(0, 63), 0L, (f, b) -> f | CASE WHEN 2 * aggregate({column}, 0, (n, h) -> "
                  f"n + CAST(shiftrightunsigned(h, b) & 1 AS int)) > size({column}) THEN shiftleft(1L, b) ELSE 0L END)")


def block(fp: Column, k: Column) -> Column:
    return F.call_function("shiftrightunsigned", fp, k * BITS).bitwiseAND(F.lit((1 << BITS) - 1))


def items_of(benchmark: DataFrame, item_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(item_id, length, shingles, fp); items without an id or words are left out."""
    b = (benchmark.select(F.col(item_col).cast("long").alias("item_id"), words(F.col(text_col)).alias("w"))
         .where("item_id IS NOT NULL AND size(w) > 0"))
    b = b.select("item_id", F.size("w").alias("length"), shingles("w").alias("shingles"))
    return b.withColumn("fp", fingerprint("shingles"))


def windows(docs: DataFrame, items: DataFrame) -> DataFrame:
    """(doc_id, length, start, shingles): the distinct item-sized windows that share a shingle with an item of their length."""
    sh = docs.select("doc_id", words(F.col("text")).alias("w")).select("doc_id", shingles("w").alias("s"))
    places = items.select("length", F.posexplode("shingles").alias("q", "h")).distinct()
    hits = join_bounded(sh.select("doc_id", F.size("s").alias("n"), F.posexplode_outer("s").alias("p", "h")),
                        places, "h", "inner", MAX_BROADCAST)
    # (the outer form, or the optimizer would filter on the array's size below and build the array once per element)
    # shingles in the window: one for items under five words, which match such documents whole
    span = F.greatest(F.col("length") - (SHINGLE - 1), F.lit(1))
    at = F.greatest(F.lit(0), F.least(F.col("p") - F.col("q"), F.col("n") - span))
    starts = (hits.select("doc_id", "length", at.alias("start"), span.alias("span"))
              .groupBy("doc_id").agg(F.collect_set(F.struct("length", "start", "span")).alias("at")))
    return (docs.join(starts.hint("shuffle_hash"), "doc_id")
            .select("doc_id", "at", words(F.col("text")).alias("w")).select("doc_id", "at", shingles("w").alias("s"))
            .select("doc_id", "s", F.explode("at").alias("x"))
            .select("doc_id", "x.length", "x.start", F.expr("slice(s, x.start + 1, x.span)").alias("shingles"))
            .dropDuplicates(["doc_id", "length", "start"]))


def candidates(wins: DataFrame, items: DataFrame) -> DataFrame:
    """Windows with the items of their length whose fingerprint is within ``RADIUS``."""
    ks = F.explode(F.array(*[F.lit(k) for k in range(BLOCKS)])).alias("k")
    index = (items.select("item_id", "length", F.col("fp").alias("item_fp"), ks)
             .select("item_id", "length", "item_fp", "k", F.explode(F.array(*[F.lit(m) for m in MASKS])).alias("mask"))
             .select("item_id", "length", "item_fp", "k", block(F.col("item_fp"), F.col("k")).bitwiseXOR(F.col("mask")).alias("value")))
    asked = (wins.select("doc_id", "length", "start", "fp", ks)
             .select("doc_id", "length", "start", "fp", "k", block(F.col("fp"), F.col("k")).alias("value")))
    met = join_bounded(asked, index, ["length", "k", "value"], "inner", MAX_BROADCAST)
    return (met.where(F.bit_count(F.col("fp").bitwiseXOR(F.col("item_fp"))) <= RADIUS)
            .select("doc_id", "length", "start", "item_id").distinct())


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 item_col: str = "item_id", item_text: str = "text", threshold: int = THRESHOLD) -> DataFrame:
    """(doc_id, item_id, start, length, similarity): per document and item the
    best window at or above the threshold, ties to the earliest.

    Words are lower-cased A-Z. ``start`` and ``length`` count words. Null and
    empty texts match nothing; an item of fewer than five words matches only
    a document that is the same words; equal items are reported each; rows
    that repeat an id are one document with the union of their windows.
    """
    ensure_checkpoint_dir(docs.sparkSession)
    items = items_of(benchmark, item_col, item_text).checkpoint()
    wins = windows(id_text(docs, id_col, text_col), items).withColumn("fp", fingerprint("shingles")).checkpoint()
    pairs = candidates(wins, items)
    counted = (pairs.join(wins, ["doc_id", "length", "start"])
               .select("doc_id", "item_id", "length", "start", F.size("shingles").alias("n"), F.explode("shingles").alias("h"))
               .groupBy("doc_id", "item_id", "length", "start", "n", "h").agg(F.count("*").alias("mine")))
    theirs = (items.select("item_id", F.size("shingles").alias("m"), F.explode("shingles").alias("h"))
              .groupBy("item_id", "m", "h").agg(F.count("*").alias("theirs")))
    both = (join_bounded(counted, theirs, ["item_id", "h"], "inner", MAX_BROADCAST)
            .groupBy("doc_id", "item_id", "length", "start", "n", "m").agg(F.sum(F.least("mine", "theirs")).alias("shared")))
    union = F.col("n") + F.col("m") - F.col("shared")
    return (both.where(100 * F.col("shared") >= threshold * union)
            .withColumn("similarity", F.col("shared") / union)
            .groupBy("doc_id", "item_id", "length")
            .agg(F.max(F.struct("similarity", (-F.col("start")).alias("least"))).alias("best"))
            .select("doc_id", "item_id", (-F.col("best.least")).cast("long").alias("start"),
                    F.col("length").cast("long").alias("length"), F.round("best.similarity", 6).alias("similarity")))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` without a benchmark passage, with all their columns."""
    hit = contaminated(docs, benchmark, id_col, text_col).select(F.col("doc_id").alias(id_col)).distinct()
    return docs.where(F.col(id_col).isNotNull()).join(hit.hint("shuffle_hash"), id_col, "left_anti").select(docs.columns)
