"""Exact duplicates with a heavy-hitter split.

A mergeable frequent-items sketch (Misra-Gries counters, Spark's
``approx_top_k``) names the digests that may be frequent. Their winners are
then counted exactly and broadcast (at most ``max_heavy`` rows), so the rows
of a hot group are settled on the map side and never meet in one task. All
other digests go through an ordinary aggregate and join; such a group holds
at most about one ``max_heavy``-th of the rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataforge.llm.common import id_text, lower_az
from strataforge.session import ensure_checkpoint_dir

#: Broadcast bound: at most so many winners (about 100 bytes each).
MAX_HEAVY = 1024
#: Counters of the sketch: a digest above 1 / TRACKED of the rows is always seen.
TRACKED = 16_384


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text_sha256): SHA-256 of the text after lower-casing A-Z."""
    t = id_text(docs, id_col, text_col)
    return t.select("doc_id", F.sha2(lower_az(F.col("text")).cast("binary"), 256).alias("text_sha256"))


def heavy_winners(keyed: DataFrame, max_heavy: int = MAX_HEAVY, tracked: int = TRACKED) -> DataFrame:
    """(text_sha256, keep_id, group_size) of digests the sketch found frequent,
    verified by exact counts; at most ``max_heavy`` rows."""
    seen = keyed.agg(F.expr(f"approx_top_k(text_sha256, {max_heavy}, {tracked})").alias("top"))
    cand = (seen.select(F.explode("top").alias("t")).where("t.count > 1")
            .select(F.col("t.item").alias("text_sha256")).limit(max_heavy))
    return (keyed.join(F.broadcast(cand), "text_sha256", "left_semi")
            .groupBy("text_sha256").agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size")))


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 max_heavy: int = MAX_HEAVY, tracked: int = TRACKED) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when their SHA-256 after lower-casing A-Z is. Of equal
    texts the row with the largest id stays. Null and empty texts are one
    group. Rows that repeat an id count as rows and share its verdict.
    """
    ensure_checkpoint_dir(docs.sparkSession)
    keyed = digests(docs, id_col, text_col).checkpoint()
    winners = heavy_winners(keyed, max_heavy, tracked).checkpoint()
    heavy = keyed.join(F.broadcast(winners), "text_sha256")
    rest = keyed.join(F.broadcast(winners.select("text_sha256")), "text_sha256", "left_anti")
    groups = rest.groupBy("text_sha256").agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
    out = heavy.unionByName(rest.join(groups, "text_sha256"))
    return out.select("doc_id", "keep_id", "group_size", (F.col("doc_id") == F.col("keep_id")).alias("kept"),
                      "text_sha256")


def drop_exact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns. Rows are told
    apart by id and text, so an id that is repeated with another text is judged
    on its own; of rows that repeat both id and text (up to A-Z case) one stays."""
    mark = "__digest"
    gone = (exact_groups(docs, id_col, text_col).where("NOT kept")
            .select(F.col("doc_id").alias(id_col), F.col("text_sha256").alias(mark)).distinct())
    text = lower_az(F.coalesce(F.col(text_col), F.lit("")))
    return (docs.where(F.col(id_col).isNotNull()).withColumn(mark, F.sha2(text.cast("binary"), 256))
            .join(gone.hint("shuffle_hash"), [id_col, mark], "left_anti")
            .dropDuplicates([id_col, mark]).select(docs.columns))      # dealt by these columns already
