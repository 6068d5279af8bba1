"""Connected components of a link table, as joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataforge.llm.common import packed
from strataforge.session import ensure_checkpoint_dir


def components(links: DataFrame, max_rounds: int = 100, rows: int | None = None) -> DataFrame:
    """(id, component) for every id in ``links`` (a, b): the smallest reachable id.

    Alternates the large-star and small-star steps of the map-reduce
    formulation: every node hangs its neighbours under the smallest one. Only
    minima per node are aggregated (map-side combine), so a hub is never
    gathered. Each round is checkpointed; it ends when a round changes nothing.
    The partitions of a round are sized by the links there are, those of the
    first by ``rows``, a bound of the rows of ``links``, if it is given.
    """
    ensure_checkpoint_dir(links.sparkSession)
    edges = (links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
             .distinct())
    edges = (edges if rows is None else packed(edges, rows)).checkpoint()

    def state(e: DataFrame):
        return e.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()

    before = state(edges)
    for _ in range(max_rounds):
        n = before["n"]
        edges = packed(edges, n)
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = packed(both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m")), n)
        # large star: larger neighbours hang under the smallest of u's neighbourhood
        large = packed(packed(both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")), n).distinct(), n)
        # small star: u and its smaller neighbours hang under the smallest
        small_low = packed(large.groupBy("u").agg(F.min("v").alias("m")), n)
        small = packed(large.join(small_low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                       .unionByName(small_low.select("u", F.col("m").alias("v"))), n)
        small = packed(small.distinct(), n).checkpoint()
        edges, after = small, state(small)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError("components did not settle")
    top = packed(edges.groupBy("u").agg(F.min("v").alias("component")).select(F.col("u").alias("id"), "component"), n)
    roots = edges.select(F.col("v").alias("id")).distinct().join(top.select("id"), "id", "left_anti")
    return packed(top.unionByName(roots.select("id", F.col("id").alias("component"))), n)
