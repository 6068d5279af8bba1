"""Training corpus from ``documents``: language ID, exact dedup, near dedup,
decontamination, mixing.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run``
writes each result as Parquet into the session's shared folder and reads it
back as the next stage's input, so a lost executor costs at most one stage's
tasks and no stage is computed twice.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataforge.llm import decontam, exact_dedup, langid, minhash, mixing
from strataforge.llm.common import read
from strataforge.session import ensure_checkpoint_dir


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts of a known language; the models learn from the rows that are not held out."""
    return langid.keep_identified(docs, langid.fit(langid.training_rows(docs)))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest id."""
    return exact_dedup.drop_exact(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the smallest id."""
    return minhash.drop_near(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage."""
    return decontam.drop_contaminated(docs, read(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents the mix takes, with mix_size, mix_target and mix_taken
    (words, repeats counted). Rows that repeat an id (with other texts; equal
    rows are gone) all stay if the mix takes any, with the figures of the one
    it takes most of."""
    quality = read(spark, sf_dir, "labels").select("doc_id", (F.col("quality") + 1.0).alias("weight"))
    m = (mixing.mix(docs, quality).where("taken > 0").groupBy("doc_id").agg(F.max(F.struct("taken", "size", "target")).alias("m"))
         .select("doc_id", F.col("m.size").alias("mix_size"), F.col("m.target").alias("mix_target"), F.col("m.taken").alias("mix_taken")))
    rest = [c for c in docs.columns if c not in m.columns]
    return docs.select("doc_id", *rest).join(m.hint("shuffle_hash"), "doc_id")


STAGES = [("language_id", language_id), ("exact_dedup", exact), ("near_dedup", near),
          ("decontamination", decontaminate), ("mixing", mix)]

#: Language ID has no SQL form; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    docs = read(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            path = f"{folder}/{k}-{name}"
            docs.write.parquet(path)
            docs = spark.read.parquet(path)
    return docs
