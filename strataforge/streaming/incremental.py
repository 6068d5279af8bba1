"""Resumable processing.

The reference keeps a JSON list of done keys (rewritten per item) or a row
count. Here progress is keyed:

* batch twin: ``pending`` = source ``left_anti`` the ledger's successful
  keys; results and new ledger rows are appended (Parquet), so a rerun
  after a crash redoes only what was not recorded as done; failed items
  stay retryable.
* streaming: a file source read with ``trigger(availableNow=True)`` and a
  ``checkpointLocation``; Structured Streaming records processed files and
  committed batches, so each file is processed once across restarts.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataforge.session import ensure_checkpoint_dir

LEDGER_SCHEMA = "key string, done_at timestamp, error string, run string"


def pending(source: DataFrame, key: str, ledger: DataFrame) -> DataFrame:
    """Rows whose key has no successful ledger entry (failed
    entries are retried, unseen keys are new)."""
    ok = ledger.where(F.col("error").isNull()).select(F.col("key").alias("__k")).distinct()
    return source.join(ok, source[key].cast("string") == ok["__k"], "left_anti")


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """The ledger, or no rows on the first run; any other read error is raised."""
    try:
        return spark.read.schema(LEDGER_SCHEMA).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LEDGER_SCHEMA)


def run_resumable(spark: SparkSession, source: DataFrame, key: str, fn: Callable[[DataFrame], DataFrame],
                  out_path: str, ledger_path: str, error_col: str | None = None) -> DataFrame:
    """T1 batch twin / S12: process pending rows with ``fn`` into a folder of
    this run, then append one ledger row per pending key (with or without
    output rows; error text kept when ``error_col`` says so). Returns the
    output of every key's latest recorded run, so rows of a run that died
    before its ledger step and rows of a failed key that was retried never
    appear twice."""
    ensure_checkpoint_dir(spark)
    run = uuid.uuid4().hex
    ledger = read_ledger(spark, ledger_path)
    todo = pending(source, key, ledger).checkpoint()
    fn(todo).write.mode("overwrite").parquet(f"{out_path}/run={run}")
    keys = todo.select(F.col(key).cast("string").alias("key")).distinct()
    if error_col:
        bad = (spark.read.parquet(f"{out_path}/run={run}").where(F.col(error_col).isNotNull())
               .groupBy(F.col(key).cast("string").alias("key")).agg(F.max(error_col).cast("string").alias("error")))
        keys = keys.join(bad, "key", "left")
    else:
        keys = keys.withColumn("error", F.lit(None).cast("string"))
    (keys.select("key", F.current_timestamp().alias("done_at"), "error", F.lit(run).alias("run"))
     .write.mode("append").parquet(ledger_path))
    latest = read_ledger(spark, ledger_path).groupBy("key").agg(F.max_by("run", "done_at").alias("run"))
    out = spark.read.parquet(out_path).withColumn("run", F.col("run").cast("string"))
    last = latest.select(F.col("key").alias("__key"), F.col("run").alias("__run"))
    return out.join(last, (F.col(key).cast("string") == F.col("__key")) & (F.col("run") == F.col("__run")), "left_semi").drop("run")


def stream_available_now(spark: SparkSession, source_dir: str, file_glob: str, schema,
                         fn: Callable[[DataFrame], DataFrame], out_path: str, checkpoint: str,
                         fmt: str = "parquet", max_files: int | None = None) -> DataFrame:
    """Every file present now is processed once (``availableNow``),
    appended to ``out_path``; progress lives in ``checkpoint``. The table may
    be one file or a folder of part files; ``max_files`` bounds the files of
    a micro-batch (no bound by default). Returns the sink read back as a
    batch DataFrame."""
    # a glob even for a plain name, so that a file and a folder of files are both listed
    name = file_glob if any(c in file_glob for c in "*?[{") else f"{file_glob[:-1]}[{file_glob[-1]}]"
    reader = spark.readStream.schema(schema).format(fmt)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    stream = reader.load(f"{source_dir.rstrip('/')}/{name}")
    q = (fn(stream).writeStream.format("parquet").option("path", out_path)
                   .option("checkpointLocation", checkpoint).outputMode("append")
                   .trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.parquet(out_path)
