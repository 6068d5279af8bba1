"""Spark session helpers.

Cluster sessions come configured; these helpers only fill in what is unset
(local tests and the bench), never override a value the cluster gives.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

_LOCAL_DEFAULTS = {
    "spark.sql.shuffle.partitions": "8",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.driver.memory": "16g",
}


def get_session(master: str | None = None, app: str = "strataforge", **conf: str) -> SparkSession:
    """Return the active session, or build a local one with sane defaults."""
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = SparkSession.builder.master(master or f"local[{cpus}]").appName(app)
    for k, v in {**_LOCAL_DEFAULTS, **conf}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the shared folder named by ``spark.checkpoint.dir``.

    Only when a local[...] session names none (tests) a scratch folder is made;
    on a cluster that would be a folder each executor sees alone, so it raises.
    Reliable checkpoints survive executor loss; local checkpoints do not and
    are never used here.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getCheckpointDir()
    if not d:
        if spark.sparkContext.master != "local" and not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="strataforge-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(d)
    return d
