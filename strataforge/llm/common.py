"""Column helpers shared by the text operators.

Conventions of this subpackage, unless an operator says otherwise: the id
column is an integer; rows without an id cannot be named in a result and are
left out; a null text counts as empty; extra input columns are ignored, so
their names cannot clash; an empty table gives an empty result with the same
schema.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: A word: a run of anything but space and the controls 09-0D.
WORD = r"[^\x20\x09-\x0D]+"


def lower_az(text: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(text, UPPER, UPPER.lower())


def lower_az_sql(text: str) -> str:
    return f"translate({text}, '{UPPER}', '{UPPER.lower()}')"


def n_words(text: Column) -> Column:
    """Number of words of a text; null counts as empty."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def id_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id long, text string without nulls), rows without an id left out."""
    return (docs.select(F.col(id_col).cast("long").alias("doc_id"),
                        F.coalesce(F.col(text_col), F.lit("")).alias("text"))
            .where(F.col("doc_id").isNotNull()))


def partitions(spark: SparkSession) -> int:
    """The session's shuffle partition count, which a cluster sizes to its input."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


#: Rows of ids and numbers that are worth a task.
TASK_ROWS = 50_000


def packed(df: DataFrame, rows: int) -> DataFrame:
    """``df``, a table of about ``rows`` rows of ids and numbers, in as many
    partitions as that needs (two at least, never more than it has). Every
    task of a shuffle writes files of its own, so a small table in many
    partitions costs more disk than its rows, again with every join."""
    return df.coalesce(max(2, -(-rows // TASK_ROWS)))
