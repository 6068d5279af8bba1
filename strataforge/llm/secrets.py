"""Secret scans over an incremental blob ledger.

Every document version is addressed by the SHA-256 of its text. The ledger
(Parquet, in a shared folder) lists which (blob, rule version) pairs were
scanned; a run reads the text of unseen pairs only, once per blob, appends
the findings, then the ledger rows, and joins the findings back to every
path that holds the blob. A run that dies between the two appends scans the
same blobs again; findings are read distinct, so nothing doubles.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataforge.llm.common import id_text
from strataforge.llm.spans import joined, label, plain, with_spans
from strataforge.session import ensure_checkpoint_dir

VALUE = "[A-Za-z0-9+/_.=-]"
#: Rule name -> (version, pattern, condition on a span ``s``).
#: The first three are the base rules; possessive groups keep the matcher's stack flat.
RULES: dict[str, tuple[int, str, str]] = {
    "assign": (1, rf"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?{VALUE}+",
               rf"length(regexp_extract(s.match, '^[A-Za-z_]+[\"\']?\\x20*[:=]\\x20*[\"\']?({VALUE}+)$', 1)) >= 8"),
    "access": (1, r"AKIA[A-Z0-9]++", "length(s.match) >= 16"),
    "hex": (1, r"(?<![0-9a-f])[0-9a-f]{32,}+", "true"),
    "github": (1, r"(?<![A-Za-z0-9_])gh[pousr]_[A-Za-z0-9]{36,}+", "true"),
    "slack": (1, r"(?<![A-Za-z0-9])xox[abprs]-[A-Za-z0-9-]{10,}+", "true"),
    "jwt": (1, r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]{8,}+\.eyJ[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}+", "true"),
    "pem": (1, r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----", "true"),
}
BASE = ("assign", "access", "hex")
LEDGER = "blob string, rule string"
FINDINGS = "blob string, rule string, start int, end int"


def _read(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The Parquet folder, or no rows when it is not there yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def rule_key(name: str, version: int) -> str:
    return f"{name}@{version}"


def scan(docs: DataFrame, ledger_dir: str, rules: Mapping[str, tuple[int, str, str]] = RULES,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, blob, findings array<struct<start, rank, kind, end>>), one row per row of ``docs``.

    Null and empty texts are the empty blob. Repeated rows and copies share a
    blob, which is scanned once; of the paths of a blob the smallest id
    provides the text. A rule whose version is new is scanned again for every
    blob; older versions' findings stay in the ledger but are not returned.
    """
    spark = docs.sparkSession
    ensure_checkpoint_dir(spark)
    keys = {rule_key(n, r[0]): n for n, r in rules.items()}
    text = id_text(docs, id_col, text_col).withColumn("blob", F.sha2(F.col("text").cast("binary"), 256))
    paths = text.select("doc_id", "blob").checkpoint()
    seen = (_read(spark, f"{ledger_dir}/ledger", LEDGER).where(F.col("rule").isin(*keys))
            .groupBy("blob").agg(F.collect_set("rule").alias("seen")))
    todo = (paths.groupBy("blob").agg(F.min("doc_id").alias("doc_id")).join(seen, "blob", "left")
            .withColumn("todo", F.array_except(F.array(*[F.lit(k) for k in keys]),
                                               F.coalesce("seen", F.expr("CAST(array() AS array<string>)"))))
            .where("size(todo) > 0").select("doc_id", "blob", "todo").checkpoint())
    # by id and blob: an id may have several versions in the table
    work = (text.join(todo.hint("shuffle_hash"), ["doc_id", "blob"])
            .withColumn("text", plain(F.col("text"))))
    found = with_spans(work, "text", {n: r[1] for n, r in rules.items()})
    each = [F.expr(f"CASE WHEN array_contains(todo, '{rule_key(n, r[0])}') THEN "
                   f"transform(filter({n}, s -> {r[2]}), s -> named_struct('rule', '{rule_key(n, r[0])}', "
                   f"'start', s.start, 'end', s.end)) ELSE CAST(array() AS array<struct<rule:string,start:int,end:int>>) END")
            for n, r in rules.items()]
    rows = (found.select("blob", F.concat(*each).alias("f")).where("size(f) > 0")
            .select("blob", F.explode("f").alias("f")).select("blob", "f.rule", "f.start", "f.end"))
    rows.write.mode("append").parquet(f"{ledger_dir}/findings")
    todo.select("blob", F.explode("todo").alias("rule")).write.mode("append").parquet(f"{ledger_dir}/ledger")
    rank = F.expr("CASE rule " + " ".join(f"WHEN '{k}' THEN {i}" for i, k in enumerate(keys)) + " END")
    kind = F.expr("CASE rule " + " ".join(f"WHEN '{k}' THEN '{n}'" for k, n in keys.items()) + " END")
    by_blob = (_read(spark, f"{ledger_dir}/findings", FINDINGS).where(F.col("rule").isin(*keys))
               .groupBy("blob").agg(F.collect_set(F.struct("start", rank.alias("rank"), kind.alias("kind"), "end"))
                                    .alias("findings")))
    return (paths.join(by_blob, "blob", "left")
            .withColumn("findings", F.coalesce("findings", F.expr(
                "CAST(array() AS array<struct<start:int,rank:int,kind:string,end:int>>)")))
            .select("doc_id", "blob", "findings"))


def fresh_ledger(spark: SparkSession) -> str:
    """A new ledger folder in the shared folder of the session."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/secret-ledger-{uuid.uuid4().hex}"


def digest(found: DataFrame) -> DataFrame:
    """Counts and span strings per document from ``scan``'s rows."""
    base = "filter(findings, s -> s.rank < %d)" % len(BASE)
    return found.select(
        "doc_id",
        *[F.expr(f"CAST(size(filter(findings, s -> s.kind = '{k}')) AS bigint)").alias(f"n_{k}") for k in BASE],
        F.expr(f"sha2(CAST({joined(base)} AS binary), 256)").alias("base_sha256"),
        F.expr(joined("findings")).alias("spans"), "blob")
