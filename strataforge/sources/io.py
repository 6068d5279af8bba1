"""Scans and sinks.

Reads always take an explicit schema (no inference in operators); keys
encoded in folder names come from ``_metadata.file_path``; sinks write
Parquet inside a job and CSV / JSON only at the edge. Scratch output goes
under the shared ``spark.checkpoint.dir`` (never a machine-local folder on a
cluster).
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strataforge.session import ensure_checkpoint_dir


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/strataforge-scratch/{name}-{uuid.uuid4().hex[:12]}"


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str, header: bool = True,
             columns: Sequence[str] | None = None, mode: str = "PERMISSIVE",
             corrupt_col: str | None = None) -> DataFrame:
    """CSV with a given schema; only ``columns`` are parsed
    (CSV column pruning); malformed rows are kept with nulls (and the raw
    line in ``corrupt_col`` when given)."""
    r = spark.read.schema(schema).option("header", header).option("mode", mode)
    if corrupt_col:
        r = r.option("columnNameOfCorruptRecord", corrupt_col)
    df = r.csv(path)
    return df.select(*columns) if columns else df


def read_text_table(spark: SparkSession, path: str, names: Sequence[str]) -> DataFrame:
    """S3: all-text CSV. Columns are found by the names in the header line
    (a UTF-8 BOM and outer blanks do not count), whatever their order; a name
    the header lacks is a null column; files whose headers differ from each
    other are refused, never misread. Blank cells become null (Q12)."""
    def clean(n: str) -> str:
        return n.replace("\ufeff", "").strip()

    raw = (spark.read.option("header", True).option("encoding", "UTF-8").option("inferSchema", False)
           .option("enforceSchema", False).csv(path))
    place = {clean(n): i for i, n in reversed(list(enumerate(raw.columns)))}
    by_place = raw.toDF(*[f"_c{i}" for i in range(len(raw.columns))])

    def cell(name: str):
        if name not in place:
            return F.lit(None).cast("string").alias(name)
        c = F.col(f"_c{place[name]}")
        return F.when(F.trim(c) != "", c).alias(name)

    return by_place.select(*[cell(clean(n)) for n in names])


def read_csv_tree(spark: SparkSession, paths: str, names: Sequence[str], patterns: dict[str, str]) -> DataFrame:
    """S1 + S2 + S4: CSV files of a tree, each with a header of its own, as
    text columns ``names`` (blank cells null) with the keys of ``patterns``
    (column -> regex with one group) from the file's path.

    Each file's cells are found by its own header, so files may order their
    columns differently, lack some (null) or have more (left out); outer blanks
    and a BOM in header names do not count, and of a name twice in a header the
    first counts. Only the file's first block holds its header; all blocks are
    read in parallel. The headers, one row per file, are joined on the path
    (broadcast while counted small). Lines are records (no line breaks inside
    cells)."""
    from strataforge.operators.joins import join_bounded

    lines = spark.read.text(paths).select(F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.file_block_start").alias("at"), "value")
    # the first line of a file's first block; one task reads that block in order
    heads = lines.where("at = 0").groupBy("file_path").agg(F.first("value").alias("header"))
    outside = r',(?=(?:[^"]*"[^"]*")*[^"]*$)'
    clean = lambda c: F.trim(F.regexp_replace(F.trim(F.regexp_replace(c, "\ufeff", "")), '^"|"$', ""))
    heads = heads.withColumn("__names", F.transform(F.split("header", outside), clean)).drop("header").checkpoint(eager=True)
    width = heads.agg(F.max(F.size("__names"))).first()[0] or 1
    cells = [f"__c{i}" for i in range(width)]
    raw = read_csv(spark, paths, ", ".join(f"{c} string" for c in cells), header=False)
    raw = with_path_keys(raw, patterns).select("file_path", *patterns, F.array(*cells).alias("__cells"))
    rows = join_bounded(raw, heads, "file_path", "inner")
    shown = F.slice(F.transform("__cells", lambda c: clean(F.coalesce(c, F.lit("")))), 1, F.size("__names"))
    rows = rows.where(shown != F.col("__names"))                 # header lines
    at = {n: F.array_position("__names", n).cast("int") for n in names}
    value = {n: F.when(p > 0, F.get("__cells", p - 1)) for n, p in at.items()}
    return rows.select(*[F.when(F.trim(v) != "", v).alias(n) for n, v in value.items()],
                       *[F.nullif(k, F.lit("")).alias(k) for k in patterns])


def with_path_keys(df: DataFrame, patterns: dict[str, str], path_col: str = "file_path") -> DataFrame:
    """Keys taken from the file path by regex (``eroll-(\\d+)`` ...)."""
    out = df.withColumn(path_col, F.col("_metadata.file_path"))
    for name, p in patterns.items():
        out = out.withColumn(name, F.regexp_extract(F.col(path_col), p, 1))
    return out


def read_whole_files(spark: SparkSession, glob: str) -> DataFrame:
    """One row per file with its whole text and path."""
    return spark.read.text(glob, wholetext=True).select(
        F.col("_metadata.file_path").alias("file_path"), F.col("value").alias("text"))


def file_inventory(spark: SparkSession, root: str, extension: str, recursive: bool = True) -> DataFrame:
    """File names and sizes (content never read: the ``binaryFile``
    source prunes it), extension matched case-insensitively, with the number
    inside the base name as sort key (O2, miss -> 0)."""
    df = (spark.read.format("binaryFile").option("recursiveFileLookup", recursive).load(root)
               .select("path", "length"))
    base = F.element_at(F.split("path", "/"), -1)
    df = df.where(F.lower(base).endswith("." + extension.lower()))
    num = F.coalesce(F.nullif(F.regexp_extract(base, r"(\d+)", 1), F.lit("")).try_cast("bigint"), F.lit(0).cast("bigint"))
    return df.select("path", base.alias("name"), "length", num.alias("number"))


MANIFEST_FILE = T.StructType([T.StructField("filename", T.StringType()), T.StructField("booth_no", T.IntegerType()),
                              T.StructField("source_path", T.StringType()), T.StructField("dest_path", T.StringType())])
MANIFEST_ENTRY = T.StructType([
    T.StructField("eroll_folder", T.StringType()), T.StructField("source_path", T.StringType()),
    T.StructField("dest_path", T.StringType()), T.StructField("total_booths", T.IntegerType()),
    T.StructField("selected_count", T.IntegerType()), T.StructField("booth_numbers", T.ArrayType(T.IntegerType())),
    T.StructField("files", T.ArrayType(MANIFEST_FILE))])
MANIFEST_LINE = T.StructType([T.StructField("erolls", T.MapType(T.StringType(), MANIFEST_ENTRY))])


def write_manifest(groups: DataFrame, path: str) -> None:
    """One JSON line per area, ``{"erolls": {area: entry}}``; the file
    list of an area is that area's chosen booths (bounded by the area)."""
    groups.select(F.create_map(F.col("eroll_folder"), F.struct(*[f.name for f in MANIFEST_ENTRY.fields]))
                  .alias("erolls")).write.mode("overwrite").json(path)


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """Manifest lines -> one row per file (map and list exploded)."""
    m = spark.read.schema(MANIFEST_LINE).json(path)
    e = m.select(F.explode("erolls").alias("key", "entry"))
    return e.select("key", "entry.eroll_folder", "entry.total_booths", "entry.selected_count",
                    F.explode_outer("entry.files").alias("file")).select(
        "key", "eroll_folder", "total_booths", "selected_count", "file.filename", "file.booth_no")


def write_partitioned(df: DataFrame, path: str, keys: Sequence[str], fmt: str = "csv") -> None:
    """One folder per key value (per booth, per chunk)."""
    w = df.write.mode("overwrite").partitionBy(*keys)
    (w.option("header", True).csv(path) if fmt == "csv" else w.format(fmt).save(path))


def timed_write(df: DataFrame, path: str, groups: Sequence[str] = ()) -> DataFrame:
    """write Parquet and return one row about the run: its stamp
    (``run_at``), ``rows`` written, distinct ``<group>_seen`` (approximate
    counts), ``elapsed`` seconds and ``rate`` in rows a second. Counts come from
    the write itself (``observe``), so nothing is read twice."""
    import datetime
    import time

    from pyspark.sql import Observation

    spark, seen = df.sparkSession, Observation()
    marked = df.observe(seen, F.count(F.lit(1)).alias("rows"), *[F.approx_count_distinct(g).alias(f"{g}_seen") for g in groups])
    stamp, began = datetime.datetime.now(datetime.timezone.utc), time.monotonic()
    marked.write.mode("overwrite").parquet(path)
    elapsed = time.monotonic() - began
    counts = seen.get
    row = (stamp, counts["rows"], *[counts[f"{g}_seen"] for g in groups], elapsed, counts["rows"] / elapsed)
    more = "".join(f", `{g}_seen` long" for g in groups)
    return spark.createDataFrame([row], f"run_at timestamp, rows long{more}, elapsed double, rate double")


def save_table(df: DataFrame, path: str) -> None:
    """Model artefacts (coefficients, covariance, variances) as
    Parquet tables."""
    df.write.mode("overwrite").parquet(path)


def load_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_json_tolerant(spark: SparkSession, path: str, schema: T.StructType,
                       corrupt_col: str = "_corrupt_record") -> DataFrame:
    """Malformed lines stay as rows with the raw text in
    ``corrupt_col`` (a later run can retry them); unreadable files are
    skipped."""
    full = T.StructType(list(schema.fields) + [T.StructField(corrupt_col, T.StringType())])
    return (spark.read.schema(full).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", corrupt_col)
                 .option("ignoreCorruptFiles", True).json(path))
