"""Phase 7 queries: resumable processing, streaming, scans and sinks (T1,
J15, S1-S13, S16, S17, A27). Each query writes to a fresh folder
under the shared checkpoint folder and returns what it reads back; the
oracle is the one-shot batch result of the same transformation."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import functions as F
from pyspark.sql import types as T

from strataforge.functions.hashing import uniform_sql
from strataforge.functions.text import max_number_in_text, regex_capture
from strataforge.operators import sampling
from strataforge.operators.joins import join_bounded
from strataforge.plans.catalogue import register, cte
from strataforge.plans.derived import roll, ROLL_SQL
from strataforge.sources import io
from strataforge.sources.tables import table
from strataforge.streaming import incremental

MANIFEST_SEED = 7
MANIFEST_PCT = 0.05
SINK_PARTS = 4


def _event_rows(df):
    """The per-item work: parse the ``{"k": n}`` properties."""
    return df.select("event_id", "user_id", "event_type",
                     F.get_json_object("props", "$.k").cast("int").alias("k"))


EVENT_ROWS_SQL = "SELECT event_id, user_id, event_type, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events"


@register("ledger_resume", EVENT_ROWS_SQL + " WHERE event_id % 3 <> 0")
def ledger_resume(spark, sf_dir):
    """J15 + S12 + S13: a previous run left a keyed ledger (every third
    event done, the next failed, the rest unseen); this run processes only
    failed and unseen events and appends output and ledger rows."""
    ev = table(spark, sf_dir, "events", "event_id", "user_id", "event_type", "props")
    ledger_path, out_path = io.scratch_dir(spark, "ledger"), io.scratch_dir(spark, "out")
    prev = ev.where(F.col("event_id") % 3 != 2).select(
        F.col("event_id").cast("string").alias("key"), F.current_timestamp().alias("done_at"),
        F.when(F.col("event_id") % 3 == 1, F.lit("timeout")).alias("error"))
    prev.write.mode("overwrite").parquet(ledger_path)
    return incremental.run_resumable(spark, ev, "event_id", _event_rows, out_path, ledger_path)


@register("stream_available_now", EVENT_ROWS_SQL)
def stream_available_now(spark, sf_dir):
    """The events file read as a stream (``availableNow`` trigger,
    checkpointed progress), transformed and appended; equals the one-shot
    batch."""
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    return incremental.stream_available_now(spark, sf_dir, "events.parquet", schema, _event_rows,
                                            io.scratch_dir(spark, "stream-out"), io.scratch_dir(spark, "stream-ckpt"))


ROLL_CSV_SCHEMA = T.StructType([T.StructField("voter_id", T.LongType()), T.StructField("gender", T.StringType()),
                                T.StructField("age", T.IntegerType()), T.StructField("eroll_no", T.IntegerType()),
                                T.StructField("booth_no", T.IntegerType())])


@register("partitioned_sink", cte(roll=ROLL_SQL) + "SELECT voter_id, gender, age, eroll_no, booth_no FROM roll")
def partitioned_sink(spark, sf_dir):
    """S9 + S10: CSV with header, one folder per (area, booth); S1 + S2
    read back with the given schema; keys come from the folder names."""
    path = io.scratch_dir(spark, "roll-csv")
    r = roll(spark, sf_dir).select("voter_id", "gender", "age", "eroll_no", "booth_no")
    # each folder is written by a few tasks, whatever the number of input partitions; a hot booth is split
    r = r.repartition("eroll_no", "booth_no", F.pmod(F.col("voter_id"), F.lit(SINK_PARTS)))
    (r.write.mode("overwrite").partitionBy("eroll_no", "booth_no").option("header", True)
      .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))
    return (spark.read.schema(ROLL_CSV_SCHEMA).option("header", True).option("ignoreLeadingWhiteSpace", False)
                 .option("ignoreTrailingWhiteSpace", False).csv(path))


@register("roll_rebuild", cte(roll=ROLL_SQL, b="""
SELECT eroll_no, booth_no, max(CAST(total_individuals AS BIGINT)) AS total FROM roll WHERE booth_no IS NOT NULL GROUP BY ALL""") + """
SELECT CAST(voter_id AS VARCHAR) AS voter_id, CASE WHEN trim(gender) = '' OR roll.booth_no % 3 = 2 THEN NULL ELSE gender END AS gender,
       CAST(age AS VARCHAR) AS age, CAST(roll.eroll_no AS VARCHAR) AS eroll_no, CAST(roll.booth_no AS VARCHAR) AS booth_no,
       CASE WHEN roll.booth_no % 4 = 3 THEN '' ELSE coalesce(CAST(b.total AS VARCHAR), '') END AS total_individuals,
       CASE WHEN roll.eroll_no % 5 = 4 THEN '' ELSE constituency_name END AS constituency_name
FROM roll JOIN b ON b.eroll_no = roll.eroll_no AND b.booth_no = roll.booth_no""")
def roll_rebuild(spark, sf_dir):
    """S1 + S2 + S4 + S5 + J1 + F11: the roll as a tree of per-booth CSV
    files whose headers differ, beside header texts; rebuilt into one table:
    cells by each file's own header, keys from the path, the head count from
    the booth's header text ('' without one), names from an area lookup (''
    when missing). The number of files grows with the booths."""
    base = io.scratch_dir(spark, "booths")
    r = roll(spark, sf_dir).where(F.col("booth_no").isNotNull())
    folder = [F.concat(F.lit("eroll-"), F.col("eroll_no").cast("string")).alias("area"), F.concat(F.lit("booth-"), F.col("booth_no").cast("string")).alias("booth")]
    layouts = [["voter_id", "gender", "age"], ["age", "note", "gender", "voter_id"], ["note", "age", "voter_id"]]
    x = r.select("*", *folder, F.lit("a, b").alias("note")).repartition("area", "booth", F.pmod(F.col("voter_id"), F.lit(SINK_PARTS)))
    for k, cols in enumerate(layouts):
        (x.where(F.col("booth_no") % 3 == k).select("area", "booth", *cols).write.mode("append").partitionBy("area", "booth")
          .option("header", True).option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(f"{base}/voters"))
    total = F.max("total_individuals").cast("bigint").cast("string")
    text = F.concat_ws("\n", F.lit("Electoral roll of 2025"), F.concat(F.lit("Total individuals: "), F.col("total")))
    (r.where("booth_no % 4 <> 3").groupBy("eroll_no", "booth_no").agg(total.alias("total")).select(*folder, text.alias("value"))
      .repartition("area", "booth").write.partitionBy("area", "booth").text(f"{base}/headers"))
    keys = {"eroll_no": r"area=eroll-(\d+)/", "booth_no": r"booth=booth-(\d+)/"}
    rows = io.read_csv_tree(spark, f"{base}/voters/*/*/*.csv", ["voter_id", "gender", "age"], keys)
    heads = io.read_whole_files(spark, f"{base}/headers/*/*/*.txt")
    heads = heads.select(*[F.regexp_extract("file_path", p, 1).alias(k) for k, p in keys.items()],
                         max_number_in_text("text").alias("total_individuals"))
    names = r.where("eroll_no % 5 <> 4").select(F.col("eroll_no").cast("string").alias("eroll_no"), "constituency_name").distinct()
    out = join_bounded(join_bounded(rows, heads, ["eroll_no", "booth_no"], "left"), names, "eroll_no", "left")
    return out.select("voter_id", "gender", "age", "eroll_no", "booth_no", *[F.coalesce(c, F.lit("")).alias(c) for c in ("total_individuals", "constituency_name")])


def _doc_tree(spark, sf_dir):
    d = table(spark, sf_dir, "documents", "doc_id", "text")
    area = F.when(F.col("doc_id") % 7 == 0, F.lit("misc-0")).otherwise(
        F.concat(F.lit("eroll-"), (F.col("doc_id") % 5).cast("string")))
    return d.select(area.alias("area_folder"), F.concat(F.lit("booth-"), (F.col("doc_id") % 3).cast("string"))
                    .alias("booth_folder"), "text")


TREE_SQL = """SELECT CASE WHEN doc_id % 7 = 0 THEN 'misc-0' ELSE 'eroll-' || (doc_id % 5) END AS area_folder,
                     'booth-' || (doc_id % 3) AS booth_folder, text FROM documents"""


@register("tree_scan", cte(t=TREE_SQL) + """
SELECT regexp_extract(area_folder, 'eroll-(\\d+)', 1) AS eroll_no, booth_folder,
       CAST(sum(length(text) + 1) AS BIGINT) AS total_chars
FROM t WHERE starts_with(area_folder, 'eroll-') GROUP BY ALL""")
def tree_scan(spark, sf_dir):
    """S4 + S5 + P15 + F4: texts written as a folder tree, read back one
    row per whole file; folders not named ``eroll-*`` skipped; area number
    and booth taken from the path."""
    path = io.scratch_dir(spark, "tree")
    t = _doc_tree(spark, sf_dir)
    t.repartition("area_folder", "booth_folder").write.mode("overwrite").partitionBy(
        "area_folder", "booth_folder").text(path)
    files = io.read_whole_files(spark, f"{path}/*/*/*.txt")
    keyed = files.select(F.regexp_extract("file_path", r"area_folder=([^/]+)/", 1).alias("area_folder"),
                         F.regexp_extract("file_path", r"booth_folder=([^/]+)/", 1).alias("booth_folder"),
                         F.length("text").alias("n"))
    keyed = keyed.where(F.col("area_folder").startswith("eroll-"))
    return keyed.groupBy(regex_capture("area_folder", r"eroll-(\d+)", 1, miss_null=False).alias("eroll_no"),
                         "booth_folder").agg(F.sum("n").cast("bigint").alias("total_chars"))


@register("file_inventory", cte(t=TREE_SQL) + """
SELECT area_folder, booth_folder, count(DISTINCT 1) AS n_files, CAST(sum(strlen(text) + 1) AS BIGINT) AS total_bytes
FROM t GROUP BY ALL""")
def file_inventory(spark, sf_dir):
    """S6 (+F40): file names and sizes by extension (case-insensitive),
    without reading file contents; one file per folder here."""
    path = io.scratch_dir(spark, "inventory")
    t = _doc_tree(spark, sf_dir)
    t.repartition("area_folder", "booth_folder").write.mode("overwrite").partitionBy(
        "area_folder", "booth_folder").text(path)
    inv = io.file_inventory(spark, path, "TXT")
    keyed = inv.select(F.regexp_extract("path", r"area_folder=([^/]+)/", 1).alias("area_folder"),
                       F.regexp_extract("path", r"booth_folder=([^/]+)/", 1).alias("booth_folder"), "length")
    return keyed.groupBy("area_folder", "booth_folder").agg(F.count(F.lit(1)).alias("n_files"),
                                                            F.sum("length").cast("bigint").alias("total_bytes"))


def _manifest_cte() -> str:
    u = uniform_sql(MANIFEST_SEED, "page_id")
    return f"""
WITH p AS (SELECT page_id, regexp_extract(url, '://([^/]+)/', 1) AS host,
                  TRY_CAST(regexp_extract(url, '/[a-z]+/(\\d+)', 1) AS INTEGER) AS booth_no,
                  string_split(regexp_extract(url, '^[a-z]+://[^/]+(/[^?#]*)', 1), '/')[-1] AS filename FROM pages),
r AS (SELECT *, row_number() OVER (PARTITION BY host ORDER BY {u}, page_id) AS rk, count(*) OVER (PARTITION BY host) AS n FROM p),
c AS (SELECT * FROM r WHERE rk <= least(greatest(ceil(n * {MANIFEST_PCT}), 1), n))
"""


def _manifest_sql() -> str:
    return _manifest_cte() + f"""SELECT host AS key, host AS eroll_folder, CAST(n AS INTEGER) AS total_booths,
       CAST(least(greatest(ceil(n * {MANIFEST_PCT}), 1), n) AS INTEGER) AS selected_count, filename, booth_no FROM c"""


@register("manifest_roundtrip", _manifest_sql())
def manifest_roundtrip(spark, sf_dir):
    """S8 manifest sink (per area: totals, chosen booths, file list) built
    from a G5 sample of each site's pages, then S7 read back and exploded
    to one row per file."""
    p = table(spark, sf_dir, "pages", "page_id", "url").select(
        "page_id", F.regexp_extract("url", r"://([^/]+)/", 1).alias("host"),
        F.regexp_extract("url", r"/[a-z]+/(\d+)", 1).try_cast("int").alias("booth_no"),
        F.element_at(F.split(F.regexp_extract("url", r"^[a-z]+://[^/]+(/[^?#]*)", 1), "/"), -1).alias("filename"))
    sizes = p.groupBy("host").agg(F.count(F.lit(1)).cast("int").alias("total_booths"))
    chosen = sampling.sample_per_group(p, "host", "page_id", MANIFEST_SEED, MANIFEST_PCT)
    g = chosen.groupBy("host").agg(
        F.count(F.lit(1)).cast("int").alias("selected_count"),
        F.array_sort(F.collect_list("booth_no")).alias("booth_numbers"),
        F.collect_list(F.struct("filename", "booth_no", F.lit(None).cast("string").alias("source_path"),
                                F.lit(None).cast("string").alias("dest_path"))).alias("files")).join(sizes, "host")
    entries = g.select(F.col("host").alias("eroll_folder"), F.lit(None).cast("string").alias("source_path"),
                       F.lit(None).cast("string").alias("dest_path"), "total_booths", "selected_count",
                       "booth_numbers", "files")
    path = io.scratch_dir(spark, "manifest")
    io.write_manifest(entries, path)
    return io.read_manifest(spark, path)


@register("run_totals", _manifest_cte() + """SELECT count(DISTINCT host) AS areas,
       CAST(sum(CASE WHEN rk = 1 THEN n END) AS BIGINT) AS files_seen, count(*) AS files_chosen,
       count(*) FILTER (WHERE booth_no IS NULL) AS missing_number FROM c""")
def run_totals(spark, sf_dir):
    """Run totals over groups: areas, files seen, files chosen,
    chosen files without a number."""
    m = manifest_roundtrip(spark, sf_dir)
    per = m.groupBy("key").agg(F.first("total_booths").alias("t"), F.count(F.lit(1)).alias("c"),
                               F.count_if(F.col("booth_no").isNull()).alias("miss"))
    return per.agg(F.count(F.lit(1)).alias("areas"), F.sum("t").cast("bigint").alias("files_seen"),
                   F.sum("c").cast("bigint").alias("files_chosen"), F.sum("miss").cast("bigint").alias("missing_number"))


@register("timed_run", """
SELECT count(*) AS rows, count(DISTINCT event_type) AS event_type_seen, true AS stamped, true AS timed, true AS rated FROM events""")
def timed_run(spark, sf_dir):
    """run stamp, elapsed time and rate of a write over all events,
    with its row count; the stamp is of today, the rate is rows over time."""
    began = F.lit(datetime.now(timezone.utc))
    run = io.timed_write(_event_rows(table(spark, sf_dir, "events", "event_id", "user_id", "event_type", "props")),
                         io.scratch_dir(spark, "timed"), ["event_type"])
    return run.select("rows", "event_type_seen", F.col("run_at").between(began, F.current_timestamp()).alias("stamped"),
                      (F.col("elapsed") > 0).alias("timed"), (F.abs(F.col("rate") * F.col("elapsed") - F.col("rows")) < 1e-6).alias("rated"))


@register("corrupt_tolerant_scan", """
SELECT CASE WHEN event_id % 9 = 0 THEN NULL ELSE event_id END AS event_id,
       CASE WHEN event_id % 9 = 0 THEN NULL ELSE CAST(json_extract_string(props, '$.k') AS INTEGER) END AS k,
       event_id % 9 = 0 AS corrupt FROM events""")
def corrupt_tolerant_scan(spark, sf_dir):
    """JSON lines with some malformed ones; bad lines are kept with
    the raw text (retryable), good ones parsed by the given schema."""
    ev = table(spark, sf_dir, "events", "event_id", "props")
    k = F.get_json_object("props", "$.k")
    line = F.when(F.col("event_id") % 9 == 0, F.concat(F.lit('{"event_id": '), F.col("event_id").cast("string"),
                                                       F.lit(', "k": '))) \
            .otherwise(F.concat(F.lit('{"event_id": '), F.col("event_id").cast("string"), F.lit(', "k": '), k, F.lit("}")))
    path = io.scratch_dir(spark, "jsonl")
    ev.select(line.alias("value")).write.mode("overwrite").text(path)
    schema = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("k", T.IntegerType())])
    r = io.read_json_tolerant(spark, path, schema)
    return r.select("event_id", "k", F.col("_corrupt_record").isNotNull().alias("corrupt"))


def _artifact_oracle() -> str:
    from strataforge.plans.q_model import glm_sql
    return glm_sql()


@register("model_artifact", _artifact_oracle())
def model_artifact(spark, sf_dir):
    """A fitted coefficient table saved as Parquet and loaded back."""
    from strataforge.plans.q_model import glm_fit
    path = io.scratch_dir(spark, "model")
    io.save_table(glm_fit(spark, sf_dir), path)
    return io.load_table(spark, path)


@register("text_table_scan", cte(roll=ROLL_SQL) + """
SELECT CAST(voter_id AS VARCHAR) AS voter_id, CASE WHEN trim(gender) = '' THEN NULL ELSE gender END AS gender,
       CAST(age AS VARCHAR) AS age FROM roll""")
def text_table_scan(spark, sf_dir):
    """S3 (+P1): an all-text CSV whose header has a UTF-8 BOM and padded
    names, read back with cleaned names, every column a string, blank cells
    null."""
    path = io.scratch_dir(spark, "text-csv")
    r = roll(spark, sf_dir).select(F.col("voter_id").cast("string").alias("﻿voter_id "),
                                   F.col("gender").alias(" gender"), F.col("age").cast("string").alias("age"))
    (r.write.mode("overwrite").option("header", True).option("ignoreLeadingWhiteSpace", False)
      .option("ignoreTrailingWhiteSpace", False).csv(path))
    names = ["﻿voter_id ", " gender", "age"]
    return io.read_text_table(spark, path, names)


def _sharded_sql() -> str:
    from strataforge.plans.q_sampling import _DEDUPE_SQL, KEY_SQL
    return _DEDUPE_SQL + f""", ch AS (SELECT {KEY_SQL} AS stratum_key, dup_count,
        CAST(ntile(4) OVER (ORDER BY {KEY_SQL}) + 8 AS INTEGER) AS chunk FROM dd)
SELECT chunk, count(*) AS n_rows, CAST(sum(dup_count) AS BIGINT) AS n_people FROM ch GROUP BY chunk"""


@register("sharded_sink", _sharded_sql())
def sharded_sink(spark, sf_dir):
    """Deduplicated sample cut into 4 near-equal shards numbered from
    9, written one folder per shard (CSV with header), read back per shard."""
    from strataforge.plans.q_sampling import chunks
    c = chunks(spark, sf_dir)
    path = io.scratch_dir(spark, "shards")
    io.write_partitioned(c, path, ["chunk"])
    back = (spark.read.schema("stratum_key string, dup_count int, chunk int").option("header", True).csv(path))
    return back.groupBy("chunk").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("dup_count").cast("bigint").alias("n_people"))


def _records_oracle() -> str:
    from strataforge.plans.q_text import _records_sql
    return _records_sql()


@register("stream_record_blocks", _records_oracle())
def stream_record_blocks(spark, sf_dir):
    """T1 as in the reference: roll page texts land as files; a stream
    (``availableNow``, checkpointed progress)
    parses each page once into voter rows (F33) and appends them; the result
    equals the one-shot batch parse."""
    from strataforge.operators import textparse
    from strataforge.plans.q_text import roll_pages

    src = io.scratch_dir(spark, "pages-in")
    roll_pages(spark, sf_dir).repartition(8).write.mode("overwrite").parquet(src)
    schema = spark.read.parquet(src).schema
    stream = spark.readStream.schema(schema).parquet(src)
    out, ck = io.scratch_dir(spark, "voters-out"), io.scratch_dir(spark, "voters-ckpt")
    q = (textparse.parse_voters(stream, "text", ["c_custkey"]).writeStream.format("parquet")
         .option("path", out).option("checkpointLocation", ck).outputMode("append")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.parquet(out)
