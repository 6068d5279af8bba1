"""Golden rows for inputs that used to be misread or dropped."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from strataforge.operators import match, model, sampling
from strataforge.operators import textparse as TP
from strataforge.sources import io
from strataforge.streaming import incremental


def test_null_groups_are_sampled_and_split(spark):
    df = spark.createDataFrame([(i, None if i % 2 else "a") for i in range(200)], "id long, g string")
    got = sampling.sample_per_group(df, "g", "id", 1, 0.1, target_rows=16).collect()
    assert sorted(r.g is None for r in got) == [False] * 10 + [True] * 10
    split = sampling.stratified_split(df, "g", "id", 1, 0.8, target_rows=16).groupBy("g", "split").count().collect()
    assert {(r.g, r.split): r["count"] for r in split} == {(g, s): n for g in ("a", None) for s, n in (("train", 80), ("validation", 20))}


def test_text_table_is_read_by_header_name(spark):
    path = io.scratch_dir(spark, "named")
    spark.createDataFrame([("41", "Ann"), ("7", " ")], "`﻿age ` string, ` name` string").coalesce(1).write.option("header", True).option(
        "ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    rows = io.read_text_table(spark, path, ["name", "age", "missing"]).collect()
    assert [tuple(r) for r in rows] == [("Ann", "41", None), (None, "7", None)]


def test_ledger_records_every_key_and_retries_replace_output(spark):
    src = spark.createDataFrame([(i, i % 3 == 0) for i in range(10)], "id long, bad boolean")
    out, led = io.scratch_dir(spark, "o"), io.scratch_dir(spark, "l")
    half = lambda d: d.where("id % 2 = 0").select("id", F.when(F.col("bad"), "timeout").alias("error"))
    assert incremental.run_resumable(spark, src, "id", half, out, led, "error").count() == 5
    ledger = incremental.read_ledger(spark, led)
    assert ledger.count() == 10 and ledger.where("error IS NOT NULL").count() == 2
    fixed = lambda d: d.select("id", F.lit(None).cast("string").alias("error"))
    again = incremental.run_resumable(spark, src, "id", fixed, out, led, "error").collect()
    assert sorted(r.id for r in again) == [0, 2, 4, 6, 8] and all(r.error is None for r in again)
    assert incremental.pending(src, "id", incremental.read_ledger(spark, led)).count() == 0


def test_stream_reads_a_folder_shaped_table(spark):
    root = io.scratch_dir(spark, "tables")
    spark.range(100).repartition(4).write.parquet(f"{root}/events.parquet")
    schema = spark.read.parquet(f"{root}/events.parquet").schema
    got = incremental.stream_available_now(spark, root, "events.parquet", schema, lambda d: d, io.scratch_dir(spark, "so"),
                                           io.scratch_dir(spark, "sc"), max_files=3)
    assert got.count() == 100


def test_answers_with_repeated_keys_and_nested_types(spark):
    rows = [('{"a": 1, "a": 2, "m": {"x": 3}, "d": 1.25}',), ('{"a": 1} tail}',), ("{'a': 1}",), ('{"a": 1',), ("none",)]
    schema = "a int, m map<string,int>, d decimal(10,2)"
    got = [r.p for r in spark.createDataFrame(rows, "r string").select(TP.parse_answer(F.col("r"), schema).alias("p")).collect()]
    assert (got[0].a, got[0].m, float(got[0].d), got[0].error) == (2, {"x": 3}, 1.25, None)
    assert [g.error for g in got[1:]] == ["parse_failed", "parse_failed", "no_json", "no_json"]


PAGE = """<TABLE class=nav><TR><TD>x<TD>y</TABLE><table class="table big"><tr><th>h</th></tr>
<TR><TD>1<TD>Ann &amp; Bob<TD> P&quot;Q <TD>3<TD>4<TD>5<TD>6
<tr><td>2</td><td><b>C</b></td><td>D</td><td>3</td><td>4</td><td>5&nbsp;</td><td>6</td></tr></table>
<table class="table"><tr><td>9</td><td>Z</td><td>Z</td><td>3</td><td>4</td><td>5</td><td>6</td></tr></table>"""


def test_html_variants(spark):
    df = spark.createDataFrame([(PAGE,)], "h string")
    names = lambda **k: [tuple(r) for r in df.select(F.explode(TP.html_table_rows("h", **k)).alias("r")).select("r.*").collect()]
    first = [("Ann & Bob", 'P"Q', "5", "6"), ("C", "D", "5", "6")]
    assert names() == [*first, ("Z", "Z", "5", "6")]
    assert names(table_class="table") == first
    opts = spark.createDataFrame([("<OPTION VALUE='S1'>A &amp; B<option value=S2>C</option><option selected value=\"\">-</option>"
                                   "<option value=\"S3\" selected>D</OPTION>",)], "h string")
    got = opts.select(F.explode(TP.option_list("h")).alias("o")).select("o.*").collect()
    assert [tuple(r) for r in got] == [("S1", "A & B"), ("S2", "C"), ("S3", "D")]


def test_fallback_raises_what_is_not_numerical(spark):
    cells = spark.createDataFrame([("a", 0.1, 5.0, 2.0)], "area string, x double, n double, s double")
    with pytest.raises(Exception, match="nope"):
        model.fit_with_fallback(spark, cells, ["nope"], "area", "x")


def test_bit_parallel_lcs(spark):
    rng = random.Random(8)
    word = lambda n: "".join(rng.choice("abcé ") for _ in range(n))
    rows = [(word(rng.randint(0, 14)), word(rng.randint(0, 14))) for _ in range(200)] + [(word(61), word(70)), (word(80), word(75)), ("", "")]

    def lcs(a, b):
        m = np.zeros((len(a) + 1, len(b) + 1), int)
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                m[i + 1, j + 1] = m[i, j] + 1 if x == y else max(m[i, j + 1], m[i + 1, j])
        return m[-1, -1]

    got = spark.createDataFrame(rows, "a string, b string").select("a", "b", match.lcs_length("a", "b").alias("n")).collect()
    assert all(r.n == lcs(r.a, r.b) for r in got)


def test_best_match_against_all_pairs(spark):
    rng = random.Random(5)
    names = ["".join(rng.choice("abcdeo") for _ in range(rng.randint(3, 12))) for _ in range(60)]
    other = [n if i % 4 == 0 else n[:-1] + "x" if i % 4 == 1 else n[1:] + n[0] for i, n in enumerate(names)] + ["zzz", "zz z"]
    left, right = (spark.createDataFrame([(n,) for n in x], "n string") for x in (names, other))
    got = {r.left_name: (r.right_name, round(r.score, 6)) for r in match.best_match(left, right, "n", "n", normalise=False).collect()}
    pairs = left.distinct().selectExpr("n AS l").join(right.distinct().selectExpr("n AS r"), F.lit(True)).select(
        "l", "r", match.token_sort_ratio("l", "r").alias("s")).where("s >= 80").collect()
    want = {}
    for p in sorted(pairs, key=lambda p: (-p.s, p.r)):
        want.setdefault(p.l, (p.r, round(p.s, 6)))
    assert got == want
