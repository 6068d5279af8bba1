"""Golden tests on small hand-written fixtures (FIXTURES.md §B): parsers,
bins, ties, nulls, scores. All rows are invented."""

import math

import pytest
from pyspark.sql import functions as F

from strataforge.functions import bins, numeric as N, text as T
from strataforge.operators import classify, clean, frame, match, poststrat, results, textparse as TP


def test_age_bands_right_closed(spark):
    df = spark.createDataFrame([(a,) for a in (17, 18, 19, 25, 26, 60, 61, None)], "age int")
    got = [r[0] for r in df.select(bins.right_closed_bins(F.col("age"))).collect()]
    assert got == [None, None, "18-25", "18-25", "26-35", "46-60", "60+", None]
    incl = [r[0] for r in df.select(bins.right_closed_bins(F.col("age"), include_lowest=True)).collect()]
    assert incl[1] == "18-25"


def test_group_mode_ties_and_fallback(spark):
    df = spark.createDataFrame([(1, 1, "Urb"), (1, 1, "Rur"), (1, 1, None), (1, 2, None), (None, 3, None)],
                               "e int, b int, area_type string")
    out = frame.fill_from_group_mode(df, ["e", "b"], "area_type", fallback="Rur?")
    got = sorted((r.e, r.b, r.area_type) for r in out.collect() if r.e is not None)
    assert got == [(1, 1, "Rur"), (1, 1, "Rur"), (1, 1, "Urb"), (1, 2, "Rur?")]


def test_first_non_null_per_booth(spark):
    df = spark.createDataFrame([(1, 1, 1, None), (1, 1, 2, 300.0), (1, 1, 3, 400.0), (1, None, 4, 9.0)],
                               "e int, b int, id int, t double")
    out = frame.first_non_null(df, ["e", "b"], "t", "id").collect()
    assert [(r.e, r.b, r.t) for r in out] == [(1, 1, 300.0)]


def test_gender_recode(spark):
    vals = ["maie", "fermain", "Mais", "x", None, " Male ", "FEMALE", "m"]
    df = spark.createDataFrame([(v,) for v in vals], "g string")
    got = [r[0] for r in df.select(clean.recode_gender("g")).collect()]
    assert got == ["Male", "Female", "Mais", "x", None, "Male", "Female", "Male"]


def test_percent_repair_and_normalise(spark):
    df = spark.createDataFrame([(0.7, 0.5, 0.5, 1), (70.0, 60.0, 40.0, 1), (None, 0.0, 0.0, 1), (1.0, 0.2, None, 0)],
                               "pw double, a double, b double, v int")
    out = df.select(N.percent_repair("pw").alias("pw"),
                    *[e.alias(k) for k, e in N.row_normalise_scoped(["a", "b"], F.col("v") == 1).items()]).collect()
    assert [r.pw for r in out] == [0.7, 0.7, None, 1.0]
    assert (out[0].a, out[0].b) == (0.5, 0.5)
    assert (out[1].a, out[1].b) == (0.6, 0.4)
    assert (out[2].a, out[2].b) == (0.0, 0.0)       # in scope, zero sum: unchanged
    assert (out[3].a, out[3].b) == (0.0, 0.0)       # out of scope: zero
    f15 = df.select(*[e.alias(k) for k, e in N.row_normalise(["a", "b"]).items()]).collect()
    assert (f15[2].a, f15[2].b) == (0.0, 0.0)        # zero sum divides by 1


@pytest.mark.parametrize("a,b,expected", [("monteswar", "manteswar", 88.89), ("nowda", "naoda", 80.0),
                                          ("joypur", "joypur (purulia)", 54.55), ("a b", "b a", 100.0),
                                          ("", "", 100.0), ("abc", "", 0.0)])
def test_token_sort_ratio(spark, a, b, expected):
    df = spark.createDataFrame([(a, b)], "a string, b string")
    got = df.select(match.token_sort_ratio("a", "b")).first()[0]
    assert round(got, 2) == expected


def test_best_match_threshold_and_ties(spark):
    left = spark.createDataFrame([("Monteswar",), ("Nowda",), ("Xyz",)], "n string")
    right = spark.createDataFrame([("manteswar",), ("naoda",), ("nowdb",), ("abcdef",)], "n string")
    got = {r.left_name: (r.right_name, round(r.score, 2)) for r in match.best_match(left, right, "n", "n").collect()}
    assert got["Monteswar"] == ("manteswar", 88.89)
    assert got["Nowda"] == ("naoda", 80.0)          # tie with nowdb: smallest name
    assert "Xyz" not in got


HEADER = ("বিধানসভা কেন্দ্রের নং, নাম : ১২৩-Dabgram Fulbari\nভাগ নং, নাম : 7–Ward Seven\nঅংশ নং : 45\n"
          "থানা : Sadar\nওয়ার্ড । 12 North\nপিন : ৭৩৪০০৫\nজেলা : Jalpaiguri\nTotal 2026 electors 1234 of 2025")


def test_parse_header(spark):
    df = spark.createDataFrame([(HEADER,), ("no fields here",)], "text string")
    rows = df.select(TP.parse_header(F.col("text")).alias("h"), T.max_number_in_text("text").alias("n")).collect()
    h = rows[0].h
    assert (h.constituency_no, h.constituency_name) == ("১২৩", "Dabgram Fulbari")
    assert (h.bhag_no, h.bhag_name, h.part_no) == ("7", "Ward Seven", "45")
    assert h.gram_panchayat == "12 North"            # second alternative pattern
    assert h.pin == "৭৩৪০০৫" and h.district == "Jalpaiguri" and h.block == ""
    assert rows[0].n == "1234"                        # 2025/2026 skipped, 123 and 734005 too big/small
    assert rows[1].h.thana == "" and rows[1].n == ""


PAGE = """Publication date 2026-01-05
12
001
Name : Asha Devi
Husband's name : Ramesh
House No: 4B Age : 34 Gender : female
WBA1234567
Photo available


002
Name : Bikash Roy
Father's name : Gopal Roy
Age : 52
Gender : Male
003
Age : 40 Gender : Maie
0004
Name : Chitra
Mother's name : Lata House Number# 9
Gender : FEMALE
Total pages 30"""


def test_parse_voters(spark):
    df = spark.createDataFrame([(1, PAGE)], "k int, text string")
    rows = TP.parse_voters(df, "text", ["k"]).orderBy("block_no").collect()
    assert [r.serial for r in rows] == ["001", "002", "0004"]      # 003 has no name; 12 is not a start
    a, b, c = rows
    assert (a.name, a.father_husband_name, a.relation_type, a.house_no, a.age, a.gender, a.voter_id) == \
        ("Asha Devi", "Ramesh", "husband", "4B", "34", "Female", "WBA1234567")
    assert (b.name, b.father_husband_name, b.relation_type, b.age, b.gender) == \
        ("Bikash Roy", "Gopal Roy", "father", "52", "Male")
    assert (c.relation_type, c.house_no, c.gender) == ("mother", "9", "Female")


ANSWERS = [
    (1, '<think>hmm\nmaybe</think>\n{"predicted_vote": "AITC", "confidence": 0.8, "key_issues": ["jobs", "roads"]}'),
    (2, 'A {"predicted_vote": "NDA"} and {"x": 1}'),
    (3, '<think>draft {"predicted_vote": "X"}</think> {"predicted_vote": "LF"}'),
    (4, '{"predicted_vote": "INC", "confidence": }'),
    (5, "no json here"),
    (6, '{"predicted_vote": "", "confidence": 0.5}'),
]


def test_parse_answers(spark):
    df = spark.createDataFrame(ANSWERS, "id int, r string")
    schema = "predicted_vote string, confidence double, key_issues array<string>"
    out = {r.id: r.p for r in df.select("id", TP.parse_answer(F.col("r"), schema).alias("p")).collect()}
    assert (out[1].predicted_vote, out[1].confidence, out[1].key_issues, out[1].thought) == \
        ("AITC", 0.8, ["jobs", "roads"], "hmm\nmaybe")
    assert out[2].error == "parse_failed" and out[2].predicted_vote is None
    assert out[3].predicted_vote == "LF" and out[3].error is None
    assert out[4].error == "parse_failed" and out[4].raw.startswith("{")
    assert out[5].error == "no_json" and out[5].raw == "no json here"
    assert out[6].predicted_vote == "" and out[6].error is None
    merged = df.select("id", TP.merge_nonempty(TP.parse_answer(F.col("r"), schema)["predicted_vote"],
                                               F.lit("OLD")).alias("v")).collect()
    assert {r.id: r.v for r in merged}[6] == "OLD"


def test_argmax_first_on_tie(spark):
    df = spark.createDataFrame([(0.0, 0.0, 0.0), (5.0, 5.0, 1.0), (1.0, float("nan"), 2.0), (None, None, None)],
                               "a double, b double, c double")
    got = [r[0] for r in df.select(poststrat.argmax_name(["a", "b", "c"], [F.col("a"), F.col("b"), F.col("c")]))
           .collect()]
    assert got == ["a", "a", "c", None]


def test_quantiles_type7_and_median_fill(spark):
    df = spark.createDataFrame([("s", 1, 1.0), ("s", 2, 2.0), ("s", 3, 3.0), ("s", 4, 4.0), ("s", 5, None)],
                               "seat string, draw int, share double")
    r = poststrat.summarise_draws(df, ["seat"], scale=1.0).first()
    # the null draw takes the median 2.5 first: values 1, 2, 2.5, 3, 4
    assert r.median == 2.5
    assert math.isclose(r.ci_low, 1.1) and math.isclose(r.ci_high, 3.9)


def test_classification_report_zero_division(spark):
    rows = [("A", "A"), ("A", "B"), ("B", "B"), ("C", "B")]
    rep = {r.label: r for r in classify.classification_report(spark.createDataFrame(rows, "t string, p string"), "t", "p")
           .collect()}
    assert rep["C"].precision == 0.0 and rep["C"].recall == 0.0 and rep["C"].f1 == 0.0
    assert rep["A"].precision == 1.0 and rep["A"].recall == 0.5
    assert rep["accuracy"].f1 == 0.5 and rep["accuracy"].support == 4
    assert math.isclose(rep["macro avg"].precision, (1 + 1 / 3 + 0) / 3)


def test_collapse_first_seen_on_tie(spark):
    rows = [("S", "P", "Zed", "1,200", 1), ("S", "P", "Amy", "1,200", 2), ("S", "Q", "Bob", "n/a", 3)]
    df = spark.createDataFrame(rows, "constituency string, party string, candidate string, total_votes string, row_pos int")
    got = {(r.party): (r.candidate, r.votes) for r in results.collapse_to_party(df).collect()}
    assert got == {"P": ("Zed", 1200), "Q": ("Bob", 0)}


def test_bucket_rollup(spark):
    rows = [("S1", "p1", "Ann", 10, 50.0), ("S1", "p2", "Ben", 10, 50.0), ("S2", "p3", "Cal", 0, 0.0)]
    df = spark.createDataFrame(rows, "constituency string, party string, candidate string, votes long, vote_share double")
    b = F.when(F.col("party").isin("p1", "p2"), "X").otherwise("Y")
    got = {(r.constituency, r.bucket): (r.candidate, r.total_votes, r.vote_share)
           for r in results.bucket_rollup(df, b, ["X", "Y"]).collect()}
    assert got[("S1", "X")] == ("Ann", 20, 100.0)        # tie -> first party in sorted order
    assert got[("S1", "Y")] == ("", 0, 0.0)              # no member
    assert got[("S2", "Y")] == ("", 0, 0.0)              # top member has 0 votes


def test_lookup_case_insensitive(spark):
    dim = spark.createDataFrame([("  kolkata port ", 0, "A"), ("KOLKATA PORT", 1, "B"), ("Entally", 0, "C")],
                                "name string, load_order int, cand string")
    df = spark.createDataFrame([("Kolkata Port",), ("Nowhere",)], "seat string")
    got = {r.seat: (r.cand, r.found) for r in match.lookup_ci(df, dim, "seat", "name", "load_order",
                                                               {"cand": ""}).collect()}
    assert got == {"Kolkata Port": ("A", True), "Nowhere": ("", False)}
    txt = spark.createDataFrame([("", ""), ("AITC", ""), (None, "Ram")], "p string, c string")
    assert [r[0] for r in txt.select(T.party_candidate("p", "c")).collect()] == ["No candidate", "AITC - ", " - Ram"]


def test_interval_check(spark):
    rows = [("a", 5.0, 4.0, 6.0), ("b", 6.0, 4.0, 6.0), ("c", 8.0, 4.0, 6.0), ("d", 1.0, 4.0, 6.0)]
    df = spark.createDataFrame(rows, "seat string, actual_X double, ci_low_X double, ci_high_X double")
    r = results.interval_check(df, ["seat"], ["X"]).first()
    assert r.inside == 2 and r.coverage == 0.5 and r.mean_width == 2.0
    assert r.mean_miss == (2.0 / 4) + (3.0 / 4)


def test_title_case_and_keys(spark):
    df = spark.createDataFrame([("dabgram-fulbari",), ("  Joypur (Purulia) - 12 ",)], "s string")
    out = df.select(T.title_case("s").alias("t"), T.match_key("s").alias("k"),
                    T.strip_trailing_code(T.strip_all("s")).alias("c")).collect()
    assert out[0].t == "Dabgram-Fulbari" and out[0].k == "dabgram fulbari"
    assert out[1].c == "Joypur (Purulia)"


def test_html_rows_and_options(spark):
    html = ("<table><tr><td>1</td><td><b> Asha </b></td><td>P1</td><td>x</td><td>y</td><td>1,200</td><td>40.5</td></tr>"
            "<tr><td>1</td><td>2</td><td>3</td><td>4</td><td>5</td><td>6</td></tr></table>"
            '<select><option value="">Select</option><option value="12">Seat 12</option></select>')
    df = spark.createDataFrame([(html,)], "h string")
    rows = df.select(F.explode(TP.html_table_rows(F.col("h"))).alias("r")).select("r.*").collect()
    assert [(r.candidate, r.party, r.total_votes, r.vote_share) for r in rows] == [("Asha", "P1", "1,200", "40.5")]
    opts = df.select(F.explode(TP.option_list(F.col("h"))).alias("o")).select("o.*").collect()
    assert [(o.code, o.name) for o in opts] == [("12", "Seat 12")]


def test_best_match_short_and_empty_names(spark):
    left = spark.createDataFrame([("",), ("a",), ("ab",), ("ba ",)], "n string")
    right = spark.createDataFrame([("",), ("a",), ("b",), ("a b",)], "n string")
    got = {r.left_name: (r.right_name, round(r.score, 2))
           for r in match.best_match(left, right, "n", "n", normalise=False).collect()}
    # "ba " sorts to "ba": LCS with "a b" is 1, ratio 40 -> no match
    assert got == {"": ("", 100.0), "a": ("a", 100.0), "ab": ("a b", 80.0)}


def test_argmax_all_zero_option(spark):
    df = spark.createDataFrame([(0.0, 0.0), (0.0, 2.0)], "a double, b double")
    cols = [F.col("a"), F.col("b")]
    got = [r[0] for r in df.select(poststrat.argmax_name(["a", "b"], cols, all_zero_null=True)).collect()]
    assert got == [None, "b"]
