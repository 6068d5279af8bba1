"""Phase 5 queries: header and record parsing, HTML rows, option lists,
answer parsing and merging, prompt text, labels, fuzzy matching (F24-F28,
F31-F33, F39, F40, W5, A29, S14, S15, J8, P12, F7, J10)."""

from __future__ import annotations

from pyspark.sql import functions as F

from strataforge.functions import text as T
from strataforge.operators import clean, match, textparse as TP
from strataforge.plans.catalogue import register, r6, cte
from strataforge.plans.derived import result, roll, ROLL_SQL, RESULT_SQL
from strataforge.plans import q_results
from strataforge.sources.tables import table


def _sql_re(p: str) -> str:
    """A reference pattern for DuckDB/RE2: Unicode digits spelled out,
    look-ahead turned into a consumed group (only group 1 is read), quotes
    doubled for SQL."""
    p = p.replace(r"\d", r"\p{Nd}").replace("(?=", "(?:")
    return p.replace("'", "''")


# ---------------------------------------------------------------- headers

def header_texts(spark, sf_dir):
    c = table(spark, sf_dir, "customer", "c_custkey", "c_nationkey")
    k, nk = F.col("c_custkey"), F.col("c_nationkey")
    s = lambda e: e.cast("string")
    pin = s(700000 + k % 999)
    lines = [
        F.when(k % 6 != 0, F.concat(F.lit("বিধানসভা কেন্দ্রের নং, নাম : "), s(nk), F.lit("-SEAT "), s(nk))),
        F.when(k % 4 != 0, F.concat(F.lit("ভাগ নং, নাম : "), s(k % 50), F.lit("–Part "), s(k % 50))),
        F.concat(F.lit("অংশ নং : "), s(k % 300)),
        F.concat(F.lit("থানা : Thana "), s(nk)),
        F.when(k % 2 == 0, F.concat(F.lit("গ্রাম পঞ্চায়েত : GP "), s(k % 17)))
         .otherwise(F.concat(F.lit("ওয়ার্ড । Ward "), s(k % 17))),
        # Bengali digits for one PIN in five
        F.concat(F.lit("পিন : "), F.when(k % 5 == 0, F.translate(pin, T.ASCII_DIGITS, T.BENGALI_DIGITS))
                 .otherwise(pin)),
        F.concat(F.lit("ভোট গ্রহন কেন্দ্রের নং : "), s(k % 200)),
        F.when(k % 3 != 0, F.concat(F.lit("জেলা : District "), s(nk % 7))),
        F.concat(F.lit("Year 2026 electors "), s(500 + k % 900)),
    ]
    return c.select("c_custkey", F.concat_ws("\n", *lines).alias("text"))


HEADER_TEXT_SQL = f"""SELECT c_custkey, concat_ws(chr(10),
  CASE WHEN c_custkey % 6 <> 0 THEN 'বিধানসভা কেন্দ্রের নং, নাম : ' || c_nationkey || '-SEAT ' || c_nationkey END,
  CASE WHEN c_custkey % 4 <> 0 THEN 'ভাগ নং, নাম : ' || (c_custkey % 50) || '–Part ' || (c_custkey % 50) END,
  'অংশ নং : ' || (c_custkey % 300),
  'থানা : Thana ' || c_nationkey,
  CASE WHEN c_custkey % 2 = 0 THEN 'গ্রাম পঞ্চায়েত : GP ' || (c_custkey % 17) ELSE 'ওয়ার্ড । Ward ' || (c_custkey % 17) END,
  'পিন : ' || CASE WHEN c_custkey % 5 = 0 THEN translate(CAST(700000 + c_custkey % 999 AS VARCHAR), '{T.ASCII_DIGITS}', '{T.BENGALI_DIGITS}')
                   ELSE CAST(700000 + c_custkey % 999 AS VARCHAR) END,
  'ভোট গ্রহন কেন্দ্রের নং : ' || (c_custkey % 200),
  CASE WHEN c_custkey % 3 <> 0 THEN 'জেলা : District ' || (c_nationkey % 7) END,
  'Year 2026 electors ' || (500 + c_custkey % 900)) AS text FROM customer"""


def _header_sql() -> str:
    cols = []
    for a, b, p in TP.HEADER_PAIR_PATTERNS:
        q = _sql_re(p)
        cols.append(f"CASE WHEN regexp_matches(text, '{q}') THEN trim(regexp_extract(text, '{q}', 1)) ELSE '' END AS {a}")
        cols.append(f"CASE WHEN regexp_matches(text, '{q}') THEN trim(regexp_extract(text, '{q}', 2)) ELSE '' END AS {b}")
    for name, pats in TP.HEADER_FIELD_PATTERNS:
        e = "''"
        for p in reversed(pats):
            q = _sql_re(p)
            e = f"CASE WHEN regexp_matches(text, '{q}') THEN trim(regexp_extract(text, '{q}', 1)) ELSE {e} END"
        cols.append(f"{e} AS {name}")
    return cte(h=HEADER_TEXT_SQL) + f"SELECT c_custkey, {', '.join(cols)} FROM h"


@register("header_fields", _header_sql())
def header_fields(spark, sf_dir):
    """F32: 13 header fields by ordered alternative patterns."""
    h = header_texts(spark, sf_dir)
    return h.select("c_custkey", TP.parse_header(F.col("text")).alias("h")).select("c_custkey", "h.*")


# ---------------------------------------------------------------- records

def roll_pages(spark, sf_dir):
    """One page of roll text per customer: boilerplate, a 2-digit serial
    that is not a block start, two voter blocks (the second without a name
    line for one customer in five)."""
    c = table(spark, sf_dir, "customer", "c_custkey", "c_name", "c_nationkey")
    k, s = F.col("c_custkey"), (lambda e: e.cast("string"))
    rel = F.when(k % 3 == 0, "Father's name : ").when(k % 3 == 1, "Husband's name : ").otherwise("Mother's name : ")
    gender = (F.when(k % 4 == 0, "female").when(k % 4 == 1, "Male").when(k % 4 == 2, "Maie").otherwise("FEMALE"))
    lines = [
        F.concat(F.lit("Publication date 2026-01-0"), s(k % 9 + 1)),
        F.lit("12"),
        s(100 + k % 900),
        F.concat(F.lit("  Name : "), F.col("c_name")),
        F.concat(rel, F.lit("Parent "), s(F.col("c_nationkey"))),
        F.concat(F.lit("House No: "), s(k % 97)),
        F.concat(F.lit("Age : "), s(20 + k % 60), F.lit(" Gender : "), gender),
        F.concat(F.lit("ABC"), F.lpad(s(k), 7, "0")),
        F.lit("Photo available"), F.lit(""), F.lit(""),
        s(1000 + k % 9000),
        F.when(k % 5 != 0, F.concat(F.lit("Name : Second "), s(k))),
        F.lit("Age : 33"),
        F.lit("Total pages 30"),
    ]
    return c.select("c_custkey", F.concat_ws("\n", *lines).alias("text"))


ROLL_PAGES_SQL = """SELECT c_custkey, concat_ws(chr(10),
  'Publication date 2026-01-0' || (c_custkey % 9 + 1), '12', CAST(100 + c_custkey % 900 AS VARCHAR),
  '  Name : ' || c_name,
  CASE c_custkey % 3 WHEN 0 THEN 'Father''s name : ' WHEN 1 THEN 'Husband''s name : ' ELSE 'Mother''s name : ' END
    || 'Parent ' || c_nationkey,
  'House No: ' || (c_custkey % 97),
  'Age : ' || (20 + c_custkey % 60) || ' Gender : ' ||
    CASE c_custkey % 4 WHEN 0 THEN 'female' WHEN 1 THEN 'Male' WHEN 2 THEN 'Maie' ELSE 'FEMALE' END,
  'ABC' || lpad(CAST(c_custkey AS VARCHAR), 7, '0'),
  'Photo available', '', '',
  CAST(1000 + c_custkey % 9000 AS VARCHAR),
  CASE WHEN c_custkey % 5 <> 0 THEN 'Name : Second ' || c_custkey END,
  'Age : 33', 'Total pages 30') AS text FROM customer"""


def _first_sql(pats, src="bt", flags="(?i)") -> str:
    e = "''"
    for p in reversed(pats):
        q = flags + _sql_re(p)
        e = f"CASE WHEN regexp_matches({src}, '{q}') THEN trim(regexp_extract({src}, '{q}', 1)) ELSE {e} END"
    return e


def _records_sql() -> str:
    clean_t = "text"
    for p in TP.BOILERPLATE:
        clean_t = f"regexp_replace({clean_t}, '{p}', '', 'g')"
    clean_t = f"regexp_replace({clean_t}, '\\n{{2,}}', chr(10), 'g')"
    fields = {f: _first_sql([p for g, p in TP.FIELD_PATTERNS if g == f])
              for f in ("name", "father_husband_name", "house_no", "age")}
    rel = "CASE " + " ".join(f"WHEN regexp_matches(bt, '(?i){_sql_re(p)}') THEN '{n}'" for n, p in TP.RELATIONS) + " ELSE '' END"
    g = "(?i)" + _sql_re(TP.GENDER)
    gender = (f"CASE WHEN NOT regexp_matches(bt, '{g}') THEN '' "
              f"WHEN contains(lower(regexp_extract(bt, '{g}', 1)), 'female') THEN 'Female' "
              f"WHEN contains(lower(regexp_extract(bt, '{g}', 1)), 'male') THEN 'Male' "
              f"ELSE regexp_extract(bt, '{g}', 1) END")
    vid = TP.VOTER_ID
    return cte(
        pg=ROLL_PAGES_SQL,
        t=f"SELECT c_custkey, {clean_t} AS t FROM pg",
        l="""SELECT c_custkey, list_filter(list_transform(string_split(t, chr(10)), lambda x: trim(x)),
                                              lambda x: x <> '') AS lines FROM t""",
        p="""SELECT c_custkey, lines, list_filter(list_transform(lines,
                 lambda x, i: CASE WHEN regexp_full_match(x, '[0-9]{3,4}') THEN i END), lambda i: i IS NOT NULL) AS pos
             FROM l""",
        b="""SELECT c_custkey, list_transform(pos, lambda q, j: list_slice(lines, q, coalesce(pos[j + 1] - 1, len(lines))))
               AS blocks FROM p""",
        u="""SELECT c_custkey, unnest(blocks) AS blk, unnest(range(len(blocks))) AS block_no FROM b""",
        v="SELECT c_custkey, block_no, blk, array_to_string(blk, ' ') AS bt FROM u",
    ) + f"""SELECT c_custkey, CAST(block_no AS INTEGER) AS block_no, trim(blk[1]) AS serial,
       {fields['name']} AS name, {fields['father_husband_name']} AS father_husband_name, {rel} AS relation_type,
       {fields['house_no']} AS house_no, {fields['age']} AS age, {gender} AS gender,
       CASE WHEN regexp_matches(bt, '{vid}') THEN regexp_extract(bt, '{vid}', 1) ELSE '' END AS voter_id
FROM v WHERE {fields['name']} <> ''"""


@register("record_blocks", _records_sql())
def record_blocks(spark, sf_dir):
    """F33 + F39 + W5: page text -> voter rows (blocks start at 3-4 digit
    serial lines; only blocks with a name are kept)."""
    return TP.parse_voters(roll_pages(spark, sf_dir), "text", ["c_custkey"])


# ---------------------------------------------------------------- pages

def _page_parts(spark, sf_dir):
    p = table(spark, sf_dir, "pages", "page_id", "url")
    return p.select("page_id", "url",
                    F.regexp_extract("url", r"://([^/]+)/", 1).alias("area"),
                    F.regexp_extract("url", r"://[^/]+/([a-z]+)/", 1).alias("booth"),
                    F.regexp_extract("url", r"/[a-z]+/(\d+)", 1).try_cast("int").alias("page_no"),
                    F.col("url").contains("#top").alias("is_header"))


@register("pages_per_group", """
WITH p AS (SELECT page_id, url, regexp_extract(url, '://([^/]+)/', 1) AS area,
                  regexp_extract(url, '://[^/]+/([a-z]+)/', 1) AS booth,
                  TRY_CAST(regexp_extract(url, '/[a-z]+/(\\d+)', 1) AS INTEGER) AS page_no,
                  contains(url, '#top') AS is_header FROM pages)
SELECT area, booth, max(CASE WHEN is_header THEN url END) AS header_url,
       coalesce(string_agg(url, ' ' ORDER BY page_no, url) FILTER (WHERE NOT is_header), '') AS pages,
       count(*) FILTER (WHERE NOT is_header) AS n_pages
FROM p GROUP BY area, booth""")
def pages_per_group(spark, sf_dir):
    """Per (area, booth) the header page apart and the other pages in
    page-number order (the list of one booth's pages)."""
    p = _page_parts(spark, sf_dir)
    g = p.groupBy("area", "booth").agg(
        F.max(F.when(F.col("is_header"), F.col("url"))).alias("header_url"),
        F.array_sort(F.collect_list(F.when(~F.col("is_header"), F.struct("page_no", "url")))).alias("__p"),
        F.count_if(~F.col("is_header")).alias("n_pages"))
    return g.select("area", "booth", "header_url", F.array_join(F.transform("__p", lambda s: s["url"]), " ").alias("pages"),
                    "n_pages")


@register("page_order", """
WITH p AS (SELECT page_id, url, regexp_extract(url, '://([^/]+)/', 1) AS area,
                  regexp_extract(url, '://[^/]+/([a-z]+)/', 1) AS booth,
                  TRY_CAST(regexp_extract(url, '/[a-z]+/(\\d+)', 1) AS INTEGER) AS page_no,
                  contains(url, '#top') AS is_header FROM pages)
SELECT area, booth, url, is_header,
       CAST(row_number() OVER (PARTITION BY area, booth, is_header ORDER BY page_no NULLS FIRST, url) - 1 AS BIGINT) AS position,
       count(*) OVER (PARTITION BY area, booth, is_header) AS n_in_part
FROM p""")
def page_order(spark, sf_dir):
    """A29 in long form: every page of a booth with its position among the
    booth's header pages or among its other pages (page-number order), from
    exact grouped positions, so no booth's page list is ever gathered into
    one task or row."""
    from strataforge.operators import sampling
    p = _page_parts(spark, sf_dir)
    g = sampling.group_positions(p, ["area", "booth", "is_header"], ["page_no", "url"])
    return g.select("area", "booth", "url", "is_header", F.col("__pos").alias("position"),
                    F.col("__size").alias("n_in_part"))


@register("page_label", """
WITH p AS (SELECT page_id, regexp_extract(url, '^[a-z]+://[^/]+(/[^?#]*)', 1) AS path FROM pages),
b AS (SELECT page_id, regexp_replace(string_split(path, '/')[-1], '(?i)\\.html$', '') AS base FROM p)
SELECT page_id, base, CASE WHEN TRY_CAST(base AS INTEGER) IS NOT NULL
                           THEN printf('voter_p%03d', TRY_CAST(base AS INTEGER) % 1000) END AS label FROM b""")
def page_label(spark, sf_dir):
    """F40 base name without extension, F31 zero-padded label."""
    p = table(spark, sf_dir, "pages", "page_id", "url")
    path = F.regexp_extract("url", r"^[a-z]+://[^/]+(/[^?#]*)", 1)
    base = T.drop_extension(T.base_name(path), "html")
    num = base.try_cast("int")
    return p.select("page_id", base.alias("base"),
                    F.when(num.isNotNull(), T.padded_label("voter_p", num % 1000)).alias("label"))


def html_results(spark, sf_dir):
    r = result(spark, sf_dir)
    s = lambda e: e.cast("string")
    html = F.concat(
        F.lit("<table><tr><th>No</th></tr><tr><td>"), s(F.col("seat_no")), F.lit("</td><td><b>"), F.col("candidate"),
        F.lit("</b></td><td>"), F.col("party"), F.lit("</td><td>-</td><td>-</td><td> "), s(F.col("votes")),
        F.lit(" </td><td>"), s(F.col("votes") % 100), F.lit(".5</td></tr>"),
        F.when(F.col("votes") % 4 == 0, F.lit("<tr><td>1</td><td>2</td><td>3</td><td>4</td><td>5</td><td>6</td></tr>"))
         .otherwise(F.lit("")),
        F.lit("</table>"))
    return r.select("constituency", "party", "candidate", html.alias("html"))


@register("html_rows", cte(res=RESULT_SQL, h="""SELECT constituency, party, candidate,
  '<table><tr><th>No</th></tr><tr><td>' || seat_no || '</td><td><b>' || candidate || '</b></td><td>' || party ||
  '</td><td>-</td><td>-</td><td> ' || votes || ' </td><td>' || (votes % 100) || '.5</td></tr>' ||
  CASE WHEN votes % 4 = 0 THEN '<tr><td>1</td><td>2</td><td>3</td><td>4</td><td>5</td><td>6</td></tr>' ELSE '' END ||
  '</table>' AS html FROM res""",
    r="""SELECT constituency, party AS src_party, candidate AS src_candidate,
                unnest(regexp_extract_all(html, '(?s)<tr[^>]*>(.*?)</tr>', 1)) AS row FROM h""",
    c="SELECT *, regexp_extract_all(row, '(?s)<td[^>]*>(.*?)</td>', 1) AS cells FROM r") + """
SELECT constituency, src_party, src_candidate,
       trim(regexp_replace(cells[2], '<[^>]+>', '', 'g')) AS candidate, trim(regexp_replace(cells[3], '<[^>]+>', '', 'g')) AS party,
       trim(regexp_replace(cells[6], '<[^>]+>', '', 'g')) AS total_votes, trim(regexp_replace(cells[7], '<[^>]+>', '', 'g')) AS vote_share
FROM c WHERE len(cells) >= 7""")
def html_rows(spark, sf_dir):
    """Table rows -> (candidate, party, votes, share) from cells 1, 2,
    5, 6; rows with fewer than 7 cells skipped."""
    h = html_results(spark, sf_dir)
    x = h.select("constituency", F.col("party").alias("src_party"), F.col("candidate").alias("src_candidate"),
                 F.explode(TP.html_table_rows(F.col("html"))).alias("r"))
    return x.select("constituency", "src_party", "src_candidate", "r.*")


NAV = r'<a href="/([^"]*)">([^<]*)</a>'


@register("option_list", f"""
WITH a AS (SELECT 'page' AS src, page_id AS id, unnest(regexp_extract_all(html, '{NAV}', 1)) AS code,
                  unnest(regexp_extract_all(html, '{NAV}', 2)) AS name FROM pages),
n AS (SELECT 'nation' AS src, CAST(n_nationkey AS BIGINT) AS id,
             '<select><option value="">Select</option><option value="' || n_nationkey || '">' || n_name || '</option></select>' AS html
      FROM nation),
b AS (SELECT src, id, unnest(regexp_extract_all(html, '<option[^>]*value="([^"]*)"[^>]*>(.*?)</option>', 1)) AS code,
             unnest(regexp_extract_all(html, '<option[^>]*value="([^"]*)"[^>]*>(.*?)</option>', 2)) AS name FROM n)
SELECT src, id, code, name FROM a WHERE trim(code) <> ''
UNION ALL SELECT src, id, code, name FROM b WHERE trim(code) <> ''""")
def option_list(spark, sf_dir):
    """code/name pairs of an option list, blank codes skipped; the nav
    links of the web pages and a dropdown built per nation row."""
    p = table(spark, sf_dir, "pages", "page_id", "html")
    a = p.select(F.lit("page").alias("src"), F.col("page_id").alias("id"),
                 F.explode(TP.option_list(F.col("html"), NAV)).alias("o"))
    n = table(spark, sf_dir, "nation", "n_nationkey", "n_name")
    html = F.concat(F.lit('<select><option value="">Select</option><option value="'), F.col("n_nationkey").cast("string"),
                    F.lit('">'), F.col("n_name"), F.lit("</option></select>"))
    b = n.select(F.lit("nation").alias("src"), F.col("n_nationkey").cast("bigint").alias("id"),
                 F.explode(TP.option_list(html)).alias("o"))
    return a.unionByName(b).select("src", "id", F.col("o.code").alias("code"), F.col("o.name").alias("name"))


# ---------------------------------------------------------------- answers

ANSWER_SCHEMA = "predicted_vote string, confidence double, reasoning string, key_issues array<string>"


def answers(spark, sf_dir):
    c = table(spark, sf_dir, "conversations", "conv_id", "turn", "role")
    t, s = F.col("turn"), (lambda e: e.cast("string"))
    resp = (F.when(t % 6 == 0, F.concat(F.lit("<think>reasoning "), s(F.col("conv_id")),
                                        F.lit('</think>\n{"predicted_vote": "AITC", "confidence": 0.'), s(t % 9 + 1),
                                        F.lit(', "reasoning": "'), F.col("role"), F.lit('", "key_issues": ["jobs", "prices"]}')))
            .when(t % 6 == 1, F.lit('Sure. {"predicted_vote": "NDA", "confidence": 0.6} and also {"note": 1}'))
            .when(t % 6 == 2, F.concat(F.lit('<think>draft {"predicted_vote": "X"}</think> {"predicted_vote": "LF", '
                                             '"confidence": 0.4, "reasoning": "'), F.col("role"), F.lit('"}')))
            .when(t % 6 == 3, F.lit('{"predicted_vote": "INC", "confidence": }'))
            .when(t % 6 == 4, F.lit("I cannot answer that."))
            .otherwise(F.lit('{"predicted_vote": "", "confidence": 0.5, "key_issues": []}')))
    return c.select("conv_id", "turn", "role", resp.alias("response"))


ANSWERS_SQL = """SELECT conv_id, turn, role, CASE turn % 6
  WHEN 0 THEN '<think>reasoning ' || conv_id || '</think>' || chr(10) || '{"predicted_vote": "AITC", "confidence": 0.'
              || (turn % 9 + 1) || ', "reasoning": "' || role || '", "key_issues": ["jobs", "prices"]}'
  WHEN 1 THEN 'Sure. {"predicted_vote": "NDA", "confidence": 0.6} and also {"note": 1}'
  WHEN 2 THEN '<think>draft {"predicted_vote": "X"}</think> {"predicted_vote": "LF", "confidence": 0.4, "reasoning": "' || role || '"}'
  WHEN 3 THEN '{"predicted_vote": "INC", "confidence": }'
  WHEN 4 THEN 'I cannot answer that.'
  ELSE '{"predicted_vote": "", "confidence": 0.5, "key_issues": []}' END AS response FROM conversations"""

PARSED_SQL = dict(
    a=ANSWERS_SQL,
    c="""SELECT *, trim(regexp_replace(response, '(?s)<think>.*?</think>', '', 'g')) AS cleaned,
                CASE WHEN regexp_matches(response, '(?s)<think>(.*?)</think>')
                     THEN trim(regexp_extract(response, '(?s)<think>(.*?)</think>', 1)) END AS thought FROM a""",
    s="""SELECT *, CASE WHEN regexp_matches(cleaned, '(?s)\\{.*\\}') THEN regexp_extract(cleaned, '(?s)\\{.*\\}', 0) END AS span
         FROM c""",
    v="SELECT *, span IS NOT NULL AND json_valid(span) AS ok FROM s",
    pa="""SELECT conv_id, turn, role, thought,
             CASE WHEN ok THEN json_extract_string(span, '$.predicted_vote') END AS predicted_vote,
             CASE WHEN ok THEN TRY_CAST(json_extract_string(span, '$.confidence') AS DOUBLE) END AS confidence,
             CASE WHEN ok THEN json_extract_string(span, '$.reasoning') END AS reasoning,
             CASE WHEN ok THEN array_to_string(CAST(json_extract(span, '$.key_issues') AS VARCHAR[]), ';') END AS key_issues,
             CASE WHEN span IS NULL THEN 'no_json' WHEN NOT ok THEN 'parse_failed' END AS error,
             CASE WHEN span IS NULL OR NOT ok THEN cleaned END AS raw FROM v""",
)


def parsed_answers(spark, sf_dir):
    a = answers(spark, sf_dir)
    p = a.select("conv_id", "turn", "role", TP.parse_answer(F.col("response"), ANSWER_SCHEMA).alias("p"))
    return p.select("conv_id", "turn", "role", "p.thought", "p.predicted_vote", "p.confidence", "p.reasoning",
                    F.array_join("p.key_issues", ";").alias("key_issues"), "p.error", "p.raw")


@register("llm_answer_parse", cte(**PARSED_SQL) + "SELECT * EXCLUDE (role) FROM pa")
def llm_answer_parse(spark, sf_dir):
    """F24 think blocks (removed, text kept) + F25 first-to-last brace JSON
    with ``no_json`` / ``parse_failed`` tags and the raw text."""
    return parsed_answers(spark, sf_dir).drop("role")


@register("llm_answer_merge", cte(**PARSED_SQL) + """
SELECT conv_id, turn, coalesce(nullif(predicted_vote, ''), upper(role)) AS vote,
       coalesce(nullif(reasoning, ''), 'none') AS reasoning FROM pa""")
def llm_answer_merge(spark, sf_dir):
    """parsed values replace the old ones only when non-empty."""
    p = parsed_answers(spark, sf_dir)
    return p.select("conv_id", "turn", TP.merge_nonempty(F.col("predicted_vote"), F.upper("role")).alias("vote"),
                    TP.merge_nonempty(F.col("reasoning"), F.lit("none")).alias("reasoning"))


# ---------------------------------------------------------------- prompts

PROMPT_TEMPLATE = "You are a {age}-year-old {gender} voter in {seat} ({area} area), a {segment}. Priority: {priority}."
SEGMENT_TEXT = {"AUTOMOBILE": "car owner", "BUILDING": "builder", "FURNITURE": "carpenter",
                "HOUSEHOLD": "home maker"}


@register("prompt_render", cte(roll=ROLL_SQL) + """
SELECT voter_id, 'You are a ' || age || '-year-old ' || coalesce(trim(gender), 'unknown') || ' voter in ' ||
       constituency_name || ' (' || coalesce(area_type, 'Unknown') || ' area), a ' ||
       CASE "R" WHEN 'AUTOMOBILE' THEN 'car owner' WHEN 'BUILDING' THEN 'builder' WHEN 'FURNITURE' THEN 'carpenter'
                WHEN 'HOUSEHOLD' THEN 'home maker' ELSE 'Unknown' END || '. Priority: ' || "G" || '.' AS prompt
FROM roll""")
def prompt_render(spark, sf_dir):
    """prompt text from columns with decoded codes (P12) and fixed
    fallbacks; the template is a caller parameter."""
    r = roll(spark, sf_dir)
    return r.select("voter_id", T.render_template(
        PROMPT_TEMPLATE, age=F.col("age"), gender=F.coalesce(T.strip_all("gender"), F.lit("unknown")),
        seat=F.col("constituency_name"), area=F.coalesce("area_type", F.lit("Unknown")),
        segment=clean.decode_map("R", SEGMENT_TEXT, "Unknown"), priority=F.col("G")).alias("prompt"))


def candidates_dim(spark, sf_dir):
    """Candidate table per seat name as loaded: names in varying case and
    padding, a later duplicate for some seats, one seat missing."""
    w = q_results.bucket_wide(spark, sf_dir)
    k = F.regexp_extract("constituency", r"(\d+)", 1).cast("int")
    name = (F.when(k % 3 == 0, F.upper("constituency"))
             .when(k % 3 == 1, F.concat(F.lit("  "), F.lower("constituency"), F.lit(" ")))
             .otherwise(F.col("constituency")))
    base = w.where(k != 24).select(name.alias("constituency_name"), F.lit(0).alias("load_order"),
                                   F.lit("AITC").alias("AITC_Party"), F.col("`AITC+_candidate`").alias("AITC_Candidate"),
                                   F.when(F.col("BJP_candidate") != "", F.lit("BJP")).otherwise(F.lit("")).alias("NDA_Party"),
                                   F.col("BJP_candidate").alias("NDA_Candidate"))
    dup = base.where(k % 4 == 0).withColumn("load_order", F.lit(1)).withColumn("AITC_Candidate", F.lit("DUP"))
    return base.unionByName(dup)


@register("candidate_text", "WITH roll AS (" + ROLL_SQL + "),\n" + q_results.base("bl")[len("WITH "):] + """
, bw AS (SELECT constituency, max(CASE WHEN bucket = 'AITC+' THEN candidate END) AS ac,
                max(CASE WHEN bucket = 'BJP' THEN candidate END) AS bc FROM bl GROUP BY constituency),
d0 AS (SELECT CAST(regexp_extract(constituency, '(\\d+)', 1) AS INTEGER) AS k, * FROM bw),
dim AS (SELECT lower(trim(CASE WHEN k % 3 = 0 THEN upper(constituency) WHEN k % 3 = 1 THEN '  ' || lower(constituency) || ' '
                         ELSE constituency END)) AS key, ac, CASE WHEN bc <> '' THEN 'BJP' ELSE '' END AS np, bc
        FROM d0 WHERE k <> 24),
seats AS (SELECT DISTINCT constituency_name FROM roll)
SELECT s.constituency_name,
  CASE WHEN coalesce(d.ac, '') = '' AND d.ac IS NULL THEN 'No candidate' ELSE 'AITC - ' || d.ac END AS aitc_text,
  CASE WHEN coalesce(d.np, '') = '' AND coalesce(d.bc, '') = '' THEN 'No candidate'
       ELSE coalesce(d.np, '') || ' - ' || coalesce(d.bc, '') END AS nda_text,
  d.key IS NOT NULL AS found
FROM seats s LEFT JOIN dim d ON lower(trim(s.constituency_name)) = d.key""")
def candidate_text(spark, sf_dir):
    """J8 case-insensitive trimmed lookup (first row per key kept, miss ->
    blanks + ``found = false``) and F28 party-candidate text."""
    seats = roll(spark, sf_dir).select("constituency_name").distinct()
    j = match.lookup_ci(seats, candidates_dim(spark, sf_dir), "constituency_name", "constituency_name", "load_order",
                        {"AITC_Party": "", "AITC_Candidate": "", "NDA_Party": "", "NDA_Candidate": ""})
    return j.select("constituency_name", T.party_candidate("AITC_Party", "AITC_Candidate").alias("aitc_text"),
                    T.party_candidate("NDA_Party", "NDA_Candidate").alias("nda_text"), "found")


# ---------------------------------------------------------------- fuzzy

def _altered(spark, sf_dir):
    p = table(spark, sf_dir, "part", "p_partkey", "p_name", "p_brand")
    k = F.col("p_partkey")
    alt = (F.when(k % 4 == 0, F.array_join(F.reverse(F.split("p_name", " ")), " "))
            .when(k % 4 == 1, F.replace(F.col("p_name"), F.lit("a"), F.lit("e")))
            .when(k % 4 == 2, F.concat(F.col("p_name"), F.lit(" ("), F.col("p_brand"), F.lit(")")))
            .otherwise(F.substring("p_name", 2, 1000)))
    return p.select("p_partkey", "p_name", alt.alias("altered"))


ALTERED_SQL = """SELECT p_partkey, p_name, CASE p_partkey % 4
  WHEN 0 THEN array_to_string(list_reverse(string_split(p_name, ' ')), ' ')
  WHEN 1 THEN replace(p_name, 'a', 'e')
  WHEN 2 THEN p_name || ' (' || p_brand || ')'
  ELSE substr(p_name, 2, 1000) END AS altered FROM part"""


def _tok_sql(x: str) -> str:
    return f"array_to_string(list_sort(list_filter(regexp_split_to_array(trim({x}), '\\s+'), lambda t: t <> '')), ' ')"


def _lcs_cte(pairs_sql: str) -> str:
    """Recursive-CTE LCS over a pairs table (id, a, b) -> (id, lcs)."""
    return f"""WITH RECURSIVE pr AS ({pairs_sql}),
dp(id, i, row) AS (
  SELECT id, 0, list_transform(range(0, length(b) + 1), lambda x: 0) FROM pr
  UNION ALL
  SELECT dp.id, dp.i + 1,
    [0] || list_transform(range(1, length(pr.b) + 1), lambda j: list_max(list_transform(range(1, j + 1),
        lambda k: CASE WHEN substr(pr.a, dp.i + 1, 1) = substr(pr.b, k, 1) THEN dp.row[k] + 1 ELSE dp.row[k + 1] END)))
  FROM dp JOIN pr ON dp.id = pr.id WHERE dp.i < length(pr.a)),
lcs AS (SELECT pr.id, CASE WHEN length(pr.a) = 0 OR length(pr.b) = 0 THEN 0 ELSE dp.row[-1] END AS lcs,
               length(pr.a) AS la, length(pr.b) AS lb
        FROM pr JOIN dp ON dp.id = pr.id AND dp.i = length(pr.a))
"""


@register("token_sort_ratio", _lcs_cte(
    f"SELECT p_partkey AS id, {_tok_sql('p_name')} AS a, {_tok_sql('altered')} AS b FROM ({ALTERED_SQL})") + f"""
SELECT x.p_partkey, x.p_name, x.altered,
       round(CASE WHEN la + lb = 0 THEN 100.0 ELSE 200.0 * lcs / (la + lb) END, 6) AS ratio
FROM ({ALTERED_SQL}) x JOIN lcs ON lcs.id = x.p_partkey""")
def token_sort_ratio(spark, sf_dir):
    """token-sort Indel ratio, 100 * 2 * LCS / (la + lb). The rows are dealt
    over all tasks first: names are small, so the scan alone gives few."""
    a = _altered(spark, sf_dir).repartition(int(spark.conf.get("spark.sql.shuffle.partitions")))
    return a.select("p_partkey", "p_name", "altered", r6(match.token_sort_ratio("p_name", "altered")).alias("ratio"))


def _key_sql(x: str) -> str:
    return f"replace(replace(lower(trim({x})), '-', ' '), '.', '')"


@register("fuzzy_best_match", _lcs_cte(f"""
  SELECT row_number() OVER () AS id, l.left_name, r.right_name,
         {_tok_sql(_key_sql('l.left_name'))} AS a, {_tok_sql(_key_sql('r.right_name'))} AS b
  FROM (SELECT DISTINCT altered AS left_name FROM ({ALTERED_SQL})) l,
       (SELECT DISTINCT p_name AS right_name FROM part) r""") + """
, sc AS (SELECT pr.left_name, pr.right_name, CASE WHEN la + lb = 0 THEN 100.0 ELSE 200.0 * lcs / (la + lb) END AS score
         FROM pr JOIN lcs USING (id)),
best AS (SELECT *, row_number() OVER (PARTITION BY left_name ORDER BY score DESC, right_name) AS rn
         FROM sc WHERE score >= 80)
SELECT left_name, right_name, round(score, 6) AS score FROM best WHERE rn = 1""")
def fuzzy_best_match(spark, sf_dir):
    """Best candidate per name by token-sort ratio on F6 keys, kept at
    >= 80; compared only within the length band a ratio of 80 allows."""
    a = _altered(spark, sf_dir)
    right = table(spark, sf_dir, "part", "p_name")
    m = match.best_match(a, right, "altered", "p_name", threshold=80.0)
    return m.select("left_name", "right_name", r6("score").alias("score"))


# Names of 9 to 18 letters in two words, one per order, spelled from a digest of
# its key; the left side misspells them: letters dropped, changed, swapped words,
# and (every sixth) a name without a partner.
HEX = "0123456789abcdef"
WIDE_SQL = f"""
SELECT o_orderkey AS k, concat(substr(w, 1, 4 + a), ' ', substr(w, 13, 4 + b)) AS name,
       CASE k6 WHEN 0 THEN concat(substr(w, 13, 4 + b), ' ', substr(w, 1, 4 + a))
               WHEN 1 THEN concat(substr(w, 1, 2), substr(w, 4, 1 + a), ' ', substr(w, 13, 4 + b))
               WHEN 2 THEN concat(substr(w, 1, 3), 'w', substr(w, 5, a), ' ', substr(w, 13, 4 + b))
               WHEN 3 THEN concat(substr(w, 1, 4 + a), ' ', substr(w, 13, 1), substr(w, 15, 1), substr(w, 14, 1), substr(w, 16, 1 + b))
               WHEN 4 THEN concat(substr(w, 13, 3 + b), 'y ', substr(w, 1, 3), substr(w, 5, a), 'x')
               ELSE concat(substr(w, 24, 8), ' ', substr(w, 19, 5)) END AS misspelt
FROM (SELECT o_orderkey, concat(translate(substr(md5(CAST(o_orderkey AS STRING)), 1, 12), '{HEX}', 'aeioubdkmnprstlz'),
                                translate(substr(md5(CAST(o_orderkey AS STRING)), 13), '{HEX}', 'ghcfjvwyqxaeoiur')) AS w,
             CAST(o_orderkey % 6 AS INT) AS k6, CAST(o_orderkey % 5 AS INT) AS a, CAST(floor(o_orderkey / 6) % 6 AS INT) AS b FROM orders)"""


def wide_names(spark, sf_dir):
    """(k, name, misspelt) of every order."""
    return spark.sql(WIDE_SQL.replace("FROM orders", "FROM {orders}"), orders=table(spark, sf_dir, "orders", "o_orderkey"))


def _letter_bits(x: str) -> str:
    """Bigrams of a text with both ends marked, as bits 0-255 in four numbers."""
    marked = f"'<' || {x} || '>'"
    grams = f"list_transform(range(1, length({x}) + 2), lambda i: hash(substr({marked}, i, 2)) % 256)"
    return "[" + ", ".join(f"list_bit_or(list_transform(list_filter({grams}, lambda h: h // 64 = {k}), "
                           f"lambda h: (1::UBIGINT << (h % 64)::UBIGINT)))" for k in range(4)) + "]"


def _lost_bits(x: str, y: str) -> str:
    return " + ".join(f"bit_count((coalesce({x}[{k}], 0::UBIGINT) & ~coalesce({y}[{k}], 0::UBIGINT)))" for k in range(1, 5))


# All pairs of distinct names whose bigram bits allow a ratio of 80: with c =
# ceil(0.4 (la + lb)), at most 2 (la - c) + lb - c bigrams of a are not in b.
@register("fuzzy_best_match_wide", _lcs_cte(f"""
  WITH n AS (SELECT * FROM ({WIDE_SQL.replace("AS STRING", "AS VARCHAR")})),
  l AS (SELECT left_name, s, length(s) AS n, {_letter_bits("s")} AS bits
        FROM (SELECT DISTINCT misspelt AS left_name, {_tok_sql(_key_sql("misspelt"))} AS s FROM n)),
  r AS (SELECT right_name, s, length(s) AS n, {_letter_bits("s")} AS bits
        FROM (SELECT DISTINCT name AS right_name, {_tok_sql(_key_sql("name"))} AS s FROM n))
  SELECT row_number() OVER () AS id, left_name, right_name, l.s AS a, r.s AS b
  FROM l JOIN r ON ceil(0.4 * (l.n + r.n) - 1e-9) <= least(l.n, r.n)
   AND {_lost_bits("l.bits", "r.bits")} <= 2 * l.n + r.n - 3 * ceil(0.4 * (l.n + r.n) - 1e-9)
   AND {_lost_bits("r.bits", "l.bits")} <= 2 * r.n + l.n - 3 * ceil(0.4 * (l.n + r.n) - 1e-9)""") + """
, sc AS (SELECT pr.left_name, pr.right_name, 200.0 * lcs / (la + lb) AS score FROM pr JOIN lcs USING (id)),
best AS (SELECT *, row_number() OVER (PARTITION BY left_name ORDER BY score DESC, right_name) AS rn
         FROM sc WHERE score >= 80)
SELECT left_name, right_name, round(score, 6) AS score FROM best WHERE rn = 1""")
def fuzzy_best_match_wide(spark, sf_dir):
    """J10 between as many names a side as there are orders."""
    n = wide_names(spark, sf_dir)
    return match.best_match(n, n, "misspelt", "name", threshold=80.0).select("left_name", "right_name", r6("score").alias("score"))
