"""Record-level text parsing as column expressions (SURVEY §2.8 F24-F28,
F32, F33, F39; §2.5 W5; §2.4 A29; §2.1 S14, S15).

Every parser is a native expression over one row's text (regex and array
higher-order functions), so parsing runs inside whole-stage code generation
with no Python per row and no shuffle; one text becomes many rows through
``inline``/``explode``.

Java regexes are ASCII-only for ``\\d \\s \\b`` unless ``(?U)`` is given;
the reference used Python ``re`` (Unicode), so patterns carry ``(?U)``.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strataforge.functions.text import strip_all, remove_think, think_text, json_span

# Header field patterns in order of preference (first hit
# wins); the first two capture a number and a name.
HEADER_PAIR_PATTERNS = (
    ("constituency_no", "constituency_name", r"নং[,،]\s*নাম\s*[:]\s*(\d+)[–\-](.+?)(?:\n|ভাগ|অংশ)"),
    ("bhag_no", "bhag_name", r"ভাগ নং[,،]\s*নাম\s*[:]\s*(\d+)[–\-](.+?)(?:\n|অংশ)"),
)
HEADER_FIELD_PATTERNS = (
    ("part_no", (r"অংশ নং\s*[:।]\s*(\d+)",)),
    ("thana", (r"থানা\s*[:।]\s*(.+)",)),
    ("gram_panchayat", (r"গ্রাম পঞ্চায়েত\s*[:।]\s*(.+)", r"ওয়ার্ড\s*[:।]\s*(.+)")),
    ("block", (r"ব্লক\s*[:।]\s*(.+)",)),
    ("sub_division", (r"মহকুমা\s*[:।]\s*(.+)",)),
    ("district", (r"জেলা\s*[:।]\s*(.+)",)),
    ("pin", (r"পিন\s*[:।]\s*(\d+)",)),
    ("polling_station_no", (r"ভোট গ্রহন কেন্দ্রের নং\s*[:।]\s*(\d+)",)),
    ("polling_station_name", (r"ভোট গ্রহন কেন্দ্রের নাম\s*[:।]\s*(.+)",)),
)
HEADER_FIELDS = ("constituency_no", "constituency_name", "part_no", "bhag_no", "bhag_name",
                 "polling_station_no", "polling_station_name", "thana", "gram_panchayat", "block",
                 "sub_division", "district", "pin")

# Voter record parsing (boilerplate removed first, block
# starts, voter id, field patterns tried in order, first hit per field).
BOILERPLATE = (r"(?i)Photo available", r"(?i)Publication date.*", r"(?i)Total pages.*")
BLOCK_START = r"^\d{3,4}$"
VOTER_ID = r"\b([A-Z]{2,4}[/\d]{5,})\b"
FIELD_PATTERNS = (
    ("name", r"Name\s*:\s*(.+?)(?=\s+(?:Father|Husband|Mother)'s name|\s+House|\s+Age|$)"),
    ("father_husband_name", r"Father's name\s*:\s*(.+?)(?=\s+House|\s+Age|$)"),
    ("father_husband_name", r"Husband's name\s*:\s*(.+?)(?=\s+House|\s+Age|$)"),
    ("father_husband_name", r"Mother's name\s*:\s*(.+?)(?=\s+House|\s+Age|$)"),
    ("house_no", r"House\s*(?:No|Number)\s*[:#.]\s*(\S+)"),
    ("age", r"Age\s*:\s*(\d+)"),
)
RELATIONS = (("father", r"Father's name"), ("husband", r"Husband's name"), ("mother", r"Mother's name"))
GENDER = r"Gender\s*:\s*(\S+)"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def first_capture(text: Column, patterns, flags: str = "(?U)") -> Column:
    """First pattern that matches wins; its group 1, stripped; none -> ""."""
    out = None
    for p in patterns:
        p = flags + p
        e = F.when(text.rlike(p), strip_all(F.regexp_extract(text, p, 1)))
        out = e if out is None else F.coalesce(out, e)
    return F.coalesce(out, F.lit(""))


def parse_header(text) -> Column:
    """F32: 13 header fields as a struct of strings ("" when absent)."""
    t = _c(text)
    vals = {}
    for a, b, p in HEADER_PAIR_PATTERNS:
        p = "(?U)" + p
        hit = t.rlike(p)
        vals[a] = F.when(hit, strip_all(F.regexp_extract(t, p, 1))).otherwise(F.lit(""))
        vals[b] = F.when(hit, strip_all(F.regexp_extract(t, p, 2))).otherwise(F.lit(""))
    for name, pats in HEADER_FIELD_PATTERNS:
        vals[name] = first_capture(t, pats)
    return F.struct(*[vals[k].alias(k) for k in HEADER_FIELDS])


def clean_lines(text) -> Column:
    """F39 after boilerplate removal: lines, stripped, blanks dropped."""
    t = _c(text)
    for p in BOILERPLATE:
        t = F.regexp_replace(t, p, "")
    t = F.regexp_replace(t, r"\n{2,}", "\n")
    return F.filter(F.transform(F.split(t, "\n"), lambda x: strip_all(x)), lambda x: x != "")


def split_blocks(lines, marker: str = BLOCK_START) -> Column:
    """Cut a line array into blocks that start at marker lines; lines
    before the first marker belong to no block. Pure array functions: marker
    positions, then one slice per marker up to the next one."""
    ln = _c(lines)
    n = F.size(ln)
    pos = F.filter(F.transform(ln, lambda x, i: F.when(x.rlike("(?U)" + marker), i + 1)),
                   lambda p: p.isNotNull())
    k = F.size(pos)
    return F.when(k == 0, F.array().cast("array<array<string>>")).otherwise(
        F.transform(pos, lambda p, j: F.slice(
            ln, p, F.coalesce(F.try_element_at(pos, j + 2), n + 1) - p)))


def parse_block(block) -> Column:
    """F33 for one block: serial, name, relation name, relation type,
    house, age, gender, voter id."""
    b = _c(block)
    bt = F.array_join(b, " ")
    vals = {"serial": strip_all(F.element_at(b, 1))}
    vid = "(?U)" + VOTER_ID
    vals["voter_id"] = F.when(bt.rlike(vid), F.regexp_extract(bt, vid, 1)).otherwise(F.lit(""))
    for field in ("name", "father_husband_name", "house_no", "age"):
        pats = [p for f, p in FIELD_PATTERNS if f == field]
        vals[field] = first_capture(bt, pats, "(?iU)")
    rel = None
    for name, p in RELATIONS:
        cond = bt.rlike("(?iU)" + p)
        rel = F.when(cond, F.lit(name)) if rel is None else rel.when(cond, F.lit(name))
    vals["relation_type"] = rel.otherwise(F.lit(""))
    g = "(?iU)" + GENDER
    graw = F.regexp_extract(bt, g, 1)
    gl = F.lower(graw)
    vals["gender"] = (F.when(~bt.rlike(g), F.lit(""))
                       .when(gl.contains("female"), F.lit("Female"))
                       .when(gl.contains("male"), F.lit("Male")).otherwise(graw))
    order = ("serial", "name", "father_husband_name", "relation_type", "house_no", "age", "gender", "voter_id")
    return F.struct(*[vals[k].alias(k) for k in order])


def spread_for_cpu(df: DataFrame) -> DataFrame:
    """CPU-heavy per-row parsing of an input with fewer partitions than the
    cluster's cores (a small file is one split) is spread round-robin first;
    inputs that already have enough splits are left alone (no extra shuffle
    at scale). Streaming inputs are left as they are."""
    if df.isStreaming:
        return df
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def parse_voters(df: DataFrame, text: str, keep: list[str]) -> DataFrame:
    """F33 + W5: one row per voter block that has a name, with its block
    number inside the page."""
    df = spread_for_cpu(df)
    blocks = split_blocks(clean_lines(text))
    x = df.select(*keep, F.posexplode(blocks).alias("block_no", "__b"))
    return (x.select(*keep, "block_no", parse_block(F.col("__b")).alias("__v"))
             .select(*keep, "block_no", "__v.*").where(F.col("name") != ""))


#: Entities the page texts may use, the ampersand last.
ENTITIES = (("&nbsp;", " "), ("&#160;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#34;", '"'),
            ("&apos;", "'"), ("&#39;", "'"), ("&#x27;", "'"), ("&#38;", "&"), ("&amp;", "&"))


def unescape(text) -> Column:
    """Character references of HTML as characters."""
    t = _c(text)
    for name, char in ENTITIES:
        t = F.replace(t, F.lit(name), F.lit(char))
    return t


def html_table_rows(html, min_cells: int = 7, take=(1, 2, 5, 6), table_class: str | None = None) -> Column:
    """Table rows as structs of the chosen cells' text (tags removed,
    entities decoded, stripped); rows with fewer than ``min_cells`` cells are
    skipped. Tags may be in either case and ``</td>`` / ``</tr>`` may be
    missing: a row or cell also ends where the next one or the table's end
    begins. With ``table_class`` only the first table of that class counts."""
    page = _c(html)
    if table_class is not None:
        page = F.regexp_extract(page, rf"(?is)<table\b[^>]*\bclass\s*=\s*[\"']?[^\"'>]*\b{table_class}\b[^>]*>(.*?)(?:</table|\z)", 1)
    rows = F.regexp_extract_all(page, F.lit(r"(?is)<tr\b[^>]*>(.*?)(?=</tr|<tr\b|</table|</tbody|\z)"), 1)
    cells = F.transform(rows, lambda r: F.regexp_extract_all(r, F.lit(r"(?is)<td\b[^>]*>(.*?)(?=</td|<td\b|\z)"), 1))
    ok = F.filter(cells, lambda c: F.size(c) >= min_cells)
    names = ("candidate", "party", "total_votes", "vote_share")

    def cell(c, i):
        return strip_all(unescape(F.regexp_replace(F.element_at(c, i + 1), r"<[^>]+>", "")))
    return F.transform(ok, lambda c: F.struct(*[cell(c, i).alias(n) for i, n in zip(take, names)]))


OPTION = r"""(?is)<option\b[^>]*?\bvalue\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))[^>]*>(.*?)(?=</option|<option\b|</select|(?![\s\S]))"""


def option_list(html, pattern: str = OPTION) -> Column:
    """(code, name) pairs of a dropdown; blank codes skipped. Values may
    be in double, single or no quotes, tags in either case, end tags missing.
    The last group of ``pattern`` is the name, the ones before it the code."""
    groups = re.compile(pattern).groups

    def every(i):
        return F.regexp_extract_all(_c(html), F.lit(pattern), i)

    code = every(1)
    for i in range(2, groups):
        code = F.zip_with(code, every(i), lambda a, b: F.concat(F.coalesce(a, F.lit("")), F.coalesce(b, F.lit(""))))
    pairs = F.arrays_zip(F.transform(code, unescape).alias("code"),
                         F.transform(every(groups), lambda n: unescape(n)).alias("name"))
    return F.filter(pairs, lambda p: strip_all(p["code"]) != "")


def parse_answer(response, schema: T.StructType | str) -> Column:
    """F24 + F25: drop think blocks, take first ``{`` to last ``}``, parse
    strictly (trailing text after the object fails, as with ``json.loads``;
    of a repeated key the last value counts). Returns a struct: the schema's
    fields (null unless parsed), ``thought``, ``error`` (``no_json`` /
    ``parse_failed`` / null) and ``raw``."""
    r = _c(response)
    span = json_span(r)
    whole = F.from_json(F.concat(F.lit('{"v":'), span, F.lit("}")), "v string, bad string",
                        {"mode": "PERMISSIVE", "allowSingleQuotes": "false", "columnNameOfCorruptRecord": "bad"})
    valid = span.isNotNull() & whole["bad"].isNull()
    shape = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    parsed = F.from_json(span, shape, {"mode": "PERMISSIVE", "allowSingleQuotes": "false"})
    fields = shape.fieldNames()
    err = F.when(span.isNull(), F.lit("no_json")).when(~valid, F.lit("parse_failed"))
    return F.struct(*[F.when(valid, parsed[f]).alias(f) for f in fields],
                    strip_all(think_text(r)).alias("thought"), err.alias("error"),
                    F.when(err.isNotNull(), strip_all(remove_think(r))).alias("raw"))


def merge_nonempty(new, old) -> Column:
    """take the parsed value only when it is non-empty."""
    return F.coalesce(F.nullif(_c(new).cast("string"), F.lit("")), _c(old))
