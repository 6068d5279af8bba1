"""String expressions (SURVEY §2.8 F1-F6, F10, F11, F24, F25, F28, F29,
F31, F39, F40). All are Catalyst expressions; none is a Python UDF.

Java regexes are not Unicode-aware for ``\\d \\s \\b`` unless ``(?U)`` is
set, while Python's ``re`` is; patterns that must behave like Python's pin
``(?U)``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Bengali digits zero..nine and their ASCII counterparts.
BENGALI_DIGITS = "০১২৩৪৫৬৭৮৯"
ASCII_DIGITS = "0123456789"
# Years never taken as a head count.
EXCLUDED_YEARS = (2025, 2026)


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_all(c) -> Column:
    """trim every Unicode white space at both ends (Python ``strip``)."""
    return F.regexp_replace(_c(c), r"(?U)^\s+|\s+$", "")


def blank_to_null(c) -> Column:
    """Blank or white-space-only text becomes null (one null, Q12)."""
    s = strip_all(c)
    return F.when(s == "", F.lit(None).cast("string")).otherwise(_c(c))


def title_case(c) -> Column:
    """Python ``str.title``: capitalise every run of letters, so
    ``dabgram-fulbari`` gives ``Dabgram-Fulbari`` (``initcap`` splits on
    blanks only)."""
    runs = F.regexp_extract_all(_c(c), F.lit(r"(\p{L}+|[^\p{L}]+)"), 1)
    return F.array_join(F.transform(runs, lambda r: F.initcap(r)), "")


def regex_capture(c, pattern: str, group: int = 1, miss_null: bool = True) -> Column:
    """first match of ``pattern``; a miss gives null (or "" like Python
    code that returns an empty string)."""
    v = F.regexp_extract(_c(c), pattern, group)
    if miss_null:
        return F.when(F.regexp_like(_c(c), F.lit(pattern)), v)
    return v


def strip_trailing_code(c) -> Column:
    """drop a trailing ``- 12`` style code."""
    return F.regexp_replace(_c(c), r"\s*-\s*\d+\s*$", "")


def match_key(c) -> Column:
    """name key for matching: strip, lower, hyphen to blank, no dots."""
    return F.regexp_replace(F.translate(F.lower(strip_all(c)), "-", " "), r"\.", "")


def ascii_digits(c) -> Column:
    """Bengali digits to ASCII."""
    return F.translate(_c(c), BENGALI_DIGITS, ASCII_DIGITS)


def max_number_in_text(c, low: int = 0, high: int = 99999,
                       excluded=EXCLUDED_YEARS) -> Column:
    """largest whole number in the text with low < n < high and n not an
    excluded year, after native digits become ASCII; none gives ""."""
    nums = F.transform(
        F.regexp_extract_all(ascii_digits(c), F.lit(r"(?U)\b(\d+)\b"), 1),
        lambda s: s.try_cast("bigint"),
    )
    ok = F.filter(nums, lambda n: (n > low) & (n < high) & ~n.isin(*excluded))
    best = F.array_max(ok)
    return F.coalesce(best.cast("string"), F.lit(""))


def remove_think(c) -> Column:
    """drop ``<think>...</think>`` blocks (non-greedy, across lines)."""
    return F.regexp_replace(_c(c), r"(?s)<think>.*?</think>", "")


def think_text(c) -> Column:
    """text of the first think block, null when absent."""
    return regex_capture(c, r"(?s)<think>(.*?)</think>", 1)


def json_span(c) -> Column:
    """first ``{`` to last ``}`` after think blocks are removed; null
    when there is none."""
    return regex_capture(remove_think(c), r"(?s)\{.*\}", 0)


def party_candidate(party, candidate, none_text: str = "No candidate") -> Column:
    """``party - candidate``; both blank gives ``none_text``; the
    separator stays when only one side is blank."""
    p = F.coalesce(strip_all(party), F.lit(""))
    k = F.coalesce(strip_all(candidate), F.lit(""))
    return F.when((p == "") & (k == ""), F.lit(none_text)).otherwise(F.concat(p, F.lit(" - "), k))


def sep_concat(a, b, sep: str = " [SEP] ") -> Column:
    """``a + sep + b``; null when either side is null."""
    return F.concat(_c(a), F.lit(sep), _c(b))


def padded_label(prefix: str, n, width: int = 3) -> Column:
    """``voter_p007`` style labels."""
    return F.format_string(f"{prefix}%0{width}d", _c(n).cast("int"))


def text_lines(c) -> Column:
    """split into lines, trim each, drop blank lines."""
    return F.filter(F.transform(F.split(_c(c), "\n"), lambda x: strip_all(x)), lambda x: x != "")


def base_name(path) -> Column:
    """last path element."""
    return F.element_at(F.split(_c(path), "/"), -1)


def drop_extension(c, ext: str = "pdf") -> Column:
    """remove a trailing extension, any case."""
    return F.regexp_replace(_c(c), rf"(?i)\.{ext}$", "")


def render_template(template: str, **values) -> Column:
    """a caller's text template with ``{name}`` placeholders filled from
    columns or expressions (``format_string`` underneath, so it stays a JVM
    expression); literal ``%`` is kept. A null value renders as "null", so
    callers coalesce first."""
    import re as _re

    names = _re.findall(r"\{(\w+)\}", template)
    fmt = _re.sub(r"\{(\w+)\}", "%s", template.replace("%", "%%"))
    return F.format_string(fmt, *[_c(values[n]).cast("string") for n in names])
