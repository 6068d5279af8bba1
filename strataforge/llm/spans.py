"""Regular-expression spans with code-point positions, as Spark SQL columns.

A pattern's matches are bracketed with two control characters, the text is
split at them, and the running length of the pieces gives the positions.
Positions count code points, ends are exclusive. Control characters 02 and 03
of the text itself are read as 04, which no pattern here tells apart.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN, SHUT, OTHER = "\x02", "\x03", "\x04"
#: Characters of context kept before and after a match.
BEFORE, AFTER = 32, 16

SPAN = "struct<start:int,end:int,match:string,before:string,after:string>"


def plain(text: Column) -> Column:
    """The text with the bracket characters read as 04 (lengths unchanged)."""
    has = F.contains(text, F.lit(OPEN)) | F.contains(text, F.lit(SHUT))
    return F.when(has, F.translate(text, OPEN + SHUT, OTHER + OTHER)).otherwise(text)


def with_spans(df: DataFrame, text_col: str, patterns: dict[str, str]) -> DataFrame:
    """Add one array<SPAN> column per name: the leftmost non-overlapping
    matches of its pattern (no unnamed groups needed; group 0 is the span).
    ``text_col`` must have gone through ``plain``."""
    keep = df.columns
    cut = {k: f"__{k}" for k in patterns}
    marked = df.select(*keep, *[
        F.regexp_replace(F.col(text_col), F.lit(f"({p})"), F.lit(f"{OPEN}$1{SHUT}")).alias(cut[k])
        for k, p in patterns.items()])
    pieces = marked.select(*keep, *[
        F.when(F.contains(F.col(c), F.lit(OPEN)), F.split(F.col(c), f"[{OPEN}{SHUT}]")).alias(c) for c in cut.values()])
    offs = pieces.select("*", *[
        F.expr(f"CASE WHEN {c} IS NOT NULL THEN aggregate({c}, array(0), "
               f"(a, p) -> array_append(a, element_at(a, -1) + char_length(p))) END").alias(f"{c}_at")
        for c in cut.values()])
    return offs.select(*keep, *[
        F.expr(f"""coalesce(transform(filter(sequence(0, size({c}) - 1), k -> k % 2 = 1), k -> named_struct(
                   'start', get({c}_at, k), 'end', get({c}_at, k + 1), 'match', get({c}, k),
                   'before', substring(get({c}, k - 1), -{BEFORE}, {BEFORE}),
                   'after', substring(get({c}, k + 1), 1, {AFTER}))), CAST(array() AS array<{SPAN}>))""").alias(k)
        for k, c in cut.items()])


def label(kind: str, order: int, spans: str, keep: str = "true") -> str:
    """SQL: spans of one kind as array<struct<start, order, kind, end>>; ``keep`` is a condition on ``s``."""
    return (f"transform(filter({spans}, s -> {keep}), s -> named_struct('start', s.start, 'rank', {order}, "
            f"'kind', '{kind}', 'end', s.end))")


def joined(spans: str) -> str:
    """SQL: ``kind:start:end`` by start, then kind, comma-joined."""
    return f"array_join(transform(array_sort({spans}), s -> concat(s.kind, ':', s.start, ':', s.end)), ',')"
