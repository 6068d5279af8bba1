"""Binning and recodes (F16, F17, F30, F38 helpers)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Age band edges and labels, right-closed bins (18,25] ...
AGE_EDGES = (18, 25, 35, 45, 60)
AGE_LABELS = ("18-25", "26-35", "36-45", "46-60", "60+")


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def right_closed_bins(c, edges=AGE_EDGES, labels=AGE_LABELS, include_lowest: bool = False) -> Column:
    """F16: (e0,e1] (e1,e2] ... (e_last, inf); outside gives null.

    ``include_lowest`` puts the first edge itself in the first bin (pandas
    ``include_lowest``); off by default as in the reference (Q9: age 18 has
    no band). ``Bucketizer`` is left-closed and would shift every edge.
    """
    x = _c(c)
    bounds = list(edges) + [None]
    expr = None
    for i, label in enumerate(labels):
        lo, hi = bounds[i], bounds[i + 1]
        cond = (x >= lo) if (i == 0 and include_lowest) else (x > lo)
        if hi is not None:
            cond = cond & (x <= hi)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(None).cast("string"))


def band_order(c, labels=AGE_LABELS) -> Column:
    """Explicit sort key for an ordered category (1-based, null when not a
    label)."""
    pos = F.array_position(F.array(*[F.lit(v) for v in labels]), _c(c))
    return F.when(pos > 0, pos.cast("int"))


def fix_values(c, mapping: dict) -> Column:
    """literal value fix-ups, others unchanged."""
    x = _c(c)
    expr = None
    for k, v in mapping.items():
        expr = F.when(x == k, F.lit(v)) if expr is None else expr.when(x == k, F.lit(v))
    return x if expr is None else expr.otherwise(x)


def index_in_vocab(c, vocab, unknown: str | None = None) -> Column:
    """0-based position of the value in ``vocab``; an unknown value takes
    the position of ``unknown`` (or null when no fallback is named)."""
    arr = F.array(*[F.lit(v) for v in vocab])
    pos = F.array_position(arr, _c(c)) - 1
    if unknown is None:
        return F.when(pos >= 0, pos.cast("int"))
    return F.when(pos >= 0, pos).otherwise(F.lit(list(vocab).index(unknown))).cast("int")
