"""Numeric expressions.

Spark 4 runs in ANSI mode: bad casts and division by zero raise, where pandas
and R give NaN. Every cast here is ``try_cast`` and every division guarded.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_double_or_zero(c) -> Column:
    """F8: text to number, unreadable gives 0."""
    return F.coalesce(_c(c).try_cast("double"), F.lit(0.0))


def count_text_to_long(c) -> Column:
    """``"1,234"`` to 1234; unreadable gives 0."""
    return F.coalesce(F.translate(_c(c), ",", "").try_cast("bigint"), F.lit(0).cast("bigint"))


def decorated_number(c) -> Column:
    """``"82.16%"``, ``"|39250"`` and ``"1,234"`` to double; null if
    still unreadable."""
    return F.regexp_replace(_c(c), r"[%|,\s]", "").try_cast("double")


def percent_repair(c) -> Column:
    """values above 1 are percents; null stays null."""
    return F.when(_c(c) > 1, _c(c) / 100.0).otherwise(_c(c))


def row_sum(*cols) -> Column:
    """sum across columns with nulls as 0."""
    return reduce(lambda a, b: a + b, [F.coalesce(_c(c), F.lit(0.0)) for c in cols])


def row_normalise_scoped(cols, in_scope: Column, percent_sum: float = 5.0) -> dict:
    """rows whose sum exceeds ``percent_sum`` are percents (/100); rows
    in scope with a positive sum are divided by it; rows out of scope get 0.
    Nulls stay null in scope (as NaN does in pandas). Returns
    ``{name: expression}``."""
    s = row_sum(*cols)
    scaled = {c: F.when(s > percent_sum, _c(c) / 100.0).otherwise(_c(c)) for c in cols}
    s2 = row_sum(*scaled.values())
    return {c: F.when(~F.coalesce(in_scope, F.lit(False)), F.lit(0.0))
            .when(s2 > 0, scaled[c] / s2).otherwise(scaled[c]) for c in cols}


def row_normalise(cols) -> dict:
    """divide by the row sum (nulls as 0); a zero sum divides by 1."""
    s = row_sum(*cols)
    den = F.when(s == 0, F.lit(1.0)).otherwise(s)
    return {c: F.coalesce(_c(c), F.lit(0.0)) / den for c in cols}


def inv_logit(c) -> Column:
    """F20."""
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-_c(c)))


def safe_ratio(num, den, zero_value: float = 0.5) -> Column:
    """num / den with 0/0 (and x/0) giving ``zero_value``."""
    return F.when(_c(den) == 0, F.lit(zero_value)).otherwise(_c(num) / _c(den))


def clamp(c, lo=None, hi=None) -> Column:
    """clip to [lo, hi]."""
    x = _c(c)
    if lo is not None:
        x = F.greatest(x, F.lit(lo))
    if hi is not None:
        x = F.least(x, F.lit(hi))
    return x


def ceil_fraction_clamped(n, pct: float, minimum: int = 1) -> Column:
    """k = clamp(ceil(n * pct), minimum, n)."""
    return F.least(F.greatest(F.ceil(_c(n) * F.lit(pct)), F.lit(minimum)).cast("bigint"),
                   _c(n).cast("bigint"))
