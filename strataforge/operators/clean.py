"""Projection, filter and recode operators.

Filters are plain predicates so Catalyst pushes them to the scan; value maps
are literal ``CASE``/map expressions (bounded, fixed lists) or, for caller
tables of unknown size, a left join that AQE may broadcast.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataforge.functions.text import strip_all

# Gender spellings recoded to two labels. The list is compared
# with the lower-cased value, so its "Mais" entry can never match (as in the
# reference).
MALE_VARIANTS = ("male", "maie", "main", "mae", "mal", "mael", "mlae", "m", "mare", "mole", "Mais")
FEMALE_VARIANTS = ("female", "fermain", "femal", "famale", "femle", "feamle", "f", "fe")


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def conform(df: DataFrame, columns: Sequence[str], blank: str = "") -> DataFrame:
    """Select ``columns`` in order; absent ones become ``blank``."""
    have = set(df.columns)
    return df.select(*[F.col(c) if c in have else F.lit(blank).alias(c) for c in columns])


def drop_if_present(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """P2 (``DataFrame.drop`` ignores absent names)."""
    return df.drop(*columns)


def rename(df: DataFrame, mapping: dict, aliases: dict | None = None) -> DataFrame:
    """Rename; ``aliases`` apply only when the target is not there yet."""
    m = {k: v for k, v in mapping.items() if k in df.columns}
    for src, dst in (aliases or {}).items():
        if src in df.columns and dst not in df.columns:
            m[src] = dst
    return df.withColumnsRenamed(m)


def complete_cases(df: DataFrame, subset: Sequence[str]) -> DataFrame:
    """P4."""
    return df.dropna(subset=list(subset))


def in_list(c, values) -> Column:
    """P5: ``isin`` for a literal list (long caller lists: use a semi join)."""
    return _c(c).isin(list(values))


def contains_ci(c, needle: str) -> Column:
    """Case-insensitive substring, null -> false."""
    return F.coalesce(F.lower(_c(c)).contains(needle.lower()), F.lit(False))


def masked_update(df: DataFrame, cond: Column, column: str, value) -> DataFrame:
    """P10: ``df.loc[cond, column] = value``."""
    v = value if isinstance(value, Column) else F.lit(value)
    return df.withColumn(column, F.when(F.coalesce(cond, F.lit(False)), v).otherwise(F.col(column)))


def map_expr(mapping: dict) -> Column:
    return F.create_map(*[x for k, v in mapping.items() for x in (F.lit(k), F.lit(v))])


def replace_map(c, mapping: dict) -> Column:
    """Replace through a mapping, unmatched values unchanged."""
    return F.coalesce(F.try_element_at(map_expr(mapping), _c(c)), _c(c))


def replace_by_table(df: DataFrame, column: str, mapping: DataFrame,
                     key: str = "old", value: str = "new") -> DataFrame:
    """P11 for a mapping table of any size (AQE picks broadcast or not)."""
    m = mapping.select(F.col(key).alias("__old"), F.col(value).alias("__new"))
    out = df.join(m, df[column] == m["__old"], "left")
    return out.select(*[F.coalesce(m["__new"], df[c]).alias(c) if c == column else df[c]
                        for c in df.columns])


def decode_map(c, mapping: dict, default: str = "Unknown") -> Column:
    """Decode with a default; null and unknown give the default."""
    return F.coalesce(F.try_element_at(map_expr(mapping), F.coalesce(_c(c).cast("string"), F.lit(""))),
                      F.lit(default))


def three_way(cond_yes: Column, cond_no: Column) -> Column:
    """1 / 0 / null (not in scope)."""
    return F.when(cond_yes, F.lit(1)).when(cond_no, F.lit(0)).otherwise(F.lit(None).cast("int"))


def collapse_other(c, valid, other: str = "O") -> Column:
    """Values outside ``valid`` become ``other`` (null too)."""
    return F.when(_c(c).isin(list(valid)), _c(c)).otherwise(F.lit(other))


def starts_with(c, prefix: str) -> Column:
    """P15."""
    return _c(c).startswith(prefix)


def id_between(c, lo, hi) -> Column:
    """Inclusive range."""
    return _c(c).between(lo, hi)


def recode_gender(c, male: str = "Male", female: str = "Female") -> Column:
    """typo recode on the stripped, lower-cased value; others and null
    are kept as they are."""
    v = F.lower(strip_all(c))
    return (F.when(_c(c).isNull(), _c(c))
             .when(v.isin(list(MALE_VARIANTS)), F.lit(male))
             .when(v.isin(list(FEMALE_VARIANTS)), F.lit(female))
             .otherwise(_c(c)))
