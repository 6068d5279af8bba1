"""Stratification frame operators (SURVEY §2.3-2.5: A1-A3, J1-J3, W1, W2,
O1; lifecycle §3.1).

Group totals are built as an aggregate joined back, not as a window over the
raw rows: the aggregate combines map-side, so a key holding a third of all
rows never lands in one task; the aggregate is broadcast after a row-count
check (``joins.join_bounded``), so the rows are not shuffled for the join,
and above the bound the shuffle join keeps AQE's skew splitting.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strataforge.functions.bins import right_closed_bins
from strataforge.operators.joins import join_bounded


def _cols(keys) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def with_group_total(df: DataFrame, keys, value: str, total_col: str = "group_total") -> DataFrame:
    """``sum(value)`` of the row's group on every row. Null keys form
    their own group (null-safe join)."""
    keys = _cols(keys)
    totals = df.groupBy(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)]) \
               .agg(F.sum(value).alias(total_col))
    cond = [F.col(k).eqNullSafe(F.col(f"__k{i}")) for i, k in enumerate(keys)]
    return join_bounded(df, totals, cond, "left").select(*df.columns, total_col)


def with_group_share(df: DataFrame, keys, value: str, share_col: str = "share",
                     keep_total: bool = False) -> DataFrame:
    """Value / group total; a zero total gives null."""
    out = with_group_total(df, keys, value, "__total")
    out = out.withColumn(share_col, F.try_divide(F.col(value), F.col("__total")))
    return out if keep_total else out.drop("__total")


def share_within(agg: DataFrame, keys, value: str, share_col: str = "share") -> DataFrame:
    """W1 + W2 on an AGGREGATED table (strata, booths, seat x party): value /
    sum(value) over the group as a window. A group there holds at most the
    number of level combinations, not rows, so the window is bounded, and
    the aggregate is not recomputed for a separate totals branch. (For
    row-level data use ``with_group_share``.)"""
    keys = _cols(keys)
    return agg.withColumn(share_col, F.try_divide(F.col(value), F.sum(value).over(Window.partitionBy(*keys))))


def group_mode(df: DataFrame, keys, value: str, out_col: str = "mode") -> DataFrame:
    """A3: most frequent non-null value per group; ties give the smallest.
    Groups with no value are absent (callers fall back by ``coalesce``).
    ``mode`` keeps a value->count map per group and combines map-side."""
    keys = _cols(keys)
    return (df.where(F.col(value).isNotNull())
              .groupBy(*keys).agg(F.mode(value, deterministic=True).alias(out_col)))


def fill_from_group_mode(df: DataFrame, keys, value: str, fallback=None) -> DataFrame:
    """Null ``value`` takes its group's mode, else ``fallback``.
    Rows with a null key find no group (as a dict lookup on NaN misses)."""
    keys = _cols(keys)
    modes = group_mode(df, keys, value, "__mode")
    modes = modes.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)], "__mode")
    cond = [F.col(k) == F.col(f"__k{i}") for i, k in enumerate(keys)]
    filled = F.coalesce(F.col(value), F.col("__mode"))
    if fallback is not None:
        filled = F.coalesce(filled, fallback if isinstance(fallback, Column) else F.lit(fallback))
    cols = [filled.alias(value) if c == value else F.col(c) for c in df.columns]
    return join_bounded(df, modes, cond, "left").select(*cols)


def first_non_null(df: DataFrame, keys, value: str, order_col: str, out_col: str | None = None) -> DataFrame:
    """A2: per group, the non-null ``value`` of the earliest row by
    ``order_col`` (deterministic ``first``); null keys are dropped."""
    keys = _cols(keys)
    out_col = out_col or value
    base = df.where(F.col(value).isNotNull())
    for k in keys:
        base = base.where(F.col(k).isNotNull())
    return base.groupBy(*keys).agg(F.min_by(value, order_col).alias(out_col))


def lookup_left(df: DataFrame, dim: DataFrame, on: Sequence[tuple[str, str]] | str,
                defaults: dict | None = None, order_col: str | None = None) -> DataFrame:
    """Left lookup; the dimension is first reduced to one row
    per key (the row with the largest ``order_col`` wins, i.e. the last
    duplicate). Misses take ``defaults``."""
    pairs = [(on, on)] if isinstance(on, str) else list(on)
    dkeys = [d for _, d in pairs]
    if order_col is not None:
        vals = [c for c in dim.columns if c not in dkeys and c != order_col]
        dim = dim.groupBy(*dkeys).agg(
            F.max_by(F.struct(*vals), order_col).alias("__v")).select(*dkeys, "__v.*")
    vals = [c for c in dim.columns if c not in dkeys]
    d = dim.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(dkeys)], *vals)
    cond = [df[l] == d[f"__k{i}"] for i, (l, _) in enumerate(pairs)]
    out = df.join(d, cond, "left").select(df["*"], *[d[v] for v in vals])
    for c, v in (defaults or {}).items():
        out = out.withColumn(c, F.coalesce(F.col(c), F.lit(v)))
    return out


def booth_weights(rows: DataFrame, area: str = "eroll_no", booth: str = "booth_no",
                  total: str = "total_individuals", order_col: str = "voter_id") -> DataFrame:
    """A2 + W1 + W2: one row per booth with its first known head count and
    its share of the area's summed head counts."""
    booths = first_non_null(rows, [area, booth], total, order_col)
    return (share_within(booths, area, total, "booth_weight")
            .select(area, booth, "booth_weight"))


def booth_table(rows: DataFrame, area: str = "eroll_no", booth: str = "booth_no",
                total: str = "total_individuals", area_type: str = "area_type",
                order_col: str = "voter_id") -> DataFrame:
    """A2 + A3 + W1 + W2 in ONE aggregate pass over the rows: per booth the
    area-type mode (ties -> smallest), the first non-null head count (rows
    with a null count have a null ordering key, which ``min_by`` skips) and
    the booth's share of the area's summed counts. Null keys are dropped."""
    b = (rows.where(F.col(area).isNotNull() & F.col(booth).isNotNull())
             .groupBy(area, booth)
             .agg(F.mode(area_type, deterministic=True).alias("__mode"),
                  F.min_by(F.col(total), F.when(F.col(total).isNotNull(), F.col(order_col))).alias("__first")))
    return share_within(b, area, "__first", "booth_weight").drop("__first")


def stratification_frame(rows: DataFrame,
                         strata=("eroll_no", "constituency_name", "gender", "age_band",
                                 "area_type", "R", "G", "SG"),
                         area: str = "eroll_no", booth: str = "booth_no",
                         age: str = "age", total: str = "total_individuals",
                         area_type: str = "area_type", order_col: str = "voter_id",
                         include_lowest: bool = False) -> DataFrame:
    """Entry A (§3.1): labelled voter rows to strata with counts, booth-
    weighted size and share of the area.

    Steps: age bands (F16) -> booth table (mode, first head count, weight)
    from one aggregate -> joined back: area type filled (J2), weight attached
    (J3) -> roll-up keeping null keys (A1) -> share of area (W2). The rows
    are read twice (booth aggregate, roll-up); ordering (O1) is left to the
    sink.
    """
    strata = list(strata)
    bt = booth_table(rows, area, booth, total, area_type, order_col) \
        .select(F.col(area).alias("__a"), F.col(booth).alias("__b"), "__mode", "booth_weight")
    df = rows.withColumn("age_band", right_closed_bins(F.col(age), include_lowest=include_lowest))
    df = join_bounded(df, bt, (F.col(area) == F.col("__a")) & (F.col(booth) == F.col("__b")), "left")
    df = df.withColumn(area_type, F.coalesce(F.col(area_type), F.col("__mode"))).drop("__a", "__b", "__mode")
    frame = (df.groupBy(*strata)
               .agg(F.count("booth_weight").alias("n_individuals"),
                    F.coalesce(F.sum("booth_weight"), F.lit(0.0)).alias("weighted_n")))
    return share_within(frame, area, "weighted_n", "stratum_share")
