"""Profiling and set operators (SURVEY §2.4 A5-A9, A11, A18, A19, A21,
A24-A28; §2.7 U1-U5; F38).

All are single aggregations that combine map-side. Whole-column exact
quantiles are computed from distributed global ranks (a global
``percentile`` would merge every distinct value in one task);
``approx=True`` switches to ``percentile_approx``.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def value_counts(df: DataFrame, col: str, dropna: bool = True) -> DataFrame:
    """A5: counts per value, largest first (``orderBy`` only at the sink)."""
    d = df.where(F.col(col).isNotNull()) if dropna else df
    return d.groupBy(col).agg(F.count(F.lit(1)).alias("n"))


def describe(df: DataFrame, cols: Sequence[str], approx: bool = False) -> DataFrame:
    """One row per column: count, mean, sample sd, min, quartiles
    (linear interpolation), max. Quartiles are exact and distributed
    (``sampling.exact_quantiles``: global ranks, no single-task merge of all
    distinct values); ``approx=True`` uses ``percentile_approx`` instead."""
    from strataforge.operators.sampling import exact_quantiles

    parts = []
    for c in cols:
        x = F.col(c).cast("double")
        if approx:
            q = F.percentile_approx(x, [0.25, 0.5, 0.75], 100000)
        else:
            q = F.array(*[F.lit(v).cast("double") for v in exact_quantiles(df, c, [0.25, 0.5, 0.75])])
        parts.append(df.agg(F.count(x).alias("count"), F.avg(x).alias("mean"),
                            F.stddev_samp(x).alias("std"), F.min(x).alias("min"), F.max(x).alias("max"))
                     .select(F.lit(c).alias("column"), "count", "mean", "std", "min",
                             q[0].alias("p25"), q[1].alias("p50"), q[2].alias("p75"), "max"))
    return reduce(DataFrame.unionByName, parts)


def null_counts(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """One pass counting nulls of every column, stacked to
    (column, n_null)."""
    cols = list(cols or df.columns)
    wide = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    return wide.unpivot([], cols, "column", "n_null")


def named_aggs(df: DataFrame, group: str, value: str) -> DataFrame:
    """Rows, total and mean per group."""
    return df.groupBy(group).agg(F.count(F.lit(1)).alias("rows"), F.sum(value).alias("total"),
                                 F.avg(value).alias("mean"))


def distinct_counts(df: DataFrame, cols: Sequence[str], approx: bool = False) -> DataFrame:
    """Distinct non-null values per column (``approx`` uses HLL++)."""
    f = F.approx_count_distinct if approx else F.count_distinct
    return df.agg(*[f(F.col(c)).alias(c) for c in cols]).unpivot([], list(cols), "column", "n_distinct")


def duplicate_rows(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Rows beyond the first of each identical group (nulls equal)."""
    cols = list(cols or df.columns)
    g = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("__n"))
    return g.agg(F.coalesce(F.sum(F.col("__n") - 1), F.lit(0)).cast("bigint").alias("duplicates"),
                 F.count(F.lit(1)).alias("distinct_rows"))


def crosstab_margins(df: DataFrame, a: str, b: str, all_label: str = "All") -> DataFrame:
    """Cross table with margins in long form via ``cube``; ``pivot`` at
    the sink turns it wide."""
    g = df.cube(a, b).agg(F.count(F.lit(1)).alias("n"), F.grouping_id().alias("__g"))
    return g.select(F.when(F.col("__g").bitwiseAND(2) == 2, F.lit(all_label)).otherwise(F.col(a).cast("string")).alias(a),
                    F.when(F.col("__g").bitwiseAND(1) == 1, F.lit(all_label)).otherwise(F.col(b).cast("string")).alias(b),
                    "n")


def presence(sets: dict[str, DataFrame], col: str = "name") -> DataFrame:
    """One row per name with a 0/1 flag per set and ``in_all``; the
    intersection is ``in_all = 1``, each set minus the common part is its
    flag = 1 and ``in_all = 0``. One shuffle for any number of sets."""
    tagged = [d.select(F.col(col).alias("name"), F.lit(k).alias("src")) for k, d in sets.items()]
    u = reduce(DataFrame.unionByName, tagged).distinct()
    g = u.groupBy("name").agg(*[F.max(F.when(F.col("src") == k, 1).otherwise(0)).alias(f"in_{k}")
                                for k in sets],
                              F.count_distinct("src").alias("__n"))
    return g.select("name", *[f"in_{k}" for k in sets],
                    (F.col("__n") == len(sets)).cast("int").alias("in_all"))


def union_by_name(*dfs: DataFrame) -> DataFrame:
    """Stack by column name; missing columns become null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)


def level_ids(*cols_by_df: tuple[DataFrame, str]) -> DataFrame:
    """Sorted union of the distinct values of several columns with
    a 1-based id. The window runs over the distinct levels only (a factor's
    level list), never over the rows."""
    vals = reduce(DataFrame.union, [d.select(F.col(c).cast("string").alias("level")) for d, c in cols_by_df])
    lv = vals.where(F.col("level").isNotNull()).distinct()
    return lv.withColumn("level_id", F.row_number().over(Window.orderBy("level")).cast("int"))


def corr_line(df: DataFrame, x: str, y: str) -> DataFrame:
    """A19 + A26: R squared over complete pairs and the OLS line of y on x."""
    d = df.where(F.col(x).isNotNull() & F.col(y).isNotNull())
    return d.agg(F.pow(F.corr(x, y), 2).alias("r2"), F.regr_slope(y, x).alias("slope"),
                 F.regr_intercept(y, x).alias("intercept"), F.count(F.lit(1)).alias("n_pairs"))


def frame_profile(df: DataFrame) -> DataFrame:
    """One row per column: position, name, type, non-null count and row
    count (type names come from the schema, counts from one pass)."""
    cols = df.columns
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    counts = df.agg(F.count(F.lit(1)).alias("__rows"), *[F.count(F.col(c)).alias(c) for c in cols])
    long = counts.unpivot(["__rows"], cols, "column", "non_null")
    tmap = F.create_map(*[x for c in cols for x in (F.lit(c), F.lit(types[c]))])
    pmap = F.create_map(*[x for i, c in enumerate(cols) for x in (F.lit(c), F.lit(i + 1))])
    return long.select(F.element_at(pmap, F.col("column")).alias("position"), "column",
                       F.element_at(tmap, F.col("column")).alias("dtype"), "non_null",
                       F.col("__rows").alias("rows"))
