"""Random draws and sampling (SURVEY §2.9 G1-G7, §2.5 W3, W4, W6, W9, W10,
§2.3 J14, §2.4 A4, §2.7 X4).

Every draw is a keyed hash of (seed, key), so results do not depend on
partitioning and a retried task recomputes the same rows.

Scale notes:
* Global running sums and row numbers never use an un-partitioned window.
  ``global_prefix`` range-partitions by the order key, takes running sums
  inside each partition, and adds the offsets of earlier partitions from a
  table with one row per partition.
* Per-group "k smallest hashes" (``hash_rank``) splits every group into
  sub-buckets by hash range, sized so no window partition exceeds
  ``target_rows``; a group holding a third of all rows is spread over many
  tasks. Ranks are exact: rank = rows in lower sub-buckets + rank inside.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strataforge.functions.hashing import uniform
from strataforge.operators.joins import join_bounded
from strataforge.session import ensure_checkpoint_dir


#: Equal stretches of a range partition's positions in ``weighted_draws``.
DRAW_CELLS = 64


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def bernoulli(p, seed, *keys) -> Column:
    """G1: 1 with probability p; null p gives null."""
    return F.when(_c(p).isNotNull(), (uniform(seed, *keys) < _c(p)).cast("int"))


def categorical(probs: dict, seed, *keys) -> Column:
    """One class name with probability proportional to the (negative or
    null -> 0) weights; all-zero rows give null."""
    ws = {k: F.greatest(F.coalesce(_c(v), F.lit(0.0)), F.lit(0.0)) for k, v in probs.items()}
    total = None
    for w in ws.values():
        total = w if total is None else total + w
    t = uniform(seed, *keys) * total
    expr, cum = None, None
    for name, w in ws.items():
        cum = w if cum is None else cum + w
        cond = t < cum
        expr = F.when(total <= 0, F.lit(None).cast("string")).when(cond, F.lit(name)) if expr is None \
            else expr.when(cond, F.lit(name))
    return expr.otherwise(F.lit(list(ws)[-1]))


def global_prefix(df: DataFrame, key, weight: str | None = None,
                  partitions: int | None = None) -> DataFrame:
    """Running sum of ``weight`` (or row number when no
    weight) in ``key`` order, as ``__lo`` (sum before the row) and ``__hi``
    (sum through the row), plus the range partition ``__pid``. ``key``
    must be unique. The partition-local result is checkpointed (reliable,
    under ``spark.checkpoint.dir``) so both uses below see the same
    partitions and a lost executor does not replay the range shuffle."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    p = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = [key] if isinstance(key, str) else list(key)
    w = F.col(weight).cast("double") if weight else F.lit(1.0)
    base = (df.withColumn("__w", w).repartitionByRange(p, *[F.col(k) for k in keys])
              .withColumn("__pid", F.spark_partition_id()))
    run = Window.partitionBy("__pid").orderBy(*keys).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = base.withColumn("__cum", F.sum("__w").over(run)).checkpoint(eager=True)
    tot = local.groupBy("__pid").agg(F.max("__cum").alias("__tot"))
    before = Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    off = tot.select("__pid", "__tot", F.coalesce(F.sum("__tot").over(before), F.lit(0.0)).alias("__off"))
    out = local.join(F.broadcast(off), "__pid")
    return out.withColumn("__hi", F.col("__off") + F.col("__cum")) \
              .withColumn("__lo", F.col("__hi") - F.col("__w")) \
              .drop("__cum", "__off", "__tot")


def weighted_draws(spark, rows: DataFrame, key: str, weight: str, n, seed,
                   draw_col: str = "draw") -> DataFrame:
    """G3 + J14: ``n`` draws with replacement, P(row) proportional to
    ``weight`` (rows with weight <= 0 or null never drawn). Returns
    (draw, key). ``n`` is the sample size (the feature, not a cap).

    Inverse CDF: draw d lands at t = u(seed, d) * W and picks the row with
    lo <= t < hi. Draws go to the range partition holding t by binary
    search over the partition start offsets (one value per partition);
    inside a partition rows and draws are merged in position order and each
    draw takes the last row start at or before it."""
    from pyspark.ml.feature import Bucketizer

    r = rows.select(key, weight).where(F.col(weight) > 0)
    pre = global_prefix(r, key, weight)
    starts = (pre.groupBy("__pid").agg(F.min("__lo").alias("s"), F.max("__hi").alias("e"))
                 .where(F.col("e") > F.col("s")).orderBy("__pid").collect())  # one row per partition
    if not starts:
        return spark.createDataFrame([], f"{draw_col} int, {key} {dict(rows.dtypes)[key]}")
    total = float(max(s["e"] for s in starts))
    splits = [-float("inf")] + [float(s["s"]) for s in starts] + [float("inf")]
    pid_of = F.create_map(*[x for i, s in enumerate(starts) for x in (F.lit(float(i + 1)), F.lit(s["__pid"]))])
    d = spark.range(1, int(n) + 1)
    d = d.select(F.col("id").cast("int").alias(draw_col)).withColumn("__t", uniform(seed, draw_col) * F.lit(total))
    d = Bucketizer(splits=splits, inputCol="__t", outputCol="__b").transform(d)
    d = d.select(draw_col, F.col("__t").alias("__pos"), F.element_at(pid_of, F.col("__b")).alias("__pid"))
    rk = pre.select(F.col(key).alias("__key"), F.col("__lo").alias("__pos"), "__pid")

    # A heavy row holds the draws of a wide stretch of positions, so a
    # partition's positions are cut into equal cells and the merge runs per
    # cell; each cell starts with the last row that begins before it.
    low = F.create_map(*[x for s in starts for x in (F.lit(s["__pid"]), F.lit(float(s["s"])))])
    wide = F.create_map(*[x for s in starts for x in (F.lit(s["__pid"]), F.lit(float(s["e"]) - float(s["s"])))])

    def cell(df: DataFrame) -> DataFrame:
        c = F.floor((F.col("__pos") - low[F.col("__pid")]) / wide[F.col("__pid")] * DRAW_CELLS)
        return df.withColumn("__cell", F.least(F.greatest(c, F.lit(0)), F.lit(DRAW_CELLS - 1)).cast("int"))

    rk, d = cell(rk.where(F.col("__pid").isin([s["__pid"] for s in starts]))), cell(d)
    last = rk.groupBy("__pid", "__cell").agg(F.max_by("__key", "__pos").alias("__last"))
    grid = spark.createDataFrame([(s["__pid"],) for s in starts], "__pid int").withColumn(
        "__cell", F.explode(F.sequence(F.lit(0), F.lit(DRAW_CELLS - 1))))
    before = Window.partitionBy("__pid").orderBy("__cell").rowsBetween(Window.unboundedPreceding, -1)
    carry = (grid.join(last, ["__pid", "__cell"], "left")
             .withColumn("__key", F.last("__last", ignorenulls=True).over(before)).where(F.col("__key").isNotNull())
             .select("__key", F.lit(-1.0).alias("__pos"), "__pid", "__cell"))
    u = (rk.unionByName(carry).withColumn(draw_col, F.lit(None).cast("int")).withColumn("__kind", F.lit(0))
           .unionByName(d.withColumn("__key", F.lit(None).cast(dict(pre.dtypes)[key])).withColumn("__kind", F.lit(1))))
    run = Window.partitionBy("__pid", "__cell").orderBy("__pos", "__kind").rowsBetween(Window.unboundedPreceding, 0)
    m = u.withColumn("__row", F.last("__key", ignorenulls=True).over(run)).where(F.col("__kind") == 1)
    return m.select(draw_col, F.col("__row").alias(key))


def top_per_group(df: DataFrame, group, order: Column, key: str) -> DataFrame:
    """The first row per group by ``order`` (ascending), ties by
    ``key``; an aggregate (``min_by``), so hot groups combine map-side."""
    group = [group] if isinstance(group, str) else list(group)
    others = [c for c in df.columns if c not in group]
    best = df.groupBy(*group).agg(F.min_by(F.struct(*others), F.struct(order.alias("o"), F.col(key).alias("k")))
                                  .alias("__r"))
    return best.select(*group, "__r.*")


def hash_rank(df: DataFrame, group, key: str, seed, target_rows: int = 1_000_000,
              upto: Column | None = None) -> DataFrame:
    """Exact 1-based rank of each row inside its group by u(seed, key) (ties
    by key), plus the group size ``__n``; null group values are a group.
    Groups are cut into sub-buckets by hash range (B_g = ceil(n_g /
    target_rows)); the window only ever holds one sub-bucket. With ``upto``
    (an expression of ``__n``) only ranks up to it are needed: sub-buckets
    that begin beyond it are dropped before the window's shuffle."""
    group = [group] if isinstance(group, str) else list(group)
    u = uniform(seed, key)
    x = df.withColumn("__u", u)
    sizes = x.groupBy(*group).agg(F.count(F.lit(1)).alias("__n"))
    sizes = sizes.withColumn("__B", F.greatest(F.lit(1), F.ceil(F.col("__n") / F.lit(target_rows))).cast("int"))
    x = join_bounded(x, sizes, group, "left", null_safe=True).withColumn("__b", F.floor(F.col("__u") * F.col("__B")).cast("int"))
    cnt = x.groupBy(*group, "__b").agg(F.count(F.lit(1)).alias("__c"))
    wb = Window.partitionBy(*group).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    cnt = cnt.withColumn("__off", F.coalesce(F.sum("__c").over(wb), F.lit(0))).drop("__c")
    x = join_bounded(x, cnt, group + ["__b"], "left", null_safe=True)
    if upto is not None:
        x = x.where(F.col("__off") < upto)
    wr = Window.partitionBy(*group, "__b").orderBy("__u", key)
    return x.withColumn("__rank", F.col("__off") + F.row_number().over(wr)).drop("__B", "__b", "__off")


def sample_per_group(df: DataFrame, group, key: str, seed, pct: float, minimum: int = 1,
                     target_rows: int = 1_000_000) -> DataFrame:
    """k = clamp(ceil(n * pct), minimum, n) random rows per group."""
    k = F.least(F.greatest(F.ceil(F.col("__n") * F.lit(pct)), F.lit(minimum)), F.col("__n"))
    r = hash_rank(df, group, key, seed, target_rows, upto=k)
    return r.where(F.col("__rank") <= k).drop("__u", "__n", "__rank")


def stratified_split(df: DataFrame, label: str, key: str, seed, train_frac: float = 0.85,
                     target_rows: int = 1_000_000) -> DataFrame:
    """Per class, the round(train_frac * n) rows with the smallest hash
    are ``train``, the rest ``validation``. Only labels and keys are ranked:
    each class has a last training key, and the rows themselves are compared
    with it where they are. Of the rows that repeat a class's last training key
    some may be beyond the share; those rows alone are numbered."""
    r = hash_rank(df.select(label, key), label, key, seed, target_rows)
    inside = F.col("__rank") <= F.round(F.col("__n") * F.lit(train_frac))
    k = F.struct("__u", F.col(key).alias("__k"))
    last = r.where(inside).groupBy(label).agg(F.max(k).alias("__last"), F.count(F.lit(1)).alias("__m"))
    x = join_bounded(df.withColumn("__u", uniform(seed, key)), last, [label], "left", null_safe=True)
    at = F.when(F.col("__last").isNull() | (k > F.col("__last")), 1).when(k < F.col("__last"), -1).otherwise(0)
    x = x.withColumn("__at", at)
    # how many rows of a class come before its last training key, and so how many with that key are inside
    before = (join_bounded(r, last, [label], "left", null_safe=True).where(k < F.col("__last"))
              .groupBy(label).agg(F.count(F.lit(1)).alias("__before")))
    tied = join_bounded(x.where("__at = 0"), before, [label], "left", null_safe=True)
    row = F.row_number().over(Window.partitionBy(label).orderBy("__u"))
    tied = tied.withColumn("__row", row + F.coalesce("__before", F.lit(0)))
    out = (x.where("__at <> 0").withColumn("split", F.when(F.col("__at") < 0, "train").otherwise("validation"))
           .unionByName(tied.withColumn("split", F.when(F.col("__row") <= F.col("__m"), "train").otherwise("validation")).drop("__before", "__row")))
    return out.drop("__u", "__last", "__m", "__at")


def count_duplicates(df: DataFrame, cols: Sequence[str] | None = None, keep_null_rows: bool = False,
                     out: str = "dup_count") -> DataFrame:
    """A4: one row per distinct row with its count; by default rows with a
    null in any column vanish (pandas ``groupby`` default, Q11)."""
    cols = list(cols or df.columns)
    d = df if keep_null_rows else df.dropna(subset=cols)
    return d.groupBy(*cols).agg(F.count(F.lit(1)).cast("int").alias(out))


def repeat_rows(df: DataFrame, n: str) -> DataFrame:
    """Each row ``n`` times (n < 1 or null gives none; ``sequence(1,0)``
    would count down, hence the guard)."""
    return df.where(F.col(n) >= 1).withColumn("__rep", F.explode(F.sequence(F.lit(1), F.col(n).cast("int")))) \
             .drop("__rep")


def chunk_ids(df: DataFrame, key: str, k: int, start: int = 0, out: str = "chunk") -> DataFrame:
    """W6 (``np.array_split``): k near-equal chunks in key order, the first
    N mod k one row longer; numbered from ``start``. Uses global row
    numbers from ``global_prefix``."""
    pre = global_prefix(df, key)
    n_total = pre.select(F.max("__hi").cast("bigint")).scalar()    # scalar subquery, no join
    x = pre
    r = (F.col("__hi") - 1).cast("bigint")
    q = (n_total / k).cast("bigint")
    m = (n_total % k).cast("bigint")
    big = r < (q + 1) * m
    cid = F.when(big, F.floor(r / (q + 1))).otherwise(m + F.floor((r - (q + 1) * m) / q))
    return x.withColumn(out, (cid + start).cast("int")).drop("__w", "__pid", "__lo", "__hi")


def row_slice(df: DataFrame, key: str, start: int, stop: int) -> DataFrame:
    """P9 (``iloc[start:stop]`` in key order) with distributed row numbers."""
    pre = global_prefix(df, key)
    r = (F.col("__hi") - 1).cast("bigint")
    return pre.where((r >= start) & (r < stop)).withColumn("row_pos", r) \
              .drop("__w", "__pid", "__lo", "__hi")


def exact_quantiles(df: DataFrame, col: str, probs) -> list:
    """Exact linear-interpolation quantiles (R type 7, ``quantile_cont``)
    of a whole column without a single-task aggregate: global ranks come
    from ``global_prefix`` over (value, row id) -- the row id spreads a
    heavily repeated value over several range partitions -- and only the
    rows at the needed ranks (two per probability) reach the driver."""
    import math as _m
    v = df.select(F.col(col).cast("double").alias("__v")).where(F.col("__v").isNotNull())
    n = v.count()
    if n == 0:
        return [None for _ in probs]
    x = v.withColumn("__tie", F.monotonically_increasing_id())
    pre = global_prefix(x, ["__v", "__tie"])
    need = {}
    for q in probs:
        h = (n - 1) * float(q)
        lo = int(_m.floor(h))
        need[q] = (lo, min(lo + 1, n - 1), h - lo)
    ranks = sorted({r for lo, hi, _ in need.values() for r in (lo, hi)})
    got = {int(r["r"]): r["__v"] for r in
           pre.select((F.col("__hi") - 1).cast("bigint").alias("r"), "__v").where(F.col("r").isin(ranks)).collect()}
    return [got[lo] + d * (got[hi] - got[lo]) for lo, hi, d in (need[q] for q in probs)]


def group_positions(df: DataFrame, group, order, partitions: int | None = None) -> DataFrame:
    """Exact 0-based position ``__pos`` of each row inside its group by
    ``order`` (unique within a group) and the group size ``__size``, with no
    window over a whole group: rows are range-partitioned on (group, order),
    so a group holding a third of all rows spans many partitions; a running
    count inside each (partition, group) plus the counts of the same group in
    earlier partitions (a table with at most one row per partition and
    group) gives the position. Checkpointed like ``global_prefix``."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    group = [group] if isinstance(group, str) else list(group)
    order = [order] if isinstance(order, str) else list(order)
    p = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    base = df.repartitionByRange(p, *[F.col(c) for c in group + order]).withColumn("__pid", F.spark_partition_id())
    run = Window.partitionBy("__pid", *group).orderBy(*order)
    local = base.withColumn("__c", F.row_number().over(run)).checkpoint(eager=True)
    cnt = local.groupBy("__pid", *group).agg(F.count(F.lit(1)).alias("__n"))
    wg = Window.partitionBy(*group)
    off = cnt.select("__pid", *group,
                     F.coalesce(F.sum("__n").over(wg.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)),
                                F.lit(0)).alias("__off"),
                     F.sum("__n").over(wg).alias("__size"))
    out = join_bounded(local, off, ["__pid", *group], "left", null_safe=True)
    return out.withColumn("__pos", (F.col("__off") + F.col("__c") - 1).cast("bigint")).drop("__pid", "__c", "__off")


def attach_draws(rows: DataFrame, draws: DataFrame, key: str, n: int, max_broadcast: int = 1_000_000) -> DataFrame:
    """Join drawn keys back to their rows. The draws table has exactly ``n``
    rows (the sample size), so it is broadcast when ``n`` is within the bound
    and the rows are not shuffled; a larger sample uses a shuffle join."""
    return rows.join(F.broadcast(draws) if n <= max_broadcast else draws, key)
