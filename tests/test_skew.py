"""Hot keys: one key holds a third of all rows or weight. Results are
checked against brute force on small fixtures (plain Python / pandas)."""

import bisect
import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from strataforge.operators import frame, sampling


def _u(seed, key) -> float:
    h = hashlib.md5(f"{seed}|{key}".encode()).hexdigest()
    return (int(h[:13], 16) + 0.5) / 2 ** 52


def test_weighted_draws_with_a_hot_row(spark):
    n_rows, n_draws = 3000, 4000
    keys = [f"k{i:05d}" for i in range(n_rows)]
    w = [1 + i % 5 for i in range(n_rows)]
    w[1234] = sum(w) // 2                      # one row holds a third of the weight
    df = spark.createDataFrame(list(zip(keys, w)), "key string, w long")
    got = {r.draw: r.key for r in sampling.weighted_draws(spark, df, "key", "w", n_draws, 7).collect()}
    order = sorted(range(n_rows), key=lambda i: keys[i])
    cum = np.cumsum([w[i] for i in order]).tolist()
    total = cum[-1]
    want = {d: keys[order[bisect.bisect_right(cum, _u(7, d) * total)]] for d in range(1, n_draws + 1)}
    assert got == want
    assert abs(sum(1 for k in got.values() if k == "k01234") / n_draws - 1 / 3) < 0.05


def _frame_pandas(rows: pd.DataFrame) -> pd.DataFrame:
    """The frame steps written plainly in pandas for a small fixture."""
    df = rows.copy()
    bins = [18, 25, 35, 45, 60, np.inf]
    df["age_band"] = pd.cut(df["age"], bins=bins, labels=["18-25", "26-35", "36-45", "46-60", "60+"],
                            right=True).astype(object)
    df.loc[df["age_band"].isna(), "age_band"] = None
    modes = (df.dropna(subset=["area_type"]).groupby(["eroll_no", "booth_no"])["area_type"]
               .agg(lambda x: sorted(x.value_counts()[x.value_counts() == x.value_counts().max()].index)[0]))
    miss = df["area_type"].isna()
    df.loc[miss, "area_type"] = [modes.get((e, b)) for e, b in zip(df.loc[miss, "eroll_no"], df.loc[miss, "booth_no"])]
    first = (df.sort_values("voter_id").dropna(subset=["total_individuals"])
               .groupby(["eroll_no", "booth_no"])["total_individuals"].first().reset_index())
    first["booth_weight"] = first["total_individuals"] / first.groupby("eroll_no")["total_individuals"].transform("sum")
    wmap = first.set_index(["eroll_no", "booth_no"])["booth_weight"]
    df["booth_weight"] = [wmap.get((e, b), np.nan) for e, b in zip(df["eroll_no"], df["booth_no"])]
    keys = ["eroll_no", "gender", "age_band", "area_type"]
    fr = (df.groupby(keys, dropna=False).agg(n_individuals=("booth_weight", "count"),
                                               weighted_n=("booth_weight", "sum")).reset_index())
    fr["stratum_share"] = fr["weighted_n"] / fr.groupby("eroll_no")["weighted_n"].transform("sum")
    return fr


def test_frame_with_a_hot_booth(spark):
    rng = np.random.default_rng(3)
    n = 3000
    booth = rng.integers(0, 12, n)
    booth[: n // 3] = 5                          # booth 5 of area 1 holds a third of the rows
    area = np.where(np.arange(n) < n // 3, 1, rng.integers(0, 4, n))
    rows = pd.DataFrame({
        "voter_id": np.arange(n), "eroll_no": area, "booth_no": booth,
        "total_individuals": np.where(rng.random(n) < 0.1, np.nan, 100.0 + area * 10 + booth),
        "area_type": np.where(rng.random(n) < 0.2, None, np.where(rng.random(n) < 0.5, "Urb", "Rur")),
        "gender": rng.choice(["male", "female"], n), "age": rng.integers(15, 80, n)})
    sdf = spark.createDataFrame(rows.astype(object).where(rows.notna(), None),
                                "voter_id long, eroll_no int, booth_no int, total_individuals double, "
                                "area_type string, gender string, age int").repartition(7)
    got = frame.stratification_frame(sdf, strata=("eroll_no", "gender", "age_band", "area_type")).toPandas()
    want = _frame_pandas(rows)
    key = ["eroll_no", "gender", "age_band", "area_type"]
    g = got.fillna({"age_band": "~", "area_type": "~"}).sort_values(key).reset_index(drop=True)
    w = want.fillna({"age_band": "~", "area_type": "~"}).sort_values(key).reset_index(drop=True)
    assert len(g) == len(w)
    assert (g[key].astype(str).values == w[key].astype(str).values).all()
    assert (g["n_individuals"].values == w["n_individuals"].values).all()
    assert np.allclose(g["weighted_n"], w["weighted_n"]) and np.allclose(g["stratum_share"], w["stratum_share"])
