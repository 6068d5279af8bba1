"""Block elimination of the largest factor: the dense fixed point, recovery with
20,000 areas, and areas whose cells fill several buckets."""

import numpy as np
from pyspark.sql import functions as F

from strataforge.functions.hashing import normal, uniform
from strataforge.functions.numeric import inv_logit
from strataforge.operators import mixed_blocks, model


def survey(spark, rows, areas):
    area = (F.col("id") % areas).cast("string")
    x = (F.col("id") % areas - areas / 2) / (areas / 3)
    d = spark.range(rows).select("id", area.alias("area"), x.alias("x"), F.when(F.col("id") % 7 < 3, "f").otherwise("m").alias("sex"))
    d = d.withColumn("true_a", F.lit(0.7) * normal(11, F.lit("area"), "area"))
    p = inv_logit(F.lit(-0.3) + F.lit(0.8) * F.col("x") + F.col("true_a") + F.when(F.col("sex") == "f", 0.4).otherwise(-0.4))
    return d.withColumn("y", (uniform(12, "id") < p).cast("int"))


def test_blocks_reach_the_dense_fixed_point(spark):
    cells = model.cells(survey(spark, 12_000, 30), "y", ["area", "sex"], ["x"]).checkpoint(eager=True)
    a = model.fit_mixed(spark, cells, ["area", "sex"], "x")
    assert a.full_cov is not None and a.converged
    residuals = model.fixed_point_residuals(spark, a, cells, ["area", "sex"], "x").collect()
    assert len(residuals) == 2 + 32 + 2 and max(abs(r.residual) for r in residuals) < 1e-5
    # one cell a bucket or all of them, level rows on the driver or not
    for kw in ({"cells_per_task": 1}, {"local_numbers": 0, "cells_per_task": 25}):
        b = mixed_blocks.fit_blocks(spark, cells, ["area", "sex"], "x", **kw)
        assert b.converged and np.allclose(a.mean, b.mean, atol=1e-4) and np.allclose(a.cov, b.cov, atol=1e-5)
        for g in ("area", "sex"):
            assert abs(a.variances[g] - b.variances[g]) < 1e-4 and list(a.levels[g]) == list(b.levels[g])
            assert np.allclose(a.level_means[g], b.level_means[g], atol=1e-4) and np.allclose(a.level_sds[g], b.level_sds[g], atol=1e-4)


def test_recovery_with_twenty_thousand_areas(spark):
    d = survey(spark, 400_000, 20_000)
    cells = model.cells(d, "y", ["area", "sex"], ["x"])
    # level rows stay distributed: the driver sees sums over levels only
    fit = mixed_blocks.fit_blocks(spark, cells.checkpoint(eager=True), ["area", "sex"], "x", local_numbers=0, tol=1e-4, max_iter=30)
    assert fit.converged and abs(fit.mean[1] - 0.8) < 0.05 and abs(fit.variances["area"] - 0.49) < 0.1
    j = fit.level_table(spark, "area").join(d.select(F.col("area").alias("level"), "true_a").distinct(), "level")
    assert j.count() == 20_000
    assert j.select(F.corr("m", "true_a")).first()[0] > 0.75
    inside = j.select(F.avg((F.abs(F.col("m") - F.col("true_a")) < 2 * F.col("s")).cast("double"))).first()[0]
    assert 0.9 < inside <= 1.0
    assert model.fit_mixed(spark, cells.where("cast(area as int) < 600"), ["area", "sex"], "x", tol=1e-3, max_iter=8).level_frames
