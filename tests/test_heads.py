"""Several heads per class: routing, defaults, learning, reports and the store."""

import numpy as np
from pyspark.sql import functions as F

from strataforge.operators import classify, heads

HEADS = {"size": ("size", ("small", "large")), "sky": ("sky", ("clear", "rain", "snow"))}
DEFAULTS = {"size": "U", "size_conf": 1.0, "sky": "U", "sky_conf": 1.0, "why": "no head"}
ROWS = "k long, cls string, text string, size string, sky string"


def rows(spark, n=240):
    sky, size = ("clear", "rain", "snow"), ("small", "large")
    out = []
    for k in range(n):
        c = "ab"[k % 2]
        a, b = size[k // 2 % 2], sky[k // 4 % 3]
        # class b speaks the other way round, so one head for both classes could not learn it
        word = {"small": "tiny", "large": "huge"}[a if c == "a" else size[1 - size.index(a)]]
        out.append((k, c, f"The {word} thing under {b}ish skies number {k}", a, b))
    return spark.createDataFrame(out, ROWS)


def test_heads_learn_per_class_and_report_per_epoch(spark):
    d = rows(spark)
    model = heads.fit(d.where("k < 200"), "cls", "text", HEADS, ("a", "b"), epochs=40)
    got = heads.predict(model, d.where("k >= 200").withColumnsRenamed({"size": "t_size", "sky": "t_sky"}), "cls", "text", DEFAULTS)
    assert got.where("size <> t_size OR sky <> t_sky").count() == 0 and got.count() == 40
    assert len(model.history) == 40 * 4
    by = {}
    for epoch, c, h, n, loss, accuracy in model.history:
        assert n == 100
        by.setdefault((c, h), []).append((loss, accuracy))
    for curve in by.values():
        assert curve[-1][0] < 0.5 * curve[0][0] and curve[-1][1] == 1.0
        assert abs(curve[0][0] - np.log(2)) < 1e-9 or abs(curve[0][0] - np.log(3)) < 1e-9


def test_partitions_do_not_matter(spark):
    d = rows(spark, 60)
    a, b = (heads.fit(d.repartition(n), "cls", "text", HEADS, ("a", "b"), epochs=4) for n in (1, 5))
    assert all(np.allclose(a.weights[p], b.weights[p], atol=1e-12) for p in a.weights)


def test_nulls_unknown_classes_and_empty_tables(spark):
    d = spark.createDataFrame([(1, "a", None, None, "rain"), (2, None, "x", "small", None), (3, "z", "x y", "small", "rain"),
                               (4, "a", "", "other", "rain"), (4, "a", "", "other", "rain")], ROWS)
    model = heads.fit(d, "cls", "text", HEADS, ("a", "b"), epochs=2)
    assert model.history[0][3] == 0 and np.all(model.weights["a", "size"] == 0)         # no label of class a: undecided
    got = {r.k: r for r in heads.predict(model, d.drop("size", "sky").withColumn("__z", F.lit(1)), "cls", "text", DEFAULTS).collect()}
    assert (got[2].size, got[2].sky_conf, got[2].why) == ("U", 1.0, "no head") and got[3].why == "no head"
    assert (got[1].size, got[1].size_conf, got[1].why) == ("small", 0.5, None) and got[1].sky == "rain"
    none = d.limit(0)
    empty = heads.fit(none, "cls", "text", HEADS, ("a",), epochs=1)
    assert heads.predict(empty, none.drop("size", "sky"), "cls", "text", DEFAULTS).collect() == []


def test_store_gives_the_model_back(spark, tmp_path):
    model = heads.fit(rows(spark, 60), "cls", "text", HEADS, ("a", "b"), epochs=3)
    heads.save(spark, model, str(tmp_path / "m"))
    back = heads.load(spark, str(tmp_path / "m"))
    assert back.heads == model.heads and back.history == model.history and back.width == model.width
    assert all(np.array_equal(back.weights[p], model.weights[p]) for p in model.weights)


def test_reports(spark):
    d = spark.createDataFrame([("x", "x"), ("x", "y"), ("y", "y"), ("z", "x"), (None, "x"), ("x", None)], "t string, p string")
    got = {r.label: tuple(r)[1:] for r in classify.classification_report(d, "t", "p").collect()}
    assert got == {"x": (0.5, 1 / 3, 0.4, 3), "y": (0.5, 1.0, 2 / 3, 1), "z": (0.0, 0.0, 0.0, 1), "accuracy": (None, None, 0.4, 5),
                   "macro avg": (1 / 3, (1 / 3 + 1) / 3, (0.4 + 2 / 3) / 3, 5), "weighted avg": (0.4, 0.4, (1.2 + 2 / 3) / 5, 5)}
    assert {r.head for r in heads.reports(d, [("a", "t", "p"), ("b", "p", "t")]).collect()} == {"a", "b"}
    assert heads.reports(d.limit(0), [("a", "t", "p")]).collect() == []


def test_features_are_counted_once_and_packed(spark):
    """What an epoch reads is bytes, not lists to count again."""
    import pyarrow as pa

    lists = pa.array([[3, 1, 3], [], [0], [7, 7, 7, 7]], pa.list_(pa.int32()))
    batch = pa.RecordBatch.from_arrays([pa.array(["a", "a", "b", None]), lists, pa.array([0, 1, None, 0], pa.int32())], ["__c", "__x", "__y0"])
    got = next(heads._packer(8)([batch]))
    for part, sizes, places, counts in ((got, [2, 0, 1, 1], [1, 3, 0, 7], [1, 2, 1, 4]), (got.slice(1, 2), [0, 1], [0], [1])):
        size, place, count = heads._unpack(part.column(1))
        assert (size.tolist(), place.tolist(), count.tolist()) == (sizes, places, counts)
    size, _, count = heads._unpack(got.column(1))
    assert np.allclose(heads._sums(heads._values(size, count) ** 2, size), [1, 0, 1, 1])


def test_models_share_kept_features(spark):
    """Training and scoring on kept features gives what it gives on the texts."""
    d = rows(spark, 80).repartition(1)
    kept = classify.with_features(d, "text", 256)
    assert kept.count() == 80 and kept.rdd.getNumPartitions() > 1
    a = classify.train(d, "text", "sky", ("clear", "rain", "snow"), num_features=256)
    b = classify.train(kept, "text", "sky", ("clear", "rain", "snow"))
    assert len(b.stages) == 1
    one, two = ({r.k: (r.predicted, r.confidence) for r in classify.score(m, x, ("clear", "rain", "snow")).collect()} for m, x in ((a, d), (b, kept)))
    assert one == two


def test_split_does_not_move_the_texts(spark):
    """Only keys and labels are ranked; repeated and null keys and labels keep the shares."""
    from strataforge.operators import sampling

    d = spark.createDataFrame([(k if k % 5 else None, "ab"[k % 2] if k % 7 else None, f"text {k}") for k in range(200)] * 2, "k long, g string, text string")
    got = sampling.stratified_split(d, "g", "k", 7, 0.8)
    plan = got._jdf.queryExecution().executedPlan().toString()
    moved = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert len(moved) <= 1                                   # the rows of a class's last key
    size = {r.g: r["count"] for r in d.groupBy("g").count().collect()}
    share = {r.g: r["count"] for r in got.where("split = 'train'").groupBy("g").count().collect()}
    assert share == {g: int(n * 0.8 + 0.5) for g, n in size.items()} and got.count() == 400
