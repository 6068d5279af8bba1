"""Phase 7 queries: classification report (A20, SQL oracle on fixed
predictions) and the re-aimed two-stage classifier (M11-M14, A22, F29,
F30, G7, J17; rows only: model training is iterative)."""

from __future__ import annotations

from pyspark.sql import functions as F

from strataforge.functions.hashing import uniform, uniform_sql
from strataforge.functions.text import sep_concat
from strataforge.operators import classify, heads, sampling
from strataforge.plans.catalogue import register, r6
from strataforge.sources import io
from strataforge.sources.tables import table

# Fixed parameters: label vocabularies (with the unknown class last), seeds,
# the default outputs for rows routed to no head.
LANG_VOCAB = ("de", "en", "es", "fr", "U")
QUALITY_VOCAB = ("L", "H", "U")
PRED_SEED = 404
SPLIT_SEED = 42
DEFAULTS = {"quality": "U", "quality_conf": 1.0}


def _truth_pred(spark, sf_dir):
    lab = table(spark, sf_dir, "labels", "doc_id", "quality", "toxic")
    truth = F.when(F.col("toxic") == 1, "T").when(F.col("quality") == 1, "H").otherwise("L")
    u = uniform(PRED_SEED, "doc_id")
    pred = F.when((u < 0.75) & (truth != "T"), truth).when(u < 0.9, "H").otherwise("L")
    return lab.select("doc_id", truth.alias("truth"), pred.alias("pred"))


def _report_sql() -> str:
    u = uniform_sql(PRED_SEED, "doc_id")
    return f"""
WITH t AS (SELECT doc_id, CASE WHEN toxic = 1 THEN 'T' WHEN quality = 1 THEN 'H' ELSE 'L' END AS truth FROM labels),
x AS (SELECT doc_id, truth, CASE WHEN {u} < 0.75 AND truth <> 'T' THEN truth WHEN {u} < 0.9 THEN 'H' ELSE 'L' END AS pred FROM t),
cls AS (SELECT truth AS label FROM x UNION SELECT pred FROM x),
m AS (SELECT c.label,
        (SELECT count(*) FROM x WHERE truth = c.label AND pred = c.label) AS tp,
        (SELECT count(*) FROM x WHERE pred = c.label) AS pc,
        (SELECT count(*) FROM x WHERE truth = c.label) AS tc FROM cls c),
per AS (SELECT label, CASE WHEN pc > 0 THEN tp / pc ELSE 0.0 END AS precision,
               CASE WHEN tc > 0 THEN tp / tc ELSE 0.0 END AS recall, tc AS support, tp FROM m),
per2 AS (SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0.0 END AS f1 FROM per),
tot AS (SELECT sum(support) AS n, sum(tp) AS t, avg(precision) AS mp, avg(recall) AS mr, avg(f1) AS mf,
               sum(precision * support) AS wp, sum(recall * support) AS wr, sum(f1 * support) AS wf FROM per2)
SELECT label, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, CAST(support AS BIGINT) AS support FROM per2
UNION ALL SELECT 'accuracy', NULL, NULL, round(t / n, 6), CAST(n AS BIGINT) FROM tot
UNION ALL SELECT 'macro avg', round(mp, 6), round(mr, 6), round(mf, 6), CAST(n AS BIGINT) FROM tot
UNION ALL SELECT 'weighted avg', round(wp / n, 6), round(wr / n, 6), round(wf / n, 6), CAST(n AS BIGINT) FROM tot"""


@register("class_report", _report_sql())
def class_report(spark, sf_dir):
    """A20 on fixed predictions: a class that is never predicted gets
    precision 0 (zero division -> 0)."""
    r = classify.classification_report(_truth_pred(spark, sf_dir), "truth", "pred")
    return r.select("label", *[r6(c).alias(c) for c in ("precision", "recall", "f1")], "support")


def _docs(spark, sf_dir):
    d = table(spark, sf_dir, "documents", "doc_id", "text", "lang", "source")
    return d.withColumn("features_text", sep_concat("text", "source"))


@register("two_stage_classifier")
def two_stage_classifier(spark, sf_dir):
    """M11 stage 1 on ``text [SEP] source`` (F29) + G7 split + M14 held-out
    report (A20) + A22 loss per iteration appended as rows ``loss_<i>``."""
    d = sampling.stratified_split(_docs(spark, sf_dir), "lang", "doc_id", SPLIT_SEED, 0.85)
    model = classify.train(d.where(F.col("split") == "train"), "features_text", "lang", LANG_VOCAB, "U")
    val = classify.score(model, d.where(F.col("split") == "validation"), LANG_VOCAB, out="pred", digits=None)
    rep = classify.classification_report(val, "lang", "pred")
    hist = classify.training_history(model)
    loss = spark.createDataFrame([(f"loss_{i}", None, None, float(v), None) for i, v in enumerate(hist)],
                                 "label string, precision double, recall double, f1 double, support bigint")
    return rep.unionByName(loss)


def _quality_docs(spark, sf_dir):
    lab = table(spark, sf_dir, "labels", "doc_id", "quality")
    q = lab.select("doc_id", F.when(F.col("quality") == 1, "H").otherwise("L").alias("quality"))
    return _docs(spark, sf_dir).join(q, "doc_id", "left")


@register("fill_missing_labels")
def fill_missing_labels(spark, sf_dir):
    """M12 (+F30): documents without a quality label get the model's class
    and confidence; labelled ones keep theirs."""
    d = _quality_docs(spark, sf_dir)
    model = classify.train(d.where(F.col("quality").isNotNull()), "features_text", "quality", QUALITY_VOCAB, "U")
    out = classify.fill_missing_labels(model, d.select("doc_id", "features_text", "quality"), "quality", QUALITY_VOCAB)
    return out.select("doc_id", "quality", "confidence", "filled")


@register("routed_predict")
def routed_predict(spark, sf_dir):
    """M13 + J17: stage 1 picks the language; each language's quality head
    scores its rows; the unknown class gets the default outputs (U, 1.0). Confidences rounded to 3."""
    d = classify.with_features(_quality_docs(spark, sf_dir).select("doc_id", "features_text", "lang", "quality"), "features_text")
    s1 = classify.train(d, "features_text", "lang", LANG_VOCAB, "U")
    heads = {}
    for lang in LANG_VOCAB[:-1]:
        sub = d.where((F.col("lang") == lang) & F.col("quality").isNotNull())
        heads[lang] = {"quality": (classify.train(sub, "features_text", "quality", QUALITY_VOCAB, "U"), QUALITY_VOCAB)}
    out = classify.routed_predict(s1, LANG_VOCAB, heads, d, "doc_id", "features_text", "U", DEFAULTS)
    return out.select("doc_id", "class", "class_conf", "quality", "quality_conf")


# Heads of every language: quality (L, H) and toxic (n, y). Fixed parameters of
# the queries with an oracle: feature terms and the rule of their weights.
HEADS = {"quality": ("quality", ("L", "H")), "toxic": ("toxic", ("n", "y"))}
HEAD_CLASSES = ("de", "en", "es")
HEAD_DEFAULTS = {"quality": "U", "quality_conf": 1.0, "toxic": "U", "toxic_conf": 1.0, "routed_to": "none"}
TERMS = ("a", "the", "of", "e", "i", "er", "in", "on", "en", "to", "is", "un", "an", "la", "or", "1", "2", "5")


def _fixed_weight(c: int, h: int, k: int, j: int) -> float:
    """Weight of class c, head h, outcome k, place j (0: intercept): a few tenths either way."""
    return ((c * 7 + h * 5 + k * 11 + j * 3) % 13 - 6) / 10.0


def _head_docs(spark, sf_dir):
    """Documents with both labels, split 85 : 15 by language, dealt evenly: the
    work on a text is long, and a file may hold all of them in one piece."""
    lab = table(spark, sf_dir, "labels", "doc_id", "quality", "toxic")
    q = lab.select("doc_id", F.when(F.col("quality") == 1, "H").otherwise("L").alias("quality"),
                   F.when(F.col("toxic") == 1, "y").otherwise("n").alias("toxic"))
    d = _docs(spark, sf_dir).select("doc_id", "lang", "features_text").join(q, "doc_id", "left")
    return sampling.stratified_split(d, "lang", "doc_id", SPLIT_SEED, 0.85).repartition(4 * spark.sparkContext.defaultParallelism)


def fixed_heads() -> heads.HeadModel:
    """A model with the caller's coefficients."""
    w = {(c, h): [[_fixed_weight(i, n, k, j) for j in range(len(TERMS) + 1)] for k in range(2)]
         for i, c in enumerate(HEAD_CLASSES) for n, h in enumerate(HEADS)}
    return heads.HeadModel({h: v for h, (_, v) in HEADS.items()}, {p: heads.np.array(v) for p, v in w.items()}, TERMS, len(TERMS))


def _routed_sql() -> str:
    weights = ", ".join(f"('{c}', '{h}', {k}, {j}, {_fixed_weight(i, n, k, j)!r})" for i, c in enumerate(HEAD_CLASSES)
                        for n, h in enumerate(HEADS) for k in range(2) for j in range(len(TERMS) + 1))
    terms = ", ".join(f"('{t}', {j})" for j, t in enumerate(TERMS, 1))
    one = lambda h, n: f"max(CASE WHEN head = '{h}' THEN {n} END)"
    labels = {h: f"CASE WHEN p1 > p0 THEN '{v[1]}' ELSE '{v[0]}' END" for h, (_, v) in HEADS.items()}
    return f"""
WITH w(lang, head, k, j, v) AS (VALUES {weights}), t(term, j) AS (VALUES {terms}),
d AS (SELECT doc_id, lang, unnest(regexp_extract_all(lower(coalesce(text, '')), '[\\p{{L}}\\p{{N}}]+')) AS word FROM documents),
c AS (SELECT doc_id, lang, t.j, count(*) AS n FROM d JOIN t ON t.term = word GROUP BY ALL),
x AS (SELECT doc_id, lang, j, n / sqrt(sum(n * n) OVER (PARTITION BY doc_id)) AS v FROM c
      UNION ALL SELECT doc_id, lang, 0, 1.0 FROM documents),
z AS (SELECT doc_id, head, sum(CASE WHEN k = 1 THEN x.v * w.v ELSE -x.v * w.v END) AS z FROM x JOIN w ON w.lang = x.lang AND w.j = x.j GROUP BY ALL),
p AS (SELECT doc_id, head, 1 / (1 + exp(-z)) AS p1, 1 / (1 + exp(z)) AS p0 FROM z),
o AS (SELECT doc_id, {", ".join(f"{one(h, labels[h])} AS {h}, {one(h, 'greatest(p0, p1)')} AS {h}_conf" for h in HEADS)} FROM p GROUP BY doc_id)
SELECT doc_id, lang, coalesce(quality, 'U') AS quality, round(coalesce(quality_conf, 1.0), 6) AS quality_conf, coalesce(toxic, 'U') AS toxic,
       round(coalesce(toxic_conf, 1.0), 6) AS toxic_conf, CASE WHEN quality IS NULL THEN 'none' END AS routed_to
FROM documents LEFT JOIN o USING (doc_id)"""


@register("routed_heads_fixed", _routed_sql())
def routed_heads_fixed(spark, sf_dir):
    """M13 + J17: rows routed by class to two heads with the caller's
    coefficients; languages without heads take five default outputs."""
    d = table(spark, sf_dir, "documents", "doc_id", "text", "lang")
    return heads.predict(fixed_heads(), d, "lang", "text", HEAD_DEFAULTS).drop("text")


@register("routed_heads")
def routed_heads(spark, sf_dir):
    """M11 + M13 + J17: quality and toxic heads of every language, fitted
    together on the training share; predictions of all documents."""
    d = _head_docs(spark, sf_dir).checkpoint(eager=True)
    model = heads.fit(d.where("split = 'train'"), "lang", "features_text", HEADS, HEAD_CLASSES)
    known = d.withColumnsRenamed({h: f"{h}_label" for h in HEADS})
    return heads.predict(model, known, "lang", "features_text", HEAD_DEFAULTS).drop("features_text")


@register("heads_report")
def heads_report(spark, sf_dir):
    """A20 + M14 + A22: held-out report of stage 1 and of every head in one
    aggregate, then loss and accuracy of every class, head and epoch."""
    d = _head_docs(spark, sf_dir).checkpoint(eager=True)
    train, held = d.where("split = 'train'"), d.where("split = 'validation'")
    s1 = heads.fit(train.withColumn("all", F.lit("all")), "all", "features_text", {"stage1": ("lang", LANG_VOCAB[:-1])}, ("all",))
    model = heads.fit(train, "lang", "features_text", HEADS, HEAD_CLASSES)
    held = heads.predict(s1, held.withColumn("all", F.lit("all")), "all", "features_text", {"stage1": "U", "stage1_conf": 1.0})
    held = heads.predict(model, held.withColumnsRenamed({h: f"{h}_label" for h in HEADS}), "stage1", "features_text", HEAD_DEFAULTS)
    rep = heads.reports(held, [("stage1", "lang", "stage1"), *[(h, f"{h}_label", h) for h in HEADS]])
    epochs = spark.createDataFrame([(h, f"epoch {e} {c}", a, float(x), int(n)) for m in (s1, model) for e, c, h, n, x, a in m.history],
                                   "head string, label string, accuracy double, loss double, support bigint")
    return rep.unionByName(epochs, allowMissingColumns=True)


_HEAD_REPORT = """
WITH t AS (SELECT 'quality' AS head, CASE WHEN quality = 1 THEN 'H' ELSE 'L' END AS t, CASE WHEN doc_id % 3 = 0 THEN 'H' ELSE 'L' END AS p FROM labels
           UNION ALL SELECT 'toxic', CASE WHEN toxic = 1 THEN 'y' ELSE 'n' END, CASE WHEN doc_id % 5 = 0 THEN 'x' ELSE 'n' END FROM labels),
l AS (SELECT head, t AS label FROM t UNION SELECT head, p FROM t),
c AS (SELECT l.head, label, count(*) FILTER (WHERE t.t = label AND p = label) AS tp, count(*) FILTER (WHERE p = label) AS pc,
             count(*) FILTER (WHERE t.t = label) AS tc FROM l JOIN t ON t.head = l.head GROUP BY ALL),
m AS (SELECT head, label, coalesce(tp / nullif(pc, 0), 0) AS precision, coalesce(tp / nullif(tc, 0), 0) AS recall,
             coalesce(2 * tp / nullif(pc + tc, 0), 0) AS f1, tc AS support, tp FROM c)
SELECT head, label, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, support FROM m
UNION ALL SELECT head, 'accuracy', NULL, NULL, round(sum(tp) / sum(support), 6), CAST(sum(support) AS BIGINT) FROM m GROUP BY head
UNION ALL SELECT head, 'macro avg', round(avg(precision), 6), round(avg(recall), 6), round(avg(f1), 6), CAST(sum(support) AS BIGINT) FROM m GROUP BY head
UNION ALL SELECT head, 'weighted avg', round(sum(precision * support) / sum(support), 6), round(sum(recall * support) / sum(support), 6),
                 round(sum(f1 * support) / sum(support), 6), CAST(sum(support) AS BIGINT) FROM m GROUP BY head"""


@register("head_reports", _HEAD_REPORT)
def head_reports(spark, sf_dir):
    """A20 for several heads at once, on fixed predictions."""
    lab = table(spark, sf_dir, "labels", "doc_id", "quality", "toxic").select(
        F.when(F.col("quality") == 1, "H").otherwise("L").alias("q"), F.when(F.col("doc_id") % 3 == 0, "H").otherwise("L").alias("qp"),
        F.when(F.col("toxic") == 1, "y").otherwise("n").alias("t"), F.when(F.col("doc_id") % 5 == 0, "x").otherwise("n").alias("tp"))
    r = heads.reports(lab, [("quality", "q", "qp"), ("toxic", "t", "tp")])
    return r.select("head", "label", *[r6(c).alias(c) for c in ("precision", "recall", "f1")], "support")


@register("model_reload", """
SELECT CASE WHEN lang IN ('de', 'en', 'es') THEN lang ELSE 'none' END AS class, count(*) AS n, count(*) AS same, 0.0::DOUBLE AS largest_change
FROM documents GROUP BY 1""")
def model_reload(spark, sf_dir):
    """Fitted heads saved and loaded back; predictions of all documents
    by both, compared row by row."""
    d = _head_docs(spark, sf_dir).select("doc_id", "lang", "features_text", "quality", "toxic").checkpoint(eager=True)
    model = heads.fit(d, "lang", "features_text", HEADS, HEAD_CLASSES, epochs=5)
    path = io.scratch_dir(spark, "heads")
    heads.save(spark, model, path)
    a, b = (heads.predict(m, d.select("doc_id", "lang", "features_text"), "lang", "features_text", HEAD_DEFAULTS, digits=15).drop("features_text")
            for m in (model, heads.load(spark, path)))
    b = b.select("doc_id", *[F.col(c).alias(f"b_{c}") for c in HEAD_DEFAULTS])
    same = F.lit(True)
    for c in HEAD_DEFAULTS:
        same = same & F.col(c).eqNullSafe(F.col(f"b_{c}"))
    change = F.greatest(*[F.abs(F.col(c) - F.col(f"b_{c}")) for c in ("quality_conf", "toxic_conf")])
    return (a.join(b, "doc_id").groupBy(F.when(F.col("lang").isin(*HEAD_CLASSES), F.col("lang")).otherwise("none").alias("class"))
            .agg(F.count(F.lit(1)).alias("n"), F.sum(same.cast("bigint")).alias("same"), F.max(change).alias("largest_change")))
