"""Two-stage text classification, label back-fill and reports (SURVEY
§2.10 M11-M14, §2.4 A20, A22, §2.8 F29, F30, §2.3 J17).

Re-aimed from a single-GPU transformer to Spark ML: whole texts are
tokenised (words and word pairs), hashed to a fixed-width vector and fed to
a multinomial logistic regression; training and scoring are distributed.
Labels are caller-supplied; no label vocabulary is built in.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF, NGram, RegexTokenizer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataforge.functions.bins import index_in_vocab
from strataforge.operators.heads import reports
from strataforge.session import ensure_checkpoint_dir


#: The column of a text's hashed counts.
FEATURES = "__features"
#: Rows of a part of kept features (some kB a row); every part sends a whole gradient in every step of a fit, so there are no more than needed.
PART_ROWS = 20_000


def text_pipeline(text_col: str, label_col: str, num_features: int = 1 << 14, max_iter: int = 30,
                  reg: float = 0.01) -> Pipeline:
    """M11 stage: tokens + bigrams -> hashed counts -> logistic regression."""
    return Pipeline(stages=[*feature_stages(text_col, num_features), regression(label_col, max_iter, reg)])


def feature_stages(text_col: str, num_features: int = 1 << 14) -> list:
    """Text to the hashed counts ``FEATURES``; nothing is learnt."""
    tok = RegexTokenizer(inputCol=text_col, outputCol="__tok", pattern=r"\W+", minTokenLength=1)
    bi = NGram(n=2, inputCol="__tok", outputCol="__bi")
    h1 = HashingTF(inputCol="__tok", outputCol="__h1", numFeatures=num_features)
    h2 = HashingTF(inputCol="__bi", outputCol="__h2", numFeatures=num_features)
    return [tok, bi, h1, h2, VectorAssembler(inputCols=["__h1", "__h2"], outputCol=FEATURES)]


def regression(label_col: str, max_iter: int = 30, reg: float = 0.01) -> LogisticRegression:
    return LogisticRegression(featuresCol=FEATURES, labelCol=label_col, family="multinomial",
                              maxIter=max_iter, regParam=reg, probabilityCol="__prob",
                              predictionCol="__pred", rawPredictionCol="__raw")


def with_features(df: DataFrame, text_col: str, num_features: int = 1 << 14) -> DataFrame:
    """``df`` and the features of its texts, dealt evenly and kept: models that
    are then trained and applied on it do not split the texts again."""
    ensure_checkpoint_dir(df.sparkSession)
    parts = max(df.sparkSession.sparkContext.defaultParallelism, -(-df.count() // PART_ROWS))
    df = df.repartition(parts)
    out = PipelineModel(feature_stages(text_col, num_features)).transform(df)
    return out.select(*df.columns, FEATURES).checkpoint(eager=True)


def train(df: DataFrame, text_col: str, label: str, vocab: Sequence[str], unknown: str | None = None,
          **kw) -> PipelineModel:
    """F30 label -> index in ``vocab`` (unknown -> index of ``unknown``),
    then fit; on the features of ``with_features`` where ``df`` has them."""
    d = df.withColumn("__y", index_in_vocab(F.col(label), vocab, unknown).cast("double")).where(F.col("__y").isNotNull())
    if FEATURES in df.columns:
        return Pipeline(stages=[regression("__y", **kw)]).fit(d)
    return text_pipeline(text_col, "__y", **kw).fit(d)


def score(model: PipelineModel, df: DataFrame, vocab: Sequence[str], out: str = "predicted",
          conf: str = "confidence", digits: int | None = 3) -> DataFrame:
    """M12 scoring: decoded class and confidence = largest class
    probability (rounded to ``digits``)."""
    s = model.transform(df)
    names = F.array(*[F.lit(v) for v in vocab])
    c = F.array_max(vector_to_array(F.col("__prob")))
    c = F.round(c, digits) if digits is not None else c
    s = s.withColumn(out, F.element_at(names, F.col("__pred").cast("int") + 1)).withColumn(conf, c)
    return s.drop(*[x for x in s.columns if x.startswith("__") and x not in df.columns])


def fill_missing_labels(model: PipelineModel, df: DataFrame, label: str, vocab: Sequence[str]) -> DataFrame:
    """Only rows with a missing label are scored; known labels stay,
    with confidence 1.0; ``filled`` marks the predictions."""
    known = df.where(F.col(label).isNotNull()).withColumn("confidence", F.lit(1.0)).withColumn("filled", F.lit(False))
    todo = df.where(F.col(label).isNull()).drop(label)
    pred = score(model, todo, vocab, out=label).withColumn("filled", F.lit(True))
    return known.unionByName(pred.select(*known.columns))


def routed_predict(stage1: PipelineModel, stage1_vocab: Sequence[str], heads: dict,
                   df: DataFrame, key: str, text_col: str, unknown_class: str,
                   defaults: dict, digits: int = 3) -> DataFrame:
    """M13 + J17: stage 1 gives the class; each class's rows go to that
    class's head models (filter per class + ``unionByName``); rows of a class
    without heads (the unknown class) get ``defaults``. ``key`` is kept so
    the caller can restore input order."""
    ensure_checkpoint_dir(df.sparkSession)
    more = [FEATURES] if FEATURES in df.columns else []
    s1 = score(stage1, df.select(key, text_col, *more), stage1_vocab, out="class", conf="class_conf", digits=digits)
    s1 = s1.checkpoint(eager=True)   # read once per class branch; reliable, survives executor loss
    parts = []
    for cls, hs in heads.items():
        part = s1.where(F.col("class") == cls)
        for head, (model, vocab) in hs.items():
            part = score(model, part, vocab, out=head, conf=f"{head}_conf", digits=digits)
        parts.append(part)
    known = list(heads)
    rest = s1.where(~F.col("class").isin(known) | F.col("class").isNull())
    for c, v in defaults.items():
        rest = rest.withColumn(c, F.lit(v))
    out = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts + [rest])
    return out.drop(text_col, *more)


def classification_report(df: DataFrame, truth: str, pred: str) -> DataFrame:
    """Per class precision, recall, f1, support; accuracy; macro and
    weighted averages. Zero divisions give 0; rows without a truth do not
    count. One aggregate of confusion counts (``heads.reports``)."""
    return reports(df, [("", truth, pred)]).drop("head")


def training_history(model: PipelineModel) -> list[float]:
    """Loss per optimiser iteration of the last logistic regression."""
    return list(model.stages[-1].summary.objectiveHistory)
