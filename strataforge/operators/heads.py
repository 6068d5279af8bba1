"""Several label heads per class over shared features (SURVEY §2.10 M11, M13,
M14, §2.3 J17, §2.4 A20, A22), and their store (S16).

Every row has a class (a stage-1 prediction or a known value) and features of
its text; every (class, head) pair is a softmax regression on the same
features. All pairs are fitted together: one pass over the feature table gives
the gradients, losses and hits of every pair, summed by Spark before they reach
the driver (at most one number per coefficient), and accelerated gradient
steps follow. Features have length 1, so the loss's curvature is at most 1/2 and
the step needs no search; each epoch reports loss and accuracy.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strataforge.functions.bins import index_in_vocab
from strataforge.session import ensure_checkpoint_dir

HASHED = 1 << 12


@dataclass
class HeadModel:
    """Weights (outcomes x (1 + features), intercept first) of each (class, head)."""

    heads: dict[str, tuple[str, ...]]
    weights: dict[tuple[str, str], np.ndarray]
    #: feature terms by place; None: words and word pairs hashed to ``width``
    terms: tuple[str, ...] | None = None
    width: int = HASHED
    #: rows (epoch, class, head, n, loss, accuracy), losses before the epoch's step
    history: list[tuple] = field(default_factory=list)

    @property
    def classes(self) -> list[str]:
        return sorted({c for c, _ in self.weights})


def features(text: Column, terms: Sequence[str] | None = None, width: int = HASHED) -> Column:
    """Places of a text's features, repeats kept: lower-case words found in
    ``terms``, or words and word pairs hashed to ``width`` places."""
    words = F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))
    if terms is not None:
        return F.transform(F.filter(F.transform(words, lambda w: F.array_position(F.array(*[F.lit(t) for t in terms]), w)),
                                    lambda p: p > 0), lambda p: (p - 1).cast("int"))
    def places(w):       # zipped, not looked up: a word list inside a lambda would be split again for every word
        n = F.greatest(F.size(w) - 1, F.lit(0))
        grams = F.concat(w, F.zip_with(F.slice(w, 1, n), F.slice(w, 2, n), lambda a, b: F.concat(a, F.lit(" "), b)))
        return F.transform(grams, lambda g: F.pmod(F.xxhash64(g), F.lit(width)).cast("int"))

    return F.element_at(F.transform(F.array(words), places), 1)       # so that the words are split once, not for each use


#: A feature of a row in a packed row: its place and how often it occurs.
ENTRY = np.dtype([("place", "<u4"), ("count", "<u4")])
#: Features looked at together, and numbers of a gradient in one row.
SLICE, BLOCK = 1 << 18, 1 << 13


def _entries(places: pa.ListArray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """How many distinct features each row has, their places and their counts, row after row."""
    size = np.diff(places.offsets.to_numpy())
    key, count = np.unique(np.repeat(np.arange(len(size)), size) * width + places.flatten().to_numpy(), return_counts=True)
    return np.bincount(key // width, minlength=len(size)), key % width, count


def _packer(width: int):
    """Rows whose feature list ``__x`` is counted once and kept as bytes, so that no pass counts it again."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            size, place, count = _entries(b.column(1), width)
            x = np.empty(len(place), ENTRY)
            x["place"], x["count"] = place, count
            ends = np.concatenate([[0], np.cumsum(size * ENTRY.itemsize)]).astype(np.int32)
            packed = pa.Array.from_buffers(pa.binary(), len(size), [None, pa.py_buffer(ends), pa.py_buffer(x)])
            yield pa.RecordBatch.from_arrays([b.column(0), packed, *b.columns[2:]], b.schema.names)
    return run


def _unpack(column: pa.BinaryArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``_entries`` of packed rows."""
    _, ends, data = column.buffers()
    ends = np.frombuffer(ends, np.int32)[column.offset:column.offset + len(column) + 1]
    x = np.frombuffer(data, ENTRY, (ends[-1] - ends[0]) // ENTRY.itemsize, ends[0]) if data is not None else np.empty(0, ENTRY)
    return np.diff(ends) // ENTRY.itemsize, x["place"], x["count"]


def _sums(v: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Sums of the first size[0] numbers, the next size[1] and so on."""
    out, some = np.zeros(len(size)), size > 0
    if len(v):
        out[some] = np.add.reduceat(v, (np.cumsum(size) - size)[some])
    return out


def _values(size: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Counts scaled so that a row's have length 1."""
    count = count.astype(float)
    return count / np.repeat(np.sqrt(_sums(count ** 2, size)), size)


def _softmax(w: np.ndarray, cls: np.ndarray, size: np.ndarray, at: np.ndarray, value: np.ndarray, width: int) -> np.ndarray:
    """Probabilities (rows x outcomes) by weights w (outcomes x classes * (1 + width)) of rows of
    class ``cls``; ``at``: where the weight of each of their features lies."""
    z = np.zeros((len(size), len(w)))                         # against the last outcome, so that one needs no pass
    for k in range(len(w) - 1):
        d = w[k] - w[-1]
        z[:, k] = d[cls * (width + 1)] + _sums(d[at] * value, size)
    z = np.exp(z - z.max(1, keepdims=True))
    return z / z.sum(1, keepdims=True)


def _slices(cls: np.ndarray, size: np.ndarray, place: np.ndarray, count: np.ndarray, width: int) -> Iterator[tuple]:
    """(rows, cls, size, at, value) of at most about ``SLICE`` features a time."""
    ends = np.concatenate([[0], np.cumsum(size)])
    lo = 0
    while lo < len(size):
        hi = max(int(np.searchsorted(ends, ends[lo] + SLICE, "right")) - 1, lo + 1)
        part, mine = slice(ends[lo], ends[hi]), slice(lo, hi)
        yield (mine, cls[mine], size[mine], np.repeat(cls[mine] * (width + 1) + 1, size[mine]) + place[part], _values(size[mine], count[part]))
        lo = hi


def prepare(df: DataFrame, class_col: str, text_col: str, heads: dict[str, tuple[str, Sequence[str]]], terms=None, width: int = HASHED) -> DataFrame:
    """(__c, __x, one label place per head or null): what a fit reads."""
    labels = [index_in_vocab(F.col(col), vocab, None).cast("int").alias(f"__y{i}") for i, (col, vocab) in enumerate(heads.values())]
    return df.select(F.col(class_col).cast("string").alias("__c"), features(F.col(text_col), terms, width).alias("__x"), *labels)


def fit(df: DataFrame, class_col: str, text_col: str, heads: dict[str, tuple[str, Sequence[str]]], classes: Sequence[str],
        epochs: int = 30, reg: float = 1e-3, terms: Sequence[str] | None = None, width: int = HASHED) -> HeadModel:
    """Fit every head for every class in ``classes`` together, on the rows of
    that class with that label; ``heads``: name -> (label column, vocabulary).
    Rows without a label, or with one outside the vocabulary, do not count; a
    pair without rows keeps zero weights (all outcomes alike). Every epoch runs
    over the partitions of ``df``."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    if terms is not None:
        width = len(terms)
    rows = prepare(df, class_col, text_col, heads, terms, width).where(F.col("__c").isin(list(classes)))
    schema = ", ".join(["__c string, __x binary", *[f"__y{i} int" for i in range(len(heads))]])
    table = rows.mapInArrow(_packer(width), schema).checkpoint(eager=True)
    names, sizes = list(heads), [len(v) for _, v in heads.values()]
    pairs = [(c, h) for c in classes for h in range(len(names))]
    at = {p: i for i, p in enumerate(pairs)}
    weights = [np.zeros((sizes[h], width + 1)) for _, h in pairs]
    ahead, momentum = [w.copy() for w in weights], 1.0
    history = []
    classes = list(classes)

    def pass_over(batches: Iterator[pa.RecordBatch], look=None):
        now = [np.concatenate([look.value[at[c, h]] for c in classes], axis=1) for h in range(len(names))]
        grad = [np.zeros_like(w) for w in now]
        stats = np.zeros((len(names), 3, len(classes)))
        for batch in batches:
            of = pc.index_in(batch.column(0), value_set=pa.array(classes)).to_numpy(zero_copy_only=False).astype(np.int64)
            labels = [batch.column(2 + h).to_numpy(zero_copy_only=False).astype(float) for h in range(len(names))]
            for mine, cls, size, where, value in _slices(of, *_unpack(batch.column(1)), width):
                for h, w in enumerate(now):
                    use = np.flatnonzero(~np.isnan(labels[h][mine]))
                    if not len(use):
                        continue
                    p = _softmax(w, cls, size, where, value, width)
                    y = labels[h][mine][use].astype(int)
                    own = p[use, y]
                    for s, v in enumerate((np.ones(len(use)), -np.log(np.maximum(own, 1e-300)), (p[use].argmax(1) == y).astype(float))):
                        stats[h, s] += np.bincount(cls[use], v, len(classes))
                    off = np.zeros_like(p)
                    off[use] = p[use]
                    off[use, y] -= 1.0
                    for k in range(len(w) - 1):               # a row's add up to 0, so the last follows
                        grad[h][k] += np.bincount(where, np.repeat(off[:, k], size) * value, w.shape[1])
                        grad[h][k].reshape(len(classes), -1)[:, 0] += np.bincount(cls, off[:, k], len(classes))
        for g in grad:
            g[-1] = -g[:-1].sum(0)
        out = []
        for i, (c, h) in enumerate(pairs):
            c = classes.index(c)
            flat = np.concatenate([stats[h, :, c], grad[h].reshape(sizes[h], len(classes), width + 1)[:, c].ravel()])
            out += [(i, j, flat[j:j + BLOCK].tobytes()) for j in range(0, len(flat), BLOCK)]
        yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*out), (pa.int32(), pa.int64(), pa.binary()))], ["i", "j", "v"])

    def add(key, parts):
        v = np.sum([np.frombuffer(x.as_buffer()) for x in parts.column("v")], axis=0)
        return pa.table([pa.array([key[0].as_py()], pa.int32()), pa.array([key[1].as_py()], pa.int64()), pa.array([v.tobytes()], pa.binary())], ["i", "j", "v"])

    for epoch in range(epochs):
        look = spark.sparkContext.broadcast(ahead)           # one number per coefficient
        got = (table.mapInArrow(lambda b, look=look: pass_over(b, look), "i int, j long, v binary")
               .groupBy("i", "j").applyInArrow(add, "i int, j long, v binary").toArrow().sort_by([("i", "ascending"), ("j", "ascending")]).to_pylist())
        faster = (1 + np.sqrt(1 + 4 * momentum ** 2)) / 2
        for k, (c, h) in enumerate(pairs):
            v = np.concatenate([np.zeros(0), *[np.frombuffer(r["v"]) for r in got if r["i"] == k]])
            if not len(v):
                v = np.zeros(3 + ahead[k].size)               # a table without partitions
            n, loss, hits = (float(x) for x in v[:3])
            history.append((epoch, c, names[h], int(n), loss / n if n else 0.0, hits / n if n else 0.0))
            g = v[3:].reshape(ahead[k].shape) / max(n, 1.0) + reg * ahead[k]
            new = ahead[k] - g / (1.0 + reg)                  # curvature: 1/2 for the features, 1/2 for the intercept
            ahead[k], weights[k] = new + (momentum - 1) / faster * (new - weights[k]), new
        momentum = faster
        look.unpersist()
    return HeadModel({h: tuple(v) for h, (_, v) in heads.items()}, {(c, names[h]): weights[at[c, h]] for c, h in pairs},
                     tuple(terms) if terms is not None else None, width, history)


def predict(model: HeadModel, df: DataFrame, class_col: str, text_col: str, defaults: dict, digits: int = 6) -> DataFrame:
    """``df`` with each head's outcome and confidence (``<head>``, ``<head>_conf``)
    of the row's class. Rows of a class without heads, and of no class, take
    ``defaults`` (column -> value; also the columns that are no head's output,
    which are null elsewhere). Of equal probabilities the first outcome counts.
    One pass, no shuffle: the rows are not split by class."""
    out = [c for h in model.heads for c in (h, f"{h}_conf")]
    more = [c for c in defaults if c not in out]
    kept = [c for c in df.columns if c not in out + more]
    known = F.col(class_col).isin(model.classes)
    rows = df.select(*kept, features(F.col(text_col), model.terms, model.width).alias("__x"), F.when(known, F.col(class_col)).alias("__c"))
    look = df.sparkSession.sparkContext.broadcast((model.weights, model.heads))
    width = model.width
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields if f.name != "__x"]
                       + [f"`{h}` string, `{h}_conf` double" for h in model.heads])

    def run(batches: Iterator[pa.RecordBatch]):
        weights, heads = look.value
        classes = sorted({c for c, _ in weights})
        every = {h: np.concatenate([weights[c, h] for c in classes], axis=1) for h in heads}
        for batch in batches:
            of = pc.index_in(batch.column(batch.schema.get_field_index("__c")), value_set=pa.array(classes, pa.string())).fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
            names = {h: np.full(batch.num_rows, None, object) for h in heads}
            conf = {h: np.full(batch.num_rows, np.nan) for h in heads}
            known = np.flatnonzero(of >= 0)
            places = batch.column(batch.schema.get_field_index("__x")).take(pa.array(known))
            for mine, cls, size, where, value in _slices(of[known], *_entries(places, width), width) if len(known) else ():
                at = known[mine]
                for h, vocab in heads.items():
                    p = _softmax(every[h], cls, size, where, value, width)
                    best = p.argmax(1)
                    names[h][at], conf[h][at] = np.array(vocab, object)[best], p[np.arange(len(at)), best]
            keep = [i for i, f in enumerate(batch.schema) if f.name != "__x"]
            cols = [batch.column(i) for i in keep]
            for h in heads:
                cols += [pa.array(names[h], pa.string()), pa.array(conf[h], pa.float64(), from_pandas=True)]
            yield pa.RecordBatch.from_arrays(cols, [batch.schema.field(i).name for i in keep] + out)

    got = rows.mapInArrow(run, schema)
    values = {c: F.round(F.col(c), digits) if c.endswith("_conf") else F.col(c) for c in out}
    unknown = F.col("__c").isNull()
    filled = [F.when(unknown, F.lit(defaults.get(c))).otherwise(v).alias(c) for c, v in values.items()]
    return got.select(*kept, *filled, *[F.when(unknown, F.lit(defaults[c])).alias(c) for c in more])


def reports(df: DataFrame, columns: Sequence[tuple[str, str, str]]) -> DataFrame:
    """A20 / M14 for several (name, truth, prediction) columns in one aggregate:
    (head, label, precision, recall, f1, support), with accuracy, macro and
    weighted averages; zero divisions give 0, rows without a truth do not count."""
    pairs = F.explode(F.array(*[F.struct(F.lit(n).alias("head"), F.col(t).cast("string").alias("t"), F.col(p).cast("string").alias("p"))
                                for n, t, p in columns]))
    conf = df.select(pairs.alias("v")).select("v.*").where(F.col("t").isNotNull()).groupBy("head", "t", "p").agg(F.count(F.lit(1)).alias("n"))
    one = conf.groupBy("head").agg(F.collect_list(F.struct("t", "p", "n")).alias("m"))       # labels x labels counts of a head
    labels = F.array_sort(F.filter(F.array_distinct(F.concat(F.transform("m", lambda r: r["t"]), F.transform("m", lambda r: r["p"]))),
                                   lambda x: x.isNotNull()))
    total = lambda keep: F.aggregate(F.filter("m", keep), F.lit(0).cast("bigint"), lambda s, r: s + r["n"])
    ratio = lambda a, b: F.coalesce(F.try_divide(a, b), F.lit(0.0))
    each = F.transform(labels, lambda x: F.struct(x.alias("label"), total(lambda r: (r["t"] == x) & (r["p"] == x)).alias("tp"),
                                                  total(lambda r: r["p"] == x).alias("pc"), total(lambda r: r["t"] == x).alias("tc")))
    per = F.transform("e", lambda r: F.struct(r["label"].alias("label"), ratio(r["tp"], r["pc"]).alias("precision"), ratio(r["tp"], r["tc"]).alias("recall"),
                                              ratio(2 * r["tp"], r["pc"] + r["tc"]).alias("f1"), r["tc"].alias("support"), r["tp"].alias("tp")))
    one = one.withColumn("e", each).withColumn("e", per)
    n = F.aggregate("e", F.lit(0).cast("bigint"), lambda s, r: s + r["support"])
    hits = F.aggregate("e", F.lit(0).cast("bigint"), lambda s, r: s + r["tp"])
    mean = lambda f, w: ratio(F.aggregate("e", F.lit(0.0), lambda s, r: s + r[f] * w(r)), F.aggregate("e", F.lit(0.0), lambda s, r: s + w(r)))
    null = F.lit(None).cast("double")
    extra = [F.struct(F.lit("accuracy").alias("label"), null.alias("precision"), null.alias("recall"), ratio(hits, n).alias("f1"), n.alias("support"))]
    for name, w in (("macro avg", lambda r: F.lit(1.0)), ("weighted avg", lambda r: r["support"].cast("double"))):
        extra.append(F.struct(F.lit(name).alias("label"), mean("precision", w).alias("precision"), mean("recall", w).alias("recall"),
                              mean("f1", w).alias("f1"), n.alias("support")))
    plain = F.transform("e", lambda r: F.struct(r["label"].alias("label"), r["precision"].alias("precision"), r["recall"].alias("recall"),
                                                r["f1"].alias("f1"), r["support"].alias("support")))
    return one.select("head", F.explode(F.concat(plain, F.array(*extra))).alias("r")).select("head", "r.*")


def save(spark: SparkSession, model: HeadModel, path: str) -> None:
    """The model as two Parquet tables under ``path``: ``weights`` (class,
    head, outcome, place, value; zeros left out) and ``about`` (one JSON row
    with a format version), written last, so a reader sees whole models only."""
    rows = [(c, h, int(k), int(j), float(w[k, j])) for (c, h), w in model.weights.items() for k, j in zip(*np.nonzero(w))]
    spark.createDataFrame(rows, "class string, head string, outcome int, place int, value double").write.mode("overwrite").parquet(f"{path}/weights")
    about = {"version": 1, "heads": {h: list(v) for h, v in model.heads.items()}, "terms": model.terms and list(model.terms), "width": model.width,
             "pairs": [list(p) for p in model.weights], "history": model.history}
    spark.createDataFrame([(json.dumps(about),)], "about string").write.mode("overwrite").parquet(f"{path}/about")


def load(spark: SparkSession, path: str) -> HeadModel:
    """A saved model, to the last bit."""
    about = json.loads(spark.read.parquet(f"{path}/about").first().about)
    if about["version"] != 1:
        raise ValueError(f"model format {about['version']} is not known")
    heads = {h: tuple(v) for h, v in about["heads"].items()}
    weights = {(c, h): np.zeros((len(heads[h]), about["width"] + 1)) for c, h in about["pairs"]}
    for r in spark.read.parquet(f"{path}/weights").collect():        # one row per coefficient
        weights[r["class"], r["head"]][r.outcome, r.place] = r.value
    return HeadModel(heads, weights, about["terms"] and tuple(about["terms"]), about["width"], [tuple(h) for h in about["history"]])
