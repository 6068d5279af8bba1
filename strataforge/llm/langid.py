"""Language identification by interpolated Kneser-Ney character models.

One 4-gram model per language is fitted on a bounded sample of labelled
documents (``sample_docs`` per language, whole texts). A model is a set of
sorted n-gram code arrays with discounted probabilities and interpolation
weights, at most ``CLASSES ** 4`` entries per language, and is broadcast.
Every text is scored whole: the distinct 4-grams of a slice are looked up
once per language by binary search, then summed per document. The language
with the lowest length-normalised cross-entropy wins. A part of the sample
that the models did not see calibrates the score (a temperature) and the
rejection limit (how far above a language's usual cross-entropy a text may be).
A language with fewer than ``LEAST_HELD`` such documents is fitted on all of
its sample and calibrated by leaving out one text at a time.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strataforge.functions.hashing import uniform
from strataforge.llm.common import id_text

#: Documents per language that the models and the calibration may read (expected number, drawn by id hash).
SAMPLE_DOCS = 3000
#: Share of the sample kept for calibration.
CALIBRATION = 0.25
#: Calibration documents with a letter that a language needs; with fewer, it is calibrated by leave-one-out.
LEAST_HELD = 8
#: 0: anything but a letter; 1-60: the most frequent letters of the sample; 61-63: other letters by block.
CLASSES = 64
OWN = 60
ORDER = 4
#: Nats a text may always lie above its language's usual cross-entropy, and standard errors added for short texts.
SLACK, SIGMAS = 0.6, 6.0
UNDETERMINED = "und"
SLICE_CHARS = 1 << 21


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


@lru_cache(maxsize=1)
def _lower() -> np.ndarray:
    out = np.arange(0x110000, dtype=np.uint32)
    for c in np.flatnonzero(_letters()):
        low = chr(c).lower()
        if len(low) == 1:
            out[c] = ord(low)
    return out


def class_table(letters: list[int]) -> np.ndarray:
    """Code point -> class; ``letters`` are the lower-case code points with a class of their own."""
    own = np.zeros(0x110000, np.uint8)
    every = np.arange(0x110000)
    own[_letters()] = (OWN + 1 + (every >> 8) % (CLASSES - OWN - 1))[_letters()]
    own[letters] = np.arange(1, len(letters) + 1)
    return own[_lower()]


def code_points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """All texts as one array, ``ORDER - 1`` blanks after each, and where each ends."""
    gap = "\n" * (ORDER - 1)
    cps = np.frombuffer((gap.join(texts) + gap).encode("utf-32-le", "surrogatepass"), np.uint32)
    return cps, np.cumsum([len(t) + ORDER - 1 for t in texts])


def grams(cls: np.ndarray) -> np.ndarray:
    """4-gram code ending at every position; positions before the start are blanks."""
    c = np.concatenate([np.zeros(ORDER - 1, np.int32), cls.astype(np.int32)])
    n = len(cls)
    code = c[:n].copy()
    for i in range(1, ORDER):
        code *= CLASSES
        code += c[i:i + n]
    return code


def scored(cls: np.ndarray) -> np.ndarray:
    """Positions that count: letters, and the blank that ends a word."""
    prev = np.concatenate([np.zeros(1, bool), cls[:-1] > 0])
    return (cls > 0) | prev


def gram_counts(texts: list[str], classes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct sorted 4-gram codes of the scored positions, and their counts."""
    cls = classes[code_points(texts)[0]]
    return np.unique(grams(cls)[scored(cls)], return_counts=True)


@dataclass
class Model:
    """Interpolated Kneser-Ney over class codes. Per order: sorted codes with
    discounted probabilities, sorted contexts with interpolation weights."""

    codes: list[np.ndarray]
    probs: list[np.ndarray]
    contexts: list[np.ndarray]
    weights: list[np.ndarray]

    @classmethod
    def fit(cls, codes: np.ndarray, counts: np.ndarray) -> Model:
        """From distinct sorted 4-gram codes and their counts."""
        out = cls([], [], [], [])
        tables = {ORDER: (codes.astype(np.int64), counts.astype(np.float64))}
        for n in range(ORDER - 1, 0, -1):  # continuation counts: distinct symbols before a shorter gram
            k, c = np.unique(tables[n + 1][0] % CLASSES**n, return_counts=True)
            tables[n] = (k, c.astype(np.float64))
        for n in range(1, ORDER + 1):
            k, c = tables[n]
            once, twice = np.sum(c == 1), np.sum(c == 2)
            d = min(max(once / (once + 2 * twice) if once else 0.5, 0.1), 0.9)
            ctx, where, kinds = np.unique(k // CLASSES, return_inverse=True, return_counts=True)
            total = np.bincount(where, c, len(ctx)) if len(ctx) else np.zeros(0)
            out.codes.append(k)
            out.probs.append(((c - d) / total[where]).astype(np.float32))
            out.contexts.append(ctx)
            out.weights.append((d * kinds / total).astype(np.float32))
        return out

    def log_probs(self, codes: np.ndarray) -> np.ndarray:
        """Natural log probability of the last symbol of each 4-gram code given the first three."""
        p = np.full(len(codes), 1.0 / CLASSES)
        for n in range(1, ORDER + 1):
            g = codes % CLASSES**n
            a, found = _look(self.codes[n - 1], g)
            w, known = _look(self.contexts[n - 1], g // CLASSES)
            p = np.where(known, self.weights[n - 1][w], 1.0) * p + np.where(found, self.probs[n - 1][a], 0.0)
        return np.log(p)


def _look(table: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.minimum(np.searchsorted(table, keys), max(len(table) - 1, 0))
    return at, (table[at] == keys) if len(table) else np.zeros(len(keys), bool)


def entropies(texts: list[str], classes: np.ndarray, models: list[Model]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(documents x languages summed -log p, scored positions, has a letter) of whole texts."""
    total, n, some = np.zeros((len(texts), len(models))), np.zeros(len(texts)), np.zeros(len(texts), bool)
    at = 0
    while at < len(texts):
        to, chars = at, 0
        while to < len(texts) and (to == at or chars + len(texts[to]) <= SLICE_CHARS):
            chars += len(texts[to])
            to += 1
        cps, ends = code_points(texts[at:to])
        cls = classes[cps]
        use = np.flatnonzero(scored(cls))
        codes = grams(cls)[use]
        seen = np.zeros(CLASSES**ORDER, bool)
        seen[codes] = True
        distinct = np.flatnonzero(seen)
        slot = np.zeros(CLASSES**ORDER, np.int32)
        slot[distinct] = np.arange(len(distinct), dtype=np.int32)
        where = slot[codes]
        cuts = np.searchsorted(use, np.concatenate([[0], ends]))
        for j, m in enumerate(models):
            sums = np.concatenate([[0.0], np.cumsum(-m.log_probs(distinct)[where])])
            total[at:to, j] = np.diff(sums[cuts])
        n[at:to] = np.diff(cuts)
        letters = np.concatenate([[0], np.cumsum(cls > 0)])
        some[at:to] = np.diff(letters[np.concatenate([[0], ends])]) > 0
        at = to
    return total, n, some


@dataclass
class Classifier:
    langs: list[str]
    classes: np.ndarray
    models: list[Model]
    temperature: float
    usual: np.ndarray
    slack: np.ndarray
    spread: float

    def predict(self, texts: list[str]) -> dict[str, np.ndarray]:
        k = len(texts)
        out = {"lang": np.full(k, UNDETERMINED, object), "score": np.zeros(k), "entropy": np.full(k, np.nan),
               "rejected": np.ones(k, bool)}
        if not self.models or not k:
            return out
        total, n, some = entropies(texts, self.classes, self.models)
        ce = total / np.maximum(n, 1)[:, None]
        best = ce.argmin(1)
        z = -self.temperature * np.sqrt(n)[:, None] * ce
        z = np.exp(z - z.max(1, keepdims=True))
        over = ce[np.arange(k), best] - self.usual[best]
        limit = self.slack[best] + SIGMAS * self.spread / np.sqrt(np.maximum(n, 1))
        out["lang"][some] = np.array(self.langs, object)[best[some]]
        out["score"][some] = (z.max(1) / z.sum(1))[some]
        out["entropy"][some] = ce[np.arange(k), best][some]
        out["rejected"] = ~some | (over > limit)
        return out


def left_out(text: str, times: int, classes: np.ndarray, codes: np.ndarray, counts: np.ndarray) -> float:
    """Cross-entropy of a text under the model of its language's counts without
    the text's ``times`` copies; of the second half of a language's only text
    under the model of the first."""
    k, c = gram_counts([text], classes)
    rest = counts.copy()
    rest[np.searchsorted(codes, k)] -= times * c
    if rest.any():
        codes, rest = codes[rest > 0], rest[rest > 0]
    else:
        cut = len(text) // 2
        codes, rest = gram_counts([text[:cut]], classes)
        text = text[cut:]
    total, n, _ = entropies([text], classes, [Model.fit(codes, rest)])
    return float(total[0, 0] / n[0]) if n[0] else float(np.log(CLASSES))


def score_truth(c: Classifier, truth: list[str], texts: list[str], times: list[int],
                few: dict[str, tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(language number, scored positions, cross-entropies) of the texts with a
    letter; a text of a language in ``few`` (codes, counts) is left out of its own model."""
    total, n, some = entropies(texts, c.classes, c.models)
    ce = total / np.maximum(n, 1)[:, None]
    y = np.array([c.langs.index(t) for t in truth], np.int64)
    for i in np.flatnonzero(some):
        if truth[i] in few:
            ce[i, y[i]] = left_out(texts[i], times[i], c.classes, *few[truth[i]])
    return y[some], n[some], ce[some]


def calibrate(c: Classifier, y: np.ndarray, n: np.ndarray, ce: np.ndarray) -> Classifier:
    """Temperature by likelihood of the true languages; usual cross-entropy and slack per language."""
    if not len(y):
        return c
    root = np.sqrt(n)[:, None]

    def loss(t: float) -> float:
        z = -t * root * ce
        z -= z.max(1, keepdims=True)
        return float(np.mean(np.log(np.exp(z).sum(1)) - z[np.arange(len(y)), y]))

    c.temperature = min((0.05, 0.1, 0.2, 0.5, 1.0, 2.0, 5.0, 10.0), key=loss)
    own = ce[np.arange(len(y)), y]
    for j in range(len(c.langs)):
        if np.any(mine := own[y == j]):
            c.usual[j] = np.median(mine)
            c.slack[j] = max(SLACK, 1.5 * (np.quantile(mine, 0.99) - c.usual[j]))
    return c


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
        sample_docs: int = SAMPLE_DOCS) -> Classifier:
    """Models of every language in ``docs`` (training rows only), null
    languages and texts left out. Reads at most about ``sample_docs``
    documents per language; what reaches the driver are n-gram counts, at most
    ``CLASSES ** 4`` per language, and one cross-entropy per language of each
    calibration document, never a text."""
    named = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull() & F.col(id_col).isNotNull())
    sizes = {r[0]: r[1] for r in named.groupBy(lang_col).count().collect()}
    if not sizes:
        return Classifier([], np.zeros(0x110000, np.uint8), [], 1.0, np.zeros(0), np.zeros(0), 2.5)
    share = F.create_map(*[x for k, n in sizes.items() for x in (F.lit(k), F.lit(min(1.0, sample_docs / n)))])
    draw = uniform("langid", F.col(id_col))
    sample = (named.where(draw < share[F.col(lang_col)])
              .select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"),
                      (uniform("langid-calibration", F.col(id_col)) < CALIBRATION).alias("held")))
    letter = F.col("text").rlike(r"\p{L}")
    drawn = sample.groupBy("lang").agg(F.count_if(F.col("held") & letter).alias("held"), F.count_if(~F.col("held") & letter).alias("own")).collect()
    langs = sorted(r["lang"] for r in drawn)
    # a language without a calibration text has the usual cross-entropy of a model that knows nothing
    empty = Classifier(langs, np.zeros(0x110000, np.uint8), [], 1.0, np.full(len(langs), np.log(CLASSES)), np.full(len(langs), SLACK), 2.5)
    scarce = [r["lang"] for r in drawn if r["held"] < LEAST_HELD or not r["own"]]
    is_scarce = F.col("lang").isin(scarce)
    fitting = sample.where(~F.col("held") | is_scarce).select("lang", "text")

    def letters(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cps, _ = code_points([t.as_py() for t in b.column(1)])
            cps = _lower()[cps[_letters()[cps]]]
            k, c = np.unique(cps, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(k, pa.int64()), pa.array(c, pa.int64())], ["cp", "n"])

    top = (fitting.mapInArrow(letters, "cp long, n long").groupBy("cp").agg(F.sum("n").alias("n"))
           .orderBy(F.desc("n"), "cp").limit(OWN).collect())
    empty.classes = class_table([r["cp"] for r in top])
    classes = docs.sparkSession.sparkContext.broadcast(empty.classes)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lang = np.array([t.as_py() for t in b.column(0)], object)
            for one in sorted(set(lang)):
                k, c = gram_counts([b.column(1)[int(i)].as_py() for i in np.flatnonzero(lang == one)], classes.value)
                yield pa.RecordBatch.from_arrays([pa.array([one] * len(k), pa.string()), pa.array(k, pa.int64()),
                                                  pa.array(c, pa.int64())], ["lang", "code", "n"])

    counts = (fitting.mapInArrow(count, "lang string, code long, n long").groupBy("lang", "code")
              .agg(F.sum("n").alias("n")).toPandas())
    few = {}
    for lang in langs:
        mine = counts[counts["lang"] == lang].sort_values("code")
        codes, n = mine["code"].to_numpy(np.int64), mine["n"].to_numpy(np.float64)
        empty.models.append(Model.fit(codes, n))
        if lang in scarce:
            few[lang] = codes, n
    held = (sample.where(F.col("held") & ~is_scarce).select("lang", "text", F.lit(1).cast("long").alias("times"))
            .unionByName(sample.where(is_scarce).groupBy("lang", "text").agg(F.count("*").alias("times"))))
    fitted = docs.sparkSession.sparkContext.broadcast((empty, few))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c, alone = fitted.value
        for b in batches:
            y, n, ce = score_truth(c, *(x.to_pylist() for x in b.columns), alone)
            yield pa.RecordBatch.from_arrays([pa.array(y, pa.int64()), pa.array(n, pa.float64()),
                                              pa.array(ce.tolist(), pa.list_(pa.float64()))], ["y", "n", "ce"])

    rows = held.mapInArrow(score, "y long, n double, ce array<double>").collect()
    return calibrate(empty, np.array([r["y"] for r in rows], np.int64), np.array([r["n"] for r in rows]),
                     np.array([r["ce"] for r in rows]).reshape(len(rows), len(langs)))


def _row_schema(docs: DataFrame) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in docs.schema.fields])


def identify(docs: DataFrame, classifier: Classifier, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score, cross_entropy, rejected), one row per row of ``docs``.

    Null, empty and letterless texts are ``und`` with score 0 and rejected;
    ties go to the language that sorts first; without any labelled document
    everything is ``und``. Equal texts get equal results.
    """
    shared = docs.sparkSession.sparkContext.broadcast(classifier)

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            p = shared.value.predict(b.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(p["lang"].tolist(), pa.string()), pa.array(p["score"], pa.float64()),
                 pa.array(p["entropy"], pa.float64()), pa.array(p["rejected"], pa.bool_())],
                ["doc_id", "lang_pred", "score", "cross_entropy", "rejected"])

    return id_text(docs, id_col, text_col).mapInArrow(
        label, "doc_id long, lang_pred string, score double, cross_entropy double, rejected boolean")


def keep_identified(docs: DataFrame, classifier: Classifier, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose text is not rejected, with all their columns; no shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast(classifier)
    at = docs.columns.index(text_col)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [t or "" for t in b.column(at).to_pylist()]
            yield b.filter(pa.array(~shared.value.predict(texts)["rejected"]))

    return docs.mapInArrow(keep, _row_schema(docs))


def training_rows(docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Rows whose crc32 of the id as text leaves another remainder than 2 by 4."""
    return docs.where(~held_out(id_col, 4))


def held_out(id_col: str, folds: int):
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % folds == 2
