"""Language ID: held-out accuracy, determinism, rejection and edge cases."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from strataforge.llm import langid
from strataforge.llm.queries import QUERIES


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet("/root/testdata/sf0.01/documents.parquet")


@pytest.fixture(scope="module")
def model(docs):
    return langid.fit(langid.training_rows(docs))


def test_held_out_accuracy_and_clean_documents_kept(spark, docs):
    rows = QUERIES["op10_language_id"](spark, "/root/testdata/sf0.01").collect()
    truth = {r.doc_id: r.lang for r in docs.collect()}
    assert len(rows) == len(truth)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    held = [r for r in rows if r.held_out]
    assert np.mean([r.lang_pred == truth[r.doc_id] for r in held]) > 0.95
    assert all(0 <= r.score <= 1 for r in rows)
    assert np.mean([r.rejected for r in rows]) < 0.01


def test_model_is_a_distribution(model):
    ctx = np.array([0, 5 * 64 + 3, (7 * 64 + 9) * 64 + 11, 64**3 - 1])
    for m in model.models:
        for c in ctx:
            assert np.exp(m.log_probs(c * 64 + np.arange(64))).sum() == pytest.approx(1, abs=1e-4)


def test_edges(model, frame):
    rows = [(1, None), (2, ""), (3, "123 $$ \n"), (None, "the and of"), (4, "the and of the in"), (4, "the and of the in"),
            (5, "zqxj " * 400), (6, "é" * 3), (7, "x" * 300000)]
    got = {}
    for r in langid.identify(frame(rows), model).collect():
        got.setdefault(r.doc_id, []).append(r)
    assert None not in got and len(got[4]) == 2 and got[4][0] == got[4][1]
    assert all(got[i][0].lang_pred == "und" and got[i][0].score == 0 and got[i][0].rejected for i in (1, 2, 3))
    assert got[4][0].lang_pred == "en" and not got[4][0].rejected and got[5][0].rejected
    kept = langid.keep_identified(frame(rows).withColumn("score", F.col("doc_id")), model)
    assert {r.doc_id for r in kept.collect()} >= {4} and kept.columns[-1] == "score"
    assert langid.identify(frame([]), model).collect() == []


def test_neighbours_do_not_matter(model):
    alone = model.predict(["la casa de las"])
    among = model.predict(["xyz", "la casa de las", "der die das"])
    assert alone["entropy"][0] == pytest.approx(among["entropy"][1], abs=1e-9)


def test_nothing_labelled(frame):
    c = langid.fit(frame([(1, "abc", None), (2, None, "en")]))
    assert [r.lang_pred for r in langid.identify(frame([(1, "abc")]), c).collect()] == ["und"]


def _by_lang(docs, held, count):
    """(id, text, lang) of some training documents of each language, with ids drawn into or out of the calibration share."""
    ids = docs.sparkSession.range(4000).select("id", (langid.uniform("langid-calibration", F.col("id")) < langid.CALIBRATION).alias("h"))
    ids = iter(r.id for r in ids.where(F.col("h") == held).orderBy("id").collect())
    rows = langid.training_rows(docs).where("lang IS NOT NULL AND length(text) > 400").orderBy("doc_id").collect()
    return [(next(ids), r.text, r.lang) for lang in sorted({r.lang for r in rows}) for r in [r for r in rows if r.lang == lang][:count]]


@pytest.mark.parametrize(("held", "count"), [(False, 12), (True, 12), (False, 1)])
def test_languages_without_calibration_or_fitting_rows(docs, frame, held, count):
    """No training row, or every one, falls into the calibration share."""
    c = langid.fit(frame(_by_lang(docs, held, count)))
    assert all(len(m.codes[-1]) for m in c.models) and (c.usual > 0.5).all()
    clean = docs.where("crc32(cast(cast(doc_id AS string) AS binary)) % 4 = 2 AND lang IS NOT NULL AND length(text) > 400").select("text", "lang").collect()
    got = c.predict([r.text for r in clean])
    assert np.mean(got["rejected"]) < 0.02
    if count > 1:
        assert np.mean(got["lang"] == np.array([r.lang for r in clean], object)) > 0.9
        assert c.predict(["zqxj " * 400])["rejected"][0]


def test_copies_of_a_text_are_left_out_together(docs, frame):
    rows = [r for r in _by_lang(docs, False, 2) if r[2] == "en"]
    once, thrice = langid.fit(frame(rows)), langid.fit(frame(rows + [(r[0], *r[1:]) for r in rows] * 2))
    assert thrice.usual[0] > 0.8 * once.usual[0]


def test_no_text_reaches_the_driver(docs, monkeypatch):
    kept, collect = [], type(docs).collect
    monkeypatch.setattr(type(docs), "collect", lambda self: kept.append(self.columns) or collect(self))
    langid.fit(langid.training_rows(docs))
    assert kept and not any("text" in c for c in kept)
