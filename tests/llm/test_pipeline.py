"""The corpus pipeline stage by stage against brute force."""

import pytest
from brute import lower_az, near, words

import corpus_pipeline as P
from strataforge.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for k, (_, f) in enumerate(P.STAGES):
        got = f(spark, docs, SF)
        path = str(tmp_path_factory.mktemp("stage") / str(k))
        got.write.parquet(path)
        out.append((docs, spark.read.parquet(path)))
        docs = out[-1][1]
    return out


def ids(df):
    return sorted(r.doc_id for r in df.select("doc_id").collect())


def test_columns_stay(stages):
    for before, after in stages[:-1]:
        assert before.columns == after.columns


def test_language_id_keeps_clean_documents(stages):
    before, after = stages[0]
    assert after.count() >= 0.97 * before.count()


def test_exact_and_near(stages):
    before, after = stages[1]
    best = {}
    for r in before.collect():
        k = lower_az(r.text)
        best[k] = max(best.get(k, -1), r.doc_id)
    assert ids(after) == sorted(best.values())
    before, after = stages[2]
    assert ids(after) == sorted(i for i, (_, c) in near([(r.doc_id, r.text) for r in before.collect()]).items() if i == c)


def test_decontamination_drops_exact_passages_only(spark, stages):
    before, after = stages[3]
    items = [" ".join(words(lower_az(r.text))) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    left = {r.doc_id: " ".join(words(lower_az(r.text))) for r in after.collect()}
    assert not any(f" {i} " in f" {t} " for t in left.values() for i in items if len(i.split()) >= 5)
    gone = set(ids(before)) - set(left)
    grams = lambda t: {tuple(t.split()[j:j + 5]) for j in range(len(t.split()) - 4)}
    some = set().union(*(grams(i) for i in items))
    texts = {r.doc_id: " ".join(words(lower_az(r.text))) for r in before.collect()}
    assert all(grams(texts[i]) & some for i in gone)


def test_mix_meets_targets(stages):
    before, after = stages[4]
    total = sum(len(words(r.text)) for r in before.collect())
    rows = after.collect()
    assert abs(sum(r.mix_taken for r in rows) - total) <= 20 and all(0 < r.mix_taken <= 3 * r.mix_size for r in rows)


def test_run_is_the_stages(spark, stages):
    assert sorted(tuple(r) for r in P.run(spark, SF).select("doc_id", "mix_taken").collect()) == sorted(
        tuple(r) for r in stages[-1][1].select("doc_id", "mix_taken").collect())
    assert set(f"op{i}" for i in range(1, 11)) <= {q.split("_")[0] for q in QUERIES} | {"op1"}


def test_empty_and_odd_documents(spark, frame, tmp_path):
    for name in ("benchmark", "labels"):
        spark.read.parquet(f"{SF}/{name}.parquet").limit(0).write.parquet(str(tmp_path / f"{name}.parquet"))
    odd = frame([(1, None, None, None), (2, "", "en", "a"), (3, "12 34", "en", None), (4, "the and of the", "en", "a"),
                 (4, "the and of the", "en", "a"), (None, "the", "en", "a")])
    for docs in (frame([]), odd):
        for _, f in P.STAGES:
            docs = f(spark, docs, str(tmp_path)).checkpoint()
        assert {r.doc_id for r in docs.collect()} <= {4}


def test_repeated_rows_are_not_multiplied(spark, frame, tmp_path):
    for name in ("benchmark", "labels"):
        spark.read.parquet(f"{SF}/{name}.parquet").limit(0).write.parquet(str(tmp_path / f"{name}.parquet"))
    docs = frame([(1, "one two three four five six", "en", "a")] * 3 + [(1, "other words stand here instead", "en", "a"), (2, "a third text of its own", "en", "a")])
    kept = P.exact(spark, docs, str(tmp_path))
    assert sorted(r.doc_id for r in kept.collect()) == [1, 1, 2]
    mixed = P.mix(spark, kept, str(tmp_path)).collect()
    assert sorted(r.doc_id for r in mixed) == [1, 1, 2] and all(r.mix_taken > 0 for r in mixed)
