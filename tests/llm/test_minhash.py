"""Near-duplicates against all-pairs brute force."""

import random

import numpy as np
import pyarrow as pa
from brute import near, shingles

from strataforge.llm import minhash
from strataforge.llm.arrays import Texts
from strataforge.llm.components import components


def corpus(seed=3):
    rng = random.Random(seed)
    vocab = [f"W{i}" for i in range(300)] + ["the", "of", "é😀"]
    out = []
    for _ in range(40):
        base = [rng.choice(vocab) for _ in range(rng.choice([3, 4, 6, 9, 30, 120, 400]))]
        out.append(base)
        for _ in range(rng.randint(0, 8)):
            copy = list(base)
            for _ in range(rng.randint(0, max(1, len(base) // 25))):
                copy[rng.randrange(len(copy))] = rng.choice(vocab)
            out.append(copy)
    rng.shuffle(out)
    texts = [rng.choice([" ", "\n", " \t"]).join(w) for w in out]
    return list(enumerate([None, "", " \n", "one", "ONE", "one two three four", "one two three four five", *texts]))


def run(df):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in minhash.near_duplicates(df).collect()}


def test_matches_brute_force(frame):
    rows = corpus()
    assert run(frame(rows)) == near(rows)


def test_documents_table(spark):
    d = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    assert run(d) == near([(r.doc_id, r.text) for r in d.collect()])


def test_hot_group_of_near_copies(frame):
    rng = random.Random(9)
    base = [f"t{i}" for i in range(200)]
    rows = []
    for i in range(400):
        w = list(base)
        for _ in range(rng.randint(0, 5)):
            w[rng.randrange(200)] = f"x{rng.randrange(10**6)}"
        rows.append((i, " ".join(w)))
    assert run(frame(rows)) == near(rows)


def test_chain_linked_only_through_the_largest_id(frame):
    base = [f"t{i}" for i in range(150)]
    rows = []
    for i in range(40):
        w = list(base)
        w[3 * i] = w[149 - 3 * i] = w[(i * 37) % 150] = f"x{i}"
        rows.append((i, " ".join(w)))
    rows.append((99, " ".join(base)))
    assert run(frame(rows)) == near(rows)


def test_large_mixed_buckets_are_split(frame, monkeypatch):
    """Unrelated documents around one long passage: buckets mix many components."""
    monkeypatch.setattr(minhash, "LISTED", 1)
    rng = random.Random(4)
    passage = [f"p{i}" for i in range(60)]
    rows = []
    for i in range(60):
        own = [f"d{i}x{j}" for j in range(rng.randint(15, 40))]
        rows.append((2 * i, " ".join(passage + own)))
        if i % 3 == 0:
            rows.append((2 * i + 1, " ".join(passage + own[:-3] + ["y1", "y2", "y3"])))
    assert run(frame(rows)) == near(rows)


def test_edges(frame):
    assert run(frame([])) == {}
    rows = [(None, "a b c d e f"), (7, "a b c d e f"), (7, "a b c d e f"), (9, "A B c d e f"), (8, "word " * 200000), (10, None)]
    assert run(frame(rows)) == {7: (2, 7), 9: (2, 7), 8: (1, 8), 10: (0, 10)}
    kept = minhash.drop_near(frame([(1, "a b c d e f"), (2, "a b c d e F"), (3, None)])).collect()
    assert sorted(r.doc_id for r in kept) == [1, 3]


def test_signature_estimates_similarity():
    rng = np.random.default_rng(5)
    texts = []
    for j in (0.5, 0.75, 0.9):
        for _ in range(60):
            same, n = [f"s{x}" for x in rng.integers(0, 10**9, int(300 * j))], 300 - int(300 * j)
            texts += [" ".join(same + [f"a{x}" for x in rng.integers(0, 10**9, n)]), " ".join(same + [f"b{x}" for x in rng.integers(0, 10**9, n)])]
    keys, size = minhash.shingle_sets(Texts.of(pa.array(texts)))
    sig = minhash.signatures(keys, len(texts))
    for i in range(0, len(texts), 120):
        got = np.mean(sig[i:i + 120:2] == sig[i + 1:i + 120:2])
        want = np.mean([len(shingles(a) & shingles(b)) / len(shingles(a) | shingles(b)) for a, b in zip(texts[i:i + 120:2], texts[i + 1:i + 120:2])])
        assert abs(got - want) < 0.03


def test_components_of_paths_and_hubs(spark):
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(100, 160)] + [(200, i) for i in range(201, 300)] + [(i, 900) for i in range(1000, 1050)]
    rng.shuffle(edges)
    got = {r.id: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got[i] == 100 for i in range(100, 161)) and all(got[i] == 200 for i in range(200, 300))
    assert got[900] == 900 and all(got[i] == 900 for i in range(1000, 1050))


def test_crowd_of_rewrites_near_the_threshold(frame):
    """1,000 rewrites of one text in pairs: the two of a pair change the same words and lie just above the
    threshold, all others below it, and nothing but the text of all is shared, so no small bucket helps a pair."""
    rng = random.Random(11)
    rows = []
    for i in range(500):
        places = [5 + 5 * x + rng.randrange(5) for x in rng.sample(range(0, 54, 2), 8)]
        for copy in "xy":
            w = [f"t{k}" for k in range(286)]
            for at in places:
                w[at] = f"{copy}{i}p{at}"
            rows.append((len(rows), " ".join(w)))
    want = near(rows)
    assert len({c for _, c in want.values()}) <= 500
    assert run(frame(rows)) == want


def test_shared_counts_every_pair(monkeypatch):
    monkeypatch.setattr(minhash, "RARE", 3)
    monkeypatch.setattr(minhash, "WIDE", 7)
    rng = np.random.default_rng(8)
    sets = [np.unique(rng.integers(0, 60, n).astype(np.uint64)) for n in (1, 5, 20, 40, 40, 60, 3)]
    assert minhash.shared(sets).tolist() == [[len(np.intersect1d(a, b)) for b in sets] for a in sets]


def test_few_links_take_few_partitions(spark):
    """A small link table is not carried through the rounds in as many partitions as the session has."""
    held = {"spark.sql.shuffle.partitions": "40", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k) for k in held}
    for k, v in held.items():
        spark.conf.set(k, v)
    try:
        got = components(spark.createDataFrame([(i, i + 1) for i in range(30)] + [(100, 200)], "a long, b long"))
        assert got.rdd.getNumPartitions() <= 4
        assert {r.id: r.component for r in got.collect()} == {**{i: 0 for i in range(31)}, 100: 100, 200: 100}
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_few_documents_take_few_tasks(spark, frame):
    """Tables of ids and numbers of near dedup are dealt by their rows, not by the session's partitions: every
    task costs the driver memory. What reads texts keeps the session's partitions."""
    rng = random.Random(5)
    base = [f"w{i}" for i in range(120)]
    rows = [(i, " ".join(base[:115 - i % 5] + [f"z{i}"] * (i % 3))) for i in range(30)]
    rows += [(100 + i, " ".join(f"u{rng.randrange(10**6)}" for _ in range(40))) for i in range(20)]
    held = {"spark.sql.shuffle.partitions": "60", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k) for k in held}
    for k, v in held.items():
        spark.conf.set(k, v)
    spark.sparkContext.setJobGroup("few-tasks", "near duplicates")
    try:
        assert run(frame(rows)) == near(rows)
        track = spark.sparkContext.statusTracker()
        stages = {s for j in track.getJobIdsForGroup("few-tasks") for s in track.getJobInfo(j).stageIds}
        assert sum(track.getStageInfo(s).numCompletedTasks for s in stages) < 1800
    finally:
        spark.sparkContext._jsc.clearJobGroup()
        for k, v in old.items():
            spark.conf.set(k, v)


def test_second_links_extend_the_first_components(frame, monkeypatch):
    """Links found after the stars join whole components, their smallest ids and the documents between them."""
    rng = random.Random(12)
    rows = []
    for g in range(6):
        base = [f"g{g}w{i}" for i in range(160)]
        for i in range(25):
            w = list(base)
            for j in range(i % 9):
                w[(i * 7 + j * 11) % 160] = f"x{g}y{i}z{j}"
            rows.append((rng.randrange(10**6) * 200 + len(rows), " ".join(w)))
    for listed in (0, 8):
        monkeypatch.setattr(minhash, "LISTED", listed)
        assert run(frame(rows)) == near(rows)
