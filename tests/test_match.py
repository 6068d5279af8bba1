"""Best-match join: exact against all pairs at any threshold, and candidates
that grow about linearly with the names."""

import random

import pytest
from pyspark.sql import functions as F

from paths import SF_MID
from strataforge.operators import match
from strataforge.plans.q_text import wide_names


def _lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[-1]))
        row = new
    return row[-1]


def _ratio(a, b):
    a, b = " ".join(sorted(a.split())), " ".join(sorted(b.split()))
    return 200.0 * _lcs(a, b) / (len(a) + len(b)) if a or b else 100.0


def _names(rng, n, letters, lo, hi):
    out = set()
    while len(out) < n:
        out.add("".join(rng.choice(letters + " ") for _ in range(rng.randint(lo, hi))))
    return sorted(out)


@pytest.mark.parametrize("letters,lo,hi,t", [("abc", 0, 9, 80.0), ("abcdef", 3, 14, 75.0), ("abcd", 1, 30, 85.0), ("abc", 0, 8, 60.0),
                                             ("ab", 0, 6, 100.0), ("ab", 0, 5, 0.0), ("abcdefghijkl", 18, 40, 72.0)])
def test_best_match_equals_all_pairs(spark, letters, lo, hi, t):
    rng = random.Random(len(letters) + hi)
    right = _names(rng, 80, letters, lo, hi)
    left = set(_names(rng, 60, letters, lo, hi))
    for k in range(0, 80, 2):
        x = list(right[k])
        for _ in range(rng.randint(1, max(1, len(x) // 5))):
            if x:
                x[rng.randrange(len(x))] = rng.choice(["", "q", letters[0]])
        left.add("".join(x))
    frame = lambda names: spark.createDataFrame([(x,) for x in [*names, None]], "n string")
    got = {r.left_name: (r.right_name, round(r.score, 6)) for r in match.best_match(frame(left), frame(right), "n", "n", t, normalise=False).collect()}
    best = {a: min((-round(_ratio(a, b), 9), b) for b in right) for a in left}
    assert got == {a: (b, round(-s, 6)) for a, (s, b) in best.items() if -s >= t}


def test_no_names(spark):
    none, some = spark.createDataFrame([], "n string"), spark.createDataFrame([("abc",), (None,)], "n string")
    for left, right in ((none, some), (some, none), (none, none)):
        assert match.best_match(left, right, "n", "n").collect() == []


def test_lcs_of_many_pairs_at_once():
    """Ends of words of 64 places, repeated and empty texts, code points beyond 16 bits."""
    rng = random.Random(3)
    text = lambda: "".join(rng.choice("abé𝄞 ") for _ in range(rng.choice((0, 1, 7, 63, 64, 65, 128, 130))))
    a, b = ([text() for _ in range(150)] for _ in range(2))
    assert match.lcs_lengths(a, b).tolist() == [_lcs(x, y) for x, y in zip(a, b)]
    assert match.lcs_lengths(["", "x"], ["", ""]).tolist() == [0, 0] and match.lcs_lengths([], []).tolist() == []


def test_pairs_are_scored_in_batches():
    import pyarrow as pa

    batch = pa.RecordBatch.from_arrays([pa.array(["abcd", "abcd", ""]), pa.array(["abcd", "xbcy", ""])], ["ls", "rs"])
    got = pa.Table.from_batches(match._scorer(80.0)([batch]))
    assert got.to_pylist() == [{"ls": "abcd", "rs": "abcd", "score": 100.0}, {"ls": "", "rs": "", "score": 100.0}]


def test_ratio_of_a_small_file_runs_in_many_tasks(spark, tmp_path):
    from strataforge.plans.q_text import token_sort_ratio

    rows = [(k, f"red {k} apple", "B") for k in range(200)] + [(None, None, None), (1, "red 1 apple", "B")]
    spark.createDataFrame(rows, "p_partkey long, p_name string, p_brand string").coalesce(1).write.parquet(str(tmp_path / "part.parquet"))
    got = token_sort_ratio(spark, str(tmp_path))
    assert len({r.p for r in got.select(F.spark_partition_id().alias("p")).distinct().collect()}) > 1
    found = got.collect()
    assert len(found) == 202 and [r.ratio for r in found if r.p_name is None] == [None]


def test_candidates_grow_about_linearly(spark):
    """Twice the names on both sides: about twice the candidates of the loosest
    level, not four times, and a handful per name."""
    names = wide_names(spark, SF_MID).where("k % 6 <> 5")

    def pairs(n):
        x = names.orderBy("k").limit(n)
        both = (x.select(F.lit("l").alias("side"), match.sort_tokens("misspelt").alias("s"))
                .unionAll(x.select(F.lit("r").alias("side"), match.sort_tokens("name").alias("s"))).distinct()
                .withColumn("n", F.length("s")))
        return both.where("side = 'r'").count(), match.candidate_pairs(match._gram_order(both, 2), 80.0).count()

    (small, a), (large, b) = pairs(5500), pairs(11000)
    assert large >= 10_000 and large == 2 * small
    assert a >= small and b < 3 * a and b < 12 * large


def _files(spark):
    """Bytes of shuffle and checkpoint files."""
    import os
    from urllib.parse import urlparse

    jvm, checkpoints = spark.sparkContext._jvm, urlparse(spark.sparkContext.getCheckpointDir()).path
    shuffled = jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    files = [shuffled.apply(i).getPath() for i in range(shuffled.size())] + [f"{d}/{f}" for d, _, names in os.walk(checkpoints) for f in names]
    return {f: os.path.getsize(f) for f in files if os.path.exists(f)}


def test_names_take_few_bytes_of_disk(spark):
    """Keys by which names meet are made inside the tasks: what is shuffled and
    checkpointed is a few packed copies of a name, not a row for each key."""
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("abcdefghijklmnopqrst") for _ in range(rng.randint(5, 9)))
    right = sorted({f"{word()} {word()}" for _ in range(3000)})
    left = [x[:k % 7] + "v" + x[k % 7 + 1:] if k % 3 else f"{word()} {word()}" for k, x in enumerate(right)]
    frame = lambda names: spark.createDataFrame([(x,) for x in names], "n string")
    before = _files(spark)
    got = match.best_match(frame(left), frame(right), "n", "n").count()
    wrote = sum(n for f, n in _files(spark).items() if f not in before)
    assert got >= len(right) * 0.5
    assert wrote < 500 * (len(left) + len(right)), wrote


@pytest.mark.parametrize("pairs,side", [(1 << 20, 100_000), (50, 7)])
def test_each_pair_meets_once(monkeypatch, pairs, side):
    """Candidates hold all pairs that reach the ratio, each pair once over all
    shards, also when names are looked up a few at a time."""
    from strataforge.operators import name_blocks as B

    for name, value in (("PAIRS", pairs), ("LIKELY", pairs), ("LEFT", side), ("RIGHT", side), ("KEYS", side)):
        monkeypatch.setattr(B, name, value)
    rng = random.Random(2)
    for letters, lo, hi, t, q in (("abcd", 3, 12, 80.0, 2), ("abcdefgh𝄞é", 8, 20, 75.0, 2), ("abcdefghijkl", 60, 75, 71.0, 2), ("abc", 1, 6, 60.0, 1)):
        right = _names(rng, 40, letters, lo, hi)
        left = sorted({x[:3] + x[4:] for x in right[:20]} | {"z" + x[1:] for x in right[20:30]} | set(_names(rng, 20, letters, lo, hi)))
        x, y = B.texts(left), B.texts([v for s in right for v in (s, s.upper())])
        rank = B.ranked(B.counted(x, q) + B.counted(y.column(0, 2), q))
        plan = B.plan_of(*[sorted({len(s) for s in z if s}) for z in (left, right)], t, q)
        met, shards = [], 5
        dealt = [{}, {}]
        for to, (text, kind, columns) in zip(dealt, ((x, "l", 1), (y, "r", 2))):
            for shard, blob in B.copies(text, kind, columns, plan, rank, shards):
                to.setdefault(shard, []).append(blob)
        for shard in range(shards):
            for a, b, li, ri, score in B.meet(shard, shards, dealt[0].get(shard, []), dealt[1].get(shard, []), 2, plan, rank, match._all):
                met += zip(a.s.strings(li), b.s.strings(ri))
                assert b.t.column(1, 2).strings(ri) == [s.upper() for s in b.s.strings(ri)]
        assert len(met) == len(set(met))
        reach = {(a, b) for a in left for b in right if 200.0 * _lcs(a, b) / max(len(a) + len(b), 1) >= t}
        assert reach and reach <= set(met)


def test_blocks_of_texts():
    from strataforge.operators import name_blocks as B

    for some in ([], [""], ["", "a", "é𝄞", "b" * 300, ""], ["x"] * 5):
        t = B.unpack(B.pack(B.texts(some)))
        assert t.strings() == some
        assert t.strings(B.np.arange(len(some))[::-1]) == some[::-1]
    h = B.homes(B.texts(["ab", "ab", "ba", ""]), 7)
    assert h[0] == h[1] and 0 <= h.min() and h.max() < 7
