"""Name matching.

``token_sort_ratio`` is the Indel similarity of the token-sorted strings:
100 * 2 * LCS / (len a + len b) (not Levenshtein). LCS runs bit-parallel over
the pairs of an Arrow batch, one step per character of the longest string of a
block of pairs.

The best-match join (J10) forms no cross product above threshold 0: candidates
share combinations of rare bigrams, at falling thresholds (see ``best_match``).
Names travel in packed blocks (``name_blocks``).
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataforge.functions.text import match_key, strip_all
from strataforge.operators import name_blocks as B


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def sort_tokens(c) -> Column:
    """Tokens split on white space, sorted, joined by one blank."""
    toks = F.filter(F.split(strip_all(c), r"\s+"), lambda t: t != "")
    return F.array_join(F.array_sort(toks), " ")


#: Bits of a word of ``lcs_lengths``, and words of match masks looked up at a time.
WORD, MASKS = 64, 1 << 18


def _table(codes: np.ndarray, first: np.ndarray, length: np.ndarray, width: int) -> np.ndarray:
    """Texts as rows of ``width`` codes, 0 behind their end."""
    at = np.arange(width)
    inside = at < length[:, None]
    out = np.zeros(inside.shape, np.int64)
    out[inside] = codes[(first[:, None] + at)[inside]]
    return out


def _lcs_block(short: np.ndarray, n: np.ndarray, long: np.ndarray, kinds: int) -> np.ndarray:
    """LCS lengths of the rows of two code tables (codes below ``kinds``, 0: none)."""
    rows, words = np.arange(len(n)), -(-short.shape[1] // WORD)
    mask = np.zeros((words, len(n) * kinds), np.uint64)      # places of a character in the short text
    for i in range(short.shape[1]):
        mask[i // WORD, rows * kinds + short[:, i]] |= np.uint64(1 << i % WORD)
    mask.reshape(words, len(n), kinds)[:, :, 0] = 0
    v = np.full((words, len(n)), np.uint64(2**64 - 1))
    for j in range(long.shape[1]):
        at = rows * kinds + long[:, j]
        carry = np.zeros(len(n), np.uint64)
        for w in range(words):
            m = mask[w, at]
            part = v[w] + (v[w] & m)
            total = part + carry
            carry = ((part < v[w]) | (total < part)).astype(np.uint64)
            v[w] = total | (v[w] & ~m)
    out = np.zeros(len(n), np.int64)
    for w in range(words):
        use = np.clip(n - w * WORD, 0, WORD)
        inside = np.where(use == WORD, np.uint64(2**64 - 1), (np.uint64(1) << (use % WORD).astype(np.uint64)) - np.uint64(1))
        out += np.bitwise_count(~v[w] & inside)
    return out


def lcs_lengths(a: list[str], b: list[str]) -> np.ndarray:
    """Lengths of the longest common subsequences of pairs of strings,
    bit-parallel and all pairs of a block at once: ``v`` holds a 1 for every
    position of the shorter string where the dynamic-programming row does not
    grow; per character of the longer one the matching positions ``u`` turn it
    into (v + u) | (v - u), with carries between words of 64 positions."""
    return _lcs_of(B.texts(a), B.texts(b))


def _lcs_of(a: B.Texts, b: B.Texts, x: np.ndarray | None = None, y: np.ndarray | None = None) -> np.ndarray:
    """``lcs_lengths`` of the pairs of texts (x of a, y of b), in order by default."""
    x, y = (np.arange(len(t.length)) if at is None else at for t, at in ((a, x), (b, y)))
    codes = np.concatenate([a.codes, b.codes])
    la, lb = a.length[x], b.length[y]
    first, length = np.stack([a.first[x], len(a.codes) + b.first[y]]), np.stack([la, lb])
    swap = (la > lb).astype(np.int64)
    every = np.arange(len(la))
    s, n, t, m = first[swap, every], length[swap, every], first[1 - swap, every], length[1 - swap, every]
    out = np.zeros(len(la), np.int64)
    order = np.lexsort((n, m))                               # pairs of about one length side by side
    lo = int(np.searchsorted(m[order], 1))                   # two empty strings have nothing in common
    known, codes = np.unique(codes, return_inverse=True)
    codes, kinds = codes + 1, len(known) + 1
    while lo < len(order):
        words = -(-int(n[order[lo:lo + 4096]].max()) // WORD) or 1
        hi = min(lo + max(MASKS // (kinds * words), 1), lo + 4096, len(order))
        x = order[lo:hi]
        out[x] = _lcs_block(_table(codes, s[x], n[x], int(n[x].max())), n[x], _table(codes, t[x], m[x], int(m[x].max())), kinds)
        lo = hi
    return out


def _lcs(a: pa.Array, b: pa.Array) -> pa.Array:
    known = pc.and_(pc.is_valid(a), pc.is_valid(b))
    n = lcs_lengths(a.filter(known).to_pylist(), b.filter(known).to_pylist())
    out = np.zeros(len(a), np.int32)
    out[known.to_numpy(zero_copy_only=False)] = n
    return pa.array(out, pa.int32(), mask=~known.to_numpy(zero_copy_only=False))


def lcs_length(a, b) -> Column:
    """Length of the longest common subsequence of two strings (``lcs_lengths``)."""
    return F.arrow_udf(_lcs, "int")(_c(a), _c(b))


def indel_ratio(a, b) -> Column:
    la, lb = F.length(_c(a)), F.length(_c(b))
    return (F.when((la + lb) == 0, F.lit(100.0))
             .otherwise(F.lit(200.0) * lcs_length(a, b) / (la + lb)))


def token_sort_ratio(a, b) -> Column:
    """F7."""
    return indel_ratio(sort_tokens(a), sort_tokens(b))


#: Above this threshold bigrams still tell names apart; from it down, single characters are compared.
BIGRAMS_FROM = 70.0
#: A ratio below that of any two strings that share a character.
LEAST = 1e-6

class Ordered(NamedTuple):
    """Names in packed blocks and the order of their grams. ``packed``: (kind,
    blob), kind l or r; ``lengths``: those of names that are not empty, by side."""
    packed: DataFrame
    rank: np.ndarray
    lengths: dict[str, list[int]]
    names: int


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (side, s, name) as blocks of (s, name)."""
    held: dict[str, list[tuple[str, str]]] = {}

    def blocks(side):
        return pa.RecordBatch.from_arrays([pa.array([side]), pa.array([B.packed(held.pop(side))])], ["kind", "blob"])

    for b in batches:
        for side, s, name in zip(*(c.to_pylist() for c in b.columns)):
            held.setdefault(side, []).append((s, name))
            if len(held[side]) >= B.BLOCK:
                yield blocks(side)
    yield from map(blocks, sorted(held))


def _gram_order(names: DataFrame, q: int) -> Ordered:
    """Distinct names, rows (side, s) or packed blocks (kind, blob), with an
    order of their grams, rarest first. Grams are counted in ``B.BUCKETS``
    buckets, which any number of names keeps to that many numbers."""
    if "blob" not in names.columns:
        names = names.select("side", "s", F.col("s").alias("name")).mapInArrow(_pack, "kind string, blob binary").checkpoint(eager=True)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, lengths, n = np.zeros(B.BUCKETS, np.int64), {"l": set(), "r": set()}, 0
        for b in batches:
            for side, blob in zip(*(c.to_pylist() for c in b.select(["kind", "blob"]).columns)):
                s = B.unpack(blob).column(0, 2)
                counts, n = counts + B.counted(s, q), n + len(s.length)
                lengths[side].update(np.unique(s.length[s.length > 0]).tolist())
        yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (n, B.press(counts.tobytes()), sorted(lengths["l"]), sorted(lengths["r"]))], schema=seen)

    seen = pa.schema([("n", pa.int64()), ("counts", pa.binary()), ("l", pa.list_(pa.int64())), ("r", pa.list_(pa.int64()))])
    found = names.select("kind", "blob").mapInArrow(count, "n long, counts binary, l array<long>, r array<long>").collect()   # a few kB a task
    counts = sum((np.frombuffer(B.unpress(bytes(r.counts)), np.int64) for r in found), np.zeros(B.BUCKETS, np.int64))
    return Ordered(names, B.ranked(counts), {x: sorted({n for r in found for n in r[x]}) for x in "lr"}, sum(r.n for r in found))


def _all(left: B.Side, right: B.Side, li: np.ndarray, ri: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return li, ri, np.zeros(len(li))


def _pairs_of(met) -> pa.Table:
    found = [(left.s.strings(li), right.s.strings(ri)) for left, right, li, ri, _ in met]
    return pa.table({k: pa.array([x for part in found for x in part[i]], pa.string()) for i, k in enumerate(("ls", "rs"))})


#: Names a shard of the join is made for; one task takes a few shards.
SHARD_NAMES = 60_000


def candidate_pairs(ordered: Ordered, t: float, q: int = 2, judge=_all, give=_pairs_of, schema: str = "ls string, rs string") -> DataFrame:
    """(ls, rs): every pair of a left and a right string that can have Indel
    ratio >= t, each once. Names go to the shards of the grams that can be the
    first of a key they share with a partner (``B.copies``) and meet there in
    memory (``B.meet``). ``judge`` keeps some of the pairs with a score, and
    ``give`` turns what is kept into rows of ``schema``."""
    spark, rank = ordered.packed.sparkSession, ordered.rank
    plan = B.plan_of(ordered.lengths["l"], ordered.lengths["r"], t, q)
    tasks = min(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-ordered.names // 5_000))
    shards = max(tasks, -(-ordered.names // SHARD_NAMES), 1)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[B.Texts]] = {"l": [], "r": []}

        def out(side):
            t, held[side] = B.joined(held[side]), []
            if side == "l":
                t = B.texts(list(dict.fromkeys(t.column(0, 2).strings())))
            for shard, blob in B.copies(t, side, 1 if side == "l" else 2, plan, rank, shards):
                yield pa.RecordBatch.from_arrays([pa.array([shard], pa.int32()), pa.array([side]), pa.array([blob])], ["shard", "kind", "blob"])

        for b in batches:
            for side, blob in zip(*(c.to_pylist() for c in b.columns)):
                held[side].append(B.unpack(blob))
                if sum(len(x.length) for x in held[side]) >= 2 * B.BLOCK:
                    yield from out(side)
        for side in "lr":
            if held[side]:
                yield from out(side)

    def join(rows: pa.Table) -> pa.Table:
        sides = {"l": [], "r": []}
        for side, blob in zip(rows["kind"].to_pylist(), rows["blob"].to_pylist()):
            sides[side].append(blob)
        return give(B.meet(rows["shard"][0].as_py(), shards, sides["l"], sides["r"], 2, plan, rank, judge))

    dealt = ordered.packed.select("kind", "blob").mapInArrow(deal, "shard int, kind string, blob binary")
    # a number of partitions of its own: blocks are small, what they take to join is not
    return dealt.repartition(shards, "shard").groupBy("shard").applyInArrow(join, schema)


def _scorer(least: float):
    """The pairs (ls, rs) with their Indel ratio, where it is ``least`` or more."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x, y = b.column(0).to_pylist(), b.column(1).to_pylist()
            both = np.fromiter((len(p) + len(q) for p, q in zip(x, y)), np.int64, len(x))
            score = np.where(both == 0, 100.0, 200.0 * lcs_lengths(x, y) / np.maximum(both, 1))
            keep = pa.array(score >= least)
            yield pa.RecordBatch.from_arrays([b.column(0).filter(keep), b.column(1).filter(keep), pa.array(score).filter(keep)], ["ls", "rs", "score"])
    return run


def _judge(least: float):
    """Keeps pairs with an Indel ratio of ``least`` or more."""
    def run(left: B.Side, right: B.Side, li: np.ndarray, ri: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        (x, x_at), (y, y_at) = np.unique(li, return_inverse=True), np.unique(ri, return_inverse=True)
        lcs = _lcs_of(left.s.take(x), right.s.take(y), x_at, y_at)
        score = 200.0 * lcs / np.maximum(left.s.length[li] + right.s.length[ri], 1)
        keep = score >= least
        return li[keep], ri[keep], score[keep]
    return run


def _levels(t: float) -> list[float]:
    """Thresholds tried one after the other down to t."""
    return [t + (100.0 - t) * f for f in (0.4, 0.0)] if t > BIGRAMS_FROM else [t]


#: Rows of the best-match join: kind l, blocks of (s, name) of left names
#: without a partner yet; r, of (s, name) of right names; f and p, of (left
#: name, right name) and (left s, right name), with their scores.
BLOCKS = "shard int, kind string, blob binary, scores binary"
_BLOCKS = pa.schema([("shard", pa.int32()), ("kind", pa.string()), ("blob", pa.binary()), ("scores", pa.binary())])


def _blocks(rows: list[tuple[int, str, bytes, bytes | None]]) -> pa.Table:
    return pa.table([pa.array([r[i] for r in rows], _BLOCKS.types[i]) for i in range(4)], schema=_BLOCKS)


def _laid(shard: int, kind: str, rows: list[tuple]) -> list[tuple[int, str, bytes, bytes | None]]:
    """Rows of strings, with a score at the end for kinds f and p, as blocks."""
    scored = kind in "fp"
    return [(shard, kind, B.packed([r[:2] for r in x]), B.press(np.array([r[2] for r in x]).tobytes()) if scored else None) for x in B.slices(rows, B.BLOCK // 4)]


def _rows(blob: bytes, scores: bytes | None = None) -> list[tuple]:
    x = B.unpack(blob).strings()
    return list(zip(x[0::2], x[1::2], *([np.frombuffer(B.unpress(scores)).tolist()] if scores is not None else [])))


def _by_kind(table: pa.Table) -> tuple[int, dict[str, list[tuple]]]:
    """(shard, rows by kind) of the blocks of a shard."""
    out: dict[str, list[tuple]] = {"l": [], "r": [], "p": []}
    for kind, blob, scores in zip(table["kind"].to_pylist(), table["blob"].to_pylist(), table["scores"].to_pylist()):
        out[kind].extend(_rows(blob, scores))
    return table["shard"][0].as_py(), out


def _deal_names(parts: int):
    """Rows (side, s, name) to blocks by their s, each row of a block once."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, str, str], None] = {}

        def out():
            rows, found = list(held), []
            held.clear()
            home = B.homes(B.texts([s for _, s, _ in rows]), parts).tolist()
            dealt: dict[tuple[int, str], list[tuple[str, str]]] = {}
            for (side, s, name), shard in zip(rows, home):
                dealt.setdefault((shard, side), []).append((s, name))
            for (shard, side), x in dealt.items():
                found += _laid(shard, side, x)
            return _blocks(found).to_batches()

        for b in batches:
            held.update(dict.fromkeys(zip(*(c.to_pylist() for c in b.columns))))
            if len(held) >= B.BLOCK:
                yield from out()
        if held:
            yield from out()
    return run


def _equal(t: float):
    """Left names whose s a right name has, found; the others; right names, the smallest of each s."""
    def run(table: pa.Table) -> pa.Table:
        shard, rows = _by_kind(table)
        right: dict[str, str] = {}
        for s, name in rows["r"]:
            if s not in right or name < right[s]:
                right[s] = name
        left = dict.fromkeys(rows["l"])
        same = [(name, right[s], 100.0) for s, name in left if s in right] if 100.0 >= t else []
        return _blocks(_laid(shard, "f", same) + _laid(shard, "l", [x for x in left if x[0] not in right]) + _laid(shard, "r", list(right.items())))
    return run


def _best(table: pa.Table) -> pa.Table:
    """The best of the scored pairs of each left name, and the left names without one."""
    shard, rows = _by_kind(table)
    best: dict[str, tuple[float, str]] = {}
    for s, name, score in rows["p"]:
        if s not in best or (-score, name) < best[s]:
            best[s] = (-score, name)
    found = [(name, best[s][1], -best[s][0]) for s, name in rows["l"] if s in best]
    return _blocks(_laid(shard, "f", found) + _laid(shard, "l", [x for x in rows["l"] if x[0] not in best]))


def _scored(parts: int):
    """Judged pairs as blocks by the shard of their left s."""
    def run(met) -> pa.Table:
        dealt: dict[int, list[tuple[str, str, float]]] = {}
        for left, right, li, ri, score in met:
            s = left.s.take(li)
            for shard, *row in zip(B.homes(s, parts).tolist(), s.strings(), right.t.column(1, 2).strings(ri), score.tolist()):
                dealt.setdefault(shard, []).append(tuple(row))
        return _blocks([x for shard, rows in dealt.items() for x in _laid(shard, "p", rows)])
    return run


def _found_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for blob, scores in zip(*(c.to_pylist() for c in b.columns)):
            x = _rows(blob, scores)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*x), (pa.string(), pa.string(), pa.float64()))], ["left_name", "right_name", "score"])


def _name_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for blob in b.column(0).to_pylist():
            yield pa.RecordBatch.from_arrays([pa.array([name for _, name in _rows(blob)], pa.string())], ["name"])


def best_match(left: DataFrame, right: DataFrame, left_name: str, right_name: str,
               threshold: float = 80.0, normalise: bool = True) -> DataFrame:
    """For each distinct left name, the right name with the highest
    token-sort ratio (ties: smallest right name), kept when >= threshold.
    Names are compared by their F6 keys when ``normalise``; null names are left
    out.

    Names with equal sorted tokens leave first. The others go through falling
    thresholds: at each, all pairs that can reach it are found by shared
    combinations of rare grams (``candidate_pairs``; set-similarity joins:
    Chaudhuri, Ganti and Kaushik 2006; Wang, Li and Feng 2012), scored, and
    names with a partner leave, because any partner not looked at is worse. So
    near-equal names never meet the loose bound of the last threshold, under
    which only names without a good partner are left. No step loses a pair that
    reaches the threshold.

    Between the steps names lie in packed blocks by a hash of their sorted
    tokens, where equal names meet and the best of a name's pairs is taken."""
    from strataforge.session import ensure_checkpoint_dir

    spark = left.sparkSession
    ensure_checkpoint_dir(spark)
    key = match_key if normalise else (lambda c: _c(c))
    t = float(threshold)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def names(df, col, side):
        x = F.col("name")
        return df.select(F.col(col).cast("string").alias("name")).where(x.isNotNull()).select(F.lit(side).alias("side"), sort_tokens(key(x)).alias("s"), "name")

    dealt = names(left, left_name, "l").unionAll(names(right, right_name, "r")).mapInArrow(_deal_names(parts), BLOCKS)
    state = dealt.groupBy("shard").applyInArrow(_equal(t), BLOCKS).checkpoint(eager=True)
    q = 2 if t > BIGRAMS_FROM else 1
    kind = F.col("kind")
    todo, others, out = state.where(kind == "l"), state.where(kind == "r"), [state.where(kind == "f")]
    ordered = _gram_order(todo.unionAll(others), q)
    for level in _levels(max(t, LEAST)) if t < 100 and ordered.lengths["l"] and ordered.lengths["r"] else []:
        pairs = candidate_pairs(ordered, level, q, _judge(level), _scored(parts), BLOCKS)
        state = pairs.unionAll(todo).groupBy("shard").applyInArrow(_best, BLOCKS).checkpoint(eager=True)
        todo = state.where(kind == "l")
        out.append(state.where(kind == "f"))
        if todo.isEmpty():
            break
        ordered = ordered._replace(packed=todo.unionAll(others))
    every = out[0]
    for part in out[1:]:
        every = every.unionAll(part)
    every = every.select("blob", "scores").mapInArrow(_found_rows, "left_name string, right_name string, score double")
    if t <= 0:      # names that share nothing with any partner have ratio 0 with all
        cells = lambda df: df.select("blob", "scores").mapInArrow(_name_rows, "name string")
        first = cells(others).agg(F.min("name").alias("m")).first().m
        if first is not None:
            every = every.unionAll(cells(todo).select(F.col("name").alias("left_name"), F.lit(first).alias("right_name"), F.lit(0.0).alias("score")))
    return every


def lookup_ci(df: DataFrame, dim: DataFrame, left_key: str, dim_key: str, order_col: str,
              defaults: dict, found_col: str = "found") -> DataFrame:
    """Join on lower(strip(key)); the dimension keeps its first row per
    key by load order; misses take ``defaults`` and ``found = false``."""
    vals = [c for c in dim.columns if c not in (dim_key, order_col)]
    d = (dim.withColumn("__k", F.lower(strip_all(F.col(dim_key))))
            .groupBy("__k").agg(F.min_by(F.struct(*vals), F.col(order_col)).alias("__v"))
            .select("__k", "__v.*", F.lit(True).alias(found_col)))
    out = df.withColumn("__lk", F.lower(strip_all(F.col(left_key)))).join(d, F.col("__lk") == F.col("__k"), "left")
    out = out.drop("__lk", "__k").withColumn(found_col, F.coalesce(F.col(found_col), F.lit(False)))
    for c, v in defaults.items():
        out = out.withColumn(c, F.coalesce(F.col(c), F.lit(v)))
    return out

