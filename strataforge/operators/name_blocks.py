"""Names in packed blocks, dealt by their rarest grams and met in memory.

A block is one binary cell: the code points of many texts, compressed. What a
shuffle moves is so a few bytes a name instead of a row of columns, and the
combinations of grams by which names meet (hundreds a name) exist only inside
a task, for one part of a shard at a time.

A gram is a 64-bit number: the rank of its bucket by frequency on top, below it
a hash of the gram and its occurrence number. In one order of all grams, names
that share o of them share k among the first |grams| - o + k of each (prefix
filtering, extended to k common grams). So every pair shares a key of k grams,
the first of which is among the first |grams| - o + 1 of both: a name goes to
the shards of those grams, once to each.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Iterator
from functools import cache
from itertools import combinations
from typing import NamedTuple

import numpy as np
import pyarrow as pa

#: Names packed or dealt at a time; left names indexed and right names looked up at a time.
BLOCK, LEFT, RIGHT = 200_000, 100_000, 40_000
#: Codes of a table of texts, pairs of names and likely ones among them, and
#: keys made of one gram, looked at at a time (in reach of a core's cache).
CODES, PAIRS, LIKELY, KEYS = 4_000_000, 1 << 16, 1 << 20, 1 << 16
#: Buckets that grams are counted in, and bits of a gram's hash.
BUCKETS, HASH_BITS = 1 << 13, 48
#: Most grams in a key, and most keys of three or more grams a name may have.
MOST_GRAMS, MOST_KEYS = 4, 2000
#: Longest row of grams whose occurrences are counted pair by pair.
SHORT_ROW = 64
_ODD = np.uint64(0x9E3779B97F4A7C15)


# ---------------------------------------------------------------- texts

class Texts(NamedTuple):
    """Code points of texts, one after the other; where each text begins and its length."""
    codes: np.ndarray
    first: np.ndarray
    length: np.ndarray

    @classmethod
    def laid(cls, codes: np.ndarray, length: np.ndarray) -> Texts:
        return cls(codes, np.cumsum(length) - length, length)

    def take(self, rows: np.ndarray) -> Texts:
        n = self.length[rows]
        start = np.cumsum(n) - n
        return Texts(self.codes[np.repeat(self.first[rows] - start, n) + np.arange(int(n.sum()))], start, n)

    def column(self, k: int, columns: int) -> Texts:
        """Every ``columns``-th text from ``k``."""
        return Texts(self.codes, self.first[k::columns], self.length[k::columns])

    def strings(self, rows: np.ndarray | None = None) -> list[str]:
        """The texts, or those of ``rows``."""
        t = self.take(np.arange(len(self.length)) if rows is None else rows)
        whole, ends = t.codes.astype("<u4").tobytes().decode("utf-32-le"), np.cumsum(t.length).tolist()
        return [whole[a:b] for a, b in zip([0, *ends], ends)]


def texts(strings: list[str]) -> Texts:
    codes = np.frombuffer("".join(strings).encode("utf-32-le"), "<u4").astype(np.uint32)
    return Texts.laid(codes, np.fromiter(map(len, strings), np.int64, len(strings)))


def joined(parts: list[Texts]) -> Texts:
    """Texts whose codes lie one after the other, in one."""
    return parts[0] if len(parts) == 1 else Texts.laid(np.concatenate([p.codes for p in parts]), np.concatenate([p.length for p in parts]))


def _narrow(x: np.ndarray) -> np.ndarray:
    top = int(x.max()) if len(x) else 0
    return x.astype("u1" if top < 1 << 8 else "<u2" if top < 1 << 16 else "<u4")


def press(body: bytes) -> bytes:
    return len(body).to_bytes(8, "little") + pa.compress(body, codec="zstd", asbytes=True)


def unpress(blob: bytes) -> bytes:
    return pa.decompress(blob[8:], decompressed_size=int.from_bytes(blob[:8], "little"), codec="zstd", asbytes=True)


def pack(t: Texts) -> bytes:
    """Texts whose codes lie one after the other, as one compressed block."""
    codes, length = _narrow(t.codes), _narrow(t.length)
    return press(np.array([len(length), length.itemsize, codes.itemsize], "<i8").tobytes() + length.tobytes() + codes.tobytes())


def unpack(blob: bytes) -> Texts:
    body = unpress(blob)
    n, wide, code = np.frombuffer(body, "<i8", 3).tolist()
    length = np.frombuffer(body, f"<u{wide}", n, 24).astype(np.int64)
    return Texts.laid(np.frombuffer(body[24 + n * wide:], f"<u{code}").astype(np.uint32), length)


def packed(rows: Iterable[tuple[str, ...]]) -> bytes:
    """Rows of strings as one block, cell by cell."""
    return pack(texts([x for row in rows for x in row]))


def slices(rows: list, size: int = BLOCK) -> Iterator[list]:
    return (rows[i:i + size] for i in range(0, len(rows), size))


def table(t: Texts, rows: np.ndarray, n: int) -> np.ndarray:
    """Texts of length ``n`` as rows of codes."""
    return t.codes[t.first[rows][:, None] + np.arange(n)]


def same_length(t: Texts) -> Iterator[tuple[int, np.ndarray]]:
    """(length, rows) of the texts that are not empty, some of one length at a time."""
    order = np.argsort(t.length, kind="stable")
    found, at = np.unique(t.length[order], return_index=True)
    for n, lo, hi in zip(found.tolist(), at.tolist(), [*at[1:].tolist(), len(order)]):
        if n:
            step = max(CODES // n, 1)
            for a in range(lo, hi, step):
                yield n, order[a:min(a + step, hi)]


def homes(t: Texts, parts: int) -> np.ndarray:
    """A shard for each text, by its characters."""
    out = np.zeros(len(t.length), np.uint64)
    for n, rows in same_length(t):
        x, h = table(t, rows, n).astype(np.uint64), np.full(len(rows), n, np.uint64)
        for j in range(n):
            h = (h ^ x[:, j]) * _ODD
            h ^= h >> np.uint64(29)
        out[rows] = h
    return ((out >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)


# ---------------------------------------------------------------- grams

def hashed(x: np.ndarray, q: int) -> np.ndarray:
    """The characters of equally long texts, or their bigrams with both ends
    marked, each hashed with its occurrence number, so that what two texts
    share as multisets they share as sets."""
    g = x.astype(np.uint64)
    if q == 2:
        ends = [np.full((len(x), 1), c, np.uint64) for c in (0x110000, 0x110001)]
        marked = np.concatenate([ends[0], g, ends[1]], 1)
        g = (marked[:, :-1] << np.uint64(21)) | marked[:, 1:]
    wide = g.shape[1]
    before = np.zeros(g.shape, np.uint8 if wide <= SHORT_ROW else np.uint64)
    if wide <= SHORT_ROW:
        for d in range(1, wide):
            before[:, d:] += g[:, d:] == g[:, :-d]
    else:
        order = np.argsort(g, 1, kind="stable")
        s = np.take_along_axis(g, order, 1)
        at = np.broadcast_to(np.arange(wide), g.shape)
        new = np.concatenate([np.ones((len(x), 1), bool), s[:, 1:] != s[:, :-1]], 1)
        np.put_along_axis(before, order, (at - np.maximum.accumulate(np.where(new, at, 0), 1)).astype(np.uint64), 1)
    g = (g + (before.astype(np.uint64) << np.uint64(44))) * _ODD
    for k in (0xBF58476D1CE4E5B9, 0x94D049BB133111EB):
        g ^= g >> np.uint64(29)
        g *= np.uint64(k)
    return g >> np.uint64(64 - HASH_BITS)


def counted(t: Texts, q: int) -> np.ndarray:
    """Grams in each bucket."""
    out = np.zeros(BUCKETS, np.int64)
    for n, rows in same_length(t):
        out += np.bincount((hashed(table(t, rows, n), q) % np.uint64(BUCKETS)).astype(np.int64).ravel(), minlength=BUCKETS)
    return out


def ranked(counts: np.ndarray) -> np.ndarray:
    """The place of each bucket, rarest first, above the bits of a hash."""
    out = np.empty(BUCKETS, np.uint64)
    out[np.argsort(counts, kind="stable")] = np.arange(BUCKETS, dtype=np.uint64)
    return out << np.uint64(HASH_BITS)


def shard_of(grams: np.ndarray, shards: int) -> np.ndarray:
    low = grams & np.uint64((1 << 32) - 1)
    return (low * np.uint64(shards) >> np.uint64(32)).astype(np.int64)


class Grams(NamedTuple):
    """Some texts of one length: their rows and grams, rarest first."""
    n: int
    rows: np.ndarray
    grams: np.ndarray


def grams_of(t: Texts, q: int, rank: np.ndarray) -> Iterator[Grams]:
    for n, rows in same_length(t):
        h = hashed(table(t, rows, n), q)
        yield Grams(n, rows, np.sort(rank[(h % np.uint64(BUCKETS)).astype(np.int64)] | h, 1))


# ---------------------------------------------------------------- which pairs

def shared(la: int, lb: int, t: float, q: int) -> int:
    """Grams that names of lengths la, lb with ratio >= t must share: LCS >= c
    = ceil(t (la + lb) / 200), one deletion breaks q grams of a name and one
    insertion breaks q - 1 (0 where the lengths allow no such pair). A tiny
    epsilon keeps float error from raising an exact integer."""
    c = math.ceil((la + lb) * t / 200.0 - 1e-9)
    return max(c * (2 * q - 1) - (la + lb - 1) * (q - 1), 0) if c <= min(la, lb) else 0


class Plan(NamedTuple):
    """How names of some lengths can reach a ratio. ``least``: by side and
    length, the least grams shared with any partner; ``need``: by grams in a
    key, for each pair of lengths that meets on such keys the grams it shares
    at least, else -1."""
    q: int
    lengths: dict[str, np.ndarray]
    least: dict[tuple[str, int], int]
    need: dict[int, np.ndarray]

    def wide(self, n: int) -> int:
        return n + self.q - 1

    def open(self, side: str, n: int) -> int:
        """How many of a name's grams can be the first of a key (0: it has no partner)."""
        return self.wide(n) - self.least[side, n] + 1 if (side, n) in self.least else 0


def plan_of(left: list[int], right: list[int], t: float, q: int) -> Plan:
    pairs = [(a, b, o) for a in left for b in right if (o := shared(a, b, t, q)) > 0]
    least: dict[tuple[str, int], int] = {}
    for a, b, o in pairs:
        least["l", a], least["r", b] = min(o, least.get(("l", a), o)), min(o, least.get(("r", b), o))

    def most(x: tuple[str, int]) -> int:
        """Grams in a key of a name: as many as leave it few enough keys."""
        free = x[1] + q - 1 - least[x]
        return max([min(2, least[x]), *(k for k in range(3, min(MOST_GRAMS, least[x]) + 1) if math.comb(free + k, k) <= MOST_KEYS)])

    kinds, need = {x: most(x) for x in least}, {}
    place = {"l": {n: i for i, n in enumerate(left)}, "r": {n: i for i, n in enumerate(right)}}
    for a, b, o in pairs:
        k = min(kinds["l", a], kinds["r", b])
        if k not in need:
            need[k] = np.full((len(left), len(right)), -1, np.int32)
        need[k][place["l"][a], place["r"][b]] = o
    return Plan(q, {"l": np.array(left, np.int64), "r": np.array(right, np.int64)}, least, need)


# ---------------------------------------------------------------- dealing

def copies(t: Texts, side: str, columns: int, plan: Plan, rank: np.ndarray, shards: int) -> Iterator[tuple[int, bytes]]:
    """(shard, block): the names of a block, ``columns`` texts each of which the
    first has the grams, in every shard that the first gram of a key lies in."""
    s = t.column(0, columns)
    to, who = [], []
    for n, rows, grams in grams_of(s, plan.q, rank):
        if open := plan.open(side, n):
            at = np.sort(shard_of(grams[:, :open], shards), 1)
            new = np.concatenate([np.ones((len(rows), 1), bool), at[:, 1:] != at[:, :-1]], 1)
            to.append(at[new])
            who.append(np.repeat(rows, new.sum(1)))
    if not to:
        return
    to, who = np.concatenate(to), np.concatenate(who)
    order = np.argsort(to * len(s.length) + who)
    to, who = to[order], who[order]
    found, first = np.unique(to, return_index=True)
    for shard, a, b in zip(found.tolist(), first.tolist(), [*first[1:].tolist(), len(to)]):
        yield shard, pack(t.take((who[a:b, None] * columns + np.arange(columns)).ravel()))


# ---------------------------------------------------------------- meeting

@cache
def _subsets(n: int, k: int) -> np.ndarray:
    """The k-subsets of n places, a row for each member."""
    return np.array(list(combinations(range(n), k)), np.int64).reshape(math.comb(n, k), k).T.copy()


class Side:
    """Names of a shard: their texts, grams, and what pairs are first told apart by."""

    def __init__(self, t: Texts, side: str, columns: int, plan: Plan, rank: np.ndarray):
        self.t, self.s, self.side, self.plan = t, t.column(0, columns), side, plan
        self.blocks = [b for b in grams_of(self.s, plan.q, rank) if plan.open(side, b.n)]
        self.kind = np.searchsorted(plan.lengths[side], self.s.length)
        self.bits = np.zeros((2, len(self.s.length)), np.uint64)
        self.grams = np.zeros(sum(b.grams.size for b in self.blocks), np.uint64)
        self.at, done = np.zeros(len(self.s.length), np.int64), 0
        for _, rows, grams in self.blocks:
            bit, odd = np.uint64(1) << (grams & np.uint64(63)), (grams & np.uint64(64)) > 0
            for w in (0, 1):
                self.bits[w, rows] = np.bitwise_or.reduce(np.where(odd == bool(w), bit, np.uint64(0)), 1)
            self.grams[done:done + grams.size] = grams.ravel()
            self.at[rows] = done + np.arange(len(rows)) * grams.shape[1]
            done += grams.size

    def keys(self, k: int, shard: int, shards: int, low: int, index: Index | None = None) -> np.ndarray:
        """Keys, the name's row in the ``low`` lowest bits: all k-subsets of the
        grams that names of this class have in common, whose first gram lies in
        the shard; of those only what ``index`` may have, if there is one."""
        out, mask = [np.zeros(0, np.uint64)], ~np.uint64((1 << low) - 1)
        meets = (self.plan.need[k] >= 0).any(1 if self.side == "l" else 0)
        for n, rows, grams in self.blocks:
            if not meets[np.searchsorted(self.plan.lengths[self.side], n)]:
                continue
            open = self.plan.open(self.side, n)
            here = shard_of(grams[:, :open], shards) == shard
            for i in range(open):
                others = _subsets(open + k - 2 - i, k - 1)
                step = max(KEYS // others.shape[1], 1)
                found = np.flatnonzero(here[:, i])
                for a in range(0, len(found), step):
                    x = found[a:a + step]
                    g = np.ascontiguousarray(grams[x, i:open + k - 1].T)
                    key = np.repeat(g[:1], others.shape[1], 0)
                    for members in others:
                        key += g[1 + members]
                    key *= _ODD
                    key &= mask
                    key |= rows[x].astype(np.uint64)
                    key = key.ravel()
                    out.append(key if index is None else key[index.may_have(key)])
        return np.concatenate(out)


class Index:
    """Sorted keys of left names, and a table of bits of those there are."""

    def __init__(self, keys: np.ndarray, low: int):
        self.mask = np.uint64((1 << low) - 1)
        self.shift = np.uint64(64 - min(max(len(keys).bit_length() + 3, 12), 27))
        known = np.zeros(1 << (64 - int(self.shift)), bool)
        known[keys >> self.shift] = True
        self.bits = np.packbits(known, bitorder="little")
        self.sorted = np.sort(keys)

    def may_have(self, keys: np.ndarray) -> np.ndarray:
        at = keys >> self.shift
        return (self.bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8) & np.uint8(1)).view(bool)

    def pairs(self, keys: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(left row, right row) of equal keys, some at a time."""
        x = np.sort(keys)
        lo = np.searchsorted(self.sorted, x & ~self.mask)
        count = np.searchsorted(self.sorted, x | self.mask, "right") - lo
        x, lo, count = (y[count > 0] for y in (x, lo, count))
        ends = np.cumsum(count)
        a = 0
        while a < len(x):
            b = max(int(np.searchsorted(ends, ends[a] - count[a] + PAIRS, "right")), a + 1)
            n = count[a:b]
            at = np.repeat(lo[a:b] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
            yield (self.sorted[at] & self.mask).astype(np.int64), np.repeat((x[a:b] & self.mask).astype(np.int64), n)
            a = b


#: The pairs (left row, right row) that are to be kept, with a score each.
Judge = Callable[[Side, Side, np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray, np.ndarray]]


def _likely(left: Side, right: Side, k: int, li: np.ndarray, ri: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The pairs of this class of which neither name can lack too many of the
    other's grams: a bit that a name has and the other has not is a gram lacked."""
    need = left.plan.need[k][left.kind[li], right.kind[ri]]
    ok = need >= 0
    li, ri, need = li[ok], ri[ok], need[ok]
    more = left.plan.q - 1 - need
    lacks = np.zeros((2, len(li)), np.int64)
    for w in (0, 1):
        x, y = left.bits[w, li], right.bits[w, ri]
        lacks[0] += np.bitwise_count(x & ~y)
        lacks[1] += np.bitwise_count(y & ~x)
    ok = (lacks[0] <= left.s.length[li] + more) & (lacks[1] <= right.s.length[ri] + more)
    return li[ok], ri[ok]


def _owned(left: Side, right: Side, li: np.ndarray, ri: np.ndarray, shard: int, shards: int) -> np.ndarray:
    """Whether the first gram that a pair shares lies in the shard: the pair
    meets there, and is taken there only."""
    out = np.zeros(len(li), bool)
    wide = [x.s.length[y] + x.plan.q - 1 for x, y in ((left, li), (right, ri))]
    order = np.argsort(wide[1], kind="stable")
    step = max(CODES // int(wide[1].max()), 1) if len(li) else 1
    for a in range(0, len(li), step):
        todo, column = order[a:a + step], 0
        other = wide[1][todo]
        at = np.arange(int(other.max()))
        inside = at < other[:, None]
        there = np.full(inside.shape, np.uint64(2**64 - 1))      # above every gram
        there[inside] = right.grams[(right.at[ri[todo]][:, None] + at)[inside]]
        while len(todo):
            g = left.grams[left.at[li[todo]] + column]
            met = (there == g[:, None]).any(1)
            out[todo[met]] = shard_of(g[met], shards) == shard
            column += 1
            on = ~met & (wide[0][todo] > column)
            todo, there = todo[on], there[on]
    return out


def _parts(blobs: list[bytes], columns: int, most: int) -> Iterator[Texts]:
    """Some blocks at a time, at most about ``most`` names of them."""
    held: list[Texts] = []
    for b in blobs:
        t = unpack(b)
        for rows in range(0, len(t.length), most * columns):
            held.append(t if len(t.length) <= most * columns else t.take(np.arange(rows, min(rows + most * columns, len(t.length)))))
            if sum(len(x.length) for x in held) >= most * columns or sum(len(x.codes) for x in held) >= CODES:
                yield joined(held)
                held = []
    if held:
        yield joined(held)


def meet(shard: int, shards: int, lefts: list[bytes], rights: list[bytes], columns: int, plan: Plan, rank: np.ndarray,
         judge: Judge) -> Iterator[tuple[Side, Side, np.ndarray, np.ndarray, np.ndarray]]:
    """Pairs (left row, right row, score) of a shard that can reach the plan's
    ratio and that ``judge`` keeps, each pair in one shard only."""
    for lt in _parts(lefts, 1, LEFT):
        left = Side(lt, "l", 1, plan, rank)
        low = max(len(left.s.length), 2 * RIGHT).bit_length()
        index = {k: Index(left.keys(k, shard, shards, low), low) for k in sorted(plan.need)}
        for rt in _parts(rights, columns, RIGHT):
            yield from _met(left, index, low, rt, columns, rank, shard, shards, judge)


def _met(left: Side, index: dict[int, Index], low: int, rt: Texts, columns: int, rank: np.ndarray, shard: int, shards: int, judge: Judge):
    """``meet`` of indexed left and some right names, fewer where too many pairs meet at a time."""
    right = Side(rt, "r", columns, left.plan, rank)
    n, found, more = len(right.s.length), np.zeros(0, np.int64), []
    for k, x in index.items():
        for li, ri in x.pairs(right.keys(k, shard, shards, low, x)):
            li, ri = _likely(left, right, k, li, ri)
            more.append(li * n + ri)
            if sum(map(len, more)) > LIKELY:
                found, more = np.unique(np.concatenate([found, *more])), []
            if len(found) > LIKELY and n > 1:
                for rows in np.array_split(np.arange(n * columns).reshape(n, columns), 2):
                    yield from _met(left, index, low, rt.take(rows.ravel()), columns, rank, shard, shards, judge)
                return
    found = np.unique(np.concatenate([found, *more]))
    li, ri, score = judge(left, right, *np.divmod(found, max(n, 1)))
    mine = _owned(left, right, li, ri, shard, shards)
    if mine.any():
        yield left, right, li[mine], ri[mine], score[mine]
