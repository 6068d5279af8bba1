"""Repeated byte strings by longest-previous-factor arrays over a sparse
suffix array.

A full suffix array of a large corpus cannot be held anywhere, so suffixes
are sampled so that nothing is lost: of every ``LENGTH`` consecutive bytes
the leftmost smallest ``SEED``-byte hash is an anchor. Equal strings of
``LENGTH`` bytes choose the same anchor at the same offset, so a string can
only repeat between anchors that share their seed.

1. Blocks of documents report seeds and whole anchor contexts (the bytes of
   all strings that chose the anchor). A context that occurs twice settles
   all its strings at once; a seed with one context has no other matches.
2. What is left is one representative of every context of a seed with
   several. A bucket of seeds sorts the suffixes that start at the anchors,
   and the reversed prefixes that end there, and takes the LCP arrays of both
   orders. Positions in one LCP interval of depth ``LENGTH - o`` going right
   and of depth ``o`` going left share the string that starts ``o`` bytes
   before the anchor. Inside such an interval the smallest position is the
   one whose longest previous factor is shorter than ``LENGTH``: every other
   position has a previous or next smaller position in suffix order within
   the interval. Runs of offsets become byte spans.
3. A seed with more than ``CROWD`` contexts (a passage in a large share of
   all documents) is not gathered: its strings are looked up one by one,
   spread over all shards by their own hash. The result is the same.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataforge.llm import blocks
from strataforge.llm.arrays import Rolling, Texts, leftmost_min, mix, run_starts
from strataforge.llm.common import id_text, partitions

LENGTH, SEED = 400, 32
CROWD = 512
#: Suffixes sorted at once in a bucket.
CHUNK = 16_384
_SEED_SALT, _WINDOW_SALT = np.uint64(0x5EED), np.uint64(0xA11CE)
ENTRY = np.dtype([("a", "<i8"), ("b", "<i8"), ("n", "<i8")])
HEAD = np.dtype([("seed", "<u8"), ("doc", "<i8"), ("row", "<i4"), ("at", "<i8"), ("lo", "<i4"), ("hi", "<i4")])
ANY, LATER, ELECTED, SEVERAL, CROWDED = 1, 2, 4, 8, 16


class Anchors:
    """Anchors of some documents: position, first and last string that chose
    it, seed hash, context hash, document."""

    def __init__(self, t: Texts, length: int, seed: int):
        self.texts, self.length = t, length
        n = len(t.data) - length + 1
        self.roll = Rolling(t.symbols())
        if n <= 0:
            self.p = self.first = self.last = self.doc = np.zeros(0, np.int64)
            self.seed = self.context = np.zeros(0, np.uint64)
            return
        step = np.zeros(n + 1, np.int64)
        edge = t.offsets[1:-1]
        np.add.at(step, np.clip(edge - length + 1, 0, n), 1)
        np.add.at(step, np.minimum(edge, n), -1)
        at = np.flatnonzero(np.cumsum(step[:n]) == 0)
        grams = self.roll.windows(seed)
        chosen = leftmost_min(grams, length - seed + 1)[at]
        start = run_starts(chosen)
        self.p, self.first = chosen[start], at[start]
        self.last = at[np.append(start[1:], len(at)) - 1] if len(at) else at
        self.seed = grams[self.p]
        self.context = mix(self.roll.of(self.first, self.last + length)
                           + ((self.p - self.first).astype(np.uint64) << np.uint64(32)) + (self.p - self.last).astype(np.uint64))
        self.doc = np.searchsorted(t.offsets, self.p, "right") - 1


def _entries(keys: np.ndarray, doc: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct keys, their entries (first document and place, count), and the index of the first occurrence."""
    order = np.lexsort((at, doc, keys))
    start = run_starts(keys[order])
    out = np.zeros(len(start), ENTRY)
    first = order[start]
    out["a"], out["b"], out["n"] = doc[first], at[first], np.diff(np.append(start, len(keys)))
    return keys[first], out, first


class Block:
    """A block's documents in a fixed order, with their anchors and what the block asks first."""

    def __init__(self, table: pa.Table, length: int, seed: int):
        table = table.sort_by([("doc_id", "ascending"), ("text", "ascending")])
        self.ids, self.length = table.column("doc_id").to_numpy().astype(np.int64), length
        self.slices = [(lo, hi, Anchors(t, length, seed)) for lo, hi, t in Texts.of(table.column("text")).slices()]
        cat = lambda f, kind: np.concatenate([f(lo, x) for lo, _, x in self.slices]) if self.slices else np.zeros(0, kind)
        self.context = cat(lambda lo, x: x.context, np.uint64)
        self.seed = mix(cat(lambda lo, x: x.seed, np.uint64) ^ _SEED_SALT)
        self.row = cat(lambda lo, x: x.doc + lo, np.int64)
        self.at = cat(lambda lo, x: x.p - x.texts.offsets[x.doc], np.int64)
        c_keys, c_entry, self.c_first = _entries(self.context, self.ids[self.row], self.at)
        pair = np.lexsort((self.context, self.seed))
        pair = pair[run_starts(self.seed[pair], self.context[pair])]
        start = run_starts(self.seed[pair])
        s_keys, s_entry = self.seed[pair][start], np.zeros(len(start), ENTRY)
        ctx = self.context[pair].view(np.int64)
        if len(start):
            s_entry["a"], s_entry["b"] = np.minimum.reduceat(ctx, start), np.maximum.reduceat(ctx, start)
        s_entry["n"] = -np.diff(np.append(start, len(pair)))
        keys, entry = np.concatenate([c_keys, s_keys]), np.concatenate([c_entry, s_entry])
        order = np.argsort(keys, kind="stable")
        self.keys, self.entry = keys[order], entry[order]

    def told(self, replies: pa.Table, shards: int) -> tuple[np.ndarray, np.ndarray]:
        """Answer bits per anchor: of its context and of its seed."""
        bits = blocks.replied(replies, self.keys, shards, 1, np.uint8)
        look = lambda k: bits[np.searchsorted(self.keys, k)] if len(k) else np.zeros(0, np.uint8)
        return look(self.context), look(self.seed)

    def representatives(self, context_bits: np.ndarray, seed_bits: np.ndarray) -> np.ndarray:
        """Anchors that stand for their context in a seed with several contexts."""
        mine = np.zeros(len(self.context), bool)
        mine[self.c_first] = True
        return mine & (context_bits & ELECTED > 0) & (seed_bits & SEVERAL > 0)

    def windows(self, use: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All strings of the anchors ``use``: hash, document row, start in the document."""
        keys, row, at, base = [], [], [], 0
        for lo, _, x in self.slices:
            u = np.flatnonzero(use[base:base + len(x.p)])
            base += len(x.p)
            n = x.last[u] - x.first[u] + 1
            j = np.repeat(x.first[u] - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
            keys.append(mix(x.roll.of(j, j + self.length) ^ _WINDOW_SALT))
            d = np.repeat(x.doc[u], n)
            row.append(d + lo)
            at.append(j - x.texts.offsets[d])
        none = np.zeros(0, np.int64)
        return ((np.concatenate(keys), np.concatenate(row), np.concatenate(at)) if keys else (np.zeros(0, np.uint64), none, none))

    def members(self, use: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Headers and context bytes (left part reversed, then right part) of the anchors ``use``."""
        heads, texts, base, left = [], [], 0, self.length - 1
        span = np.arange(self.length)
        for lo, _, x in self.slices:
            u = np.flatnonzero(use[base:base + len(x.p)])
            h = np.zeros(len(u), HEAD)
            h["seed"], h["row"], h["doc"] = self.seed[base + u], x.doc[u] + lo, self.ids[x.doc[u] + lo]
            h["at"], h["lo"], h["hi"] = self.at[base + u], x.p[u] - x.last[u], x.p[u] - x.first[u]
            base += len(x.p)
            data = np.append(x.texts.data, np.uint8(0))
            back = x.p[u][:, None] - 1 - span[None, :left]
            ahead = x.p[u][:, None] + span[None, :]
            back[span[None, :left] >= h["hi"][:, None]] = len(data) - 1
            ahead[span[None, :] >= self.length - h["lo"][:, None]] = len(data) - 1
            heads.append(h)
            texts.append(np.concatenate([data[back], data[ahead]], axis=1))
        return ((np.concatenate(heads), np.concatenate(texts)) if heads
                else (np.zeros(0, HEAD), np.zeros((0, 2 * self.length - 1), np.uint8)))


def _answer(keys: np.ndarray, entry: np.ndarray, crowd: int = CROWD) -> np.ndarray:
    """Bits for every asked key of a shard, from the entries of all blocks."""
    order = np.lexsort((entry["b"], entry["a"], keys))
    start = run_starts(keys[order])
    size = np.diff(np.append(start, len(keys)))
    e = entry[order]
    out = np.zeros(len(keys), np.uint8)
    if not len(keys):
        return out
    seeds = e["n"][start] < 0
    total = np.add.reduceat(np.abs(e["n"]), start)
    several = seeds & (np.minimum.reduceat(e["a"], start) != np.maximum.reduceat(e["b"], start))
    bits = (~seeds & (total > 1)) * ANY + several * SEVERAL + (seeds & (total > crowd)) * CROWDED
    bits = np.repeat(bits.astype(np.uint8), size)
    lead = np.zeros(len(keys), bool)
    lead[start] = True
    bits[lead & np.repeat(~seeds, size)] |= ELECTED
    bits[~lead & np.repeat(~seeds, size)] |= LATER
    out[order] = bits
    return out


def _order(seed: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffix order within each seed, and the LCP with the one before (-1 across
    seeds). Padding counts as bytes: a suffix that ends in it may lie between
    two that go on with zero bytes, and must not part them; intervals deeper
    than a suffix are not asked of it."""
    order = np.argsort(np.ascontiguousarray(text).view(f"S{text.shape[1]}").ravel(), kind="stable")
    order = order[np.argsort(seed[order], kind="stable")]
    lcp = np.full(len(order), -1, np.int64)
    if len(order) > 1:
        differ = text[order[1:]] != text[order[:-1]]
        n = np.where(differ.any(1), differ.argmax(1), text.shape[1])
        lcp[1:] = np.where(seed[order[1:]] == seed[order[:-1]], n, -1)
    return order, lcp


def factor_spans(head: np.ndarray, text: np.ndarray, length: int, keep_first: bool) -> np.ndarray:
    """(member, start, end) byte spans of the strings of ``length`` bytes that
    the members (sorted by seed) share: all, or all but the first by position."""
    m = len(head)
    left, right = text[:, :length - 1], text[:, length - 1:]
    place = np.empty(m, np.int64)
    place[np.lexsort((head["at"], head["doc"]))] = np.arange(m)
    orders = [_order(head["seed"], right), _order(head["seed"], left)]

    def interval(which: int, depth: int) -> np.ndarray:
        order, lcp = orders[which]
        out = np.empty(m, np.int64)
        out[order] = np.cumsum(lcp < depth)
        return out

    found = []
    for o in range(int(head["hi"].max()) + 1 if m else 0):
        on = np.flatnonzero((head["lo"] <= o) & (o <= head["hi"]))
        if len(on) < 2:
            continue
        key = interval(0, length - o)[on] * (m + 1) + interval(1, o)[on]
        by = np.lexsort((place[on], key))
        k = key[by]
        same = k[1:] == k[:-1]
        hit = np.concatenate([[False], same])  # a smaller position in the interval
        if not keep_first:
            hit[:-1] |= same
        u = on[by[hit]]
        found.append(np.stack([u, np.full(len(u), o)], 1))
    if not found:
        return np.zeros((0, 3), np.int64)
    f = np.concatenate(found)
    f = f[np.lexsort((f[:, 1], f[:, 0]))]
    new = np.ones(len(f), bool)
    new[1:] = (f[1:, 0] != f[:-1, 0]) | (f[1:, 1] != f[:-1, 1] + 1)
    start = np.flatnonzero(new)
    end = np.append(start[1:], len(f)) - 1
    u = f[start, 0]
    return np.stack([u, head["at"][u] - f[end, 1], head["at"][u] - f[start, 1] + length], 1) if len(f) else np.zeros((0, 3), np.int64)


def _bucket_spans(parts: list[tuple[int, bytes, bytes]], length: int, keep_first: bool, chunk: int = CHUNK) -> dict[int, np.ndarray]:
    """block -> (row, start, end) spans of the members that blocks sent to one bucket."""
    if not parts:
        return {}
    head = np.concatenate([np.frombuffer(h, HEAD) for _, h, _ in parts])
    text = np.concatenate([np.frombuffer(x, np.uint8).reshape(-1, 2 * length - 1) for *_, x in parts])
    block = np.repeat([b for b, *_ in parts], [len(h) // HEAD.itemsize for _, h, _ in parts])
    order = np.argsort(head["seed"], kind="stable")
    ends = np.append(run_starts(head["seed"][order])[1:], len(order))
    out, at = [], 0
    while at < len(order):
        last = ends[np.searchsorted(ends, at + chunk, "right") - 1]
        to = last if last > at and last <= at + chunk else ends[np.searchsorted(ends, at, "right")]
        mine = order[at:to]
        s = factor_spans(head[mine], text[mine], length, keep_first)
        u = mine[s[:, 0]]
        out.append(np.stack([block[u], head["row"][u], s[:, 1], s[:, 2]], 1))
        at = to
    spans = np.concatenate(out)
    return {int(b): spans[spans[:, 0] == b][:, 1:] for b in np.unique(spans[:, 0])}


def repeated_bytes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH,
                   seed: int = SEED, keep_first: bool = True, crowd: int = CROWD, chunk: int = CHUNK) -> DataFrame:
    """(doc_id, n_bytes, n_removed, kept binary, removed array<struct<start,end>>), one row per row of ``docs``.

    Texts are UTF-8 bytes. A byte goes when it is covered by a string of
    ``length`` bytes that also starts at an earlier place (smaller id, then
    smaller offset) or, without ``keep_first``, anywhere else. Strings are
    judged on the input; matches do not cross documents. Null, empty and
    shorter texts stay whole; rows that repeat an id are separate places.
    """
    shards = partitions(docs.sparkSession)
    dealt = blocks.to_blocks(id_text(docs, id_col, text_col))

    def ask(table: pa.Table) -> pa.Table:
        b = Block(table, length, seed)
        return blocks.asked(table.column("block")[0].as_py(), b.keys, b.entry, shards)

    def ask_rest(table: pa.Table, replies: pa.Table) -> pa.Table:
        if not table.num_rows:
            return blocks.asked(0, np.zeros(0, np.uint64), None, shards)
        b, number = Block(table, length, seed), table.column("block")[0].as_py()
        context_bits, seed_bits = b.told(replies, shards)
        use = b.representatives(context_bits, seed_bits)
        crowded = seed_bits & CROWDED > 0
        keys, row, at = b.windows(use & crowded)
        keys, entry, _ = _entries(keys, b.ids[row], at)
        head, text = b.members(use & ~crowded)
        order = np.argsort(head["seed"], kind="stable")
        head, text = head[order], text[order]
        cut = blocks.cuts(head["seed"], shards)
        on = np.flatnonzero(np.diff(cut))
        more = [on.astype(np.int32), np.full(len(on), number, np.int32), np.full(len(on), -1, np.int64),
                pa.array([head[cut[i]:cut[i + 1]].tobytes() for i in on], pa.binary()),
                pa.array([text[cut[i]:cut[i + 1]].tobytes() for i in on], pa.binary())]
        first = blocks.asked(number, keys, entry, shards)
        return pa.concat_tables([first, pa.table(more, schema=first.schema)])

    def settle_shard(key, rows):
        shard = key[0].as_py()
        block, n = rows.column("block").to_pylist(), rows.column("n").to_pylist()
        keys, extra = rows.column("keys"), rows.column("extra")
        plain, spans = [i for i, x in enumerate(n) if x >= 0], [i for i, x in enumerate(n) if x < 0]
        out = []
        if plain:
            parts = [blocks.unpack(keys[i].as_py()) for i in plain]
            bits = _answer(np.concatenate(parts), np.concatenate([np.frombuffer(extra[i].as_py(), ENTRY) for i in plain]))
            out += [(block[i], 2, x.tobytes()) for i, x in zip(plain, np.split(bits, np.cumsum([len(p) for p in parts])[:-1]))]
        found = _bucket_spans([(block[i], keys[i].as_py(), extra[i].as_py()) for i in spans], length, keep_first, chunk)
        out += [(b, 3, x.astype("<i8").tobytes()) for b, x in found.items()]
        return pa.table([pa.array([x[0] for x in out], pa.int32()), pa.array([shard] * len(out), pa.int32()),
                         pa.array([x[1] for x in out], pa.int32()), pa.array([x[2] for x in out], pa.binary())],
                        ["block", "shard", "round", "reply"])

    def settle(table: pa.Table, replies: pa.Table) -> pa.Table:
        b = Block(table, length, seed)
        context_bits, seed_bits = b.told(replies, shards)
        use = b.representatives(context_bits, seed_bits) & (seed_bits & CROWDED > 0)
        keys, row, at = b.windows(use)
        distinct, entry, first = _entries(keys, b.ids[row], at)
        bits = blocks.replied(replies, distinct, shards, 2, np.uint8)
        where = np.searchsorted(distinct, keys)
        lead = np.zeros(len(keys), bool)
        lead[first] = True
        hit = (bits[where] & LATER > 0) | ~lead if keep_first else bits[where] & ANY > 0
        row, at = row[hit], at[hit]
        lead = np.zeros(len(b.context), bool)
        lead[b.c_first] = True
        whole = (context_bits & LATER > 0) | ~lead if keep_first else context_bits & ANY > 0
        spans = [np.frombuffer(x, "<i8").reshape(-1, 3) for x, r in zip(replies.column("reply").to_pylist(), replies.column("round").to_pylist()) if r == 3]
        spans = np.concatenate(spans) if spans else np.zeros((0, 3), np.int64)
        total, removed, kept, runs, base = [], [], [], [], 0
        for lo, hi, x in b.slices:
            t = x.texts
            step = np.zeros(len(t.data) + 1, np.int64)
            w = np.flatnonzero(whole[base:base + len(x.p)])
            base += len(x.p)
            np.add.at(step, x.first[w], 1)
            np.add.at(step, x.last[w] + length, -1)
            mine = (row >= lo) & (row < hi)
            place = t.offsets[row[mine] - lo] + at[mine]
            np.add.at(step, place, 1)
            np.add.at(step, place + length, -1)
            s = spans[(spans[:, 0] >= lo) & (spans[:, 0] < hi)]
            np.add.at(step, t.offsets[s[:, 0] - lo] + s[:, 1], 1)
            np.add.at(step, t.offsets[s[:, 0] - lo] + s[:, 2], -1)
            gone = np.cumsum(step[:-1]) > 0
            edge = np.zeros(len(gone) + 1, bool)
            edge[t.offsets] = True
            prev = np.concatenate([[False], gone[:-1]])
            nxt = np.concatenate([gone[1:], [False]]) if len(gone) else gone
            begin = np.flatnonzero(gone & (~prev | edge[:-1]))
            end = np.flatnonzero(gone & (~nxt | edge[1:])) + 1
            sums = np.concatenate([[0], np.cumsum(gone)])
            total.append(np.diff(t.offsets))
            removed.append(np.diff(sums[t.offsets]))
            flat, place = t.data[~gone].tobytes(), (np.arange(len(gone) + 1) - sums)[t.offsets]
            kept += [flat[i:j] for i, j in zip(place[:-1], place[1:])]
            cut = np.searchsorted(begin, t.offsets)
            rel = np.searchsorted(t.offsets, begin, "right") - 1
            begin, end = begin - t.offsets[rel], end - t.offsets[rel]
            runs += [[{"start": int(p), "end": int(q)} for p, q in zip(begin[i:j], end[i:j])] for i, j in zip(cut[:-1], cut[1:])]
        return pa.table([pa.array(b.ids, pa.int64()), pa.array(np.concatenate(total) if total else [], pa.int64()),
                         pa.array(np.concatenate(removed) if removed else [], pa.int64()), pa.array(kept, pa.binary()),
                         pa.array(runs, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))],
                        ["doc_id", "n_bytes", "n_removed", "kept", "removed"])

    first = blocks.answers(dealt.groupBy("block").applyInArrow(ask, blocks.ASKED), lambda k, e: _answer(k, e, crowd), 1, ENTRY)
    by_block = dealt.groupBy("block")
    second = by_block.cogroup(first.groupBy("block")).applyInArrow(ask_rest, blocks.ASKED).groupBy("shard").applyInArrow(
        settle_shard, blocks.REPLY)
    return by_block.cogroup(first.unionByName(second).groupBy("block")).applyInArrow(
        settle, "doc_id long, n_bytes long, n_removed long, kept binary, removed array<struct<start:long,end:long>>")


def digest(cleaned: DataFrame) -> DataFrame:
    return cleaned.select("doc_id", "n_bytes", "n_removed", F.size("removed").cast("long").alias("n_spans"),
                          F.sha2("kept", 256).alias("kept_sha256"))
