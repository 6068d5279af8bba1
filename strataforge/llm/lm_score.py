"""Scoring texts with an n-gram model held in Elias-Fano tries.

The model is an interpolated, absolutely discounted trigram model over an
add-one unigram base. Its n-grams live in one trie per shard of the word-hash
space: all n-grams of a first word are in one shard. A trie has three levels:
words in hash order, and for every word, then every pair, the sorted 32-bit
hashes of its successors. The pointers from a level to the next are monotone
and stored Elias-Fano coded; discounted probabilities and interpolation
weights are stored as 8-bit codes on a logarithmic scale. A trie is one byte
string whose levels are read in place (``Trie.view`` on a buffer,
``Trie.open`` on a memory-mapped file), and a query walks it by searching the
successor inside its context's range.

Blocks of documents send their distinct n-grams with training counts to the
shards, once; a shard merges them, builds its trie, answers every block from
it, and can hand the trie out as a table (``train``). Counts cover all
training documents and what is exchanged grows with the input.
"""

from __future__ import annotations

import struct
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataforge.llm import blocks
from strataforge.llm.arrays import Texts, Words
from strataforge.llm.common import partitions

DISCOUNT = 0.75
#: 8-bit codes: 0 stands for nothing stored, q for 10 ** (-(q - 1) / STEPS).
STEPS = 32
#: Hashes of the end of a text (counted as a token) and of its beginning (context only).
END, BEGIN = np.uint64(0x0123456789ABCDEF), np.uint64(0xFEDCBA9876543210)
HIGH = np.uint64(32)


# ---------------------------------------------------------------- Elias-Fano

@dataclass
class EliasFano:
    """A monotone sequence: low bits in a packed array, high bits in unary."""

    n: int
    low_bits: int
    lows: np.ndarray
    highs: np.ndarray
    ranks: np.ndarray

    @staticmethod
    def encode(values: np.ndarray) -> bytes:
        n, top = len(values), int(values[-1]) if len(values) else 0
        low = max(0, (top // max(n, 1)).bit_length() - 1)
        v = values.astype(np.uint64)
        bits = ((v[:, None] >> np.arange(low, dtype=np.uint64)) & np.uint64(1)).astype(np.uint8) if low else np.zeros((n, 0), np.uint8)
        unary = np.zeros(n + (top >> low) + 1, np.uint8)
        unary[(v >> np.uint64(low)).astype(np.int64) + np.arange(n)] = 1
        lows, highs = np.packbits(bits.reshape(-1), bitorder="little"), np.packbits(unary, bitorder="little")
        return struct.pack("<QQQQ", n, low, len(lows), len(highs)) + lows.tobytes() + highs.tobytes()

    @classmethod
    def view(cls, data: np.ndarray, at: int) -> tuple[EliasFano, int]:
        n, low, a, b = struct.unpack("<QQQQ", data[at:at + 32].tobytes())
        lows, highs = data[at + 32:at + 32 + a], data[at + 32 + a:at + 32 + a + b]
        ranks = np.concatenate([[0], np.cumsum(np.bitwise_count(highs), dtype=np.int64)])
        return cls(n, low, lows, highs, ranks), at + 32 + a + b

    def get(self, i: np.ndarray) -> np.ndarray:
        """Values at positions ``i``: select in the unary part, then the low bits."""
        byte = np.searchsorted(self.ranks, i, "right") - 1
        left = i - self.ranks[byte]
        bits = np.unpackbits(self.highs[byte][:, None], axis=1, bitorder="little")
        bit = (np.cumsum(bits, axis=1) == (left + 1)[:, None]).argmax(1)
        high = byte * 8 + bit - i
        low = np.zeros(len(i), np.int64)
        place = i * self.low_bits
        for k in range(self.low_bits):
            p = place + k
            low |= ((self.lows[p >> 3] >> (p & 7).astype(np.uint8)) & 1).astype(np.int64) << k
        return (high << self.low_bits) | low


# ---------------------------------------------------------------- trie

def quantise(x: np.ndarray) -> np.ndarray:
    """8-bit codes of probabilities; 0 for 0."""
    with np.errstate(divide="ignore"):
        q = np.rint(-np.log10(x) * STEPS) + 1
    return np.where(x > 0, np.clip(q, 1, 255), 0).astype(np.uint8)


_VALUE = np.concatenate([[0.0], 10.0 ** (-np.arange(255) / STEPS)])


def _search(keys: np.ndarray, lo: np.ndarray, hi: np.ndarray, want: np.ndarray) -> np.ndarray:
    """First position in [lo, hi) whose key is not below ``want``; -1 where it is another key."""
    lo, end = lo.copy(), hi
    hi = hi.copy()
    while np.any(open_ := lo < hi):
        mid = (lo + hi) >> 1
        below = open_ & (keys[np.minimum(mid, len(keys) - 1)] < want)
        lo = np.where(below, mid + 1, lo)
        hi = np.where(open_ & ~below, mid, hi)
    at = np.minimum(lo, max(len(keys) - 1, 0))
    return np.where((lo < end) & (keys[at] == want), lo, -1) if len(keys) else np.full(len(want), -1)


@dataclass
class Trie:
    """Levels of a shard, read in place."""

    words: np.ndarray
    counts: np.ndarray
    weight1: np.ndarray
    to2: EliasFano
    next2: np.ndarray
    prob2: np.ndarray
    weight2: np.ndarray
    to3: EliasFano
    next3: np.ndarray
    prob3: np.ndarray

    @staticmethod
    def build(words: np.ndarray, c1: np.ndarray, key2: np.ndarray, c2: np.ndarray, key3: np.ndarray, c3: np.ndarray,
              discount: float = DISCOUNT) -> bytes:
        """From sorted words, pairs (word index << 32 | hash) and triples (pair index << 32 | hash)
        with training counts; pairs and triples have counts above 0."""
        def level(parents: int, key: np.ndarray, c: np.ndarray):
            parent = (key >> HIGH).astype(np.int64)
            kinds, total = np.bincount(parent, minlength=parents), np.bincount(parent, c, parents)
            prob = quantise((c - discount) / total[parent]) if len(c) else np.zeros(0, np.uint8)
            weight = np.where(total > 0, discount * kinds / np.maximum(total, 1), 0)
            return EliasFano.encode(np.concatenate([[0], np.cumsum(kinds)])), (key & np.uint64(0xFFFFFFFF)).astype("<u4"), prob, quantise(weight)

        to2, next2, prob2, weight1 = level(len(words), key2, c2)
        to3, next3, prob3, weight2 = level(len(key2), key3, c3)
        width = 4 if not len(c1) or int(c1.max()) < 1 << 32 else 8
        head = struct.pack("<QQQQ", len(words), len(next2), len(next3), width)
        return b"".join([head, words.astype("<u8").tobytes(), c1.astype(f"<u{width}").tobytes(), next2.tobytes(), next3.tobytes(),
                         weight1.tobytes(), prob2.tobytes(), weight2.tobytes(), prob3.tobytes(), to2, to3])

    @classmethod
    def view(cls, data: np.ndarray) -> Trie:
        n1, n2, n3, width = struct.unpack("<QQQQ", data[:32].tobytes())
        at, out = 32, []
        for n, kind in ((n1, "<u8"), (n1, f"<u{width}"), (n2, "<u4"), (n3, "<u4"), (n1, "u1"), (n2, "u1"), (n2, "u1"), (n3, "u1")):
            size = n * np.dtype(kind).itemsize
            out.append(data[at:at + size].view(kind))
            at += size
        words, counts, next2, next3, weight1, prob2, weight2, prob3 = out
        to2, at = EliasFano.view(data, at)
        to3, _ = EliasFano.view(data, at)
        return cls(words, counts, weight1, to2, next2, prob2, weight2, to3, next3, prob3)

    @classmethod
    def open(cls, path: str) -> Trie:
        return cls.view(np.memmap(path, np.uint8, "r"))

    def find1(self, words: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.words, words), max(len(self.words) - 1, 0))
        return np.where(self.words[at] == words, at, -1) if len(self.words) else np.full(len(words), -1)

    def _next(self, pointers: EliasFano, keys: np.ndarray, parent: np.ndarray, want: np.ndarray) -> np.ndarray:
        known = parent >= 0
        out = np.full(len(parent), -1, np.int64)
        if known.any():
            p = parent[known]
            out[known] = _search(keys, pointers.get(p), pointers.get(p + 1), want[known])
        return out

    def find2(self, word: np.ndarray, want: np.ndarray) -> np.ndarray:
        return self._next(self.to2, self.next2, word, want)

    def find3(self, pair: np.ndarray, want: np.ndarray) -> np.ndarray:
        return self._next(self.to3, self.next3, pair, want)


def _at(values: np.ndarray, i: np.ndarray) -> np.ndarray:
    return np.where(i >= 0, values[np.maximum(i, 0)], 0) if len(values) else np.zeros(len(i), values.dtype)


# ---------------------------------------------------------------- blocks

def _small(x: np.ndarray) -> bytes:
    """Non-negative integers in the narrowest width; counts and codes, which repeat, are deflated, hashes are not."""
    top = int(x.max()) if len(x) else 0
    kind = "u1" if top < 1 << 8 else "<u2" if top < 1 << 16 else "<u4" if top < 1 << 32 else "<u8"
    body = x.astype(kind).tobytes()
    if x.dtype != np.uint32:
        body = zlib.compress(body, 1)
    return struct.pack("<QBB", len(body), np.dtype(kind).itemsize, x.dtype != np.uint32) + body


def _smalls(data: bytes, n: int) -> list[np.ndarray]:
    at, out = 0, []
    for _ in range(n):
        size, width, deflated = struct.unpack_from("<QBB", data, at)
        body = data[at + 10:at + 10 + size]
        out.append(np.frombuffer(zlib.decompress(body) if deflated else body, f"<u{width}"))
        at += 10 + size
    return out


class Block:
    """The tokens of a block and its distinct words, pairs and triples in trie order."""

    def __init__(self, table: pa.Table):
        self.ids = table.column("doc_id")
        self.train = np.array(table.column("train").to_pylist(), bool)
        hashes, counts = [], []
        for lo, hi, t in Texts.of(table.column("text")).slices():
            w = Words(t, lower=True)
            begin = np.cumsum(w.counts + 2) - (w.counts + 2)
            h = np.empty(len(w.hashes) + 2 * t.n, np.uint64)
            h[np.arange(len(w.hashes)) + 2 * w.doc + 1] = w.hashes
            h[begin] = BEGIN
            h[begin + w.counts + 1] = END
            hashes.append(h)
            counts.append(w.counts + 2)
        h = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
        self.size = np.concatenate(counts) if counts else np.zeros(0, np.int64)
        self.doc = np.repeat(np.arange(len(self.size)), self.size)
        place = np.arange(len(h)) - np.repeat(np.cumsum(self.size) - self.size, self.size)
        self.words, self.word = np.unique(h, return_inverse=True)
        v = max(len(self.words), 1)
        #: tokens (all but beginnings), and those of them with two words before
        self.token, self.second = np.flatnonzero(place > 0), np.flatnonzero(place > 1)
        pair = self.word[self.token - 1] * v + self.word[self.token]
        self.pairs, which = np.unique(pair, return_inverse=True)
        self.pair = np.full(len(h), -1)
        self.pair[self.token] = which
        triple = self.pair[self.second - 1] * v + self.word[self.second]
        self.triples, self.triple = np.unique(triple, return_inverse=True)
        on = self.train[self.doc]
        self.c1 = np.bincount(self.word[self.token], on[self.token], len(self.words)).astype(np.int64)
        self.c2 = np.bincount(which, on[self.token], len(self.pairs)).astype(np.int64)
        self.c3 = np.bincount(self.triple, on[self.second], len(self.triples)).astype(np.int64)
        self.first2 = np.searchsorted(self.pairs, np.arange(len(self.words) + 1) * v)
        self.first3 = np.searchsorted(self.triples, np.arange(len(self.pairs) + 1) * v)
        self.v = v

    def cuts(self, shards: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Where each shard's words, pairs and triples begin."""
        one = blocks.cuts(self.words, shards)
        two = self.first2[one]
        return one, two, self.first3[two]

    def ask(self, block: int, shards: int) -> pa.Table:
        a, b, c = self.cuts(shards)
        tail = (self.words >> HIGH).astype(np.uint32)
        keys, extra = [], []
        for i in range(shards):
            w, p, t = slice(a[i], a[i + 1]), slice(b[i], b[i + 1]), slice(c[i], c[i + 1])
            keys.append(blocks.pack(self.words[w]))
            fan2, fan3 = np.diff(self.first2[a[i]:a[i + 1] + 1]), np.diff(self.first3[b[i]:b[i + 1] + 1])
            extra.append(b"".join(map(_small, (self.c1[w], fan2, tail[self.pairs[p] % self.v], self.c2[p], fan3,
                                               tail[self.triples[t] % self.v], self.c3[t]))))
        schema = pa.schema([("shard", pa.int32()), ("block", pa.int32()), ("n", pa.int64()), ("keys", pa.binary()), ("extra", pa.binary())])
        return pa.table([np.arange(shards, dtype=np.int32), np.full(shards, block, np.int32), np.diff(a), pa.array(keys, pa.binary()),
                         pa.array(extra, pa.binary())], schema=schema)

    def scores(self, replies: pa.Table, shards: int) -> tuple[np.ndarray, ...]:
        """Per document: tokens, known tokens, base and model log10 probability; and the training tokens."""
        parts: list = [None] * shards
        total = kinds = 0
        for shard, reply in zip(replies.column("shard").to_pylist(), replies.column("reply").to_pylist()):
            n, v = struct.unpack_from("<QQ", reply)
            total, kinds = total + n, kinds + v
            parts[shard] = _smalls(reply[16:], 5)
        count, weight1, prob2, weight2, prob3 = (np.concatenate([p[i] for p in parts]) for i in range(5))
        base = (count + 1.0) / (total + kinds + 1.0)
        p = base[self.word]
        t = self.token
        weight = np.where(weight1 > 0, _VALUE[weight1], 1.0)
        p[t] = _VALUE[prob2[self.pair[t]]] + weight[self.word[t - 1]] * p[t]
        s = self.second
        weight = np.where(weight2 > 0, _VALUE[weight2], 1.0)
        p[s] = _VALUE[prob3[self.triple]] + weight[self.pair[s - 1]] * p[s]
        n = len(self.size)
        d = self.doc[t]
        known = np.bincount(d, count[self.word[t]] > 0, n).astype(np.int64)
        return (self.size - 1, known, np.bincount(d, np.log10(base[self.word[t]]), n), np.bincount(d, np.log10(p[t]), n), total)


def _merged(rows: list[tuple[bytes, bytes]]):
    """The words, pairs and triples of all blocks of a shard with summed counts, and each block's places in them."""
    parts = [(blocks.unpack(k), *_smalls(x, 7)) for k, x in rows]
    cat = lambda i: np.concatenate([p[i] for p in parts])
    words, at1 = np.unique(cat(0), return_inverse=True)
    c1 = np.bincount(at1, cat(1), len(words)).astype(np.int64)
    key2 = (np.repeat(at1, cat(2)).astype(np.uint64) << HIGH) | cat(3).astype(np.uint64)
    pairs, at2 = np.unique(key2, return_inverse=True)
    c2 = np.bincount(at2, cat(4), len(pairs)).astype(np.int64)
    key3 = (np.repeat(at2, cat(5)).astype(np.uint64) << HIGH) | cat(6).astype(np.uint64)
    triples, at3 = np.unique(key3, return_inverse=True)
    c3 = np.bincount(at3, cat(7), len(triples)).astype(np.int64)
    return words, c1, pairs, c2, triples, c3


def shard_trie(rows: list[tuple[bytes, bytes]]) -> bytes:
    """The trie of a shard's training n-grams."""
    words, c1, pairs, c2, triples, c3 = _merged(rows)
    on1 = (c1 > 0) | (np.bincount((pairs >> HIGH).astype(np.int64), c2, len(words)) > 0)
    on2, on3 = c2 > 0, c3 > 0
    new1, new2 = np.cumsum(on1) - 1, np.cumsum(on2) - 1
    low = np.uint64(0xFFFFFFFF)
    renumber = lambda key, new: (new[(key >> HIGH).astype(np.int64)].astype(np.uint64) << HIGH) | (key & low)
    return Trie.build(words[on1], c1[on1], renumber(pairs[on2], new1), c2[on2], renumber(triples[on3], new2), c3[on3])


def trie_answer(trie: Trie, keys: bytes, extra: bytes) -> bytes:
    """Counts, probabilities and weights of a block's n-grams, found by walking the trie."""
    words, (_, fan2, tail2, _, fan3, tail3, _) = blocks.unpack(keys), _smalls(extra, 7)
    one = trie.find1(words)
    two = trie.find2(np.repeat(one, fan2), tail2)
    three = trie.find3(np.repeat(two, fan3), tail3)
    return b"".join(map(_small, (_at(trie.counts, one).astype(np.int64), _at(trie.weight1, one), _at(trie.prob2, two), _at(trie.weight2, two),
                                 _at(trie.prob3, three))))


def _asked(docs: DataFrame, train: Column, id_col: str, text_col: str):
    shards = partitions(docs.sparkSession)
    rows = (docs.where(F.col(id_col).isNotNull())
            .select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"),
                    F.coalesce(train, F.lit(False)).alias("train")))
    dealt = blocks.to_blocks(rows, 1)

    def ask(table: pa.Table) -> pa.Table:
        return Block(table).ask(table.column("block")[0].as_py(), shards)

    return dealt, dealt.groupBy("block").applyInArrow(ask, blocks.ASKED), shards


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(shard, trie): the model of all of ``docs`` as one byte string per shard."""
    _, asked, _ = _asked(docs, F.lit(True), id_col, text_col)

    def build(key, rows):
        trie = shard_trie(list(zip(rows.column("keys").to_pylist(), rows.column("extra").to_pylist())))
        return pa.table([pa.array([key[0].as_py()], pa.int32()), pa.array([trie], pa.binary())], ["shard", "trie"])

    return asked.groupBy("shard").applyInArrow(build, "shard int, trie binary")


def score(docs: DataFrame, training: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, n_known, train_tokens, base_score, score), one row per row of ``docs``.

    The model learns from the rows where ``training`` holds and scores all.
    Words are lower-cased A-Z and followed by one end token; null and empty
    texts are the end token alone. Without training rows every token is
    unknown (probability 1). Repeated rows count as often as they occur.
    """
    dealt, asked, shards = _asked(docs, training, id_col, text_col)

    def answer(key, rows):
        parts = list(zip(rows.column("keys").to_pylist(), rows.column("extra").to_pylist()))
        trie = Trie.view(np.frombuffer(shard_trie(parts), np.uint8))
        counts = trie.counts.astype(np.int64)
        head = struct.pack("<QQ", int(counts.sum()), int(np.sum(counts > 0)))
        n = len(parts)
        return pa.table([rows.column("block"), pa.array([key[0].as_py()] * n, pa.int32()), pa.array([1] * n, pa.int32()),
                         pa.array([head + trie_answer(trie, *p) for p in parts], pa.binary())], ["block", "shard", "round", "reply"])

    def settle(table: pa.Table, replies: pa.Table) -> pa.Table:
        if not table.num_rows:
            return pa.table([pa.array([], pa.int64())] * 4 + [pa.array([], pa.float64())] * 2,
                            ["doc_id", "n_tokens", "n_known", "train_tokens", "base_score", "score"])
        b = Block(table)
        n, known, base, model, total = b.scores(replies, shards)
        return pa.table([b.ids, pa.array(n), pa.array(known), pa.array(np.full(len(n), total, np.int64)), pa.array(base), pa.array(model)],
                        ["doc_id", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    replies = asked.groupBy("shard").applyInArrow(answer, blocks.REPLY)
    return dealt.groupBy("block").cogroup(replies.groupBy("block")).applyInArrow(
        settle, "doc_id long, n_tokens long, n_known long, train_tokens long, base_score double, score double")
