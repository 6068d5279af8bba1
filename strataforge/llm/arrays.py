"""Whole Arrow batches of texts as flat byte arrays: words, rolling hashes,
winnowing. Everything is vectorised over a slice of documents of bounded size
(``slices``), so memory does not grow with the batch."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Text bytes handled at once; one longer document is handled alone.
SLICE_BYTES = 2 << 20
#: Documents handled at once (their index fits 15 bits).
SLICE_DOCS = 1 << 15

_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True
_TABLE = np.random.default_rng(20240607).integers(1, 2**64 - 1, 256, np.uint64)
_LOWER = _TABLE.copy()
_LOWER[65:91] = _TABLE[97:123]
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))
_POWERS: dict[int, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values (finaliser of a public 64-bit hash)."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


def powers(base: np.uint64, n: int) -> np.ndarray:
    have = _POWERS.get(int(base))
    if have is None or len(have) < n:
        p = np.full(max(n, 1 << 16), base, np.uint64)
        p[0] = 1
        have = np.cumprod(p, dtype=np.uint64)
        if n <= SLICE_BYTES + (1 << 20):  # longer ones are not kept
            _POWERS[int(base)] = have
    return have[:n]


class Rolling:
    """Polynomial prefix sums mod 2**64 over a sequence of 64-bit symbols:
    ``of(starts, ends)`` hashes any ranges at once."""

    def __init__(self, symbols: np.ndarray):
        self.sums = np.zeros(len(symbols) + 1, np.uint64)
        np.cumsum(symbols * powers(_BASE, len(symbols)), out=self.sums[1:])

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix((self.sums[ends] - self.sums[starts]) * powers(_INVERSE, len(self.sums))[starts]
                   + (ends - starts).astype(np.uint64))

    def windows(self, k: int) -> np.ndarray:
        """Hash of every k consecutive symbols, by start."""
        n = len(self.sums) - k
        if n <= 0:
            return np.zeros(0, np.uint64)
        return mix((self.sums[k:] - self.sums[:n]) * powers(_INVERSE, n) + np.uint64(k))


class Texts:
    """Documents as one byte array: ``data[offsets[i]:offsets[i + 1]]``."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.data, self.offsets, self.n = data, offsets, len(offsets) - 1

    @classmethod
    def of(cls, column) -> Texts:
        if isinstance(column, pa.ChunkedArray):
            column = column.combine_chunks()
        column = pc.fill_null(column.cast(pa.large_string()), "")
        bufs = column.buffers()
        off = np.frombuffer(bufs[1], np.int64)[column.offset:column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
        data = np.frombuffer(bufs[2], np.uint8) if bufs[2] is not None and bufs[2].size else np.zeros(0, np.uint8)
        return cls(data[off[0]:off[-1]], off - off[0])

    def slices(self) -> Iterator[tuple[int, int, Texts]]:
        """(first, last, documents first..last - 1) in pieces of bounded size."""
        at = 0
        while at < self.n:
            to = int(np.searchsorted(self.offsets, self.offsets[at] + SLICE_BYTES, "right")) - 1
            to = min(max(to, at + 1), at + SLICE_DOCS, self.n)
            lo, hi = self.offsets[at], self.offsets[to]
            yield at, to, Texts(self.data[lo:hi], self.offsets[at:to + 1] - lo)
            at = to

    def symbols(self, lower: bool = False) -> np.ndarray:
        return (_LOWER if lower else _TABLE)[self.data]


class Words:
    """The words (runs of anything but space and 09-0D) of some documents:
    byte ranges, 64-bit hashes, and ``first[i]:first[i + 1]`` per document."""

    def __init__(self, texts: Texts, lower: bool = False):
        d, off = texts.data, texts.offsets
        space = _SPACE[d]
        cut = np.zeros(len(d) + 1, bool)
        cut[off] = True
        before, after = np.empty(len(d), bool), np.empty(len(d), bool)
        if len(d):
            before[0], after[-1] = True, True
            before[1:], after[:-1] = space[:-1], space[1:]
            before |= cut[:-1]
            after |= cut[1:]
        self.starts = np.flatnonzero(~space & before)
        self.ends = np.flatnonzero(~space & after) + 1
        self.first = np.searchsorted(self.starts, off)
        self.first[-1] = len(self.starts)
        self.hashes = Rolling(texts.symbols(lower)).of(self.starts, self.ends)
        self.counts = np.diff(self.first)
        self.doc = np.repeat(np.arange(texts.n), self.counts)

    def grams(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(start word, hash) of every k consecutive words of one document."""
        h = Rolling(self.hashes).windows(k)
        at = np.flatnonzero(self.doc[:len(h)] == self.doc[k - 1:k - 1 + len(h)]) if len(h) else np.zeros(0, np.int64)
        return at, h[at]


def sliding_min(v: np.ndarray, w: int) -> np.ndarray:
    """Minimum of every w consecutive values."""
    have, out = 1, v
    while have * 2 <= w:
        out = np.minimum(out[:-have], out[have:])
        have *= 2
    rest = w - have
    return np.minimum(out[:len(out) - rest], out[rest:]) if rest else out


def leftmost_min(h: np.ndarray, w: int) -> np.ndarray:
    """Position of the leftmost smallest of every w consecutive hashes (upper
    36 bits compared, so the choice depends on the w values alone)."""
    bits = np.uint64(28)
    if len(h) >> 28:
        raise ValueError("too many positions in one slice")
    v = ((h >> bits) << bits) | np.arange(len(h), dtype=np.uint64)
    return (sliding_min(v, w) & np.uint64((1 << 28) - 1)).astype(np.int64)


def run_starts(*keys: np.ndarray) -> np.ndarray:
    """Where runs of equal keys begin in sorted arrays."""
    n = len(keys[0])
    new = np.zeros(n, bool)
    if n:
        new[0] = True
        for k in keys:
            new[1:] |= k[1:] != k[:-1]
    return np.flatnonzero(new)


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def unsigned(x: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(x).view(np.uint64)
