"""Repeated passages by seed and extend.

Seeds are winnowed anchors: of every ``WINDOW - SEED + 1`` consecutive word
``SEED``-grams the leftmost smallest hash, so equal windows choose equal
anchors. Documents meet on the anchors they share. Around a shared anchor
the match is extended to both sides, window by window: every window that
chose the anchor is looked up by its whole word sequence, and the smallest
document that has it is found. Runs of covered windows are the maximal
repeats over the length threshold. Anchors that no other document has, most
of the text, cost one packed key and are never extended.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataforge.llm import blocks
from strataforge.llm.arrays import Rolling, Texts, Words, leftmost_min, run_starts
from strataforge.llm.common import id_text, partitions

WINDOW, SEED = 13, 5
#: Seeds are compared by their upper 40 bits: a chance hit only costs an extension that fails.
_LOW = np.uint64((1 << 24) - 1)
_NONE = np.zeros(0, np.uint64)


@dataclass
class Windows:
    """The windows of some documents: starting word, document, seed, whole hash."""

    words: Words
    at: np.ndarray
    doc: np.ndarray
    seed: np.ndarray
    whole: np.ndarray

    @classmethod
    def of(cls, texts: Texts, window: int, seed: int, base: int) -> Windows:
        w = Words(texts)
        n = len(w.starts) - window + 1
        if n <= 0:
            none = np.zeros(0, np.int64)
            return cls(w, none, none, _NONE, _NONE)
        roll = Rolling(w.hashes)
        grams = roll.windows(seed)
        at = np.flatnonzero(w.doc[:n] == w.doc[window - 1:])
        chosen = leftmost_min(grams, window - seed + 1)[at]
        return cls(w, at, w.doc[at] + base, grams[chosen] & ~_LOW, roll.of(at, at + window))


def _seeds(table: pa.Table, window: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct seeds of a block and whether two of its documents have them."""
    pairs = []
    for lo, _, t in Texts.of(table.column("text")).slices():
        x = Windows.of(t, window, seed, lo)
        new = run_starts(x.doc, x.seed)
        pairs.append(x.seed[new] | x.doc[new].astype(np.uint64))  # a block has far fewer than 2 ** 24 documents
    both = np.unique(np.concatenate(pairs)) if pairs else _NONE
    keys = both & ~_LOW
    first = run_starts(keys)
    return keys[first], np.diff(np.append(first, len(keys))) > 1


def _shared(table: pa.Table, replies: pa.Table, window: int, seed: int, shards: int):
    """Windows per slice whose seed another document has, with the block's distinct
    window hashes and the smallest document of the block that has each."""
    keys, _ = _seeds(table, window, seed)
    hit = keys[blocks.replied(replies, keys, shards, 1)]
    ids = table.column("doc_id").to_numpy()
    slices, whole, owner = [], [], []
    for lo, hi, t in Texts.of(table.column("text")).slices():
        x = Windows.of(t, window, seed, lo)
        if len(hit):
            use = np.flatnonzero(hit[np.minimum(np.searchsorted(hit, x.seed), len(hit) - 1)] == x.seed)
        else:
            use = np.zeros(0, np.int64)
        slices.append((lo, hi, t, x, use))
        whole.append(x.whole[use])
        owner.append(ids[x.doc[use]])
    whole = np.concatenate(whole) if whole else _NONE
    owner = np.concatenate(owner) if owner else np.zeros(0, np.int64)
    order = np.lexsort((owner, whole))
    first = order[run_starts(whole[order])]
    return slices, whole[first], owner[first].astype(np.int64)


def _any_other(keys: np.ndarray, several: np.ndarray) -> np.ndarray:
    """Does another document have the seed? It does when two blocks ask, or one block knows of two."""
    kinds, where, n = np.unique(keys, return_inverse=True, return_counts=True)
    return (n > 1)[where] | (np.bincount(where, several, len(kinds)) > 0)[where]


def _smaller(keys: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """Does another block have the window in a smaller document?"""
    kinds, where = np.unique(keys, return_inverse=True)
    least = np.full(len(kinds), np.iinfo(np.int64).max)
    np.minimum.at(least, where, owner)
    return least[where] < owner


def _keep(t: Texts, w: Words, gone: np.ndarray) -> list[bytes]:
    """Per document, the words that stay, joined by one space."""
    size = len(t.data)
    stay = ~gone
    step = np.zeros(size + 1, np.int8)
    step[w.starts[stay]] += 1
    np.subtract.at(step, w.ends[stay], 1)
    mask = np.cumsum(step[:-1], dtype=np.int8) > 0
    doc_end = t.offsets[1:][w.doc]
    gap = w.ends[stay & (w.ends < doc_end)]
    out = t.data.copy()
    out[gap] = 32
    mask[gap] = True
    at = np.concatenate([[0], np.cumsum(mask)])[t.offsets]
    flat = out[mask].tobytes()
    return [flat[a:b].rstrip(b" ") for a, b in zip(at[:-1], at[1:])]


def repeated_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                      window: int = WINDOW, seed: int = SEED) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_text, repeats), one row per row of ``docs``.

    A word goes when it is covered by a window of ``window`` words whose
    sequence also starts in a document with a smaller id; windows are judged
    on the input. ``repeats`` are the maximal removed runs as word ranges.
    Null, empty and shorter texts keep all their words; rows that repeat an
    id do not cover each other.
    """
    shards = partitions(docs.sparkSession)
    dealt = blocks.to_blocks(id_text(docs, id_col, text_col))

    def ask_seeds(table: pa.Table) -> pa.Table:
        keys, several = _seeds(table, window, seed)
        return blocks.asked(table.column("block")[0].as_py(), keys, several.astype(np.uint8), shards)

    def ask_windows(table: pa.Table, replies: pa.Table) -> pa.Table:
        if not table.num_rows:
            return blocks.asked(0, _NONE, None, shards)
        _, keys, owner = _shared(table, replies, window, seed, shards)
        return blocks.asked(table.column("block")[0].as_py(), keys, owner, shards)

    def settle(table: pa.Table, replies: pa.Table) -> pa.Table:
        slices, keys, owner = _shared(table, replies, window, seed, shards)
        other = blocks.replied(replies, keys, shards, 2)
        ids = table.column("doc_id").to_numpy()
        total, removed, kept, runs = [], [], [], []
        for lo, hi, t, x, use in slices:
            k = np.searchsorted(keys, x.whole[use])
            bad = x.at[use[other[k] | (owner[k] < ids[x.doc[use]])]] if len(use) else use
            n = len(x.words.starts)
            step = np.zeros(n + 1, np.int64)
            np.add.at(step, bad, 1)
            np.add.at(step, bad + window, -1)
            gone = np.cumsum(step[:-1]) > 0
            sums = np.concatenate([[0], np.cumsum(gone)])
            total.append(x.words.counts)
            removed.append(np.diff(sums[x.words.first]))
            kept += _keep(t, x.words, gone)
            start = run_starts(x.words.doc, gone)
            end = np.append(start[1:], n)
            on = gone[start] if n else np.zeros(0, bool)
            start, end = start[on], end[on]
            doc = x.words.doc[start]
            for i, (a, b) in enumerate(zip(*(np.searchsorted(doc, np.arange(t.n), s) for s in ("left", "right")))):
                runs.append([{"start": int(s - x.words.first[i]), "end": int(e - x.words.first[i])}
                             for s, e in zip(start[a:b], end[a:b])])
        return pa.table([table.column("doc_id"), pa.array(np.concatenate(total) if total else [], pa.int64()),
                         pa.array(np.concatenate(removed) if removed else [], pa.int64()), pa.array(kept, pa.binary()).cast(pa.string()),
                         pa.array(runs, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))],
                        ["doc_id", "n_words", "n_removed", "kept_text", "repeats"])

    first = blocks.answers(dealt.groupBy("block").applyInArrow(ask_seeds, blocks.ASKED), _any_other, 1, np.uint8)
    by_block = dealt.groupBy("block")
    second = blocks.answers(by_block.cogroup(first.groupBy("block")).applyInArrow(ask_windows, blocks.ASKED), _smaller, 2, np.int64)
    return by_block.cogroup(first.unionByName(second).groupBy("block")).applyInArrow(
        settle, "doc_id long, n_words long, n_removed long, kept_text string, repeats array<struct<start:int,end:int>>")


def digest(cleaned: DataFrame) -> DataFrame:
    return cleaned.select("doc_id", "n_words", "n_removed",
                          F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))
