"""Alignment of the tokens of two tokenizers by their byte offsets.

The cumulative byte ends of both token lists go into dictionaries from end to
token index; the sorted intersection of their keys cuts both id lists into
groups, and the links (pairs of tokens whose bytes overlap) are expanded inside
each group. Texts fall into chunks at places where both tokenizers surely end a
token (before a blank that follows something else), and a chunk's alignment is
made once and remembered, within a bound, by each Python worker.

How often the corpus links two ids is settled in packed form: each document
brings its distinct id pairs and counts, blocks of documents ask the shards of
the pair space for their distinct pairs once, and all pairs of one B id live in
one shard (at most as many as A has ids), which finds the highest count too.
"""

from __future__ import annotations

import hashlib
import json
import re
from array import array
from collections.abc import Iterator
from itertools import accumulate
from operator import itemgetter

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataforge.llm import blocks, pieces
from strataforge.llm.common import id_text, partitions

#: Odd, so b -> b * SPREAD mod 2^16 is one to one; it spreads B ids over the shards.
SPREAD, ID_BITS = 40503, 16


#: The pattern by which the byte-level vocabularies split words.
WORDS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


#: Parts of a remembered chunk.
SIZES, LINKS, TEXTS = map(itemgetter, range(3))


def _byte_alphabet() -> dict[str, int]:
    """Characters that stand for bytes in a byte-level vocabulary: printable ones for themselves, the rest from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {**{chr(b): b for b in plain}, **{chr(256 + k): b for k, b in enumerate(rest)}}


class Aligner:
    """Token ids and links of chunks under a byte-level BPE (A) and a sentencepiece BPE (B)."""

    def __init__(self, a_json: bytes, b_model: bytes):
        from tokenizers import Tokenizer

        spec = json.loads(a_json)
        before = spec["pre_tokenizer"] or {}
        if spec["normalizer"] or spec["model"]["type"] != "BPE" or before.get("type") != "ByteLevel" or not before.get("use_regex", True):
            raise ValueError("A is not a byte-level BPE that splits words and normalises nothing")
        self.a = Tokenizer.from_str(a_json.decode())
        self.a.encode_special_tokens = True
        self.b = pieces.model(b_model)
        if max(len(self.b.piece), self.a.get_vocab_size()) > 1 << ID_BITS:
            raise ValueError(f"more than {1 << ID_BITS} ids")
        alphabet, vocab = _byte_alphabet(), spec["model"]["vocab"]
        if not alphabet.keys() <= vocab.keys():
            raise ValueError("A lacks bytes")
        #: Bytes of each id; both sides give every text back but for B's mark of a space.
        self.a_size = {i: len(t) for t, i in vocab.items()}
        self.b_size = {p: len(p.replace(pieces.SPACE, " ").encode()) for p in self.b.ids}
        # the same merges as ranks: quicker, and the same wherever both know the letters, so used on Latin text only
        pairs = [p if isinstance(p, list) else p.split(" ") for p in spec["model"]["merges"]]
        order = [vocab[x + y] for x, y in pairs]
        ranks = {bytes(map(alphabet.__getitem__, t)): i for t, i in vocab.items() if all(c in alphabet for c in t)
                 and i not in {x["id"] for x in spec["added_tokens"]}}
        self.plain = re.compile(r"[\0-\u024f]*").fullmatch
        if order != sorted(order):
            self.plain = lambda chunk: None
        self.ranked = tiktoken.Encoding("a", pat_str=WORDS, mergeable_ranks=ranks, special_tokens={})
        # blanks no piece of B holds after something else end a chunk; A's words never hold one there
        inner = {c for p in self.b.ids for x, c in zip(p, p[1:]) if not x.isspace() and x != pieces.SPACE}
        cut = "".join(c for c in " \t\n\x0b\x0c" if c not in inner)
        other = f"[^\\S{cut}]"
        word = rf"\s*[{pieces.LETTERS}]++(?=[{pieces.MARKS}{cut}]|\Z)|" if self.b.ends_words else ""
        self.chunks = re.compile(rf"{word}\s*\S+(?:{other}\s*\S*)*|\s+").findall
        self.known = pieces.Remembered(self.aligned)

    def a_ids(self, chunk: str) -> list[int]:
        return self.ranked.encode_ordinary(chunk) if self.plain(chunk) else self.a.encode(chunk, add_special_tokens=False).ids

    def aligned(self, chunk: str) -> tuple[int, bytes, str]:
        """Of a chunk: tokens of A, of B and groups as digits of base 2^32, links as packed pairs, groups as text."""
        a, found = self.a_ids(chunk), self.b.segments(chunk.replace(" ", pieces.SPACE))
        b, b_size = [*map(self.b.ids.get, found)], [*map(self.b_size.get, found)]
        if None in b:  # characters as bytes
            b = [i for p in found for i in ([self.b.ids[p]] if p in self.b.ids else [self.b.byte_ids[x] for x in p.encode()])]
            b_size = [n for p in found for n in ([self.b_size[p]] if p in self.b_size else [1] * len(p.encode()))]
        n, links, text = groups(a, b, [*map(self.a_size.__getitem__, a)], b_size)
        return len(a) | len(b) << 32 | n << 64, array("I", links).tobytes(), text

    def document(self, text: str) -> tuple[int, int, int, bytes, str] | None:
        """(tokens of A, tokens of B, groups, links, groups as text) of a space and the whole text; None without tokens."""
        if not text or pieces.SPACE in text:  # B gives a space for its mark
            return None
        found = [*map(self.known.__getitem__, self.chunks(" " + text))]
        size, low = sum(map(SIZES, found)), (1 << 32) - 1
        return size & low, size >> 32 & low, size >> 64, b"".join(map(LINKS, found)), ";".join(map(TEXTS, found))


def groups(a: list[int], b: list[int], a_size: list[int], b_size: list[int]) -> tuple[int, list[int], str]:
    """Number of groups, linked id pairs (b << 16 | a), and the groups as text, of token ids and byte sizes of one text."""
    a_at = {end: k for k, end in enumerate(accumulate(a_size), 1)}
    b_at = {end: k for k, end in enumerate(accumulate(b_size), 1)}
    links, texts = [], []
    i = j = 0
    ends = sorted(a_at.keys() & b_at.keys())
    for end in ends:
        p, q = a_at[end], b_at[end]
        if p - i == 1 and q - j == 1:
            links.append(b[j] << ID_BITS | a[i])
            texts.append(f"{a[i]}|{b[j]}")
        else:
            left, right = a[i:p], b[j:q]
            if p - i == 1 or q - j == 1:  # one token overlaps all of the other side
                links += [y << ID_BITS | x for y in right for x in left]
            else:
                links += _overlaps(left, right, a_size[i:p], b_size[j:q])
            texts.append(f"{','.join(map(str, left))}|{','.join(map(str, right))}")
        i, j = p, q
    return len(ends), links, ";".join(texts)


def _overlaps(left: list[int], right: list[int], left_size: list[int], right_size: list[int]) -> list[int]:
    """Linked pairs of a group: each step links the two tokens under way and passes the one that ends first."""
    out, x, y = [], 0, 0
    over = left_size[0] - right_size[0]  # how much further the left token reaches
    while True:
        out.append(right[y] << ID_BITS | left[x])
        if over > 0:
            y += 1
            over -= right_size[y]
        elif over < 0:
            x += 1
            over += left_size[x]
        else:
            return out


_ALIGNERS: dict[bytes, Aligner] = {}


def aligner(a_json: bytes, b_model: bytes) -> Aligner:
    """The aligner of two model files, made once per worker."""
    key = hashlib.sha256(a_json).digest() + hashlib.sha256(b_model).digest()
    if key not in _ALIGNERS:
        _ALIGNERS[key] = Aligner(a_json, b_model)
    return _ALIGNERS[key]


def _pairs(keys: np.ndarray) -> np.ndarray:
    """Pairs as 64-bit keys whose high 16 bits are the spread B id."""
    b = (keys >> np.uint32(ID_BITS)).astype(np.uint64) * np.uint64(SPREAD) & np.uint64(0xFFFF)
    return b << np.uint64(48) | (keys & np.uint32(0xFFFF)).astype(np.uint64)


def _packed(links: bytes) -> tuple[bytes, bytes]:
    """Distinct pairs of a document and how often each occurs."""
    keys, counts = np.unique(np.frombuffer(links, np.uint32), return_counts=True)
    return keys.tobytes(), counts.astype(np.uint32).tobytes()


def align(docs: DataFrame, a_json: bytes, b_model: bytes, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, groups, pairs, counts), one row per row of ``docs`` that has an id.

    ``groups`` is ``a1,a2|b1;a3|b2,b3``: ids of A and B between bytes where both
    end. ``pairs`` are the distinct linked id pairs as packed 32-bit numbers
    (B id << 16 | A id), ``counts`` the links of each. Null and empty texts, and
    texts that either tokenizer does not give back, have zeros and an empty
    ``groups``. No shuffle: texts are read and aligned where they lie, so repeated rows come out as
    often as they occur; other columns are ignored.
    """
    def tokens(batches: Iterator[pa.RecordBatch]):
        m = aligner(a_json, b_model)
        for batch in batches:
            for k in range(0, batch.num_rows, pieces.ROWS):
                part = batch.slice(k, pieces.ROWS)
                a, b, g, links, texts = zip(*((m.document(t) or NOTHING) for t in part.column(1).to_pylist()))
                keys, counts = zip(*map(_packed, links))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(g, pa.int64()),
                     pa.array([len(x) // 4 for x in links], pa.int64()), pa.array(texts, pa.string()),
                     pa.array(keys, pa.binary()), pa.array(counts, pa.binary())],
                    ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups", "pairs", "counts"])

    return id_text(docs, id_col, text_col).mapInArrow(
        tokens, "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups string, pairs binary, counts binary")


NOTHING = (0, 0, 0, b"", "")


def _columns(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of a block's rows: all pairs as keys, their counts, and how many pairs each row has."""
    keys, counts = table.column("pairs").to_pylist(), table.column("counts").to_pylist()
    return (_pairs(np.frombuffer(b"".join(keys), np.uint32)), np.frombuffer(b"".join(counts), np.uint32).astype(np.int64),
            np.array([len(k) // 4 for k in keys], np.int64))


def _summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys, their summed counts, and each key's place among them."""
    distinct, at = np.unique(keys, return_inverse=True)
    total = np.zeros(len(distinct), np.int64)
    np.add.at(total, at, counts)
    return distinct, total, at


def _judged(keys: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """A shard's answer to each key: the corpus-wide count, doubled, plus 1 if it is the highest of the key's B id."""
    pairs, total, at = _summed(keys, counts)
    b = pairs >> np.uint64(48)
    first = np.flatnonzero(np.concatenate([[True], b[1:] != b[:-1]]))
    highest = np.repeat(np.maximum.reduceat(total, first), np.diff(np.append(first, len(total))))
    return (total * 2 + (total == highest))[at]


def count_links(aligned: DataFrame) -> DataFrame:
    """``aligned`` with n_best and count_sum (long) in place of ``pairs`` and ``counts``.

    A link's count is how many links of all rows hold its id pair; count_sum
    adds it over a row's links, n_best counts the links whose count is the
    highest of their B id, ties included. Other columns are carried along, so
    drop wide ones first.
    """
    n = partitions(aligned.sparkSession)
    shards = 1 << min(ID_BITS, max(0, (n - 1).bit_length()))  # a power of two, so that no B id is cut
    kept = [f for f in aligned.schema.fields if f.name not in ("pairs", "counts")]
    dealt = blocks.to_blocks(aligned, 1)

    def ask(table: pa.Table) -> pa.Table:
        keys, counts, _ = _columns(table)
        distinct, total, _ = _summed(keys, counts)
        return blocks.asked(table.column("block")[0].as_py(), distinct, total, shards)

    def settle(table: pa.Table, replies: pa.Table) -> pa.Table:
        keys, counts, size = _columns(table)
        distinct, _, at = _summed(keys, counts)
        answer = blocks.replied(replies, distinct, shards, 1, np.int64)[at]
        end = np.concatenate([[0], np.cumsum(size)])
        row_sums = lambda x: np.diff(np.concatenate([[0], np.cumsum(x)])[end])
        new = [pa.array(row_sums(counts * (answer & 1))), pa.array(row_sums(counts * (answer >> 1)))]
        return pa.table([table.column(f.name) for f in kept] + new, [f.name for f in kept] + ["n_best", "count_sum"])

    asked = dealt.groupBy("block").applyInArrow(ask, blocks.ASKED)
    replies = blocks.answers(asked, _judged, 1, np.int64)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept) + ", n_best long, count_sum long"
    return dealt.groupBy("block").cogroup(replies.groupBy("block")).applyInArrow(settle, schema)


def digest(aligned: DataFrame) -> DataFrame:
    """``count_links`` of ``align`` rows with groups_sha256 ('' without tokens) in place of ``groups``."""
    sha = F.when(F.col("n_groups") > 0, F.sha2("groups", 256)).otherwise("").alias("groups_sha256")
    return count_links(aligned.select("doc_id", "n_a", "n_b", "n_groups", "n_links", sha, "pairs", "counts"))
