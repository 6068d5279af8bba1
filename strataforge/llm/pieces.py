"""SentencePiece BPE encoding by backtracking, and decoding.

A sequence of pieces is the encoding of its text exactly when every two
neighbours, merged again from their characters, come out as those two: a merge
across a border would have been the best one inside the two neighbours as well.
So the text is walked from the left with the longest piece that starts at each
position (Aho-Corasick, leftmost longest), a piece is taken if it
is compatible with the piece before it, shorter prefixes follow, and a position
from which no piece fits is marked in a bit field and never tried again. Every
prefix has one encoding, so no position is reached in two ways and the work is
linear in the text.

Text falls into chunks at places no piece spans (a space after anything else, a
line feed, punctuation after a word), which are encoded by themselves and remembered. The remembered
chunks, and neighbours found compatible, are bounded per Python worker.
"""

from __future__ import annotations

import hashlib
import re
import struct
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from sentencepiece import sentencepiece_model_pb2

from strataforge.llm.common import id_text

SPACE = "▁"
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6
#: Chunks (twice) and pairs remembered by one worker, and the longest chunk worth it.
REMEMBERED, REMEMBERED_PAIRS, LONGEST = 250_000, 500_000, 48
BAD = "�"
#: Latin letters and ASCII punctuation, as ranges of a character class.
LETTERS, MARKS = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f", "!-/:-@\\[-`{-~"


class Remembered(dict):
    """Values by key, made when first asked for; of two generations the older goes when the younger is full."""

    def __init__(self, make, most: int = REMEMBERED):
        super().__init__()
        self.make, self.most, self.old = make, most, {}

    def __missing__(self, key: str):
        found = self.old.get(key)
        if found is None:
            found = self.make(key)
        if len(key) <= LONGEST:
            if len(self) >= self.most:
                self.old = dict(self)
                self.clear()
            self[key] = found
        return found


class _Codes(dict):
    """Packed ids by piece; of a character the model lacks, its bytes' ids."""

    byte_ids: list[int]

    def __missing__(self, piece: str) -> bytes:
        return struct.pack(f"<{len(b := piece.encode())}i", *(self.byte_ids[x] for x in b))


class PieceModel:
    """A byte-fallback BPE model of the sentencepiece format without text normalisation."""

    def __init__(self, data: bytes):
        proto = sentencepiece_model_pb2.ModelProto()
        proto.ParseFromString(data)
        kinds = {p.type for p in proto.pieces}
        if (proto.trainer_spec.model_type != 2 or not proto.trainer_spec.byte_fallback or kinds - {NORMAL, UNKNOWN, CONTROL, BYTE}
                or proto.normalizer_spec.precompiled_charsmap or proto.normalizer_spec.remove_extra_whitespaces
                or not proto.normalizer_spec.add_dummy_prefix or proto.trainer_spec.treat_whitespace_as_suffix
                or not proto.normalizer_spec.escape_whitespaces):
            raise ValueError("not a byte-fallback BPE model with identity normalisation and a space before the text")
        self.kind = np.array([p.type for p in proto.pieces], np.uint8)
        self.piece = [p.piece for p in proto.pieces]
        self.ids = {p.piece: i for i, p in enumerate(proto.pieces) if p.type == NORMAL}
        self.cost = {p.piece: -p.score for p in proto.pieces if p.type == NORMAL}
        self.byte_ids = [0] * 256
        self.surface: list[bytes] = []
        for i, p in enumerate(proto.pieces):
            if p.type == BYTE:
                value = int(p.piece[3:5], 16)
                self.byte_ids[value] = i
                self.surface.append(bytes([value]))
            elif p.type == NORMAL:
                self.surface.append(p.piece.replace(SPACE, " ").encode())
            else:
                self.surface.append(b"" if p.type == CONTROL else (proto.trainer_spec.unk_surface or " ⁇ ").encode())
        several = [p for p in self.ids if len(p) > 1]
        if any(SPACE in p.lstrip(SPACE) for p in several):
            raise ValueError("a piece holds a space after other characters")
        free = "" if any("\n" in p for p in several) else "\n"
        #: Whether no piece holds punctuation after a letter, so that a word ends a chunk before it.
        self.ends_words = not any(re.search(f"[{LETTERS}][{MARKS}]", p) for p in several)
        #: A chunk ends before each space that follows something else, around line feeds, and before punctuation after a word.
        word = f"{SPACE}*[{LETTERS}]++(?=[{MARKS}{SPACE}{free}]|\\Z)|" if self.ends_words else ""
        self.chunks = re.compile(f"{word}{SPACE}*[^{SPACE}{free}]+|{SPACE}+" + (f"|{free}+" if free else "")).findall
        # pieces that merge to something else by themselves never occur; characters stand for themselves
        self.words = {p for p in several if self.remerged(p) == [p]} | {c for p in self.ids for c in p}
        self.shorter = {}
        self.automaton = ahocorasick.Automaton()
        for w in self.words:
            self.automaton.add_word(w, w)
            self.shorter[w] = next((w[:k] for k in range(len(w) - 1, 0, -1) if w[:k] in self.words), None)
        self.automaton.make_automaton()
        self.most = max(map(len, self.words), default=1)
        self.pairs: dict[tuple[str, str], bool] = {}
        self.codes = _Codes((p, struct.pack("<i", i)) for p, i in self.ids.items())
        self.codes.byte_ids = self.byte_ids
        self.known = Remembered(lambda chunk: b"".join(map(self.codes.__getitem__, self.segments(chunk))))

    def remerged(self, text: str) -> list[str]:
        """The merges themselves, cheapest piece first, leftmost of equals."""
        parts, cost, none = list(text), self.cost, float("inf")
        while len(parts) > 1:
            costs = [cost.get(a + b, none) for a, b in zip(parts, parts[1:])]
            least = min(costs)
            if least == none:
                break
            at = costs.index(least)
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def compatible(self, a: str, b: str) -> bool:
        """Whether ``a`` then ``b`` is the encoding of their joined text."""
        if len(self.pairs) >= REMEMBERED_PAIRS:
            self.pairs.clear()
        found = self.pairs[a, b] = self.remerged(a + b) == [a, b]
        return found

    def segments(self, text: str) -> list[str]:
        """The pieces of ``text``; a character the model lacks is one of them."""
        n, most, matches, shorter, pairs = len(text), self.most, self.automaton.iter_long, self.shorter, self.pairs
        failed = bytearray((n >> 3) + 1)
        out: list[str] = []
        before = word = None
        at = 0
        while True:
            if word is None:  # the longest piece that starts here, or the character if none does
                for last, word in matches(text[at:at + most]):
                    if last >= len(word):
                        word = text[at]
                    break
                else:
                    word = text[at]
            end = at + len(word)
            if not failed[end >> 3] >> (end & 7) & 1:
                fits = before is None or pairs.get((before, word))
                if fits is None:
                    fits = self.compatible(before, word)
                if fits:
                    out.append(word)
                    if end == n:
                        return out
                    before, at, word = word, end, None
                    continue
            less = shorter.get(word)
            if less is None:  # nothing fits here: back to the piece before
                failed[at >> 3] |= 1 << (at & 7)
                less = out.pop()
                at -= len(less)
                before = out[-1] if out else None
            word = less

    def encode(self, text: str) -> bytes:
        """Ids of a text, with the space the model puts before it, as 32-bit numbers."""
        if not text:
            return b""
        return b"".join(map(self.known.__getitem__, self.chunks(SPACE + text.replace(" ", SPACE))))

    def decode(self, ids: np.ndarray) -> str:
        """The text of any ids: one space less at the start, bytes that are not UTF-8 as U+FFFD each."""
        control = self.kind[ids] == CONTROL
        shown = ids[~control] if control.any() else ids
        data = b"".join(map(self.surface.__getitem__, shown.tolist()))
        drop = int(len(shown) > 0 and self.kind[shown[0]] == NORMAL and self.piece[shown[0]].startswith(SPACE))
        if control.any():  # bytes on its two sides make no character together
            size = np.concatenate([[0], np.cumsum([len(self.surface[i]) for i in ids.tolist()])])
            edge = [drop, *(max(drop, int(size[k])) for k in np.flatnonzero(control)), len(data)]
            return "".join(_text(data[a:b]) for a, b in zip(edge, edge[1:]))
        return _text(data[drop:])


def _text(data: bytes) -> str:
    """UTF-8 text in which every byte that begins no valid character is one U+FFFD."""
    try:
        return data.decode()
    except UnicodeDecodeError:
        out, at = [], 0
    while at < len(data):
        try:
            out.append(data[at:].decode())
            break
        except UnicodeDecodeError as e:
            out += [data[at:at + e.start].decode(), BAD]
            at += e.start + 1
    return "".join(out)


_MODELS: dict[bytes, PieceModel] = {}


def model(data: bytes) -> PieceModel:
    """The model of a file's bytes, made once per worker."""
    key = hashlib.sha256(data).digest()
    if key not in _MODELS:
        _MODELS[key] = PieceModel(data)
    return _MODELS[key]


def read_model(path: str) -> bytes:
    """A model file, at most a few MB; it travels to the tasks with the job."""
    with open(path, "rb") as f:
        return f.read()


def _id_lists(parts: list[bytes]) -> pa.Array:
    ends = np.cumsum([0] + [len(p) // 4 for p in parts], dtype=np.int64)
    return pa.LargeListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(parts), np.int32))).cast(pa.list_(pa.int32()))


def encode(docs: DataFrame, data: bytes, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids array<int>), one row per row of ``docs`` that has an id.

    Ids are those of the sentencepiece library without begin and end, for whole
    texts; null and empty texts have none. Repeated rows come out as often as
    they occur; other columns are ignored. No shuffle: texts are encoded where
    they are read.
    """
    def run(batches: Iterator[pa.RecordBatch]):
        m = model(data)
        for b in batches:
            for x in _slices(b):
                yield pa.RecordBatch.from_arrays([x.column(0), _id_lists([m.encode(t) for t in x.column(1).to_pylist()])], ["doc_id", "ids"])

    return id_text(docs, id_col, text_col).mapInArrow(run, "doc_id long, ids array<int>")


def decode(frame: DataFrame, data: bytes, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(doc_id, text): the text of the ids of every row; no ids (or null) give an empty text.

    Ids outside the model and null ids count as the unknown piece."""
    def run(batches: Iterator[pa.RecordBatch]):
        m = model(data)
        for b in batches:
            texts = []
            for ids in b.column(1):
                ids = np.array([UNK_ID if i is None or not 0 <= i < len(m.piece) else i for i in ids.as_py() or ()], np.int64)
                texts.append(m.decode(ids))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    rows = frame.select(F.col(id_col).cast("long").alias("doc_id"), F.col(ids_col).cast("array<int>").alias("ids"))
    return rows.mapInArrow(run, "doc_id long, text string")


UNK_ID = 0


def round_trip(docs: DataFrame, data: bytes, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids, decoded): ``encode`` and ``decode`` of its ids in one pass."""
    def run(batches: Iterator[pa.RecordBatch]):
        m = model(data)
        for b in batches:
            for x in _slices(b):
                ids = [m.encode(t) for t in x.column(1).to_pylist()]
                texts = [m.decode(np.frombuffer(i, np.int32)) for i in ids]
                yield pa.RecordBatch.from_arrays([x.column(0), _id_lists(ids), pa.array(texts, pa.string())], ["doc_id", "ids", "decoded"])

    return id_text(docs, id_col, text_col).mapInArrow(run, "doc_id long, ids array<int>, decoded string")


def digest(found: DataFrame) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of ``round_trip`` rows."""
    return found.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
                        F.sha2("decoded", 256).alias("decoded_sha256"))


#: Texts handled at a time, so that a batch of very long ones stays small.
ROWS = 256


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    for k in range(0, batch.num_rows, ROWS):
        yield batch.slice(k, ROWS)
