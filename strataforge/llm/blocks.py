"""Asking the whole corpus about keys, in packed form.

Documents are dealt into blocks by a hash of their id; every block sends its
distinct 64-bit keys to shards (ranges of the key space), a shard merges the
keys of all blocks and answers each block, key by key. A key reaches a shard
once per block, however often it occurs, so a hot key is pre-aggregated, and
both blocks and shards get smaller as the session's partition count grows.
Keys travel as sorted arrays of differences rather than rows.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataforge.llm.common import partitions

ASKED = "shard int, block int, n long, keys binary, extra binary"
REPLY = "block int, shard int, round int, reply binary"


def to_blocks(docs: DataFrame, per_partition: int = 2) -> DataFrame:
    """The columns of ``docs`` (doc_id, text, ...) after block, dealt by block."""
    n = partitions(docs.sparkSession)
    return (docs.select(F.pmod(F.xxhash64("doc_id"), F.lit(n * per_partition)).cast("int").alias("block"), *docs.columns)
            .repartition(n, "block"))


def pack(keys: np.ndarray) -> bytes:
    """Sorted uint64 keys as their first differences, in as many bytes each as the largest needs."""
    if not len(keys):
        return b""
    d = np.diff(keys, prepend=np.uint64(0))
    width = max(1, (int(d[1:].max()).bit_length() + 7) // 8) if len(d) > 1 else 1
    return bytes([width]) + int(d[0]).to_bytes(8, "little") + d[1:].astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].tobytes()


def unpack(data: bytes) -> np.ndarray:
    if not data:
        return np.zeros(0, np.uint64)
    width, rest = data[0], np.frombuffer(data, np.uint8, offset=9).reshape(-1, data[0])
    d = np.zeros((len(rest) + 1, 8), np.uint8)
    d[0] = np.frombuffer(data, np.uint8, 8, 1)
    d[1:, :width] = rest
    return np.cumsum(d.reshape(-1).view("<u8"), dtype=np.uint64)


def cuts(keys: np.ndarray, shards: int) -> np.ndarray:
    """Where the key ranges of the shards begin in sorted keys, and their end."""
    edge = np.array([(i << 64) // shards for i in range(1, shards)], np.uint64)
    return np.concatenate([[0], np.searchsorted(keys, edge), [len(keys)]])


def asked(block: int, keys: np.ndarray, extra: np.ndarray | None, shards: int) -> pa.Table:
    """Rows of ``ASKED`` for a block's sorted distinct keys; ``extra`` has one fixed-size value per key."""
    at = cuts(keys, shards)
    use = np.flatnonzero(np.diff(at))
    schema = pa.schema([("shard", pa.int32()), ("block", pa.int32()), ("n", pa.int64()), ("keys", pa.binary()), ("extra", pa.binary())])
    return pa.table([use.astype(np.int32), np.full(len(use), block, np.int32), np.diff(at)[use],
                     pa.array([pack(keys[at[i]:at[i + 1]]) for i in use], pa.binary()),
                     pa.array([extra[at[i]:at[i + 1]].tobytes() if extra is not None else b"" for i in use], pa.binary())],
                    schema=schema)


def answers(asked_rows: DataFrame, answer: Callable, rnd: int, extra_type=None) -> DataFrame:
    """``answer(keys, extra, block_of, starts)`` gets the concatenated keys of
    all blocks of a shard and returns one fixed-size value per key (or bits,
    as a bool array); each block gets its part back."""

    def shard(key, rows):
        parts = [unpack(k) for k in rows.column("keys").to_pylist()]
        keys = np.concatenate(parts)
        ends = np.cumsum([len(p) for p in parts])
        extra = (np.concatenate([np.frombuffer(x, extra_type) for x in rows.column("extra").to_pylist()])
                 if extra_type is not None else None)
        out = answer(keys, extra)
        if out.dtype == bool:
            replies = [np.packbits(x).tobytes() for x in np.split(out, ends[:-1])]
        else:
            replies = [x.tobytes() for x in np.split(out, ends[:-1])]
        return pa.table([rows.column("block"), pa.array([key[0].as_py()] * len(parts), pa.int32()),
                         pa.array([rnd] * len(parts), pa.int32()), pa.array(replies, pa.binary())],
                        ["block", "shard", "round", "reply"])

    return asked_rows.groupBy("shard").applyInArrow(shard, REPLY)


def replied(rows: pa.Table, keys: np.ndarray, shards: int, rnd: int, dtype=None) -> np.ndarray:
    """The answers to a block's sorted distinct keys, in their order (bits when ``dtype`` is None)."""
    at = cuts(keys, shards)
    out = np.zeros(len(keys), bool if dtype is None else dtype)
    for shard, r, reply in zip(rows.column("shard").to_pylist(), rows.column("round").to_pylist(), rows.column("reply").to_pylist()):
        if r == rnd:
            lo, hi = at[shard], at[shard + 1]
            out[lo:hi] = (np.unpackbits(np.frombuffer(reply, np.uint8), count=hi - lo).astype(bool) if dtype is None
                          else np.frombuffer(reply, dtype))
    return out
