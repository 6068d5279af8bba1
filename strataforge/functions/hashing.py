"""Keyed-hash randomness.

``rand(seed)`` depends on how rows land in partitions, so a retried task or
a different partition count would change every draw. Here a draw is a pure
function of (seed, key): the first 52 bits of ``md5(seed|key...)`` mapped to
the open interval (0, 1). The same formula written in DuckDB SQL gives the
same numbers, which is what the oracle checks rely on.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# 52-bit hash prefix (13 hex digits) scaled by 2**52.
HEX_DIGITS = 13
TWO_POW_52 = 4503599627370496.0


def _as_col(k) -> Column:
    if isinstance(k, Column):
        return k.cast("string")
    if isinstance(k, str):
        return F.col(k).cast("string")
    return F.lit(str(k))


def _digest(seed, *keys) -> Column:
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[_as_col(k) for k in keys]))


def _bits_to_unit(h: Column, part: int) -> Column:
    """Hex digits [13*part+1, 13*part+13] of a digest -> (0, 1)."""
    bits = F.conv(F.substring(h, HEX_DIGITS * part + 1, HEX_DIGITS), 16, 10).cast("bigint")
    return (bits.cast("double") + F.lit(0.5)) / F.lit(TWO_POW_52)


def uniform(seed, *keys) -> Column:
    """u(seed, keys) in (0, 1); strings name columns, Columns are used as is,
    other values become literals."""
    return _bits_to_unit(_digest(seed, *keys), 0)


def normal_pair(seed, *keys) -> tuple[Column, Column]:
    """Two independent standard normals (Box-Muller, cos and sin) from the
    two 52-bit uniforms of ONE digest; Catalyst evaluates the shared digest
    once per row."""
    h = _digest(seed, *keys)
    u1, u2 = _bits_to_unit(h, 0), _bits_to_unit(h, 1)
    r = F.sqrt(F.lit(-2.0) * F.log(u1))
    a = F.lit(2.0 * math.pi) * u2
    return r * F.cos(a), r * F.sin(a)


def normal(seed, *keys) -> Column:
    """Standard normal by Box-Muller from one keyed digest."""
    return normal_pair(seed, *keys)[0]


def _digest_sql(seed, *key_sql: str) -> str:
    parts = ", ".join([f"'{seed}'"] + [f"CAST({k} AS VARCHAR)" for k in key_sql])
    return f"md5(concat_ws('|', {parts}))"


def _unit_sql(digest: str, part: int) -> str:
    return (f"((CAST(('0x' || substr({digest}, {HEX_DIGITS * part + 1}, {HEX_DIGITS})) AS BIGINT)"
            f" + 0.5::DOUBLE) / {TWO_POW_52!r}::DOUBLE)")


def uniform_sql(seed, *key_sql: str) -> str:
    """The same draw as DuckDB SQL text (for oracle queries)."""
    return _unit_sql(_digest_sql(seed, *key_sql), 0)


def normal_pair_sql(seed, *key_sql: str) -> tuple[str, str]:
    h = _digest_sql(seed, *key_sql)
    u1, u2 = _unit_sql(h, 0), _unit_sql(h, 1)
    r = f"sqrt(-2.0::DOUBLE * ln({u1}))"
    a = f"({2.0 * math.pi!r}::DOUBLE * {u2})"
    return f"({r} * cos({a}))", f"({r} * sin({a}))"


def normal_sql(seed, *key_sql: str) -> str:
    return normal_pair_sql(seed, *key_sql)[0]


def dlit(x: float) -> str:
    """A double literal for DuckDB (plain decimals would parse as DECIMAL)."""
    return f"{float(x)!r}::DOUBLE"
