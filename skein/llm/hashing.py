"""Vectorised 64-bit hashing of byte ranges and fixed-size membership bitmaps."""

from __future__ import annotations

from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_BASE = 0x9E3779B97F4A7C55  # odd, so it has an inverse modulo 2**64
_BASE_INV = pow(_BASE, -1, 1 << 64)
FILTER_BITS = 24  # log2 of a membership bitmap's bits: 2 MB, whatever the data


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser of 64-bit words (splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@lru_cache(maxsize=1)
def _byte_values() -> np.ndarray:
    return mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))


@lru_cache(maxsize=2)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    up = np.full(size, _BASE, np.uint64)
    down = np.full(size, _BASE_INV, np.uint64)
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """(base**i, base**-i) for i < n at least, modulo 2**64; sizes are rounded up so they are reused."""
    size = 1 << 19
    while size < n:
        size *= 2
    return _powers(size)


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """P with P[j] - P[i] = the polynomial of bytes i..j-1, shifted by base**i."""
    up, _ = powers(len(data) + 1)
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_byte_values()[data] * up[:len(data)], out=out[1:])
    return out


def range_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of each byte range [start, end): equal bytes, equal hash, wherever they stand."""
    _, down = powers(len(prefix))
    return mix((prefix[end] - prefix[start]) * down[start] + (end - start).astype(np.uint64))


def rows_of(start: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Row of each ascending position, by the rows' offsets."""
    return np.repeat(np.arange(len(offs) - 1), np.diff(np.searchsorted(start, offs)))


def membership(keys: DataFrame, column: str, bits: int = FILTER_BITS) -> np.ndarray:
    """A bitmap of 2**bits bits with a bit set for the low bits of every key. Its size is fixed, so
    it may be broadcast; with many keys it fills up and lets more pass, never fewer."""
    at = F.col(column).bitwiseAND((1 << bits) - 1)
    words = keys.select(F.shiftright(at, 6).alias("w"), at.alias("at"))
    words = words.groupBy("w").agg(F.bit_or(F.expr("shiftleft(1L, cast(at & 63 as int))")).alias("b"))
    out = np.zeros(1 << (bits - 6), np.uint64)
    got = words.toPandas()  # at most 2**(bits - 6) rows
    out[got["w"].to_numpy(np.int64)] = got["b"].to_numpy(np.int64).view(np.uint64)
    return out


def member(bitmap: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Whether each 64-bit key's bit is set."""
    at = keys.view(np.uint64) & np.uint64(len(bitmap) * 64 - 1)
    return (bitmap[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1) == 1
