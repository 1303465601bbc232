"""Separable linear maps of images: windowed-sinc resampling and wavelet filter banks.

A map is two small matrices (out x in), one for rows and one for columns, worked out at planning; a grid passes
through them as two array expressions over constant sparse tables (for every output the first input and its
weights): no shuffle, no Python. ``resample_pixels`` does the same with numpy for decoded images of any size.

Resampling is Lanczos-3 as 8-bit image libraries do it: the window widens when the image shrinks, weights are
fixed-point numbers of 22 bits, the horizontal pass is rounded and clipped to 0..255 before the vertical one.
"""

from __future__ import annotations

import json
import math
from functools import lru_cache

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

from skein.functions.imagehash import let, mean_of, median_of

LOBES = 3
PRECISION = 22  # fractional bits of a weight


# ---------------------------------------------------------------- matrices
def _lanczos(x: float) -> float:
    if x == 0:
        return 1.0
    if abs(x) >= LOBES:
        return 0.0
    p = math.pi * x
    return math.sin(p) / p * math.sin(p / LOBES) / (p / LOBES)


@lru_cache(maxsize=256)
def lanczos_matrix(size: int, out: int) -> np.ndarray:
    """(out x size) whole weights in units of 2**-PRECISION that take ``size`` pixels to ``out``."""
    scale = size / out
    widen = max(scale, 1.0)
    reach = LOBES * widen
    m = np.zeros((out, size), np.int64)
    for o in range(out):
        centre = (o + 0.5) * scale
        a, b = max(int(centre - reach + 0.5), 0), min(int(centre + reach + 0.5), size)
        w = np.array([_lanczos((i - centre + 0.5) / widen) for i in range(a, b)])
        w = w / w.sum() * (1 << PRECISION)
        m[o, a:b] = np.trunc(w + np.where(w < 0, -0.5, 0.5)).astype(np.int64)
    return m


# Low-pass analysis filters, by their published coefficients.
FILTERS = {
    "haar": (0.7071067811865476, 0.7071067811865476),
    "db4": (-0.010597401784997278, 0.032883011666982945, 0.030841381835986965, -0.18703481171888114,
            -0.02798376941698385, 0.6308807679295904, 0.7148465705525415, 0.23037781330885523),
}


def high_pass(name: str) -> tuple[float, ...]:
    """The high-pass analysis filter that belongs to the low-pass one (alternating signs, reversed)."""
    low = FILTERS[name]
    return tuple((-1) ** (i + 1) * c for i, c in enumerate(reversed(low)))


def _outside(i: int, n: int, border: str) -> int:
    """The sample that stands for sample ``i`` of ``n``: mirrored with the edge repeated, or from the other end."""
    if border == "periodic":
        return i % n
    i %= 2 * n
    return i if i < n else 2 * n - 1 - i


@lru_cache(maxsize=256)
def analysis(n: int, name: str, border: str = "symmetric", high: bool = False) -> np.ndarray:
    """One level: every second sample of the filtered signal, (n + taps - 1) // 2 of them."""
    taps = high_pass(name) if high else FILTERS[name]
    out = (n + len(taps) - 1) // 2
    m = np.zeros((out, n))
    for k in range(out):
        for j, c in enumerate(taps):
            m[k, _outside(2 * k + 1 - j, n, border)] += c
    return m


@lru_cache(maxsize=256)
def synthesis(size: int, n: int, name: str, high: bool = False) -> np.ndarray:
    """One level back: (n x size); what analysis of n samples gave, up-sampled and filtered."""
    taps = (high_pass(name) if high else FILTERS[name])[::-1]
    m = np.zeros((n, size))
    for t in range(n):
        for k in range(size):
            j = t + len(taps) - 2 - 2 * k
            if 0 <= j < len(taps):
                m[t, k] = taps[j]
    return m


@lru_cache(maxsize=256)
def cascade(n: int, name: str, levels: int, border: str = "symmetric") -> np.ndarray:
    """The low band of ``levels`` levels as one matrix."""
    m = np.eye(n)
    for _ in range(levels):
        m = analysis(len(m), name, border) @ m
    return m


@lru_cache(maxsize=256)
def low_part(n: int, name: str, levels: int, border: str = "symmetric") -> np.ndarray:
    """(n x n): decompose ``levels`` levels, keep the lowest band only, reconstruct."""
    sizes, m = [n], np.eye(n)
    for _ in range(levels):
        m = analysis(len(m), name, border) @ m
        sizes.append(len(m))
    for size in reversed(sizes[:-1]):
        m = synthesis(len(m), size, name) @ m
    return m


# ------------------------------------------------------------- expressions
def _table(m: np.ndarray) -> Column:
    """A matrix as array<struct<first, w>>: each row from its first to its last weight that isn't zero."""
    rows = []
    for row in m:
        at = np.flatnonzero(row)
        a, b = (int(at[0]), int(at[-1]) + 1) if len(at) else (0, 1)
        rows.append({"first": a, "w": [int(x) if m.dtype.kind == "i" else float(x) for x in row[a:b]]})
    kind = "bigint" if m.dtype.kind == "i" else "double"
    return F.from_json(F.lit(json.dumps(rows)), f"array<struct<first:int,w:array<{kind}>>>")


def _pass(g: Column, table: Column, n: int, lines: int, out: int, whole: bool) -> Column:
    """Each of ``lines`` runs of ``n`` values through the table; output in the transposed order (out x lines)."""
    zero = F.lit(1 << (PRECISION - 1)).cast("long") if whole else F.lit(0.0)

    def cell(j: Column) -> Column:
        line = j % lines

        def dot(t: Column) -> Column:
            part = F.slice(g, line * n + t["first"] + 1, F.size(t["w"]))
            total = F.aggregate(F.zip_with(part, t["w"], lambda x, w: x * w), zero, lambda s, x: s + x)
            return F.least(F.greatest(F.shiftright(total, PRECISION), F.lit(0)), F.lit(255)) if whole else total

        return let(F.get(table, (j / lines).cast("int")), dot)

    return F.transform(F.sequence(F.lit(0), F.lit(out * lines - 1)), cell)


def apply_map(grid: Column, w: int, h: int, rows: np.ndarray, columns: np.ndarray) -> Column:
    """A w x h grid through ``rows`` (out width x w), then ``columns`` (out height x h), row-major again."""
    whole = rows.dtype.kind == "i"
    values = F.transform(grid, lambda x: x.cast("long" if whole else "double"))
    # the tables and the grid are bound once each; the first pass leaves columns as runs for the second
    first = let(F.struct(values.alias("g"), _table(rows).alias("t")), lambda b: _pass(b["g"], b["t"], w, h, len(rows), whole))
    return let(F.struct(first.alias("g"), _table(columns).alias("t")), lambda b: _pass(b["g"], b["t"], h, len(rows), len(columns), whole))


def resample(grid: Column | str, w: int, h: int, width: int, height: int) -> Column:
    """Grey levels 0..255 of w x h pixels, resampled to width x height (array<int>)."""
    g = F.col(grid) if isinstance(grid, str) else grid
    return F.transform(apply_map(g, w, h, lanczos_matrix(w, width), lanczos_matrix(h, height)), lambda x: x.cast("int"))


def resample_pixels(pixels: np.ndarray, width: int, height: int) -> np.ndarray:
    """The same for a decoded image (rows x columns of 0..255)."""
    half = 1 << (PRECISION - 1)
    h, w = pixels.shape
    across = np.clip((pixels.astype(np.int64) @ lanczos_matrix(w, width).T + half) >> PRECISION, 0, 255)
    return np.clip((lanczos_matrix(h, height) @ across + half) >> PRECISION, 0, 255)


def wavelet_low(grid: Column | str, n: int, hash_size: int, name: str = "db4", border: str = "symmetric",
                remove_lowest: int | None = None) -> Column:
    """F8: the low band of an n x n image at log2(n / hash_size) levels (doubles; at a border its side exceeds
    ``hash_size`` for filters of more than two taps).

    Values are taken as shares of 255. ``remove_lowest``: first take away what a Haar decomposition of so many levels leaves
    in its lowest band (log2(n) levels: the mean); None leaves the image as it is."""
    for size in (n, hash_size):
        if size & (size - 1):
            raise ValueError(f"{size} is not a power of 2")
    if hash_size > n:
        raise ValueError("the hash is larger than the image")
    low = cascade(n, name, int(math.log2(n // hash_size)), border)
    g = F.col(grid) if isinstance(grid, str) else grid
    g = F.transform(g, lambda x: x.cast("double") / 255.0)
    if remove_lowest == int(math.log2(n)):
        g = let(g, lambda v: let(mean_of(v), lambda m: F.transform(v, lambda x: x - m)))
    elif remove_lowest is not None:
        part = low_part(n, "haar", remove_lowest)
        g = let(g, lambda v: F.zip_with(v, apply_map(v, n, n, part, part), lambda x, y: x - y))
    return apply_map(g, n, n, low, low)


def wavelet_bits(grid: Column | str, n: int, hash_size: int, name: str = "db4", border: str = "symmetric",
                 remove_lowest: int | None = None) -> tuple[Column, int]:
    """F8: (array<boolean>, number of bits): low band above its median."""
    side = len(cascade(n, name, int(math.log2(n // hash_size)), border))
    low = wavelet_low(grid, n, hash_size, name, border, remove_lowest)
    return let(low, lambda v: let(median_of(v), lambda m: F.transform(v, lambda x: x > m))), side * side
