"""Perceptual image hashes as Column expressions over a pixel array.

A grid is an ``array<int>`` (or double) of ``w*h`` grey values, row-major:
pixel (x, y) is element ``y*w + x``. Every hash here is a per-row
higher-order-function expression: hashing needs no shuffle and no Python.
Bits are packed most-significant first (the first pixel is the top bit), and
rendered as hex with ``ceil(bits/4)`` digits.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from skein.functions.bits import bits_to_long


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _at(arr: Column, i: Column) -> Column:
    """0-based array access."""
    return F.element_at(arr, (i + 1).cast("int"))


def grey_from_unit(values: Column | str, offset: float = 0.5) -> Column:
    """Floats around 0 (e.g. [-0.5, 0.5]) to grey levels 0..255: floor((v+offset)*255) clamped."""
    return F.transform(_c(values), lambda v: F.least(F.greatest(
        F.floor((v.cast("double") + offset) * 255), F.lit(0)), F.lit(255)).cast("int"))


def block_mean(grid: Column | str, w: int, h: int, k: int) -> Column:
    """Resize by ``k x k`` block means: (w/k) x (h/k) doubles."""
    return let(_c(grid), lambda g: _block_mean(g, w, h, k))


def _block_mean(g: Column, w: int, h: int, k: int) -> Column:
    w2, h2 = w // k, h // k
    return F.transform(
        F.sequence(F.lit(0), F.lit(w2 * h2 - 1)),
        lambda j: F.aggregate(
            F.sequence(F.lit(0), F.lit(k * k - 1)), F.lit(0.0),
            lambda acc, t: acc + _at(g, ((j / w2).cast("int") * k + (t / k).cast("int")) * w
                                     + (j % w2) * k + t % k).cast("double"),
        ) / F.lit(float(k * k)),
    )


def let(value: Column, fn) -> Column:
    """Evaluate ``value`` once and pass it to ``fn`` (Spark does not share a
    sub-expression that is repeated inside a lambda)."""
    return F.element_at(F.transform(F.array(value), fn), 1)


def mean_of(arr: Column) -> Column:
    return F.aggregate(arr, F.lit(0.0), lambda a, x: a + x.cast("double")) / F.size(arr)


def median_of(arr: Column) -> Column:
    """Median of a small array (average of the two middle values for an even size)."""
    s = F.array_sort(F.transform(arr, lambda x: x.cast("double")))
    n = F.size(s)
    mid_hi = F.element_at(s, (n / 2).cast("int") + 1)
    mid_lo = F.element_at(s, ((n - 1) / 2).cast("int") + 1)
    return (mid_lo + mid_hi) / 2


def average_hash(grid: Column | str, variant: str = "python") -> Column:
    """bit = pixel > mean. ``scala`` compares with the integer (floored) mean (Q12)."""
    def with_grid(g):
        def with_mean(m):
            m = F.floor(m) if variant == "scala" else m
            return bits_to_long(F.transform(g, lambda p: p > m))

        return let(mean_of(g), with_mean)

    return let(_c(grid), with_grid)


def dhash(grid: Column | str, w: int, h: int, variant: str = "python") -> Column:
    """F6 horizontal: per row, bit = right > left (``scala``: left > right; Q12). (w-1)*h bits."""
    return let(_c(grid), lambda g: _dhash(g, w, h, variant))


def _dhash(g: Column, w: int, h: int, variant: str) -> Column:
    idx = F.sequence(F.lit(0), F.lit((w - 1) * h - 1))

    def bit(i):
        left = _at(g, (i / (w - 1)).cast("int") * w + i % (w - 1))
        right = _at(g, (i / (w - 1)).cast("int") * w + i % (w - 1) + 1)
        return right > left if variant == "python" else left > right

    return bits_to_long(F.transform(idx, bit))


def dhash_vertical(grid: Column | str, w: int, h: int) -> Column:
    """F6 vertical: bit = below > above, w*(h-1) bits."""
    idx = F.sequence(F.lit(0), F.lit(w * (h - 1) - 1))
    return let(_c(grid), lambda g: bits_to_long(F.transform(idx, lambda i: _at(g, i + w) > _at(g, i))))


def cos_table(n: int) -> Column:
    """DCT-II basis ``cos(pi * k * (2x + 1) / (2n))`` as one literal array, index k*n + x."""
    c = math.pi / (2 * n)
    return F.array(*[F.lit(math.cos(c * k * (2 * x + 1))) for k in range(n) for x in range(n)])


def dct_rows(grid: Column | str, n: int) -> Column:
    """1-D DCT-II along each row: n*n doubles, (row, k) row-major."""
    return let(F.struct(_c(grid).alias("g"), cos_table(n).alias("c")),
               lambda b: _dct_rows(b["g"], b["c"], n))


def _dct_rows(g: Column, ct: Column, n: int) -> Column:
    return F.transform(
        F.sequence(F.lit(0), F.lit(n * n - 1)),
        lambda j: F.aggregate(
            F.sequence(F.lit(0), F.lit(n - 1)), F.lit(0.0),
            lambda acc, x: acc + _at(g, (j / n).cast("int") * n + x).cast("double") * _at(ct, (j % n) * n + x),
        ),
    )


def dct2(grid: Column | str, n: int) -> Column:
    """2-D DCT-II (unnormalised) of an n x n grid as n*n doubles, (u, v) row-major.

    Separable: a row pass then a column pass (2 n^3 multiply-adds), with the
    basis bound once as a literal table.
    """
    def cols(b):
        r = b["r"]
        ct = b["c"]
        return F.transform(
            F.sequence(F.lit(0), F.lit(n * n - 1)),
            lambda j: F.aggregate(
                F.sequence(F.lit(0), F.lit(n - 1)), F.lit(0.0),
                lambda acc, y: acc + _at(ct, (j / n).cast("int") * n + y) * _at(r, y * n + j % n),
            ),
        )

    return let(F.struct(dct_rows(grid, n).alias("r"), cos_table(n).alias("c")), cols)


def phash(grid: Column | str, n: int, mode: str = "median", hash_size: int | None = None) -> Column:
    """DCT hash of the ``hash_size`` x ``hash_size`` lowest frequencies of an n x n grid (8 of 32 in the usual form;
    default: 8, or n if that is smaller). The rest, the fine detail, is left out.

    ``median`` (Python form): coefficients > their median; ``mean_no_dc`` (Scala form): coefficients with the first row
    and column scaled by 1/sqrt(2), > the mean of all but the DC term, horizontal frequency first; ``simple``: 1-D row
    DCT, the first ``hash_size`` rows, columns 1 to ``hash_size`` (to n - 1 at most), > their mean."""
    k = min(n, 8) if hash_size is None else hash_size
    if not 2 <= k <= n:
        raise ValueError(f"hash_size must be from 2 to {n}")

    def above(stat):
        return lambda d: let(stat(d), lambda m: bits_to_long(F.transform(d, lambda x: x > m)))

    def low(d: Column, first: int = 0, turned: bool = False) -> Column:
        last = min(k, n - first)
        places = [(v, u) if turned else (u, v) for u in range(k) for v in range(first, first + last)]
        return F.transform(F.array(*[F.lit(u * n + v + 1) for u, v in places]), lambda i: F.element_at(d, i))

    def scaled(d: Column) -> Column:
        half = 1 / math.sqrt(2)
        return F.transform(d, lambda x, i: x * F.when(i < n, half).otherwise(1.0) * F.when(i % n == 0, half).otherwise(1.0))

    if mode == "simple":
        return let(let(dct_rows(grid, n), lambda d: low(d, 1)), above(mean_of))
    if mode == "median":
        return let(let(dct2(grid, n), lambda d: low(d)), above(median_of))
    if mode == "mean_no_dc":
        kept = let(let(dct2(grid, n), scaled), lambda d: low(d, turned=True))
        return let(kept, above(lambda d: mean_of(F.slice(d, 2, k * k - 1))))
    raise ValueError(mode)


def wavelet_hash(grid: Column | str) -> Column:
    """F8 (Python form, grid already at hash size): bit = value > median.

    Removing the top Haar LL band shifts every value by one constant, so it
    changes no bit; a larger image is first reduced with ``block_mean``.
    """
    return let(_c(grid), lambda g: let(median_of(g), lambda m: bits_to_long(F.transform(g, lambda p: p > m))))


def haar_basis(n: int) -> list[list[float]]:
    """Matrix of the full 2-D Haar pyramid (averaging form: (a+b)/2, (a-b)/2),
    horizontal then vertical at each level on the shrinking low band, each
    level reading the previous level's values (Q23). Row j gives coefficient j
    (row-major) as weights of the n*n pixels; built by applying the transform
    to unit images."""
    import numpy as np

    def transform(a):
        r = a.astype(float).copy()
        size = n
        while size > 1:
            half = size // 2
            src = r.copy()
            for y in range(size):
                for x in range(half):
                    e, o = src[y, 2 * x], src[y, 2 * x + 1]
                    r[y, x], r[y, x + half] = (e + o) / 2, (e - o) / 2
            src = r.copy()
            for y in range(half):
                for x in range(size):
                    e, o = src[2 * y, x], src[2 * y + 1, x]
                    r[y, x], r[y + half, x] = (e + o) / 2, (e - o) / 2
            size = half
        return r

    cols = []
    for t in range(n * n):
        u = np.zeros(n * n)
        u[t] = 1.0
        cols.append(transform(u.reshape(n, n)).ravel())
    return np.array(cols).T.tolist()


def haar_hash(grid: Column | str, n: int) -> Column:
    """F8 Scala form: Haar pyramid of the n x n block-mean grid, bit =
    coefficient > mean of all coefficients but the DC term. Each coefficient
    is a fixed sum over the pixels with a nonzero basis weight (640 terms for
    n = 8), so the whole hash stays one generated expression."""
    m = haar_basis(n)

    def coefs(g):
        return F.array(*[sum((F.lit(w) * _at(g, F.lit(t)).cast("double") for t, w in enumerate(row) if w != 0),
                             F.lit(0.0)) for row in m])

    return let(let(_c(grid), coefs), lambda d: let(mean_of(F.slice(d, 2, n * n - 1)),
                                                   lambda mm: bits_to_long(F.transform(d, lambda x: x > mm))))


def hash_hex(h: Column | str, bits: int) -> Column:
    """packed hash -> hex with ceil(bits/4) digits."""
    digits = (bits + 3) // 4
    hx = F.lower(F.hex(_c(h)))
    return F.lpad(F.substring(hx, -digits, digits), digits, "0") if digits < 16 else F.lpad(hx, 16, "0")


def hex_to_hash(s: Column | str) -> Column:
    """hex back to the signed 64-bit value."""
    return F.conv(_c(s), 16, -10).cast("long")


# ----------------------------------------------------------------- colour hash
# Fixed values of the colour hash: black below grey 256//8, grey below
# saturation 256//3, faint below 256*2//3 (exactly 170 is in neither colour
# class), six hue bins of width 255/6, 3 bits per fraction.
BLACK_BELOW = 32
GRAY_SAT_BELOW = 85
FAINT_SAT_BELOW = 170
HUE_BINS = 6


def rgb_to_hsv(r: Column, g: Column, b: Column) -> tuple[Column, Column, Column]:
    """RGB (0..255) -> HSV scaled to 0..255 (hue wraps into [0, 255))."""
    mx = F.greatest(r, g, b).cast("double")
    mn = F.least(r, g, b).cast("double")
    d = mx - mn
    rc, gc, bc = r.cast("double"), g.cast("double"), b.cast("double")
    hue6 = (F.when(d == 0, F.lit(0.0))
            .when(mx == rc, (gc - bc) / d)
            .when(mx == gc, (bc - rc) / d + 2.0)
            .otherwise((rc - gc) / d + 4.0))
    h = F.when(hue6 < 0, hue6 + 6.0).otherwise(hue6) / 6.0 * 255.0
    s = F.when(mx == 0, F.lit(0.0)).otherwise(d / mx * 255.0)
    return F.floor(h), F.floor(s), mx


def color_hash(rgb: Column | str, binbits: int = 3) -> Column:
    """Black / grey fractions and 6 faint + 6 bright hue-bin fractions,
    each as ``binbits`` bits with the reference's encoding of a value v:
    bit i = (v // 2^(b-i-1)) % 2^(b-i) > 0 (Q22). ``rgb``: array<struct<r,g,b>>."""
    px = _c(rgb)
    n = F.size(px)

    def cls(p):
        lum = F.floor((p["r"] * 299 + p["g"] * 587 + p["b"] * 114) / 1000.0 + 0.5)
        h, s, _ = rgb_to_hsv(p["r"], p["g"], p["b"])

        def pick(q):  # lum, hue and saturation bound once per pixel
            hb = F.least(F.floor(q["h"] / (255.0 / HUE_BINS)), F.lit(HUE_BINS - 1)).cast("int")
            return (F.when(q["lum"] < BLACK_BELOW, F.lit(0)).when(q["s"] < GRAY_SAT_BELOW, F.lit(1))
                    .when(q["s"] < FAINT_SAT_BELOW, 2 + hb)
                    .when(q["s"] > FAINT_SAT_BELOW, 2 + HUE_BINS + hb)
                    .otherwise(F.lit(-1)))

        return let(F.struct(lum.alias("lum"), h.alias("h"), s.alias("s")), pick)

    nk = 2 + 2 * HUE_BINS
    mx = 2 ** binbits

    def counts(classes):
        # one pass over the pixels: counts[k] = pixels of class k
        return F.aggregate(classes, F.array_repeat(F.lit(0), nk),
                           lambda acc, c: F.transform(acc, lambda x, k: x + (k == c).cast("int")))

    def from_counts(cnt):
        colours = F.aggregate(F.slice(cnt, 3, nk - 2), F.lit(0), lambda a, x: a + x)
        cden = F.greatest(colours, F.lit(1)).cast("double")
        values = F.transform(cnt, lambda x, k: F.least(F.lit(mx - 1), F.floor(
            x * mx / F.when(k < 2, n.cast("double")).otherwise(cden))))
        bits = F.flatten(F.transform(values, lambda v: F.array(*[
            (F.floor(v / (2 ** (binbits - i - 1))) % (2 ** (binbits - i))) > 0 for i in range(binbits)])))
        return bits_to_long(bits)

    return let(let(F.transform(px, cls), counts), from_counts)
