"""Hashes of any width, resampling and wavelets against plain Python."""

import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from skein.functions import separable, wide
from skein.operators import widejoin


def words_of(v, n):
    k = wide.word_count(n)
    out = [(v >> (64 * (k - 1 - i))) & ((1 << 64) - 1) for i in range(k)]
    return [w - (1 << 64) if w >> 63 else w for w in out]


@pytest.mark.parametrize("n", [1, 14, 63, 64, 65, 121, 128, 200, 256, 1024])
def test_text_and_bits_round_trip(spark, n):
    rng = random.Random(n)
    values = [0, (1 << n) - 1, 1, 1 << (n - 1)] + [rng.getrandbits(n) for _ in range(20)]
    rows = [(words_of(v, n), [c == "1" for c in f"{v:0{n}b}"], f"{v:0{-(-n // 4)}x}") for v in values]
    df = spark.createDataFrame(rows, "w array<long>, b array<boolean>, t string")
    got = df.select("*", wide.pack_bits(F.col("b"), n).alias("packed"), wide.unpack_bits("w", n).alias("bits"), wide.wide_hex("w", n).alias("hex"),
                    wide.hex_wide(F.upper("t"), n).alias("parsed")).collect()
    for r in got:
        assert r.packed == r.w and r.bits == r.b and r.hex == r.t and r.parsed == r.w


def test_text_that_is_no_hash(spark):
    df = spark.createDataFrame([("zz",), ("",), (None,), ("1ff",), ("ff",), ("f" * 40,)], "t string")
    assert [r.w for r in df.select(wide.hex_wide("t", 8).alias("w")).collect()] == [None, None, None, None, [255], None]
    with pytest.raises(Exception, match="expected 9 bits"):
        spark.createDataFrame([([True] * 8,)], "b array<boolean>").select(wide.pack_bits(F.col("b"), 9)).collect()


def test_old_byte_order(spark):
    rng = random.Random(1)
    for size in (8, 16):
        digits = size * (size // 4)
        text = "".join(rng.choice("0123456789abcdef") for _ in range(digits))
        want = [int(text[i:i + 2], 16) >> k & 1 == 1 for i in range(0, digits, 2) for k in range(8)]
        r = spark.createDataFrame([(text,)], "t string").select(wide.old_hex_wide("t", size).alias("w")).withColumn(
            "back", wide.wide_old_hex("w", digits * 4)).withColumn("bits", wide.unpack_bits("w", digits * 4)).first()
        assert r.bits == want and r.back == text
    with pytest.raises(Exception, match="expected a hex string of 16 digits"):
        spark.createDataFrame([("abc",)], "t string").select(wide.old_hex_wide("t", 8)).collect()


def test_multi_text(spark):
    r = spark.createDataFrame([("00ff,ABCD,xyz",)], "t string").select(wide.hex_multi("t", 16).alias("m"), wide.square_bits(F.lit("0" * 64)).alias("n")).first()
    assert r.m == [[255], [0xABCD], None] and r.n == 256


@settings(max_examples=30, deadline=None)
@given(st.integers(1, 300), st.integers(1, 20))
def test_bands_cover_the_hash(bits, bands):
    layout = wide.wide_bands(bits, min(bands, bits))
    assert layout[0][0] == 0 and sum(s for _, s in layout) == bits
    assert all(a + s == b for (a, s), (b, _) in zip(layout, layout[1:]))


@pytest.mark.parametrize("bits,t,bands", [(256, 12, 7), (256, 3, None), (121, 5, 2), (96, 8, 3), (200, 2, 1), (64, 4, None)])
def test_join_equals_all_pairs(spark, bits, t, bands):
    rng = random.Random(bits + t)
    base = [rng.getrandbits(bits) for _ in range(25)]
    near = [v ^ sum({1 << rng.randrange(bits) for _ in range(rng.randrange(0, 2 * t))}) for v in base for _ in range(4)]
    left, right = [(i, v) for i, v in enumerate(base * 2)], [(i, v) for i, v in enumerate(near)]
    kind = "k long, h array<long>"
    got = widejoin.hamming_pairs_wide(spark.createDataFrame([(i, words_of(v, bits)) for i, v in left], kind),
                                      spark.createDataFrame([(i, words_of(v, bits)) for i, v in right], kind), bits, t, ["k"], ["k"], bands).collect()
    want = {(i, j, (a ^ b).bit_count()) for i, a in left for j, b in right if (a ^ b).bit_count() <= t}
    assert len(got) == len(want) and {(r.k, r.r_k, r.dist) for r in got} == want


def test_probes_are_all_near_values(spark):
    for size, radius in ((5, 1), (70, 2)):
        value = [0b10110] if size == 5 else words_of(random.Random(2).getrandbits(62), 62) + [3]
        got = spark.createDataFrame([(value,)], "v array<long>").select(wide.probes(F.col("v"), size, radius).alias("p")).first().p
        assert len({tuple(x) for x in got}) == len(got) == 1 + size + (size * (size - 1) // 2 if radius == 2 else 0)
        assert max(sum((x ^ y).bit_count() for x, y in zip(p, value)) for p in got) == radius


def test_multihash_wide(spark):
    rng = random.Random(7)
    seg = [(i, s, rng.getrandbits(100)) for i in range(12) for s in range(3)]
    seg += [(20 + i, s, v ^ (1 << rng.randrange(100))) for i, s, v in seg if rng.random() < 0.7]
    got = widejoin.multihash_diff_wide(spark.createDataFrame([(i, s, words_of(v, 100)) for i, s, v in seg], "img long, seg int, h array<long>"), 100, 3).collect()
    want = {}
    for i, s, v in seg:
        for other in {x[0] for x in seg} - {i}:
            low = min((v ^ u).bit_count() for o, _, u in seg if o == other)
            if low <= 3:
                n, d = want.get((i, other), (0, 0))
                want[i, other] = (n + 1, d + low)
    assert {(r.img, r.other): (r.matches, r.sum_distance) for r in got} == want


# ------------------------------------------------------------- resampling
@pytest.mark.parametrize("w,h,out", [(8, 8, (5, 5)), (8, 8, (16, 16)), (3, 5, (8, 8)), (40, 17, (9, 8)), (1, 1, (4, 4)), (16, 16, (16, 16))])
def test_resample_columns_equal_numpy(spark, w, h, out):
    rng = np.random.default_rng(w * h)
    img = rng.integers(0, 256, (h, w))
    got = spark.createDataFrame([(img.ravel().tolist(),)], "g array<int>").select(separable.resample("g", w, h, *out).alias("g")).first().g
    assert got == separable.resample_pixels(img, *out).ravel().tolist()
    if (w, h) == out:
        assert got == img.ravel().tolist()


def test_resample_of_flat_and_ramp_images():
    flat = separable.resample_pixels(np.full((37, 21), 77), 8, 8)
    assert (flat == 77).all()
    ramp = separable.resample_pixels(np.tile(np.arange(256), (10, 1)), 32, 4)
    assert (np.diff(ramp[0]) > 0).all() and abs(int(ramp[0, 16]) - 132) <= 1
    m = separable.lanczos_matrix(300, 8)
    assert abs(m.sum(1) - (1 << separable.PRECISION)).max() <= 300 and (m != 0).sum(1).max() <= 2 * 3 * 300 / 8 + 2


# --------------------------------------------------------------- wavelets
@pytest.mark.parametrize("name", ["haar", "db4"])
@pytest.mark.parametrize("border", ["symmetric", "periodic"])
@pytest.mark.parametrize("n", [16, 32, 22])
def test_both_bands_reconstruct_the_signal(name, border, n):
    x = np.random.default_rng(n).standard_normal(n)
    low, high = separable.analysis(n, name, border), separable.analysis(n, name, border, True)
    back = separable.synthesis(len(low), n, name) @ (low @ x) + separable.synthesis(len(high), n, name, True) @ (high @ x)
    assert np.allclose(back, x)


def test_lowest_haar_band_is_block_means():
    x = np.random.default_rng(4).standard_normal((16, 16))
    for levels in (1, 2, 4):
        part = separable.low_part(16, "haar", levels)
        k = 2**levels
        means = x.reshape(16 // k, k, 16 // k, k).mean((1, 3)).repeat(k, 0).repeat(k, 1)
        assert np.allclose(part @ x @ part.T, means)


def test_wavelet_columns_equal_matrices(spark):
    img = np.random.default_rng(6).integers(0, 256, (16, 16))
    df = spark.createDataFrame([(img.ravel().tolist(),)], "g array<int>")
    for name, size, border, lowest in (("db4", 8, "symmetric", 4), ("db4", 4, "periodic", None), ("haar", 4, "symmetric", 2), ("db4", 16, "symmetric", 4)):
        x = img / 255
        if lowest is not None:
            part = separable.low_part(16, "haar", lowest)
            x = x - part @ x @ part.T
        low = separable.cascade(16, name, int(np.log2(16 // size)), border)
        got = df.select(separable.wavelet_low("g", 16, size, name, border, lowest).alias("v")).first().v
        assert np.allclose(np.array(got).reshape(len(low), len(low)), low @ x @ low.T)
    with pytest.raises(ValueError):
        separable.wavelet_low("g", 12, 4)
    with pytest.raises(ValueError):
        separable.wavelet_low("g", 4, 8)
