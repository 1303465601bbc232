"""Run-length segments against flood fill by plain Python."""

import time

import numpy as np
import pytest

from skein.operators import imaging


def flood(img, threshold):
    """(bright, pixels in reading order) of every 4-connected region."""
    h, w = img.shape
    mask, seen, out = img > threshold, np.zeros((h, w), bool), []
    for r0 in range(h):
        for c0 in range(w):
            if seen[r0, c0]:
                continue
            seen[r0, c0] = True
            stack, region = [(r0, c0)], []
            while stack:
                r, c = stack.pop()
                region.append((r, c))
                for rr, cc in ((r - 1, c), (r + 1, c), (r, c - 1), (r, c + 1)):
                    if 0 <= rr < h and 0 <= cc < w and not seen[rr, cc] and mask[rr, cc] == mask[r0, c0]:
                        seen[rr, cc] = True
                        stack.append((rr, cc))
            out.append((bool(mask[r0, c0]), sorted(region)))
    return sorted(out, key=lambda s: (not s[0], s[1][0]))


def described(seg, n):
    return [[(bool(b), int(s), (int(x0), int(y0), int(x1), int(y1))) for i, b, s, x0, y0, x1, y1 in zip(
        *(seg[k] for k in ("img", "bright", "size", "min_x", "min_y", "max_x", "max_y"))) if i == k] for k in range(n)]


def spiral(n):
    """One bright path that winds to the middle: the longest chain of runs."""
    img = np.zeros((n, n))
    r = c = 0
    dr, dc = 0, 1
    img[0, 0] = 255
    for _ in range(n * n):
        rr, cc = r + dr, c + dc
        ahead = (rr + dr, cc + dc)
        if not (0 <= rr < n and 0 <= cc < n) or img[rr, cc] or (0 <= ahead[0] < n and 0 <= ahead[1] < n and img[ahead]):
            dr, dc = dc, -dr
            rr, cc = r + dr, c + dc
            if not (0 <= rr < n and 0 <= cc < n) or img[rr, cc]:
                break
        r, c = rr, cc
        img[r, c] = 255
    return img


@pytest.mark.parametrize("share", [0.2, 0.5, 0.6, 0.8])
def test_stack_equals_flood_fill(share):
    rng = np.random.default_rng(int(share * 10))
    stack = (rng.random((12, 9, 14)) < share) * 200.0
    want = [[(b, len(p), (min(c for _, c in p), min(r for r, _ in p), max(c for _, c in p) + 1, max(r for r, _ in p) + 1)) for b, p in flood(g, 128)] for g in stack]
    assert described(imaging.stack_segments(stack, 128), 12) == want


def test_odd_shapes():
    for img in (np.zeros((1, 1)), np.full((1, 7), 255.0), np.arange(5).reshape(5, 1) * 60.0, spiral(31), np.indices((8, 8)).sum(0) % 2 * 255.0):
        seg = imaging.stack_segments(img[None], 128)
        assert described(seg, 1)[0] == [(b, len(p), (min(c for _, c in p), min(r for r, _ in p), max(c for _, c in p) + 1, max(r for r, _ in p) + 1)) for b, p in flood(img, 128)]


def test_limit_bare_images_and_hashes(spark):
    rng = np.random.default_rng(3)
    grids = [rng.integers(0, 256, 48) for _ in range(20)] + [np.indices((6, 8)).sum(0).ravel() % 2 * 255]  # a chequered image has no region of over two pixels
    df = spark.createDataFrame([(i * 10, g.tolist()) for i, g in enumerate(grids)], "img long, grid array<int>").repartition(3)
    got = {}
    for r in imaging.crop_segments(df, 8, 6, limit=3, scale=(2.0, 3.0)).orderBy("img", "seg").collect():
        got.setdefault(r.img, []).append((r.size, r.min_x, r.min_y, r.max_x, r.max_y, r.h))
    for i, g in enumerate(grids):
        img = g.reshape(6, 8).astype(float)
        regions = sorted([p for _, p in flood(img, 128) if len(p) > 2], key=len, reverse=True)[:3] or [[(0, 0), (5, 7)]]
        want = []
        for p in regions:
            y0, x0, y1, x1 = min(r for r, _ in p), min(c for _, c in p), max(r for r, _ in p) + 1, max(c for _, c in p) + 1
            spots = img[y0:y1, x0:x1][np.ix_(np.arange(4) * (y1 - y0) // 4, np.arange(4) * (x1 - x0) // 4)].ravel()
            want.append((len(p), x0 * 2, y0 * 3, x1 * 2, y1 * 3, int("".join("1" if s > spots.mean() else "0" for s in spots), 2)))
        assert got[i * 10] == want


def test_own_hash_function_and_smoothing(spark):
    img = np.zeros((10, 10), int)
    img[2:8, 2:8] = 255
    img[0, 9] = 255
    df = spark.createDataFrame([(1, img.ravel().tolist())], "img long, grid array<int>")
    got = imaging.crop_segments(df, 10, 10, min_size=0, smooth=True, hash_func=lambda box: box.size).collect()
    assert sorted(r.h for r in got) == sorted((r.max_x - r.min_x) * (r.max_y - r.min_y) for r in got)
    assert len(got) == 2  # the speck in the corner is no segment after smoothing
    assert imaging.crop_segments(df.limit(0), 10, 10).count() == 0


def test_large_images_are_fast():
    rng = np.random.default_rng(5)
    base = rng.random((4, 30, 30)).repeat(10, 1).repeat(10, 2) * 255 + rng.random((4, 300, 300)) * 20
    began = time.perf_counter()
    seg = imaging.stack_segments(base, 128)
    fast = time.perf_counter() - began
    began = time.perf_counter()
    want = flood(base[0], 128)
    slow = (time.perf_counter() - began) * 4
    assert len(want) == int((seg["img"] == 0).sum())
    assert slow >= 20 * fast, (slow, fast)
