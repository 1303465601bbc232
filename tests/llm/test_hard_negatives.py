"""Op 13 against all inner products."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from skein.llm import hard_negatives as hn


def brute(rows, every, k=5, low=80, high=100):
    ok = {}
    for i, v, lab in rows:
        if i is None or lab is None or not v or any(x is None or not math.isfinite(x) for x in v):
            continue
        x = tuple(math.floor(256 * float(np.float32(c))) for c in v)
        ok[i] = min(ok[i], (x, lab)) if i in ok else (x, lab)
    out = set()
    for a, (x, lab) in ok.items():
        if a % every:
            continue
        s = {i: sum(p * q for p, q in zip(x, y)) for i, (y, _) in ok.items() if len(y) == len(x) and i != a}
        pos = sorted((-s[i], i) for i in s if ok[i][1] == lab)[:k]
        for ps, p in pos:
            neg = sorted((-s[i], i) for i in s if ok[i][1] != lab and low * -ps <= 100 * s[i] <= high * -ps)[:k]
            out |= {(a, p, r, i, -ps, -ns) for r, (ns, i) in enumerate(neg, 1)}
    return out


def run(spark, rows, every, **more):
    df = spark.createDataFrame([(*r, "clash") for r in rows], "vec_id long, embedding array<float>, label int, cluster string").repartition(5)
    got = hn.mine_negatives(df, F.col("vec_id") % every == 0, **more).collect()
    assert len({tuple(r) for r in got}) == len(got)
    return {(r.anchor_id, r.positive_id, r.rank, r.negative_id, r.positive_score, r.negative_score) for r in got}


def clustered(rng, n, dim, groups, spread):
    centres = [[rng.gauss(0, 1) for _ in range(dim)] for _ in range(groups)]
    out = []
    for i in range(n):
        g = rng.randrange(groups)
        v = [c + rng.gauss(0, spread) for c in centres[g]]
        if rng.random() < 0.3:  # lengths differ
            v = [x * rng.uniform(0.2, 3) for x in v]
        out.append((i, v, (g + (rng.random() < 0.15)) % groups))
    return out


@pytest.fixture()
def small(monkeypatch):
    """Several segments, cells, blocks and clusters on small tables."""
    for name, value in (("FIRST_ROWS", 40), ("GROW", 3), ("CELL_ROWS", 64), ("CELL_MEMBERS", 4), ("STEP_ROWS", 16), ("MEMBERS", 6), ("BANDS", 64)):
        monkeypatch.setattr(hn, name, value)


def test_clustered_and_uniform(spark, small):
    rng = random.Random(4)
    near = clustered(rng, 900, 12, 5, 0.3)
    even = [(i, [rng.gauss(0, 1) for _ in range(6)], rng.randrange(3)) for i in range(500)]
    for rows, every in ((near, 20), (even, 25)):
        want = brute(rows, every)
        assert want and run(spark, rows, every) == want


def test_other_parameters(spark):
    rng = random.Random(6)
    rows = clustered(rng, 400, 8, 4, 0.5)
    assert run(spark, rows, 10, k=3, low=50, high=90) == brute(rows, 10, 3, 50, 90)


def test_defined_cases(spark, small):
    rng = random.Random(9)
    same = [rng.uniform(-1, 1) for _ in range(5)]
    rows = [(i, same, i % 2) for i in range(60)]  # ties everywhere
    rows += [(100, None, 1), (110, [], 1), (120, [float("nan")] * 5, 1), (130, [None] + same[1:], 1), (140, [float("inf")] + same[1:], 1), (150, same, None), (None, same, 1),
             (160, [0.0] * 5, 1), (170, [0.0] * 5, 0), (180, [-x for x in same], 1), (20, same, 1), (20, [1.0] * 5, 1), (30, same, 0), (200, [0.5, 0.5], 1), (210, [0.25, 0.5], 1), (211, [0.5, 0.4], 0)]
    assert run(spark, rows, 10) == brute(rows, 10)
    assert run(spark, [], 10) == set()
    assert run(spark, [(1, same, 1), (2, same, 0)], 10) == set()


def test_large_components_are_exact(spark):
    rng = random.Random(2)
    rows = [(i, [rng.uniform(-1, 1) * 2.0 ** rng.randrange(10, 20) for _ in range(6)], i % 3) for i in range(120)]
    assert run(spark, rows, 12) == brute(rows, 12)


def test_bounds_hold():
    rng = np.random.default_rng(3)
    x, u = rng.standard_normal((500, 16)) * 40, rng.standard_normal((200, 16)) * 7
    centres = hn.fit_centres(u, 8)
    cos = hn.unit(u) @ centres.T
    own = cos.argmax(1)
    theta = np.array([np.arccos(np.clip(cos[own == c, c], -1, 1)).max(initial=0) for c in range(len(centres))])
    bound = hn.bounds(x, centres, theta)[:, own]
    assert (x @ u.T <= bound * np.sqrt((u * u).sum(1))[None, :] + 1e-6).all()
    top = np.sqrt((x * x).sum(1)).max()
    band = hn.band_of(bound, top, hn.BANDS)
    order = np.argsort(-bound[:, 0])
    assert (np.diff(band[order, 0]) >= 0).all() and band.min() >= 0 and band.max() < hn.BANDS


def test_walk_ends_early():
    """A member of a tight cluster scores a small part of the list."""
    rng = np.random.default_rng(5)
    x = np.floor(rng.standard_normal((20_000, 32)) * 256)
    u = x[0] * 3
    theta = np.array([0.0])
    centre = hn.unit(u[None, :])
    bound = hn.bounds(x, centre, theta)[:, 0]
    order = np.argsort(-bound)
    seen = []
    real = hn.products
    try:
        hn.products = lambda a, b: seen.append(len(b)) or real(a, b)
        got = hn.walk([{"id": -1, "label": 1, "vector": u, "length": float(np.sqrt(u @ u)), "questions": [(None, None, None, None)]}],
                      np.arange(20_000)[order], np.ones(20_000, np.int64), x[order], bound[order], 5)
    finally:
        hn.products = real
    best = np.argsort(-(x @ u), kind="stable")[:5]
    assert {i for _, _, i, _ in got} == set(best.tolist()) and sum(seen) <= 1024
