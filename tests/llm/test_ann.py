"""Op 9 against brute force."""

import random

import numpy as np
from pyspark.sql import functions as F

from skein.llm import ann
from skein.llm.queries import QUERIES


def brute(rows, queries, k):
    ok = {}
    for i, v in rows:
        if i is None or not v or any(x is None or not np.isfinite(x) for x in v) or not any(v):
            continue
        ok[i] = min(ok[i], v) if i in ok else v
    out = {}
    for q in queries:
        if q not in ok:
            continue
        d = []
        for i, v in ok.items():
            if i != q and len(v) == len(ok[q]):
                s = 0.0
                for a, b in zip(v, ok[q]):
                    s += (float(a) - float(b)) ** 2
                d.append((s**0.5, i))
        out[q] = sorted(d)[:k]
    return out


def run(spark, rows, every, k=10):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("id", F.lit("clash")).repartition(4)
    got = {}
    for r in ann.nearest(df, F.col("vec_id") % every == 0, k).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.score, r.vec_id))
    return got


def f32(rng, n):
    return [float(np.float32(rng.gauss(0, 1))) for _ in range(n)]


def test_recall_and_scores(spark):
    rng = random.Random(3)
    rows = [(i, f32(rng, 64)) for i in range(3000)]
    want, got = brute(rows, range(0, 3000, 100), 10), run(spark, rows, 100)
    hits = sum(len({i for _, i in want[q]} & {i for _, i in got[q]}) for q in want)
    assert hits >= 0.98 * 10 * len(want)
    exact = {(q, i): s for q in want for s, i in want[q]}
    assert all(abs(exact[q, i] - s) < 1e-12 for q in got for s, i in got[q] if (q, i) in exact)


def test_defined_cases(spark):
    rng = random.Random(9)
    same = f32(rng, 8)
    rows = [(i, same) for i in range(40)] + [(100, f32(rng, 8)), (200, None), (300, []), (400, [0.0] * 8), (500, [float("nan")] * 8), (600, [None] + same[1:]),
                                             (700, [float("inf")] + same[1:]), (None, same), (800, f32(rng, 5)), (900, f32(rng, 5)), (100, f32(rng, 8)), (901, [0.0, 1.0])]
    want = brute(rows, range(0, 1000, 100), 10)
    got = run(spark, rows, 100)
    assert got.keys() == {q for q, v in want.items() if v}
    for q in got:
        assert [i for _, i in got[q]] == [i for _, i in want[q]]
        assert np.allclose([s for s, _ in got[q]], [s for s, _ in want[q]])
    assert run(spark, [], 100) == {}


def test_bounds_prune_and_hold():
    """The estimate's error stays in its bound for nearly all pairs, and most rows are not reranked."""
    rng = np.random.default_rng(1)
    x = rng.standard_normal((4000, 64))
    x /= np.sqrt((x * x).sum(1))[:, None]
    centre, turn = x.mean(0), ann.rotation(64)
    bits, length, corr = ann.encode(x, centre, turn)
    q = x[:50] - centre
    unit = q / np.sqrt((q * q).sum(1))[:, None]
    real = ((x - centre) / length[:, None]) @ unit.T
    signs = np.unpackbits(bits, axis=1).astype(float) * 2 - 1
    guess = signs @ (unit @ turn).T / 8 / corr[:, None]
    bound = ann.EPSILON * np.sqrt((1 - corr**2) / corr**2 / 63)
    assert (np.abs(guess - real) <= bound[:, None]).mean() > 0.93
    assert np.allclose(turn @ turn.T, np.eye(64))


def test_query_on_whole_table(spark, sf_dir):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    got = QUERIES["op9_ann"](spark, sf_dir).collect()
    want = brute(rows, [i for i, _ in rows if i % 100 == 0], 10)
    assert {(r.query_id, r.rank, r.vec_id) for r in got} == {(q, n + 1, i) for q in want for n, (_, i) in enumerate(want[q])}
