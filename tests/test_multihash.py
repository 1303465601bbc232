"""Multi-hash pairs: against brute force, and without a shuffle of the pairs."""

import itertools
import random

import numpy as np
import pyarrow.parquet as pq
from pyspark.sql import functions as F

from skein.operators import imaging

SIGNED = lambda v: v - (1 << 64) if v >= 1 << 63 else v


def segments(bits: int, images: int, seed: int) -> list[tuple]:
    """Rows (img, seg, h) around few hashes; some hashes, segments and images are null, some rows come twice, some images hold
    two hashes of one segment."""
    rnd = random.Random(seed)
    base = [rnd.getrandbits(bits) for _ in range(6)]
    rows = []
    for img in range(images):
        for seg in range(rnd.randint(1, 4)):
            h = rnd.choice(base) ^ sum(1 << b for b in set(rnd.choices(range(bits), k=rnd.randint(0, 4))))
            rows += [(img, seg, SIGNED(h))] * rnd.choice([1, 1, 1, 2])
    rows += [(0, 0, SIGNED(base[1])), (1, 9, None), (2, None, SIGNED(base[0])), (None, 0, SIGNED(base[0])), (None, None, None)]
    return rows


def brute(rows: list[tuple], cutoff: int) -> dict:
    low: dict = {}
    for (a, s, x), (b, _, y) in itertools.product(rows, rows):
        if None not in (a, x, b, y) and a != b and (d := ((x ^ y) & (1 << 64) - 1).bit_count()) <= cutoff:
            low[a, b, s] = min(d, low.get((a, b, s), d))
    out: dict = {}
    for (a, b, _), d in low.items():
        m, t = out.get((a, b), (0, 0))
        out[a, b] = (m + 1, t + d)
    return out


def exchanges(df) -> int:
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1].count("Exchange")


def test_multihash_pairs_equal_brute_force_and_only_segments_are_shuffled(spark, monkeypatch):
    monkeypatch.setattr(imaging, "GRID", 3)
    for bits, cutoff in ((16, 2), (64, 3), (16, 0), (64, 0), (3, 5)):
        rows = segments(bits, 40, bits + cutoff)
        pairs = imaging.multihash_diff(spark.createDataFrame(rows, "img long, seg int, h long"), bits, cutoff)
        assert {(r.img, r.other): (r.matches, r.sum_distance) for r in pairs.collect()} == brute(rows, cutoff)
        assert exchanges(pairs) == 1
    rows = segments(16, 12, 5)
    named = [(None if i is None else f"i{i}", s, h) for i, s, h in rows]
    got = imaging.multihash_diff(spark.createDataFrame(named, "img string, seg int, h long"), 16, 2).collect()
    assert {(int(r.img[1:]), int(r.other[1:])): (r.matches, r.sum_distance) for r in got} == brute(rows, 2)
    assert imaging.multihash_diff(spark.createDataFrame([], "img long, seg int, h long"), 16, 2).collect() == []


def test_a_cell_expanded_in_small_slices_gives_the_same_pairs(monkeypatch):
    rnd = np.random.default_rng(3)
    img, seg, h = np.repeat(np.arange(50), 4), np.tile(np.arange(4), 50), rnd.integers(0, 200, 200)

    def cell():
        return sorted(p for part in imaging.match_cell((img, seg, h), (img, h), 16, 2) for p in zip(*(v.tolist() for v in part)))

    whole = cell()
    monkeypatch.setattr(imaging, "AT_ONCE", 7)
    assert cell() == whole and len(whole) > 1000


def test_a_cell_matched_by_few_images_gives_the_same_pairs_ordered_by_their_values(monkeypatch):
    rnd = np.random.default_rng(4)
    img, seg, h = np.repeat(np.arange(50), 4), np.tile(np.arange(4), 50), rnd.integers(0, 200, 200)

    def cell():
        parts = [list(zip(*(v.tolist() for v in part))) for part in imaging.match_cell((img, seg, h), (img, h), 16, 2)]
        assert all(part == sorted(part, key=lambda p: (p[2], p[3], p[0], p[1])) for part in parts)
        return sorted(p for part in parts for p in part), len(parts)

    whole, n = cell()
    monkeypatch.setattr(imaging, "TOGETHER", 3)
    assert cell() == (whole, 17) and n == 1 and len(whole) > 1000


def test_near_values_looked_up_equal_those_of_the_bands(monkeypatch):
    rnd = np.random.default_rng(5)
    for bits, t, n in ((16, 2, 4000), (10, 1, 900), (6, 3, 64), (6, 0, 64), (3, 5, 8)):
        a, b = (np.sort(rnd.permutation(1 << bits)[:n]) for _ in range(2))
        pairs = []
        for most in (20, 0):
            monkeypatch.setattr(imaging, "LOOKED_UP", most)
            monkeypatch.setattr(imaging, "AT_ONCE", 1000)
            x, y, dist = imaging.near_values(a, b, bits, t)
            assert (np.diff(x) >= 0).all()
            pairs.append(sorted(zip(x.tolist(), y.tolist(), dist.tolist())))
        assert pairs[0] == pairs[1] and pairs[0]
        if n < 1000:
            assert pairs[0] == [(i, j, d) for i, v in enumerate(a.tolist()) for j, w in enumerate(b.tolist()) if (d := (v ^ w).bit_count()) <= t]


def test_multihash_ids_are_written_as_numbers_of_a_dictionary(spark, monkeypatch, tmp_path):
    # the first 20,000 rows of a file decide: with nearly as many ids in them, the writer gives up numbering and writes 8 bytes an id
    monkeypatch.setattr(imaging, "GRID", 1)
    segs = spark.range(20_000).selectExpr("id as img", "0 as seg", "id % 2000 as h")
    pairs = imaging.multihash_diff(segs, 16, 0, counted=True, packed=True)
    imaging.multihash_score(pairs, segs, 16, digits=6).write.parquet(str(tmp_path / "out"))
    files = [pq.ParquetFile(f) for f in (tmp_path / "out").glob("*.parquet")]
    assert sum(f.metadata.num_rows for f in files) == 20_000 * 9
    for f in files:
        for column in range(5):  # is_match has no dictionary
            assert not f.metadata.num_rows or "PLAIN" not in f.metadata.row_group(0).column(column).encodings, f.schema.names[column]


def test_multihash_packed_pairs_give_the_same_scores(spark):
    rows = segments(16, 40, 9)
    segs = spark.createDataFrame(rows, "img long, seg int, h long")
    plain = imaging.multihash_score(imaging.multihash_diff(segs, 16, 2, counted=True), segs, 16)
    for counted in (True, False):
        packed = imaging.multihash_diff(segs, 16, 2, counted, packed=True)
        assert packed.columns == ["img", "others", "matches", "sum_distance"] + ["n_segs"] * counted
        scored = imaging.multihash_score(packed, segs, 16, digits=6)
        assert scored.columns == plain.columns
        assert sorted(scored.collect()) == sorted(r for r in plain.withColumn("score", F.round("score", 6)).collect())


def test_multihash_score_counts_the_segments_where_the_pairs_are_made(spark):
    rows = segments(16, 40, 8)
    segs = spark.createDataFrame(rows, "img long, seg int, h long")
    n = {i: sum(r[0] == i for r in rows) for i in range(40)}
    want = {p: (m, d, n[p[0]] - (m - d / (m * 16)), m >= 2) for p, (m, d) in brute(rows, 2).items()}
    for counted in (True, False):
        scored = imaging.multihash_score(imaging.multihash_diff(segs, 16, 2, counted), segs, 16, 2)
        assert scored.columns == ["img", "other", "matches", "sum_distance", "score", "is_match"]
        assert {(r.img, r.other): (r.matches, r.sum_distance, r.score, r.is_match) for r in scored.collect()} == want
        assert not counted or exchanges(scored) == 1


def test_multihash_best_sorts_no_pairs(spark):
    rows = segments(16, 40, 8)
    segs = spark.createDataFrame(rows, "img long, seg int, h long")
    scored = imaging.multihash_score(imaging.multihash_diff(segs, 16, 2, counted=True), segs, 16)
    best = imaging.multihash_best(scored)
    want: dict = {}
    for r in scored.collect():
        want[r.img] = min(want.get(r.img, (r.score, r.other)), (r.score, r.other))
    assert {r.img: (r.score, r.best) for r in best.collect()} == want
    plan = best._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]
    above, pairs = plan.split("MapInArrow")[0].rsplit("Exchange", 1)  # what is done to the pairs before they are dealt again
    assert "HashAggregate" in pairs and "Sort" not in pairs, pairs
    assert above.count("Exchange") == 1
