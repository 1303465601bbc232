"""Unit tests: hand-made rows per operator, the Q-cases of the survey, and
property checks against brute force on small fixtures."""

import itertools
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from skein.functions import bits as B
from skein.functions import imagehash as H
from skein.functions import scalars as S
from skein.operators import audio, changes, imaging, match, paging, profile, shape, validate, windows
from skein.sources import store


def rows(df, *cols):
    return sorted(tuple(r) for r in (df.select(*cols) if cols else df).collect())


# ---------------------------------------------------------------- shaping
def test_split_features_trim_q1(spark):
    df = spark.createDataFrame([("a, b, c",)], "f string")
    assert df.select(shape.split_list("f", ",", trim=True)).first()[0] == ["a", "b", "c"]
    assert df.select(shape.split_list("f", ",", trim=False)).first()[0] == ["a", " b", " c"]


def test_split_by_column_literal_and_regex(spark):
    # the delimiter lives in another column
    df = spark.createDataFrame([("red#green##", "#"), ("@7.5@left", "@"), ("cost$12$", "$"), ("up^down", "^")], "v string, d string")
    lit_ = [r[0] for r in df.select(shape.split_by_column("v", "d", literal=True)).collect()]
    assert lit_ == [["red", "green", "", ""], ["", "7.5", "left"], ["cost", "12", ""], ["up", "down"]]
    rx = [r[0] for r in df.select(shape.split_by_column("v", "d", literal=False)).collect()]
    # as a regex, $ and ^ are anchors: the character itself never splits
    assert rx[2][0] == "cost$12$" and rx[3][0] == "up^down"


def test_flatten_nested_names_and_arrays(spark):
    df = spark.read.json(spark.sparkContext.parallelize([
        '{"id": 1, "a-b": {"c.d": 2, "e": [1, 2]}, "items": [{"x": 1}, {"x": 2}]}',
        '{"id": 2, "a-b": {"c.d": 3, "e": []}, "items": []}']))
    flat = shape.flatten(df)
    assert set(flat.columns) == {"id", "ab_c_d", "ab_e", "items_x"}
    got = rows(flat, "id", "ab_c_d", "ab_e", "items_x")
    assert got[:4] == [(1, 2, 1, 1), (1, 2, 1, 2), (1, 2, 2, 1), (1, 2, 2, 2)]  # two arrays multiply rows
    assert got[4] == (2, 3, None, None)  # empty arrays kept as NULL (outer)


def test_owner_or_feature_semijoin(spark):
    cat = spark.createDataFrame([(1, "a", ["x"]), (2, "b", ["a", "z"]), (3, "c", [])], "id int, owner string, feats array<string>")
    ids = spark.createDataFrame([("a",)], "artist string")
    assert rows(shape.owner_or_feature(cat, "id", "owner", "feats", ids, "artist"), "id") == [(1,), (2,)]


def test_lookup_by_key_allow_list_q7(spark):
    df = spark.createDataFrame([(1, "k")], "id int, key string")
    with pytest.raises(ValueError):
        shape.semi_lookup(df, df, "key_like", allowed=("id", "key"))


def test_duration_seconds_f10(spark):
    df = spark.createDataFrame([("42",), ("3:05",), ("1:2:3",), ("x:5",), ("1:2:3:4",)], "t string")
    assert [r[0] for r in df.select(S.duration_seconds("t")).collect()] == [42, 185, 3723, 5, 0]


def test_ascii_lower_keeps_non_ascii_f11(spark):
    df = spark.createDataFrame([("ÉCOLE Abc",)], "t string")
    assert df.select(S.ascii_lower("t")).first()[0] == "École abc"


def test_sanitize_html_f17(spark):
    html = ('<p class="x">Hi <b>there</b><script>alert(1)</script><!-- c --><div>text</div><a class="y" href="http://e" onclick="z">l</a>'
            '<A HREF="javascript:x">m</A><q cite="https://s/1" id="i">n</q><blockquote cite="x">o</blockquote><abbr>p</abbr></p>')
    df = spark.createDataFrame([(html,)], "h string")
    assert df.select(S.sanitize_html("h")).first()[0] == (
        '<p>Hi <b>there</b>text<a href="http://e" rel="nofollow">l</a><a rel="nofollow">m</A><q cite="https://s/1">n</q>'
        '<blockquote>o</blockquote>p</p>')


def test_validation_fixture_p20(spark):
    df = spark.createDataFrame([("Lamp", "last spring", 3), ("Lamp", "1998-02-28", 0), ("Desk", "2020-06-01", -7)],
                               "name string, introduced string, price int")
    rules = [validate.Rule("name", "nonempty"), validate.Rule("introduced", "date"), validate.Rule("price", "min", 0)]
    got = [r["errors"] for r in validate.validate(df, rules).collect()]
    assert got == [["introduced:error.date"], [], ["price:error.min"]]


# ------------------------------------------------------------------ bits
def test_pair_address_masks_to_32_bits_f1(spark):
    df = spark.createDataFrame([(511, 511, 2 ** 33 + 5), (3, 2, 7)], "a long, b long, d long")
    got = [r[0] for r in df.select(B.pair_address("a", "b", "d")).collect()]
    want = [((511 << 23) | (511 << 14) | ((2 ** 33 + 5) & 0xFFFFFFFF)) & 0xFFFFFFFF, (3 << 23) | (2 << 14) | 7]
    assert got == want


def test_hamming_hex_counts_digits_q21(spark):
    df = spark.createDataFrame([(0x0F, 0x00)], "a long, b long")
    r = df.select(B.hamming64("a", "b"), B.hamming_hex(H.hash_hex("a", 64), H.hash_hex("b", 64))).first()
    assert tuple(r) == (4, 1)


def test_color_hash_bit_encoding_q22(spark):
    # value v encodes as [v >= 4, (v // 2) % 4 > 0, v odd]; all-black image -> black fraction 7
    df = spark.createDataFrame([([(0, 0, 0)] * 5,)], "px array<struct<r:int,g:int,b:int>>")
    h = df.select(H.color_hash("px")).first()[0]
    bits = format(h, "042b")
    assert bits[:3] == "111" and set(bits[3:]) == {"0"}


# ----------------------------------------------------------------- windows
def test_dense_index_matches_row_number(spark):
    rnd = random.Random(1)
    data = [(rnd.randint(0, 3), rnd.randint(0, 50), i) for i in range(300)]
    df = spark.createDataFrame(data, "k int, t int, id int")
    ix = windows.dense_index(df, ["k"], F.floor(F.col("t") / 10), [F.col("t"), F.col("id")])
    got = {(r["k"], r["id"]): r["idx"] for r in ix.collect()}
    for k in range(4):
        seq = sorted((t, i) for kk, t, i in data if kk == k)
        for pos, (_, i) in enumerate(seq):
            assert got[(k, i)] == pos


def test_dense_index_splits_a_hot_key(spark):
    # one key holds 90 % of the rows, all at the same time value: range blocks
    # still spread it over several tasks, and positions stay exact
    rnd = random.Random(2)
    data = [(0 if i % 10 else rnd.randint(1, 5), 7 if i % 10 else rnd.randint(0, 50), i) for i in range(4000)]
    df = spark.createDataFrame(data, "k int, t int, id int").repartition(8)
    ix = windows.dense_index(df, ["k"], None, [F.col("t"), F.col("id")])
    per_task = ix.filter("k = 0").groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert len(per_task) > 1
    assert max(r["count"] for r in per_task) < 0.75 * sum(1 for k, _, _ in data if k == 0)
    got = {(r["k"], r["id"]): r["idx"] for r in ix.collect()}
    for k in range(6):
        seq = sorted((t, i) for kk, t, i in data if kk == k)
        assert [got[(k, i)] for _, i in seq] == list(range(len(seq)))


def test_top_k_plans_partial_limit(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("g"), "id")
    plan = df.transform(lambda d: paging.top_k_per_group(d, ["g"], [F.col("id").desc()], 2))._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


# ------------------------------------------------------------------- audio
def test_low_pass_chunks_equal_recurrence(spark):
    rnd = np.random.default_rng(3)
    x = rnd.normal(size=50)
    df = spark.createDataFrame([(1, i, float(v)) for i, v in enumerate(x)], "song_id long, i long, v double")
    got = [r["v"] for r in audio.low_pass(df, 50.0, 1000.0, chunk=7).orderBy("i").collect()]
    a = audio._alpha(50.0, 1000.0)
    y, want = 0.0, []
    for v in x:
        y = a * v + (1 - a) * y
        want.append(y)
    assert np.allclose(got, want, atol=1e-12)


@pytest.mark.parametrize("cutoff", [0.5, 50.0])
def test_low_pass_chains_chunk_ends_on_levels(spark, cutoff, monkeypatch):
    # arrays of two chunk ends: the song's nine chunks need every level
    monkeypatch.setattr(audio, "CHAIN", 2)
    rnd = np.random.default_rng(4)
    x = rnd.normal(size=60)
    df = spark.createDataFrame([(s, i, float(v)) for s in (1, 2) for i, v in enumerate(x)],
                               "song_id long, i long, v double")
    got = [r["v"] for r in audio.low_pass(df, cutoff, 1000.0, chunk=7)
           .filter("song_id = 2").orderBy("i").collect()]
    a = audio._alpha(cutoff, 1000.0)
    y, want = 0.0, []
    for v in x:
        y = a * v + (1 - a) * y
        want.append(y)
    assert np.allclose(got, want, rtol=0, atol=1e-12)


def test_stft_numpy_equals_relational(spark):
    rnd = np.random.default_rng(5)
    df = spark.createDataFrame([(s, i, float(v)) for s in (1, 2) for i, v in enumerate(rnd.normal(size=40))],
                               "song_id long, i long, v double")
    fast = audio.stft(df, 8, 2, 4, mode="full", frames_per_task=3)
    rel = audio.stft_relational(audio.frames(df, 8, 2, mode="full"), 8, 4)
    a = {(r[0], r[1], r[2]): r[3] for r in fast.select("song_id", "frame", "k", "mag").collect()}
    b = {(r[0], r[1], r[2]): r[3] for r in rel.select("song_id", "frame", "k", "mag").collect()}
    assert a.keys() == b.keys() and all(math.isclose(a[k], b[k], abs_tol=1e-9) for k in a)


def test_frames_reference_count_q3(spark):
    df = spark.createDataFrame([(1, i, 1.0) for i in range(100)], "song_id long, i long, v double")
    assert df.select(audio.frame_count(F.lit(100), 16, 4, "reference")).first()[0] == 100 // 12
    n = audio.frames(df, 16, 4, "reference").select("frame").distinct().count()
    assert n == 100 // 12


def test_band_peaks_zero_band_reports_bin0(spark):
    spec = spark.createDataFrame([(1, 0, k, 0.0 if k < 2 else float(k), 0.0, 1, 1) for k in range(8)],
                                 "song_id long, frame long, k long, mag double, re double, n_frames long, n_samples long")
    bp = {r["band"]: (r["k"], r["mag"]) for r in audio.band_peaks(spec, [0, 1, 2, 4, 8]).collect()}
    assert bp[0] == (0, 0.0) and bp[1] == (0, 0.0) and bp[2] == (3, 3.0) and bp[3] == (7, 7.0)


def _timing_brute(ms, tol=100):
    from collections import defaultdict
    by = defaultdict(list)
    for r, s_, a, sm, dm in ms:
        by[(r, s_)].append((sm, dm))
    out = {}
    for k, v in by.items():
        c = 0
        for (s1, d1), (s2, d2) in itertools.combinations(v, 2):
            if abs((s2 - s1) - (d2 - d1)) < tol and (s2 - s1) * (d2 - d1) >= 0:
                c += 1
        out[k] = c
    return out


def test_relative_timing_equals_brute_force(spark):
    rnd = random.Random(7)
    ms, addr = [], 0
    for req in range(3):
        for song in range(3):
            base = rnd.randint(-500, 500)
            for _ in range(rnd.randint(1, 40)):
                addr += 1
                s_ = rnd.randint(0, 600)
                d = s_ - base + rnd.choice([0, 0, rnd.randint(-150, 150)])
                ms.append((req, song, addr, s_, d))
                if rnd.random() < 0.2:  # duplicated (s, d) from another address
                    addr += 1
                    ms.append((req, song, addr, s_, d))
    df = spark.createDataFrame(ms, "request_id long, song_id long, address long, s_ms long, d_ms long")
    got = {(r[0], r[1]): r[2] for r in match.relative_timing(df).collect()}
    want = _timing_brute(ms)
    assert {k: v for k, v in got.items() if v} == {k: v for k, v in want.items() if v}


def test_scores_deal_the_matches_few_times(spark):
    """Statistics, offsets and agreeing gaps come from one shuffle of the points; only close ones are joined."""
    m = spark.createDataFrame([(1, 1, 1, 0, 0), (1, 1, 2, 50, 50), (1, 2, 1, 0, 9), (2, 1, 3, 7, 7)], "request_id long, song_id long, address long, s_ms long, d_ms long")
    songs = spark.createDataFrame([(1, "a", "x"), (2, "b", "y")], "song_id long, title string, artist string")
    scored = match.match_scores(m, songs)
    got = sorted((r.request_id, r.song_id, r.first_ms, r.matches, r.score, r.best_offset) for r in scored.collect())
    assert got == [(1, 1, 0, 2, 1, 0), (1, 2, 9, 1, 0, -9), (2, 1, 7, 1, 0, 0)]
    plan = scored._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]
    assert plan.count("Exchange hashpartitioning(request_id") <= 5


# ------------------------------------------------------------------ images
def test_hamming_pairs_exact_by_pigeonhole(spark):
    rnd = random.Random(11)
    base = [rnd.getrandbits(64) for _ in range(40)]
    hs = []
    for i, b in enumerate(base):
        hs.append((i, 0, b))
        v = b
        for bit in rnd.sample(range(64), rnd.randint(0, 7)):
            v ^= 1 << bit
        hs.append((i, 1, v))
    def signed(x):
        return x - (1 << 64) if x >= 1 << 63 else x
    df = spark.createDataFrame([(a, b, signed(h)) for a, b, h in hs], "video long, frame long, h long")
    got = set(rows(imaging.hamming_pairs(df, df, 64, 5, ["video", "frame"], ["video", "frame"]),
                   "video", "frame", "r_video", "r_frame"))
    want = {(a1, f1, a2, f2) for (a1, f1, h1), (a2, f2, h2) in itertools.product(hs, hs) if bin(h1 ^ h2).count("1") <= 5}
    assert got == want


def test_video_similarity_hot_value_equals_brute_force(spark):
    # one hash value held by a third of all frames, spread over every video
    rnd = random.Random(5)
    hot = rnd.getrandbits(16)
    frames = []
    for v in range(12):
        for f in range(9):
            h = hot if f % 3 == 0 else rnd.getrandbits(16)
            if f % 3 == 1:
                h = hot ^ (1 << rnd.randrange(16))  # one bit off the hot value
            frames.append((v, f, h))
    df = spark.createDataFrame(frames, "video long, frame long, h long")
    got = {(r.video, r.other_video): (r.matched, r.similarity) for r in imaging.video_similarity(df, 16, 2).collect()}
    n = {v: sum(1 for a, _, _ in frames if a == v) for v in range(12)}
    want = {}
    for a in range(12):
        for b in range(12):
            if a == b:
                continue
            m = sum(1 for va, _, ha in frames if va == a
                    and any(vb == b and bin(ha ^ hb).count("1") <= 2 for vb, _, hb in frames))
            if m:
                want[(a, b)] = (m, m / min(n[a], n[b]))
    assert got == want
    semi = set(rows(imaging.hamming_semi(df, 16, 2), "video", "frame", "other_video"))
    want_semi = {(va, fa, vb) for va, fa, ha in frames for vb, _, hb in frames
                 if va != vb and bin(ha ^ hb).count("1") <= 2}
    assert semi == want_semi


def test_hasher_registry_x5():
    assert imaging.hasher("phash")
    with pytest.raises(ValueError):
        imaging.hasher("marr")


def test_crop_segments_x4(spark):
    g = [0] * 64
    for y in range(3):
        for x in range(3):
            g[y * 8 + x] = 255  # one bright 3x3 blob, the rest dark
    df = spark.createDataFrame([(1, g)], "img long, grid array<int>")
    segs = imaging.crop_segments(df, 8, 8, threshold=128, min_size=2).orderBy("seg").collect()
    assert [(s["size"], s["min_x"], s["min_y"], s["max_x"], s["max_y"]) for s in segs] == [(9, 0, 0, 3, 3), (55, 0, 0, 8, 8)]


def test_natural_sort_o5(spark):
    df = spark.createDataFrame([("img10",), ("img2",), ("IMG1",), ("img02b",)], "n string")
    got = [r[0] for r in df.orderBy(paging.natural_sort_key("n")).collect()]
    assert got == ["IMG1", "img2", "img02b", "img10"]


# ------------------------------------------------------------- profiling
def test_exact_percentiles_hot_value(spark):
    rnd = np.random.default_rng(2)
    vals = np.concatenate([np.full(3000, 5.0), rnd.normal(size=6000)])  # one value = a third of the rows
    df = spark.createDataFrame([(float(v),) for v in vals], "x double")
    got = profile.exact_percentiles(df, "x", [0.1, 0.25, 0.5, 0.9], buckets=16).first()
    assert np.allclose(list(got), np.quantile(vals, [0.1, 0.25, 0.5, 0.9]))


def test_sentiment_no_tweets_is_pos_q15(spark):
    scores = spark.createDataFrame([("A", 0.1, 0.8, 0.1)], "symbol string, neg double, neutral double, pos double")
    syms = spark.createDataFrame([("A",), ("B",)], "symbol string")
    got = {r["symbol"]: r["label"] for r in profile.sentiment_label(scores, syms).collect()}
    assert got == {"A": "neutral", "B": "pos"}


# -------------------------------------------------------------- changes
def test_updates_null_overwrites_d1(spark):
    base = spark.createDataFrame([(1, "a", 1.0), (2, "b", 2.0)], "id int, name string, v double")
    chg = spark.createDataFrame([(1, None), (9, 5.0)], "id int, v double")
    assert rows(changes.apply_updates(base, chg, "id", ["v"])) == [(1, "a", None), (2, "b", 2.0)]


def test_upsert_last_change_wins_d3(spark):
    base = spark.createDataFrame([(1, "a"), (2, "b")], "id int, name string")
    chg = spark.createDataFrame([(2, "x", 1), (2, "y", 2), (3, "z", 1)], "id int, name string, seq int")
    out = changes.apply_upserts(base, chg, "id", [F.col("seq")])
    assert rows(out) == [(1, "a"), (2, "y"), (3, "z")]


def test_unique_insert_rejects_d4(spark):
    base = spark.createDataFrame([("k1", "y1")], "key string, yt string")
    batch = spark.createDataFrame([("k1", "n1", 1), ("k2", "y1", 2), ("k3", "n3", 3), ("k3", "n4", 4)],
                                  "key string, yt string, o int")
    acc, rej = changes.unique_insert(base, batch, ["key", "yt"], [F.col("o")])
    assert rows(acc, "key", "yt") == [("k3", "n3")]
    assert rows(rej, "key", "reason") == [("k1", "key exists"), ("k2", "yt exists"), ("k3", "key repeated")]


def test_nested_chunks_one_rule_s10(spark):
    df = spark.createDataFrame([(7, i, i % 3) for i in range(50)] + [(8, 1, 1)], "address long, anchor_ms long, song_id long")
    out = store.nested_by_key(df, "address", ["song_id"], ["anchor_ms", "song_id"], chunks=5).collect()
    assert max(len(r["couples"]) for r in out) <= 20
    assert {r["chunk"] for r in out if r["address"] == 7} == set(range(5))
    assert sum(len(r["couples"]) for r in out if r["address"] == 7) == 50


def test_four_peak_key_ranges_ties_and_fuzz_f2(spark):
    # bin 40 alone is range 0; 41..80 range 1; ties go to the first bin
    rows = [(1, 0, k, 0.0) for k in range(30, 310)]
    loud = {40: 5.0, 77: 3.0, 78: 3.0, 95: 2.0, 121: 9.0, 150: 9.0, 299: 1.0}
    rows = [(s, f, k, loud.get(k, m)) for s, f, k, m in rows]
    df = spark.createDataFrame(rows, "song_id long, frame long, k long, mag double")
    key = audio.four_peak_key(df).collect()[0]["key"]
    # p = 40, 77 (tie with 78 -> first), 95, 121; fuzz 2 -> 40, 76, 94, 120
    assert key == 40 + 76 * 100 + 94 * 100_000 + 120 * 100_000_000


def test_heat_map_scales_to_global_max_a18(spark):
    df = spark.createDataFrame([(1, 0, 0, 2.0), (1, 0, 1, 4.0), (2, 3, 0, 1.0)],
                               "song_id long, frame long, k long, mag double")
    got = {(r.song_id, r.k): r.intensity for r in audio.heat_map(df).collect()}
    assert got == {(1, 0): 127, (1, 1): 255, (2, 0): 63}


def test_haar_hash_is_a_true_haar_pyramid_q23(spark):
    m = np.array(H.haar_basis(8))
    x = np.random.RandomState(7).randint(0, 256, 64).astype(float)
    c = m @ x
    assert c[0] == x.mean()  # DC term is the mean of the grid
    # the pyramid is invertible (each level keeps (a+b)/2 and (a-b)/2)
    assert np.allclose(np.linalg.solve(m, c), x)
    bits = c > c[1:].mean()
    want = int("".join("1" if b else "0" for b in bits), 2)
    want = want - (1 << 64) if want >= 1 << 63 else want
    df = spark.createDataFrame([([int(v) for v in x],)], "grid array<int>")
    assert df.select(H.haar_hash("grid", 8).alias("h")).first()["h"] == want


def test_song_fingerprints_equal_brute_force_x2(spark):
    # the rows-only chain query against a per-song Python/numpy re-computation
    # of every step on the whole sf0.001 events table
    import pandas as pd

    import __spark_entry__ as E
    from skein.plans import fingerprint as FP

    ev = pd.read_parquet("/root/testdata/sf0.001/events.parquet", columns=["event_id", "user_id", "ts", "value"])
    ev["ms"] = ev["ts"].astype("datetime64[us]").astype("int64") // 1000
    a = audio._alpha(FP.LP_CUTOFF, FP.LP_RATE)
    size, hop, nb, edges = FP.FR_SIZE, FP.FR_HOP, FP.FR_BINS, FP.SMALL_BANDS
    win = 0.54 - 0.46 * np.cos(2 * np.pi * np.arange(size) / (size - 1))
    want = set()
    for song, g in ev.sort_values(["user_id", "ms", "event_id"]).groupby("user_id"):
        x = g["value"].to_numpy(dtype=float)
        y, prev = np.empty(len(x)), 0.0
        for i, v in enumerate(x):  # low-pass recurrence
            prev = a * v + (1 - a) * prev
            y[i] = prev
        d = np.array([y[j:j + 2].mean() for j in range(0, len(y), 2)])  # downsample by 2
        n = len(d)
        nf = (n - 1) // hop + 1
        peaks = []
        for f in range(nf):
            buf = np.zeros(size)
            seg = d[f * hop:f * hop + size]
            buf[:len(seg)] = seg
            mag = np.abs(np.fft.fft(buf * win)[:nb])
            bands = []
            for b in range(len(edges) - 1):
                ks = range(edges[b], edges[b + 1])
                k = max(ks, key=lambda kk: (mag[kk], -kk))
                bands.append((b, 0.0, 0) if mag[k] <= 0 else (b, mag[k], k))
            avg = sum(m for _, m, _ in bands) / len(bands)
            for b, m, k in bands:
                if m > avg:
                    t = (f + k / size) * (n / (FP.LP_RATE / 2) / nf) * 1000
                    peaks.append((t, b, int(math.floor(t)), k))
        peaks.sort()
        anchors = {}
        for i, (a_t, _, a_ms, a_f) in enumerate(peaks):
            for dd in range(1, audio.TARGET_ZONE + 1):
                if i + dd < len(peaks):
                    b_t, _, _, b_f = peaks[i + dd]
                    delta = math.floor(b_t - a_t)  # of the exact times
                    addr = ((a_f << 23) | (b_f << 14) | (delta & 0xFFFFFFFF)) & 0xFFFFFFFF
                    anchors[addr] = a_ms  # written in (anchor, distance) order: the last one wins
        want |= {(addr, int(song), ms) for addr, ms in anchors.items()}
    got = set(rows(E.queries()["song_fingerprints"](spark, "/root/testdata/sf0.001"), "address", "song_id", "anchor_ms"))
    assert len(want) > 0
    assert got == want


def test_stft_peaks_equal_band_peaks_of_the_spectrum(spark):
    from skein.operators import audio

    rng = np.random.default_rng(5)
    rows = [(s, i, float(v)) for s, n in ((1, 137), (2, 20), (None, 40)) for i, v in enumerate(rng.standard_normal(n))] + [(3, i, 0.0) for i in range(30)]
    df = spark.createDataFrame(rows, "song_id long, i long, v double")
    for edges in ([0, 1, 2, 4, 8], [0, 3, 12]):
        slow = audio.band_peaks(audio.stft(df, 16, 4, 8, mode="full", frames_per_task=3), edges)
        fast = audio.stft_peaks(df, edges, 16, 4, 8, mode="full", frames_per_task=3)
        key = lambda r: (str(r.song_id), r.frame, r.band)
        a, b = sorted(slow.collect(), key=key), sorted(fast.collect(), key=key)
        assert [(*key(r), r.k, r.n_frames, r.n_samples) for r in a] == [(*key(r), r.k, r.n_frames, r.n_samples) for r in b]
        assert np.allclose([(r.mag, r.re) for r in a], [(r.mag, r.re) for r in b])
