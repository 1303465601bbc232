"""Defaults and variants that no query exercises."""

import numpy as np
from pyspark.sql import functions as F

from skein.operators import audio, imaging, paging, profile, shape, validate
from skein.sources import files


def test_link_kinds_by_default(spark):
    twenty_two, si, album_si = "a1B2" * 5 + "xy", "0123456789abcdef", "A_-b" * 5 + "cd"
    urls = {f"https://music.example/track/{twenty_two}?si={si}": "track", f"https://music.example/playlist/{twenty_two}?si={si}": "playlist",
            f"https://music.example/album/{twenty_two}?si={album_si}": "album", f"https://music.example/album/{twenty_two}?si={si}": None,
            f"https://music.example/track/{twenty_two}": None, f"https://other.example/track/{twenty_two}?si={si}": None}
    df = spark.createDataFrame([(u,) for u in urls], "u string")
    got = df.select("u", shape.url_kind("u", r"^https://music\.example").alias("k")).collect()
    assert {r.u: r.k for r in got} == urls


def test_valid_and_rejected_rows_are_split(spark):
    df = spark.createDataFrame([("x", 3), ("", 3), ("y", -1), (None, None)], "name string, n int")
    ok, bad = validate.split_valid(df, [validate.Rule("name", "nonempty"), validate.Rule("n", "min", 0)])
    assert [r.name for r in ok.collect()] == ["x"] and bad.count() == 3


def test_peaks_keyed_by_the_real_part(spark):
    bands = [(1, 0, b, 1, 16, m, k, re) for b, (m, k, re) in enumerate([(9.0, 2, -7.9), (1.0, 5, 3.0), (1.0, 6, 1.0)])]
    df = spark.createDataFrame(bands, "song_id long, frame long, band int, n_frames long, n_samples long, mag double, k long, re double")
    assert [r.freq for r in audio.extract_peaks(df, 1000.0, 16, freq="real").collect()] == [-7]
    assert [r.freq for r in audio.extract_peaks(df, 1000.0, 16).collect()] == [2]


def test_snapshot_folders_are_fresh():
    assert files.new_snapshot_path("s3://b/t/").startswith("s3://b/t/snap-")
    assert files.new_snapshot_path("x") != files.new_snapshot_path("x")


def test_pages_by_key_walk_the_whole_order(spark):
    rows = [(i, None if i % 5 == 0 else "abc"[i % 3], float(i % 4)) for i in range(60)]
    df = spark.createDataFrame(rows, "id int, name string, v double")
    order = [("name", True), ("v", False), ("id", False)]
    want = [r.id for r in df.orderBy(F.col("name").desc_nulls_last(), "v", "id").collect()]
    first = df.orderBy(F.col("name").desc_nulls_last(), "v", "id").first()
    seen, last = [first.id], [first.name, first.v, first.id]
    while page := paging.page_after(df, order, last, 7).collect():
        seen += [r.id for r in page]
        last = [page[-1].name, page[-1].v, page[-1].id]
    assert seen == want


def test_latency_of_a_window_without_values(spark):
    df = spark.createDataFrame([("2024-01-01 00:00:01", 2.0), ("2024-01-01 00:00:02", 4.0), ("2024-01-02 00:00:00", None)], "t string, v double")
    got = profile.rate_latency(df.withColumn("t", F.col("t").cast("timestamp")), "t", "v", "1 day", (0.5,)).orderBy("window_start").collect()
    assert [(r.requests, r.p50, r.max_latency) for r in got] == [(2, 3.0, 4.0), (1, None, None)]


def test_segments_with_a_hash_of_choice_scaled_and_smoothed(spark):
    grid = np.zeros((16, 16), int)
    grid[2:8, 3:9] = 200  # a bright block
    grid[12, 12] = 255  # a speck
    df = spark.createDataFrame([(1, grid.ravel().tolist())], "img long, grid array<int>")
    find = lambda **more: {(r.min_x, r.min_y, r.max_x, r.max_y, r.h) for r in imaging.crop_segments(
        df, 16, 16, 100, 0, hash_func=lambda box: int(box.max()), **more).collect()}
    assert (3, 2, 9, 8, 200) in find() and (12, 12, 13, 13, 255) in find()
    assert (6, 6, 18, 24, 200) in find(scale=(2.0, 3.0))
    assert not any(h == 255 and x > 9 for x, _, _, _, h in find(smooth=True))
    assert np.allclose(imaging.smoothed(np.full((5, 5), 7.0)), 7.0)
