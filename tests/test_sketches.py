"""Profiles merged from stored sketches: exact counts, bounded errors, old rows not read again."""

import random

from pyspark.sql import functions as F

from skein.operators import sketches

RANKS = [0.05, 0.5, 0.9]


def test_merged_equals_whole_within_bounds(spark, tmp_path):
    rng = random.Random(3)
    rows = [(rng.gauss(0, 10), rng.randrange(3000) if rng.random() < 0.9 else None, float("nan") if rng.random() < 0.01 else 1.5) for _ in range(40_000)]
    df = spark.createDataFrame(rows, "a double, b int, c double").withColumn("batch", F.monotonically_increasing_id() % 6).cache()
    path = str(tmp_path / "p")
    for batch in range(6):
        sketches.store_profile(df.filter(F.col("batch") == batch), ["a", "b", "c"], path, str(batch))
    sketches.store_profile(df.filter("batch = 2"), ["a", "b", "c"], path, "2")  # again: it replaces itself
    merged = sketches.merged_profile(sketches.stored_profiles(spark, path), RANKS)
    got = {r.column: r for r in merged.collect()}
    numbers = {"a": [r[0] for r in rows], "b": [r[1] for r in rows if r[1] is not None], "c": [1.5 for r in rows if r[2] == 1.5]}
    for c, values in numbers.items():
        r = got[c]
        assert r.rows == len(rows) and r.nulls == (len(rows) - len(values) if c == "b" else 0)
        assert (r.low, r.high) == (min(values), max(values)) and abs(r.mean - sum(values) / len(values)) < 1e-9
    assert got["c"].quantiles == [1.5] * 3
    for r in sketches.rank_errors(df, merged, ["a", "b"], RANKS).collect():
        assert r.distinct_error <= sketches.COUNT_ERROR and r.rank_error <= sketches.RANK_ERROR
    df.unpersist()


def test_an_append_reads_the_new_rows_only(spark, tmp_path):
    path = str(tmp_path / "p")
    for day in ("1", "2"):
        folder = str(tmp_path / f"day{day}")
        spark.range(int(day) * 100).selectExpr("id as x").write.parquet(folder)
        sketches.store_profile(spark.read.parquet(folder), ["x"], path, day)
    profiles = sketches.stored_profiles(spark, path)
    assert all("day" not in f for f in sketches.merged_profile(profiles, RANKS).inputFiles())
    r = sketches.merged_profile(profiles, RANKS).first()
    assert (r.rows, r.low, r.high) == (300, 0.0, 199.0) and abs(r.distinct - 200) <= 200 * sketches.COUNT_ERROR + 1


def test_empty_and_null_columns(spark, tmp_path):
    path = str(tmp_path / "p")
    sketches.store_profile(spark.createDataFrame([], "x double, y double"), ["x", "y"], path, "none")
    sketches.store_profile(spark.createDataFrame([(1.0, None), (2.0, None)], "x double, y double"), ["x", "y"], path, "some")
    got = {r.column: r for r in sketches.merged_profile(sketches.stored_profiles(spark, path), [0.0, 1.0]).collect()}
    assert got["x"].quantiles == [1.0, 2.0] and got["x"].distinct == 2
    assert (got["y"].rows, got["y"].nulls, got["y"].quantiles, got["y"].distinct, got["y"].mean) == (2, 2, None, 0, None)


def test_merging_by_key(spark):
    a = sketches.batch_profile(spark.createDataFrame([(1.0,), (3.0,)], "x double"), ["x"]).withColumn("day", F.lit(1))
    b = sketches.batch_profile(spark.createDataFrame([(5.0,)], "x double"), ["x"]).withColumn("day", F.lit(2))
    got = {(r.day, r.rows, r.mean) for r in sketches.merged_profile(a.unionByName(b), [0.5], ["day"]).collect()}
    assert got == {(1, 2, 2.0), (2, 1, 5.0)}
