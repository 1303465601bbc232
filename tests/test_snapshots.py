"""D1-D3 on hash-partitioned snapshots: what changes, what stays, what is read."""

import os
import random

import pytest
from pyspark.sql import functions as F

from skein.sources import snapshots

SCHEMA = "id long, name string, n double"


def files_of(path):
    """{bucket: names and times of its files}"""
    out = {}
    for folder in os.listdir(path):
        if folder.startswith(snapshots.BUCKET):
            at = os.path.join(path, folder)
            out[int(folder.split("=")[1])] = sorted((f, os.stat(os.path.join(at, f)).st_mtime_ns) for f in os.listdir(at) if f.endswith(".parquet"))
    return out


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture()
def people(spark, tmp_path):
    base = [(i, f"name {i}", i / 2) for i in range(500)] + [(None, "nobody", 1.0), (None, "nobody", 1.0)]
    path = str(tmp_path / "people")
    snapshots.create_snapshot(spark.createDataFrame(base, SCHEMA).repartition(3), path, "id", 32)
    return path, base


def test_untouched_buckets_keep_their_files(spark, people):
    path, base = people
    before = files_of(path)
    batch = spark.createDataFrame([(7, "seven", None), (9, "nine", 4.5), (10_000, "absent", 1.0)], SCHEMA)
    touched = snapshots.update_snapshot(spark, path, batch, ["name", "n"])
    after = files_of(path)
    assert 0 < len(touched) <= 3
    assert {b for b in after if after[b] != before.get(b)} == set(touched)
    want = [(7, "seven", None) if r[0] == 7 else (9, "nine", 4.5) if r[0] == 9 else r for r in base]
    assert rows_of(snapshots.read_snapshot(spark, path)) == sorted(want, key=repr)


def test_only_touched_partitions_are_read(spark, people):
    path, _ = people
    df = snapshots.read_snapshot(spark, path, [3, 5])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and snapshots.BUCKET in plan.split("PartitionFilters")[1].split("]")[0]
    assert {f.split(snapshots.BUCKET + "=")[1].split("/")[0] for f in df.inputFiles()} <= {str(i) for i in range(32)}
    read = df.select(F.input_file_name().alias("f")).distinct().collect()
    assert {r.f.split(snapshots.BUCKET + "=")[1].split("/")[0] for r in read} == {"3", "5"}


def test_emptied_buckets_stay_empty_and_fill_again(spark, people):
    path, base = people
    everyone = spark.createDataFrame([(r[0],) for r in base], "id long")
    snapshots.delete_from_snapshot(spark, path, everyone)
    assert rows_of(snapshots.read_snapshot(spark, path)) == [r for r in base if r[0] is None]  # no change finds a null key
    snapshots.upsert_snapshot(spark, path, spark.createDataFrame([(7, "back", 1.0), (None, "no key", 2.0)], SCHEMA))
    assert rows_of(snapshots.read_snapshot(spark, path)) == sorted([(7, "back", 1.0)] + [r for r in base if r[0] is None], key=repr)


def test_empty_batch_empty_table_and_wrong_key(spark, people, tmp_path):
    path, base = people
    before = files_of(path)
    assert snapshots.update_snapshot(spark, path, spark.createDataFrame([], SCHEMA), ["n"]) == []
    assert files_of(path) == before
    with pytest.raises(ValueError):
        snapshots.delete_from_snapshot(spark, path, spark.createDataFrame([(1,)], "other long"))
    none = str(tmp_path / "none")
    snapshots.create_snapshot(spark.createDataFrame([], SCHEMA), none, "id", 4)
    assert snapshots.read_snapshot(spark, none).collect() == []
    snapshots.delete_from_snapshot(spark, none, spark.createDataFrame([(1,)], "id long"))
    snapshots.upsert_snapshot(spark, none, spark.createDataFrame([(1, "one", 1.0)], SCHEMA))
    assert rows_of(snapshots.read_snapshot(spark, none)) == [(1, "one", 1.0)]


def test_applying_a_batch_again_changes_nothing(spark, people):
    path, _ = people
    batch = spark.createDataFrame([(i, f"new {i}", float(i)) for i in range(490, 510)], SCHEMA)
    snapshots.upsert_snapshot(spark, path, batch)
    once = rows_of(snapshots.read_snapshot(spark, path))
    snapshots.upsert_snapshot(spark, path, batch)
    assert rows_of(snapshots.read_snapshot(spark, path)) == once and len(once) == 512


def test_random_changes_equal_a_dict(spark, tmp_path):
    rng = random.Random(11)
    state = {i: (i, f"n{i}", float(i)) for i in range(60)}
    path = str(tmp_path / "t")
    snapshots.create_snapshot(spark.createDataFrame(list(state.values()), SCHEMA), path, "id", 8, files=2)
    for _ in range(4):
        ids = [rng.randrange(80) for _ in range(12)]
        batch = [(i, f"c{rng.randrange(9)}", float(k)) for k, i in enumerate(ids)]
        kind = rng.choice(["update", "delete", "upsert"])
        df = spark.createDataFrame(batch, SCHEMA)
        if kind == "update":
            snapshots.update_snapshot(spark, path, df, ["name", "n"], [F.col("n")])
            state.update({r[0]: r for r in batch if r[0] in state})
        elif kind == "upsert":
            snapshots.upsert_snapshot(spark, path, df, [F.col("n")])
            state.update({r[0]: r for r in batch})
        else:
            snapshots.delete_from_snapshot(spark, path, df)
            state = {k: v for k, v in state.items() if k not in set(ids)}
        assert rows_of(snapshots.read_snapshot(spark, path)) == sorted(state.values(), key=repr)
