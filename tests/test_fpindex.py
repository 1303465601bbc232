"""The stored fingerprint index: unique rows, no shuffle of the index, reopened and compacted tables."""

import re
import uuid

import pytest

from skein.sources import fpindex

SCHEMA = "address long, song_id long, anchor_ms long"


@pytest.fixture()
def index(spark, tmp_path):
    name, path = f"idx_{uuid.uuid4().hex}", str(tmp_path / "idx")
    fpindex.create_index(spark, name, path, 8)
    yield name, path
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def rows(spark, name):
    return sorted(tuple(r) for r in spark.table(name).collect())


FIRST = [(a, s, a * 10 + s) for a in range(50) for s in range(3)]
SECOND = FIRST[40:90] + [(a, 7, 5) for a in range(30, 70)] * 2 + [(None, 1, 1)]


def test_batches_keep_rows_unique(spark, index):
    name, _ = index
    fpindex.append_to_index(spark, name, spark.createDataFrame(FIRST, SCHEMA))
    fpindex.append_to_index(spark, name, spark.createDataFrame(SECOND, SCHEMA).repartition(5))
    fpindex.append_to_index(spark, name, spark.createDataFrame(SECOND, SCHEMA))
    assert rows(spark, name) == sorted(set(FIRST) | {r for r in SECOND if r[0] is not None})


def test_the_index_side_is_not_shuffled(spark, index):
    name, _ = index
    fpindex.append_to_index(spark, name, spark.createDataFrame(FIRST, SCHEMA))
    fpindex.append_to_index(spark, name, spark.createDataFrame(SECOND, SCHEMA))
    clips = spark.range(2000).selectExpr("id as request_id", "id % 60 as address", "id as s_ms")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = fpindex.probe_index(clips, spark.table(name))._jdf.queryExecution().executedPlan().toString()
        anti = re.sub(r"\s+", " ", plan)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert anti.count("Exchange") == 1 and "Bucketed: true" in anti
    # the one Exchange stands on the clips' side
    assert "Range" in anti.split("Exchange")[1].split("FileScan")[0] or "Range" in anti.split("Exchange")[1]
    assert anti.index("FileScan") < anti.index("Exchange") or "FileScan" not in anti.split("Exchange")[1].split("Range")[0]


def test_every_match_is_found(spark, index):
    name, _ = index
    fpindex.append_to_index(spark, name, spark.createDataFrame(FIRST, SCHEMA))
    clips = spark.createDataFrame([(1, 5, 100), (2, 5, 200), (2, 999, 1), (3, None, 1)], "request_id long, address long, s_ms long")
    got = {(r.request_id, r.song_id, r.address, r.s_ms, r.d_ms) for r in fpindex.probe_index(clips, spark.table(name)).collect()}
    assert got == {(q, s, 5, ms, 50 + s) for q, ms in ((1, 100), (2, 200)) for s in range(3)}


def test_reopened_and_compacted(spark, index, tmp_path):
    name, path = index
    fpindex.append_to_index(spark, name, spark.createDataFrame(FIRST, SCHEMA))
    fpindex.append_to_index(spark, name, spark.createDataFrame(SECOND, SCHEMA))
    want = rows(spark, name)
    spark.sql(f"DROP TABLE {name}")  # the folder stays
    fpindex.open_index(spark, name, path, 8)
    assert rows(spark, name) == want and fpindex.buckets_of(spark, name) == 8
    before = len(spark.table(name).inputFiles())
    fpindex.compact_index(spark, name, str(tmp_path / "compact"))
    assert rows(spark, name) == want and fpindex.buckets_of(spark, name) == 8
    assert len(spark.table(name).inputFiles()) <= 8 < before
    with pytest.raises(ValueError):
        fpindex.create_index(spark, f"{name}_again", path, 8)
    spark.sql(f"DROP TABLE IF EXISTS {name}_again")
