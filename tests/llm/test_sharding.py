"""Op 7: the law, movement, balance, weights and slots."""

import zlib
from collections import Counter

from pyspark.sql import functions as F

from skein.llm import sharding
from skein.llm.queries import QUERIES


def test_movement_and_balance(spark):
    keys = spark.range(60_000).withColumnRenamed("id", "k")
    old, new = [1.0] * 16, [1.0] * 17
    rows = keys.select(sharding.rendezvous(F.col("k"), old).alias("a"), sharding.rendezvous(F.col("k"), new).alias("b")).collect()
    assert all(r.b in (r.a, 16) for r in rows)
    moved = sum(r.b == 16 for r in rows)
    assert abs(moved - 60_000 / 17) < 400
    assert max(abs(n - 3750) for n in Counter(r.a for r in rows).values()) < 350


def test_weights(spark):
    n = Counter(r.s for r in spark.range(40_000).select(sharding.rendezvous(F.col("id"), [1, 3, 4]).alias("s")).collect())
    assert abs(n[0] - 5000) < 400 and abs(n[1] - 15000) < 600 and abs(n[2] - 20000) < 600


def test_slots_and_defined_cases(spark):
    rows = [(1, "a"), (1, "a"), (1, None), (None, "é"), (None, ""), (2, "x" * 70_000)] + [(5, "hot")] * 500
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("shard", F.lit("clash")).repartition(7)
    got = sharding.shard_documents(df, [1.0] * 4, [1.0] * 5).collect()
    by = {}
    for r in got:
        by.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in by.values()) and len(got) == len(rows)
    assert len({r.shard for r in got if r.doc_id == 1}) == 1 == len({r.shard for r in got if r.doc_id is None})
    assert {(r.size, r.text_crc32) for r in got if r.doc_id is None} == {(3, zlib.crc32("é".encode())), (1, 0)}
    assert sharding.shard_documents(df.limit(0), [1.0], [1.0, 1.0]).count() == 0


def test_query_on_whole_table(spark, sf_dir):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    got = QUERIES["op7_sharding"](spark, sf_dir).collect()
    assert sorted(r.doc_id for r in got) == sorted(texts)
    for r in got:
        raw = texts[r.doc_id].encode()
        assert (r.size, r.text_crc32, r.law) == (len(raw) + 1, zlib.crc32(raw), "key")
        assert 0 <= r.shard < 16 and r.grown_shard in (r.shard, 16)
    for s in range(16):
        assert sorted(r.slot for r in got if r.shard == s) == list(range(sum(r.shard == s for r in got)))
