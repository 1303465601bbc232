"""Op 10: held-out accuracy, calibration, and defined cases."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from skein.llm import quality
from skein.llm.queries import QUERIES


def test_held_out_accuracy_and_calibration(spark):
    folder = "/root/testdata/sf0.1"
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    got = QUERIES["op10_quality"](spark, folder).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    held = [(r.score, labels[r.doc_id]) for r in got if r.held_out and r.doc_id in labels]
    assert np.mean([(s >= 0.5) == (y == 1) for s, y in held]) > 0.98
    p = np.clip([s for s, _ in held], 1e-6, 1 - 1e-6)
    y = np.array([y for _, y in held])
    assert -np.mean(y * np.log(p) + (1 - y) * np.log(1 - p)) < 0.08


def test_scores_do_not_depend_on_ids_or_held_out_labels(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    flipped = labels.withColumn("quality", F.when(quality.held_out(), 1 - F.col("quality")).otherwise(F.col("quality")))
    score = lambda ls: {r.doc_id: r.score for r in quality.classify(docs, ls).collect()}
    a, b = score(labels), score(flipped)
    assert all(abs(a[k] - b[k]) < 1e-9 for k in a)


def test_context_table_is_a_sum_over_all_documents(spark):
    docs = spark.createDataFrame([("alpha beta alpha",), ("beta gamma",), (None,), ("",)], "text string")
    one, many = quality.context_table(docs.coalesce(1)), quality.context_table(docs.repartition(4))
    assert np.allclose(one, many) and np.allclose(np.sort(np.sqrt((one * one).sum(1)))[-3:], 1)
    data = np.frombuffer(b"alpha beta alphabeta gamma", np.uint8)
    word, row, _, _ = quality.tokens(data, np.array([0, 16, 26]))
    assert row.tolist() == [0, 0, 0, 1, 1] and word[0] == word[2] and word[1] == word[3]
    want = 2 * quality.index_table()[word[0]] + quality.index_table()[word[4]]
    assert np.allclose(one[word[1]], want / np.sqrt((want * want).sum()), atol=1e-6)


@pytest.mark.parametrize("rows, value", [([], 0.5), ([(1, 1), (2, 1)], 0.75), ([(1, 0)], 1 / 3), ([(1, None), (None, 1)], 0.5)])
def test_too_few_labels(spark, rows, value):
    docs = spark.createDataFrame([(1, "a b"), (2, None), (2, None), (None, "c")], "doc_id long, text string").withColumn("y", F.lit("clash"))
    got = quality.classify(docs, spark.createDataFrame(rows, "doc_id long, quality int"))
    assert got.columns == ["doc_id", "text", "y", "score"]
    usable = {i for i, y in rows if i is not None and y is not None and zlib.crc32(str(i).encode()) % 3 != 1}
    ones = sum(y for i, y in rows if i in usable)
    want = (ones + 1) / (len(usable) + 2) if usable else 0.5
    assert [round(r.score, 9) for r in got.collect()] == [round(want, 9)] * 4


def test_empty_long_and_repeated(spark):
    good, bad = "plain words stand here. ", "*** !!! ### "
    docs = [(i, (good if i % 2 else bad) * (1 + i % 9)) for i in range(120)] + [(500, ""), (501, None), (502, good * 20_000), (502, good * 20_000)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(120)] + [(3, 1), (3, 1)], "doc_id long, quality int")
    got = [(r.doc_id, r.score) for r in quality.classify(df, labels).collect()]
    score = dict(got)
    assert all((score[i] >= 0.5) == bool(i % 2) for i in range(120))
    assert score[500] == score[501] and score[502] > 0.5 and len(got) == len(docs)
    assert quality.classify(df.limit(0), labels).count() == 0


def test_repeated_labelled_rows_count_once(spark):
    """A third of all rows may be copies of one labelled document: they are one row of the sample."""
    rows = [(1, "good words stand here")] * 300 + [(2, "bad bad bad"), (4, "more good words"), (5, "bad again")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    labels = spark.createDataFrame([(1, 1), (2, 0), (4, 1), (5, 0)], "doc_id long, quality int")
    seen = []
    real = quality.features
    quality.features = lambda df, context: seen.append(df.count()) or real(df, context)
    try:
        quality.train(docs, labels, quality.F.lit(True), quality.context_table(docs))
    finally:
        quality.features = real
    assert seen == [4]
