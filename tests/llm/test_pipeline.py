"""The stages one by one and together, against brute force on a small corpus."""

import random
import re
from collections import Counter

import pytest

import corpus_pipeline as C
from skein.llm.queries import QUERIES
from tests.llm.test_decontaminate import brute as overlaps
from tests.llm.test_ngram_jaccard import brute as components

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", None if t is None else len(t)) for i, t in rows], DOCUMENTS).repartition(3)


def back(df):
    return sorted(((r.doc_id, r.text, r.n_chars) for r in df.collect()), key=repr)


def test_names_and_order():
    assert [n for n, _ in C.STAGES] == ["quality", "near_duplicates", "repeats", "decontamination", "tokens"]
    assert C.ORACLE_SQL is None


def test_near_duplicates_keep_one_of_each_group(spark):
    rng = random.Random(3)
    base = [str(rng.randrange(1000)) for _ in range(80)]
    rows = [(i, " ".join(base[:i % 7] + ["x"] + base)) for i in range(20)] + [(50 + i, f"alone {i} " * 9) for i in range(10)]
    rows += [(70, None), (71, ""), (71, ""), (None, "no id, but text enough here"), (90, "same row twice over again"), (90, "same row twice over again")]
    got = C.near_duplicate_stage(spark, frame(spark, rows), "")
    assert got.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    heads = {c for d, n, c in components(rows) if n}
    ids = Counter(r.doc_id for r in got.collect())
    assert ids == Counter([h for h in heads] + [70, 71, 71])


def test_repeats_go_and_the_rest_stays(spark):
    rng = random.Random(5)
    letters = lambda n: "".join(rng.choice("abcdefé ") for _ in range(n))
    shared = letters(500)
    rows = [(1, letters(100) + shared + "end"), (2, "start" + shared), (3, letters(700)), (4, None), (5, ""), (6, shared), (7, "short")]
    got = {r.doc_id: r for r in C.repeat_stage(spark, frame(spark, rows), "").collect()}
    assert set(got) == {1, 2, 3, 4, 5, 7}
    assert (got[1].text, got[1].n_chars) == (rows[0][1][:100] + "end", 103) and got[2].text == "start"
    assert [got[k].text for k in (3, 4, 5, 7)] == [rows[2][1], None, "", "short"]


def test_a_passage_of_51_words_goes(spark):
    rng = random.Random(8)
    words = lambda n: " ".join("".join(rng.choice("abcdefghilmnoprstu") for _ in range(rng.randrange(2, 9))) for _ in range(n))
    passage = words(51)
    rows = [(1, words(120) + " " + passage + " " + words(80)), (2, words(60) + " " + passage + " " + words(150)), (3, words(300)), (4, words(40))]
    got = {r.doc_id: r.text for r in C.repeat_stage(spark, frame(spark, rows), "").collect()}
    assert len(passage) > C.REPEAT_BYTES
    assert passage not in got[1] and passage not in got[2] and len(got[1]) <= len(rows[0][1]) - len(passage)
    assert got[3] == rows[2][1] and got[4] == rows[3][1]


def test_a_cut_character_goes(spark):
    a, b = "é" * 250, "é" * 250
    rows = [(1, "1" + a + "ĩ tail"), (2, "2" + b + "é other")]  # both start with byte c3/c4 after the run
    for r in C.repeat_stage(spark, frame(spark, rows), "").collect():
        assert "�" not in r.text and r.n_chars == len(r.text)


@pytest.fixture(scope="module")
def written(spark, tmp_path_factory):
    """A small corpus with planted cases, as a folder of tables."""
    folder = str(tmp_path_factory.mktemp("corpus"))
    src = "/root/testdata/sf0.01"
    for t in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{src}/{t}.parquet").write.parquet(f"{folder}/{t}.parquet")
    return folder


def test_whole_pipeline(spark, written):
    docs = spark.read.parquet(f"{written}/documents.parquet")
    columns, first = docs.columns, {r.doc_id for r in docs.collect()}
    stages = {}
    for name, stage in C.STAGES[:-1]:
        path = f"{written}/out-{name}"
        stage(spark, docs, written).write.parquet(path)
        docs = spark.read.parquet(path)
        assert docs.columns == columns
        stages[name] = {r.doc_id: r.text for r in docs.collect()}
    q = stages["quality"]
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{written}/labels.parquet").collect()}
    known = [d for d in first if d in labels]
    assert sum((d in q) == bool(labels[d]) for d in known) / len(known) > 0.98
    assert set(stages["near_duplicates"]) == {c for _, _, c in components(list(q.items()))}
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{written}/benchmark.parquet").collect()]
    before = list(stages["repeats"].items())
    assert set(stages["decontamination"]) == {d for d, _ in before} - {d for d, *_ in overlaps(before, items)}
    got = {r.doc_id: r for r in QUERIES["pipeline"](spark, written).collect()}
    assert got.keys() == stages["decontamination"].keys()
    assert all(r.n_tokens == len(r.ids) for r in got.values())


def test_empty_documents(spark, written, tmp_path):
    docs = spark.createDataFrame([], DOCUMENTS)
    for name, stage in C.STAGES:
        assert stage(spark, docs, written).count() == 0, name


def test_words_of_the_stage_match_the_contract():
    assert re.findall("[^\x20\x09-\x0d]+", "a\x0bb c d") == ["a", "b c", "d"]
