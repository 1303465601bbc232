"""Op 11: places by plain string code, notices by planted texts."""

import re

from skein.llm import licenses
from skein.llm.queries import LICENSE_PHRASES, QUERIES


def words(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", lower)


def places(text):
    w = words(text)
    return [(i, label) for phrase, label in LICENSE_PHRASES for i in range(len(w)) if w[i:i + len(words(phrase))] == words(phrase)]


def expected(text):
    at = places(text)
    starts = [i for i, _ in at]
    return (len(words(text)), len(at), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in at})))


def report(spark, texts, **more):
    df = spark.createDataFrame([(i, t, "clash", 1) for i, t in enumerate(texts)], "doc_id long, text string, words string, hits int").repartition(3)
    return {r.doc_id: r for r in licenses.license_report(df, LICENSE_PHRASES, **more).collect()}


MIT = next(t for t in licenses.NOTICES if t.label == "mit")
FILLER = "plain words of a story that goes on and on without any notice of that kind "
TEXTS = [
    None, "", " .,;\x00\x7f", "Released under the MIT License.", "under the mit\x00license", "under the mitİlicense", "under_the-mit/license!",
    "UNDER THE MIT LICENSE under the MIT license", "under the Kmit license", "Apache License, Version 2.0 and CC BY-NC 4.0, under the MIT License",
    "cc by nc cc by nc", "apache license version 3", "the apache license version 2", "xunder the mit license", "under the mit licensex", "éunder the mit license ß",
    "cc-by-nc", "cc  by\tnc", "cc by", "under the mit", FILLER * 3000 + "under the mit license " + FILLER * 3000 + " cc by nc",
    "under the mit license " * 3000, "ccé by nc", "cc by nc", "2 version license apache",
]


def test_places(spark):
    got = report(spark, TEXTS)
    assert len(got) == len(TEXTS)
    for i, t in enumerate(TEXTS):
        r = got[i]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == expected(t), (i, (t or "")[:60])
        assert set(filter(None, r.base_labels.split(","))) <= set(filter(None, r.labels.split(",")))
        assert (r.score == 1.0) if r.n_base else (0 <= r.score <= 1)


def test_notices_whole_moved_and_broken(spark):
    notice = MIT.text
    ws = notice.split()
    gapped = " ".join(ws[:20] + ["by", "Ann", "Example"] + ws[20:])
    texts = [n.text for n in licenses.NOTICES]
    n = len(texts)
    texts += [FILLER * 200 + notice + FILLER * 200, gapped, notice.upper(), " ".join(reversed(ws)), " ".join(ws[:6]), FILLER * 50, notice.replace("without restriction", "with restriction"),
              (FILLER + notice) * 40, notice[:60] + FILLER * 30 + notice[60:], "license software copyright permission public version 2 3", notice.replace(" ", "\n// ")]
    got = report(spark, texts)
    for i, t in enumerate(licenses.NOTICES):
        assert t.label in got[i].labels.split(","), t.label
        assert got[i].score > 0.999
        assert {x for x in got[i].labels.split(",")} <= {t.label, *expected(texts[i])[4].split(",")}, (t.label, got[i].labels)
    has = [("mit" in got[n + j].labels.split(",")) for j in range(len(texts) - n)]
    assert has == [True, True, True, False, False, False, False, True, False, False, True]
    assert got[n + 5].labels == "" and got[n + 5].score == 0.0


def test_document_frequencies_and_anchors(spark):
    df = spark.createDataFrame([("the MIT the license",), ("License K the",), (None,), ("",)], "text string").select(licenses.words_column(licenses.F.col("text")).alias("words"))
    assert licenses.document_frequencies(df, ["the", "mit", "license", "k", "gone"]) == (4, {"the": 2, "mit": 1, "license": 2})
    index = licenses.build_index(100, {"under": 90, "the": 99, "mit": 2, "license": 50}, (), (("under the mit license", "mit"),))
    assert index.phrases == ((("under", "the", "mit", "license"), "mit", 2),)


def test_empty_table_repeated_rows_and_no_templates(spark):
    df = spark.createDataFrame([(1, "under the mit license")] * 3 + [(None, "cc by nc")], "doc_id long, text string")
    got = licenses.license_report(df, LICENSE_PHRASES, notices=()).collect()
    assert sorted((r.doc_id or 0, r.labels) for r in got) == [(0, "cc-by-nc")] + [(1, "mit")] * 3
    assert licenses.license_report(df.limit(0), LICENSE_PHRASES).collect() == []
    none = licenses.license_report(df, ()).collect()
    assert len(none) == 4 and all(r.n_base == 0 and r.base_labels == "" for r in none)


def test_no_python_in_the_plan(spark, sf_dir):
    plan = QUERIES["op11_licenses"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


def test_query_on_whole_table(spark, sf_dir):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    got = QUERIES["op11_licenses"](spark, sf_dir).collect()
    assert len(got) == len(texts)
    for r in got:
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == expected(texts[r.doc_id])
        assert ("gpl-3" in r.labels) == ("gnu general public license version 3" in " ".join(words(texts[r.doc_id])))
