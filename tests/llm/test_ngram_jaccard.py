"""Op 1 against brute force over all pairs of documents."""

import random
import re

import numpy as np
import pytest

from skein.llm import ngram_jaccard
from skein.llm.queries import QUERIES


def brute(rows, words=5, percent=80):
    """{id: (n, component)} by comparing all pairs that share a shingle."""
    sets, by = [], {}
    for i, (_, text) in enumerate(rows):
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        w = re.findall("[^\x20\x09-\x0d]+", low)
        s = {tuple(w[k:k + words]) for k in range(max(len(w) - words + 1, 1))} if w else set()
        sets.append(s)
        for x in s:
            by.setdefault(x, []).append(i)
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for i, s in enumerate(sets):
        near = {j for x in s for j in by[x] if j > i}
        for j in near:
            both = len(s & sets[j])
            if 100 * both >= percent * (len(s) + len(sets[j]) - both):
                parent[find(j)] = find(i)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return sorted(((d, len(sets[i]), least.get(find(i)) if sets[i] else d) for i, (d, _) in enumerate(rows)), key=repr)


def run(spark, rows, extra=""):
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumnRenamed("x", "x")
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in ngram_jaccard.jaccard_components(df).collect()), key=repr)


def variants(rng, base, n, edits):
    out = []
    for _ in range(n):
        w = list(base)
        for _ in range(rng.randrange(edits + 1)):
            w[rng.randrange(len(w))] = rng.choice("abcdefgh") + str(rng.randrange(99))
        out.append(" ".join(w))
    return out


def test_planted_groups(spark):
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefghijkl") for _ in range(rng.randrange(1, 7)))
    passage = " ".join(word() for _ in range(60))
    texts = []
    for size, n, edits in ((60, 40, 4), (200, 60, 9), (9, 30, 1), (5, 10, 1), (30, 300, 2)):
        texts += variants(rng, [word() for _ in range(size)], n, edits)
    texts += [passage + " " + " ".join(word() for _ in range(rng.randrange(1, 60))) for _ in range(120)]
    texts += ["", None, " \t\n", "One two", "one TWO", "one two three four five", "x", "É é", "é É", "a\x0bb c\x0cd e", "a b c d e"]
    texts += [" ".join(word() for _ in range(20_000))] * 2
    rows = [(i, t) for i, t in enumerate(texts)]
    rng.shuffle(rows)
    assert run(spark, rows) == brute(rows)


def test_defined_cases(spark):
    same = "a b c d e f g h"
    rows = [(7, same), (7, same), (None, same), (3, "A B c d e f g h"), (None, None), (4, ""), (None, "solo text"), (9, "z " * 50)]
    assert run(spark, rows) == brute(rows)
    assert run(spark, []) == []


def test_columns_beside_are_not_read(spark):
    df = spark.createDataFrame([(1, "a b c", 5, "k"), (2, "a b c", 6, "k")], "doc_id long, text string, n long, a string")
    got = {tuple(r) for r in ngram_jaccard.jaccard_components(df).collect()}
    assert got == {(1, 1, 1), (2, 1, 1)}


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_query_on_whole_table(spark, folder):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in QUERIES["op1_ngram_jaccard"](spark, folder).collect()), key=repr)
    assert got == brute(rows)


def test_order_of_shingles_does_not_matter(spark, monkeypatch):
    """The count table orders only: with every bucket common the links are the same."""
    rng = random.Random(8)
    rows = [(i, t) for i, t in enumerate(variants(rng, [str(k) for k in range(80)], 50, 6))]
    full = np.full(1 << (ngram_jaccard.ORDER_BITS - 6), np.uint64(0xFFFFFFFFFFFFFFFF))
    monkeypatch.setattr(ngram_jaccard, "common_buckets", lambda *_: full)
    assert run(spark, rows) == brute(rows)
