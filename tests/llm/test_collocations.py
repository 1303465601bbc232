"""Op 12 against counting by plain Python code."""

import random
import re
from collections import Counter

import numpy as np

from skein.llm import batches, collocations


def brute(rows, support, top, percent=80, scale=2_000_000):
    f, n = {}, Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", low):
            w = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, 5):
                for i in range(len(w) - k + 1):
                    f.setdefault(lang, Counter())[tuple(w[i:i + k])] += 1
    out = set()
    for lang, c in f.items():
        cands = {p: a for p, a in c.items() if len(p) > 1 and a >= support}
        most = Counter()
        for p, a in cands.items():
            for m in range(2, len(p)):
                for i in range(len(p) - m + 1):
                    most[p[i:i + m]] = max(most[p[i:i + m]], a)
        ranked = []
        for p, a in cands.items():
            score, k = min((scale * a // (c[p[:k]] + c[p[k:]]), k) for k in range(1, len(p)))
            if 100 * most[p] < percent * a:
                ranked.append((-score, -a, " ".join(p).encode(), c[p[:k]], c[p[k:]]))
        for rank, (s, a, p, left, right) in enumerate(sorted(ranked)[:top], 1):
            out.add((lang, rank, p.decode(), -a, left, right, n[lang], -s))
    return out


def run(spark, rows, support, top, **more):
    df = spark.createDataFrame([(lang, t, 7, "clash") for lang, t in rows], "lang string, text string, key int, phrase string").repartition(5)
    return {tuple(r) for r in collocations.collocations(df, support, top, **more).collect()}


def corpus(rng, docs, vocabulary, marks=" \t .,\n"):
    out = []
    for _ in range(docs):
        ws = [rng.choice(vocabulary) for _ in range(rng.randrange(1, 60))]
        if rng.random() < 0.4:
            at = rng.randrange(len(ws))
            ws[at:at] = ["New", "york", "City", "hall"][:rng.randrange(2, 5)]
        out.append("".join(w + rng.choice(marks) for w in ws))
    return out


def test_random_corpora(spark):
    for seed, support, top, shards in ((1, 5, 1000, 4), (2, 12, 10, 7), (3, 2, 50, 1)):
        rng = random.Random(seed)
        vocabulary = [f"w{i}" for i in range(12)] + ["É", "ê", "日本", "a b"]
        rows = [(rng.choice(["en", "en", "fr", None, "und", ""]), t) for t in corpus(rng, 300, vocabulary)]
        assert run(spark, rows, support, top, shards=shards) == brute(rows, support, top)


def test_defined_cases(spark):
    hot = "the same Text, again and again: the same text"
    rows = [(None, hot)] * 400 + [("en", None), ("en", ""), ("en", " \t.,"), ("und", hot), ("en", "alpha beta " * 20_000), ("fr", "x y\x0bx y\x0cx y\rx y\nx y"), ("fr", "x y!x y?x y;x y")]
    assert run(spark, rows, 3, 100) == brute(rows, 3, 100)
    assert run(spark, [], 3, 100) == set()
    assert run(spark, [("en", "one two")], 30, 10) == set()


def test_overlaps_ties_and_nesting(spark):
    rows = [("en", "a a a a a a a")] * 6 + [("en", "b c d e")] * 10 + [("en", "c d")] * 2 + [("en", "d e")] * 9 + [("xx", "q r. s t")] * 5
    assert run(spark, rows, 5, 100) == brute(rows, 5, 100)


def test_cut_keeps_rows_and_pieces_apart():
    texts = ["ab c", "", "d.e", "f", " g ", "\n"]
    raw = [t.encode() for t in texts]
    offs = np.cumsum([0] + [len(r) for r in raw])
    data = np.frombuffer(b"".join(raw), np.uint8)
    low, start, end, piece, row = collocations.cut(data, offs)
    assert [low[a:b].tobytes().decode() for a, b in zip(start, end)] == ["ab", "c", "d", "e", "f", "g"]
    assert row.tolist() == [0, 0, 2, 2, 3, 4]
    assert len(set(piece.tolist())) == 5 and piece[0] == piece[1]


def test_small_slices_give_the_same(spark, monkeypatch):
    rng = random.Random(8)
    rows = [("en", t) for t in corpus(rng, 200, ["a", "b", "c", "d"])]
    whole = list(batches.slices(np.cumsum([0] + [len(t) for _, t in rows]), 64))
    assert len(whole) > 20
    assert run(spark, rows, 4, 500, shards=3) == brute(rows, 4, 500)


def test_shards_by_file(spark, tmp_path):
    rng = random.Random(12)
    rows = [(rng.choice(["en", "fr"]), t) for t in corpus(rng, 400, ["a", "b", "c", "d", "e", "f g", "É"])]
    spark.createDataFrame(rows, "lang string, text string").repartition(9).write.parquet(str(tmp_path / "docs"))
    got = collocations.collocations(spark.read.parquet(str(tmp_path / "docs")), 15, 200, shards=5).collect()
    assert {tuple(r) for r in got} == brute(rows, 15, 200)


def test_salted_keys_come_back():
    keys = np.random.default_rng(1).integers(0, 2**64, 1000, dtype=np.uint64)
    shard = np.arange(1000) % 7
    assert (collocations._unmixed(collocations._salted(keys, shard)) ^ collocations._salt(shard) == keys).all()


def test_bitmap_holds_its_keys(spark):
    keys = np.random.default_rng(2).integers(0, 2**64, 5000, dtype=np.uint64)
    df = spark.createDataFrame([(int(k),) for k in keys.view(np.int64)], "k long")
    bitmap = collocations._bitmap(df, "k")
    assert collocations.member(bitmap, keys).all()
    assert collocations.member(bitmap, np.random.default_rng(3).integers(0, 2**64, 50_000, dtype=np.uint64)).mean() < 0.07
    assert not collocations.member(collocations._bitmap(df.limit(0), "k"), keys).any()
