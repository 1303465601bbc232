"""Op 8 against brute force over every window."""

import hashlib
import random
from collections import Counter

import pytest

from skein.llm import suffix_dedup
from skein.llm.queries import QUERIES


def brute(texts, length):
    """(bytes, removed, spans, sha256 of the rest) of each text."""
    raw = [(t or "").encode() for t in texts]
    seen = Counter(t[p:p + length] for t in raw for p in range(len(t) - length + 1))
    out = []
    for t in raw:
        gone = bytearray(len(t))
        for p in range(len(t) - length + 1):
            if seen[t[p:p + length]] > 1:
                gone[p:p + length] = b"\x01" * length
        spans = sum(1 for i in range(len(t)) if gone[i] and (i == 0 or not gone[i - 1]))
        out.append((len(t), sum(gone), spans, hashlib.sha256(bytes(c for c, g in zip(t, gone) if not g)).hexdigest()))
    return out


def run(spark, texts, length, parts=5):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(parts)
    got = {r.doc_id: r for r in suffix_dedup.remove_repeats(df, length=length).collect()}
    return [(len(r.kept) + (n := sum(s.end - s.start for s in r.removed)), n, len(r.removed), hashlib.sha256(bytes(r.kept)).hexdigest())
            for _, r in sorted(got.items())]


@pytest.mark.parametrize("length", [40, 41, 100])
def test_random_pieces(spark, length):
    rng = random.Random(length)
    letters = lambda n, a="abcde": "".join(rng.choice(a) for _ in range(n))
    pool = [letters(rng.randrange(length // 2, 3 * length)) for _ in range(12)]
    texts = ["".join(rng.choice([rng.choice(pool), letters(rng.randrange(1, length))]) for _ in range(rng.randrange(1, 8))) for _ in range(150)]
    texts += ["a" * 3 * length, "ab" * length, letters(30) * 9, None, "", "x" * length, pool[0][:length - 1], texts[0], texts[0], "é" * length]
    base = letters(6 * length)
    for _ in range(40):  # near copies with edits anywhere: many contexts of one gram
        p = rng.randrange(len(base))
        texts.append(base[:p] + rng.choice("XYZ") + base[p + 1:])
    assert run(spark, texts, length) == brute(texts, length)


def test_common_short_passage(spark):
    """A passage just shorter than the window never counts, one just as long does."""
    rng = random.Random(2)
    letters = lambda n: "".join(rng.choice("abcdefghij") for _ in range(n))
    short, exact = letters(99), letters(100)
    texts = [letters(150) + (short if i % 2 else exact) + letters(150) for i in range(60)]
    assert run(spark, texts, 100) == brute(texts, 100)


@pytest.mark.parametrize("size", [60, 99, 100, 170])
def test_hot_gram_is_split_over_tasks(spark, monkeypatch, size):
    """A passage in every document with different neighbours: no task compares all its contexts."""
    rng = random.Random(size)
    letters = lambda n: "".join(rng.choice("abcdefghij") for _ in range(n))
    passage, sides = letters(size), [letters(150) for _ in range(4)]
    texts = [letters(150) + passage + letters(150) for _ in range(120)]
    for i in range(60):  # some share a part of their neighbours too
        a, b = rng.randrange(1, 60), rng.randrange(1, 60)
        texts.append(letters(150 - a) + sides[i % 2][-a:] + passage + sides[2 + i % 2][:b] + letters(150 - b))
    want = brute(texts, 100)
    real, limit = suffix_dedup.equal_windows, 16

    def bounded(before, suffixes, lcp, length):
        assert len(suffixes) <= limit, f"{len(suffixes)} contexts in one task"
        return real(before, suffixes, lcp, length)

    monkeypatch.setattr(suffix_dedup, "HOT", limit, raising=False)
    monkeypatch.setattr(suffix_dedup, "equal_windows", bounded)
    assert run(spark, texts, 100) == want


def test_empty_table(spark):
    assert run(spark, [], 40) == []
    assert run(spark, [None, "", "short"], 40) == brute([None, "", "short"], 40)


def test_repeated_rows_and_other_columns(spark):
    t = "0123456789" * 3 + "abcdefghijklmnopqrstuvwxyz"
    df = spark.createDataFrame([(1, t, "k"), (1, t, "k"), (None, "other", None)], "doc_id long, text string, removed string")
    got = suffix_dedup.remove_repeats(df, length=40).collect()
    assert sorted(len(r.kept) for r in got) == [0, 0, 5]


def test_merge_runs_is_a_sort():
    rng = random.Random(1)
    words = [bytes(rng.choice(b"ab") for _ in range(rng.randrange(0, 12))) for _ in range(500)]
    for k in (1, 2, 3, 7, 16):
        runs = [suffix_dedup.front_code(sorted(words[r::k])) for r in range(k)]
        got = list(suffix_dedup.merge_runs(runs))
        assert [s for _, _, s, _ in got] == sorted(words)
        assert all(c == suffix_dedup.shared(a[2], b[2]) for a, b, c in zip(got, got[1:], [x[3] for x in got[1:]]))


def test_query_on_whole_table(spark):
    folder = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{folder}/documents.parquet").orderBy("doc_id").collect()
    got = [tuple(r)[1:] for r in QUERIES["op8_suffix_dedup"](spark, folder).orderBy("doc_id").collect()]
    assert got == brute([r.text for r in rows], 400)
