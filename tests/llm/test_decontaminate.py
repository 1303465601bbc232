"""Op 3 against laying every text along every item."""

import itertools
import random
import re

from skein.llm import decontaminate as D
from skein.llm.queries import QUERIES


def words(text):
    return [w.lower() for w in re.findall(rb"[A-Za-z0-9\x80-\xff]+", (text or "").encode())]


def brute(docs, items):
    out = set()
    for i, t in items:
        b = words(t)
        if len(b) < D.MIN_ITEM:
            continue
        w = min(len(b), D.WINDOW)
        need = w - (D.SUBSTITUTIONS if w == D.WINDOW else 1)
        known = set(b)
        for d, text in docs:
            a = words(text)
            if len(known.intersection(a)) < min(5, len(known)):
                continue
            best = 0
            for shift in range(-len(b) + w, len(a) - w + 1):
                same = [0 <= k + shift < len(a) and a[k + shift] == b[k] for k in range(len(b))]
                for k in range(len(b) - w + 1):
                    if 0 <= k + shift and k + shift + w <= len(a):
                        best = max(best, sum(same[k:k + w]))
            if best >= need:
                out.add((d, i, w, best))
    return out


def run(spark, docs, items):
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    b = spark.createDataFrame(items, "item_id long, text string")
    return {tuple(r) for r in D.contaminated(d, b).collect()}


def test_masks_meet_every_window():
    """Whatever words are substituted, one mask lies untouched somewhere in the window."""
    for w in range(D.MIN_ITEM, D.WINDOW + 1):
        k = D.SUBSTITUTIONS if w == D.WINDOW else 1
        for lost in itertools.combinations(range(w), k):
            assert any(all(s + o not in lost for o, c in enumerate(m) if c == "1") for m in D.MASKS for s in range(w - len(m) + 1)), (w, lost)


def test_planted_passages(spark):
    rng = random.Random(6)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randrange(1, 3)))
    items = [(i, " ".join(word() for _ in range(rng.choice([3, 7, 8, 9, 12, 13, 14, 40])))) for i in range(40)] + [(90, None), (91, ""), (None, "a b c d e f g h i j")]
    docs = []
    for i in range(300):
        own = [word() for _ in range(rng.randrange(0, 60))]
        _, t = rng.choice(items)
        part = (t or "").split()
        cut = rng.randrange(len(part) + 1) if rng.random() < 0.3 else 0
        part = part[cut:]
        for _ in range(rng.randrange(4)):
            if part:
                part[rng.randrange(len(part))] = rng.choice(["zz", "z-z", "y"])
        at = rng.randrange(len(own) + 1)
        text = " ".join(own[:at] + part + own[at:])
        docs.append((i, text.upper() if rng.random() < 0.2 else text.replace(" ", rng.choice([" ", ", ", "\n"]))))
    docs += [(900, None), (901, ""), (None, items[5][1])]
    assert run(spark, docs, items) == brute(docs, items)


def test_empty_and_repeated(spark):
    item = [(1, "one two three four five six seven eight")]
    assert run(spark, [], item) == set() == run(spark, [(1, "x")], [])
    assert run(spark, [(5, item[0][1]), (5, item[0][1])], item) == {(5, 1, 8, 8)}
    docs = spark.createDataFrame([(5, item[0][1], "k"), (6, "clean", "k"), (None, None, None)], "doc_id long, text string, rid string")
    kept = D.decontaminate(docs, spark.createDataFrame(item, "item_id long, text string"))
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {6, None}


def test_query_on_whole_table(spark):
    folder = "/root/testdata/sf0.001"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    assert {tuple(r) for r in QUERIES["op3_decontaminate"](spark, folder).collect()} == brute(docs, items)
