"""License scans by a positional index of rare tokens.

Texts are cut into words (ASCII letters, digits and everything beyond ASCII; A-Z lower-cased). Licence
notices and phrases are *templates*. Of every template the index keeps postings only of its highest-IDF
words (the ``anchors``; document frequencies are counted over all rows of the table, for the words of the
templates only, so that table has a fixed size). A file's occurrences of indexed words are looked up; each
posting of an occurrence says where the template would have to begin. Beginnings of one template that
agree within ``DRIFT`` words in ``needed`` postings make a candidate (intersection by relative position),
and a candidate counts if every mandatory key phrase of its template stands in its window, word by
word. Its score is the IDF-weighted share of the template's distinct words found in the window.

Phrases are the strict form: their rarest word is looked up, and the other words must stand exactly beside it;
*every* place is returned, with the label of the phrase and a score of 1.

All of it is column functions on the row's own text: no Python on executors, no shuffle but the counts of
the templates' words, and no group of rows anywhere.

Defined results: a null text counts as empty, and an empty one has no words, no place, empty labels and score 0;
very long texts are scanned whole; repeated rows are judged again, each alike; of equally rare words the
alphabetically first is the anchor; templates and phrases of letters other than a-z must be in lower case; an empty table stays empty; other columns are not read.
"""

from __future__ import annotations

import json
import math
import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BREAK = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"  # what stands between words; A-Z are a word's letters before and after lowering
ANCHORS = 8  # rarest words of a template that the index holds
DRIFT = 12  # words by which a copy may be shifted against its template (names, added or dropped words)
_SPAN = 1 << 40  # postings are coded as template * _SPAN + beginning
_BASE = 1 << 20  # beginnings before the text's first word stay positive


@dataclass(frozen=True)
class Template:
    """A licence notice: its label, its words, and the phrases without which it doesn't count."""

    label: str
    text: str
    keys: tuple[str, ...]


# Notices of common public licences, by their published wording, with their mandatory phrases.
NOTICES = (
    Template("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
             "documentation files (the Software), to deal in the Software without restriction, including without limitation the "
             "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software",
             ("permission is hereby granted free of charge", "to deal in the software without restriction", "sublicense and or sell copies")),
    Template("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
             "granted, provided that the above copyright notice and this permission notice appear in all copies",
             ("permission to use copy modify and or distribute", "with or without fee is hereby granted")),
    Template("bsd-2", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
             "following conditions are met: Redistributions of source code must retain the above copyright notice, this list of "
             "conditions and the following disclaimer",
             ("redistribution and use in source and binary forms", "redistributions of source code must retain")),
    Template("bsd-3", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products "
             "derived from this software without specific prior written permission",
             ("may be used to endorse or promote products derived from this software", "without specific prior written permission")),
    Template("apache-2", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with "
             "the License. You may obtain a copy of the License at",
             ("licensed under the apache license", "you may not use this file except in compliance with the license")),
    Template("gpl-2", "This program is licensed under the GNU General Public License, version 2", ("gnu general public license", "version 2")),
    Template("gpl-3", "This work is licensed under the GNU General Public License, version 3", ("gnu general public license", "version 3")),
    Template("lgpl-2.1", "This library is licensed under the GNU Lesser General Public License, version 2.1",
             ("gnu lesser general public license", "version 2 1")),
    Template("lgpl-3", "This library is licensed under the GNU Lesser General Public License, version 3", ("gnu lesser general public license", "version 3")),
    Template("agpl-3", "This work is licensed under the GNU Affero General Public License, version 3", ("gnu affero general public license", "version 3")),
    Template("mpl-2", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
             "distributed with this file, You can obtain one", ("source code form is subject to the terms", "mozilla public license v 2 0")),
    Template("epl-2", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0",
             ("accompanying materials are made available under the terms", "eclipse public license 2 0")),
    Template("zlib", "This software is provided as-is, without any express or implied warranty. In no event will the authors be held liable "
             "for any damages arising from the use of this software", ("provided as is without any express or implied warranty", "in no event will the authors be held liable")),
    Template("bsl-1", "Boost Software License, Version 1.0. Permission is hereby granted, free of charge, to any person or organization obtaining a "
             "copy of the software and accompanying documentation covered by this license", ("boost software license version 1 0",)),
    Template("unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, "
             "compile, sell, or distribute this software", ("free and unencumbered software released into the public domain",)),
    Template("cc0-1", "To the extent possible under law, the author has dedicated all copyright and related and neighboring rights to this work to "
             "the public domain worldwide under CC0 1.0", ("to the extent possible under law", "related and neighboring rights")),
    Template("cc-by-4", "This work is licensed under a Creative Commons Attribution 4.0 International License",
             ("licensed under a creative commons attribution 4 0 international license",)),
    Template("cc-by-sa-4", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License",
             ("creative commons attribution sharealike 4 0 international license",)),
    Template("cc-by-nc-4", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License",
             ("creative commons attribution noncommercial 4 0 international license",)),
)


def words_of(text: str) -> list[str]:
    """The words of a template, by the rule that texts are cut by."""
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def words_column(text: Column) -> Column:
    """The words of every whole text, as they stand; none where it is null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), BREAK), "")


def lowered(word: Column) -> Column:
    """A-Z lower-cased, nothing else. It costs much per character, so only words in question get it."""
    return F.translate(word, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def one_of(word: Column, wanted: Sequence[str]) -> Column:
    """Whether the lowered word is in ``wanted``. ``lower`` is quick and lowers A-Z too, and other letters besides, so it
    decides which words are looked at again; a word of a template is ASCII or holds no letter that ``lower`` changes."""
    return F.lower(word).isin(wanted) & lowered(word).isin(wanted)


def document_frequencies(words: DataFrame, vocabulary: Sequence[str]) -> tuple[int, dict[str, int]]:
    """(rows, rows that hold each word of ``vocabulary``) over all rows of ``words`` (column ``words``).

    One row per word and task is shuffled; what comes to the driver is as large as the vocabulary."""
    wanted = sorted(set(vocabulary))
    held = F.array_distinct(F.transform(F.filter("words", lambda w: one_of(w, wanted)), lowered))
    counted = words.select(F.explode(F.concat(held, F.array(F.lit("")))).alias("w")).groupBy("w").agg(F.count(F.lit(1)).alias("n"))
    counts = {r.w: r.n for r in counted.collect()}
    rows = counts.pop("", 0)  # every row holds the empty word once, a text's words are never empty
    return rows, counts


@dataclass(frozen=True)
class Index:
    """Postings of the rarest words: {word: [(template, position)]}, and each phrase's anchor position."""

    idf: dict[str, float]
    notices: tuple[Template, ...]
    postings: dict[str, list[tuple[int, int]]]
    needed: list[int]
    phrases: tuple[tuple[tuple[str, ...], str, int], ...]


def build_index(rows: int, counts: dict[str, int], notices: Sequence[Template], phrases: Sequence[tuple[str, str]]) -> Index:
    """The index of ``notices`` and ``phrases`` (words, label), by document frequencies."""
    vocabulary = {w for t in notices for w in words_of(t.text)} | {w for p, _ in phrases for w in words_of(p)}
    idf = {w: math.log((rows + 1) / (counts.get(w, 0) + 1)) + 1 for w in vocabulary}
    rarest = lambda ws: sorted(set(ws), key=lambda w: (-idf[w], w))
    postings: dict[str, list[tuple[int, int]]] = {}
    needed = []
    for t, notice in enumerate(notices):
        ws = words_of(notice.text)
        anchors = set(rarest(ws)[:ANCHORS])
        for at, w in enumerate(ws):
            if w in anchors:
                postings.setdefault(w, []).append((t, at))
        needed.append(max(2, len(anchors) // 2))
    strict = []
    for phrase, label in phrases:
        ws = words_of(phrase)
        strict.append((tuple(ws), label, ws.index(rarest(ws)[0])))
    return Index(idf, tuple(notices), postings, needed, tuple(strict))


def _stands(words: Column, at: Column, phrase: Sequence[str]) -> Column:
    """Whether the words of ``phrase`` stand consecutively from word ``at``."""
    ok = F.lit(True)
    for j, w in enumerate(phrase):
        ok = ok & F.coalesce(lowered(F.get(words, at + j)) == w, F.lit(False))
    return ok


def places(words: Column, hits: Column, index: Index) -> Column:
    """Start of every place of every phrase, as code phrase * _SPAN + start."""

    def of(p: int, phrase: Sequence[str], anchor: int) -> Column:
        at = F.filter(hits, lambda i: (lowered(F.get(words, i)) == phrase[anchor]) & (i >= anchor) & _stands(words, i - anchor, phrase))
        return F.transform(at, lambda i: (i - anchor).cast("long") + F.lit(p * _SPAN))

    found = [of(p, phrase, anchor) for p, (phrase, _, anchor) in enumerate(index.phrases)]
    return F.concat(*found) if found else F.array().cast("array<bigint>")


def constant(value: object, kind: str) -> Column:
    """A nested constant, folded once by the optimizer."""
    return F.from_json(F.lit(json.dumps(value)), kind)


def beginnings(words: Column, hits: Column, index: Index) -> Column:
    """Sorted codes template * _SPAN + _BASE + beginning of every posting of every hit."""
    lists = constant({w: [t * _SPAN + _BASE - at for t, at in posts] for w, posts in index.postings.items()}, "map<string,array<bigint>>")
    none = F.array().cast("array<bigint>")
    return F.sort_array(F.flatten(F.transform(hits, lambda i: F.transform(F.coalesce(F.try_element_at(lists, lowered(F.get(words, i))), none), lambda c: c + i))))


def candidates(codes: Column, index: Index) -> Column:
    """Codes from which ``needed`` beginnings of one template agree within DRIFT words, to whole multiples of DRIFT.

    Codes of two templates are _SPAN apart, so one comparison on the sorted codes checks both."""
    need = constant(index.needed, "array<int>")
    agree = lambda c, k: F.coalesce(F.get(codes, k + F.get(need, (c / _SPAN).cast("int")) - 1) <= c + DRIFT, F.lit(False))
    return F.array_distinct(F.transform(F.filter(codes, agree), lambda c: c - F.pmod(c, F.lit(DRIFT))))


def verified(words: Column, found: Column, index: Index) -> Column:
    """[(label, score)] of the candidates whose key phrases all stand in their window."""
    table = []
    for notice in index.notices:
        ws = words_of(notice.text)
        total = sum(index.idf[w] for w in set(ws))
        table.append({"label": notice.label, "span": len(ws) + 3 * DRIFT, "keys": [words_of(k) for k in notice.keys],
                      "weights": [{"w": w, "share": index.idf[w] / total} for w in sorted(set(ws))]})
    notices = constant(table, "array<struct<label:string,span:int,keys:array<array<string>>,weights:array<struct<w:string,share:double>>>>")

    def window(c: Column) -> Column:
        t = (c / _SPAN).cast("int")
        begin = (F.pmod(c, F.lit(_SPAN)) - F.lit(_BASE + DRIFT)).cast("int")
        notice = F.get(notices, t)
        return F.struct(notice.alias("notice"), F.transform(F.slice(words, F.greatest(begin, F.lit(0)) + 1, notice["span"]), lowered).alias("w"))

    def stands_in(w: Column, key: Column) -> Column:
        at = F.filter(F.transform(w, lambda x, j: F.when(x == F.get(key, F.lit(0)), j + 1)), lambda j: j.isNotNull())
        return F.exists(at, lambda j: F.slice(w, j, F.size(key)) == key)

    def score(s: Column) -> Column:
        share = F.aggregate(s["notice"]["weights"], F.lit(0.0), lambda n, x: n + F.when(F.array_contains(s["w"], x["w"]), x["share"]).otherwise(0.0))
        return F.least(share, F.lit(1.0))

    windows = F.filter(F.transform(found, window), lambda s: F.forall(s["notice"]["keys"], lambda key: stands_in(s["w"], key)))
    return F.transform(windows, lambda s: F.struct(s["notice"]["label"].alias("label"), score(s).alias("score")))


def scan_licenses(df: DataFrame, phrases: Sequence[tuple[str, str]], notices: Sequence[Template] = NOTICES,
                  key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_words, base: [(phrase, start)], notices: [(label, score)]) of every row."""
    words = df.select(F.col(key).alias("__key"), words_column(F.col(text)).alias("words"))
    vocabulary = {w for t in notices for w in words_of(t.text)} | {w for p, _ in phrases for w in words_of(p)}
    index = build_index(*document_frequencies(words, sorted(vocabulary)), notices, phrases)
    indexed = sorted(set(index.postings) | {p[a] for p, _, a in index.phrases})
    numbered = F.transform("words", lambda w, i: F.when(one_of(w, indexed), i))
    looked_up = words.withColumn("hits", F.filter(numbered, lambda i: i.isNotNull()))
    w, hits = F.col("words"), F.col("hits")
    # each step is a column of its own, so that nothing is worked out again inside another step's loop
    found = looked_up.select("__key", "words", places(w, hits, index).alias("places"), beginnings(w, hits, index).alias("codes"))
    found = found.select("__key", "words", "places", candidates(F.col("codes"), index).alias("found"))
    base = F.transform("places", lambda c: F.struct((c / _SPAN).cast("int").alias("phrase"), F.pmod(c, F.lit(_SPAN)).alias("start")))
    return found.select(F.col("__key").alias(key), F.size("words").cast("long").alias("n_words"), base.alias("base"), verified(w, F.col("found"), index).alias("notices"))


def license_report(df: DataFrame, phrases: Sequence[tuple[str, str]], notices: Sequence[Template] = NOTICES,
                   key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``df``: places of the phrases, their labels, all labels, and the best score."""
    found = scan_licenses(df, phrases, notices, key, text)
    labels = F.array(*[F.lit(label) for _, label in phrases])
    base = F.transform("base", lambda b: F.get(labels, b["phrase"]))
    joined = lambda names: F.array_join(F.sort_array(F.array_distinct(names)), ",")
    starts = F.transform("base", lambda b: b["start"])
    best = F.when(F.size("base") > 0, 1.0).otherwise(F.coalesce(F.array_max(F.transform("notices", lambda m: m["score"])), F.lit(0.0)))
    return found.select(key, "n_words", F.size("base").cast("long").alias("n_base"), F.array_min(starts).alias("first_word"),
                        F.array_max(starts).alias("last_word"), joined(base).alias("base_labels"),
                        joined(F.concat(base, F.transform("notices", lambda m: m["label"]))).alias("labels"), best.alias("score"))
