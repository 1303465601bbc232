"""Benchmark decontamination by spaced-seed hashing.

Texts are sequences of words: maximal runs of ASCII letters (lower-cased), digits and bytes
above 127; case, punctuation and spacing don't count. A seed is a mask laid over consecutive
words: the hash of the words under its ones; words under its zeros are ignored. A text and
a benchmark item overlap if, laid side by side without gaps, some window of WINDOW words (the
whole item, if it is shorter) agrees in all but SUBSTITUTIONS words (all but one below
WINDOW). The two masks have a common seed in every such window: every way to place the
substitutions leaves one of them untouched somewhere (a test goes through them all).

Seeds of the benchmark make a bitmap of fixed size. Training seeds that pass it carry the words
around them and are joined with the benchmark's on the seed; every joined hit is laid out
and its windows counted. Neither side is collected; texts are not shuffled.

Defined results: null and empty texts overlap with nothing, nor do items of fewer than
MIN_ITEM words (a few common words are no evidence) or null items; repeated rows
share their result; empty tables give an empty result; extra columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skein.llm.batches import list_array, slices, small_batches, text_bytes
from skein.llm.hashing import member, membership, mix, prefix_hash, range_hash
from skein.session import materialize

MASKS = ("1010111", "10111001")
WINDOW, SUBSTITUTIONS, MIN_ITEM = 13, 2, 8
_REACH = WINDOW - 1  # words of context on either side of a seed
_SPAN = max(map(len, MASKS))
_WIDTH = _SPAN + 2 * _REACH

_LETTER = np.zeros(256, bool)
_LETTER[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_MULTIPLY = mix(np.arange(7, 7 + _SPAN, dtype=np.uint64)) | np.uint64(1)


def word_hashes(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every word, rows + 1 offsets)."""
    low = _LOWER[data]
    solid = _LETTER[low]
    edge = np.zeros(len(low) + 1, bool)
    edge[offs] = True
    start = np.flatnonzero(solid & (~np.r_[False, solid[:-1]][:len(solid)] | edge[:-1]))
    end = np.flatnonzero(solid & (~np.r_[solid[1:], False][:len(solid)] | edge[1:])) + 1
    word = range_hash(prefix_hash(low), start, end)
    counts = np.diff(np.searchsorted(start, offs))
    return word, np.r_[0, np.cumsum(counts)].astype(np.int64)


def seeds(word: np.ndarray, ends: np.ndarray, masks=MASKS):
    """(seed, index of its first word, row) of every mask at every place inside a row."""
    row = np.repeat(np.arange(len(ends) - 1), np.diff(ends))
    out = []
    for number, mask in enumerate(masks):
        n = len(word) - len(mask) + 1
        if n <= 0:
            continue
        at = np.flatnonzero(np.arange(n) + len(mask) <= ends[row[:n] + 1])
        code = np.full(n, np.uint64(number + 1))
        for i, c in enumerate(mask):
            if c == "1":
                code += word[i:i + n] * _MULTIPLY[i]
        out.append((mix(code[at]), at, row[at]))
    if not out:
        none = np.zeros(0, np.int64)
        return none.view(np.uint64), none, none
    return tuple(np.concatenate(x) for x in zip(*out))


def _around(word: np.ndarray, ends: np.ndarray, at: np.ndarray, row: np.ndarray) -> np.ndarray:
    """The _WIDTH words around each seed; 0 where the row has none."""
    where = at[:, None] + np.arange(-_REACH, _SPAN + _REACH)
    inside = (where >= ends[row][:, None]) & (where < ends[row + 1][:, None])
    return np.where(inside, word[np.clip(where, 0, max(len(word) - 1, 0))] | np.uint64(1), np.uint64(0))


def _hits(rows: DataFrame, held: np.ndarray | None, items: bool) -> DataFrame:
    """(seed, id, n_words, around) of an (id, text) table; only seeds in ``held``, if given."""
    held_of = None if held is None else rows.sparkSession.sparkContext.broadcast(held)

    def run(batches):
        for batch in batches:
            data, offs = text_bytes(batch.column(1))
            for a, b in slices(offs):
                word, ends = word_hashes(data[offs[a]:offs[b]], offs[a:b + 1] - offs[a])
                code, at, row = seeds(word, ends)
                n = np.diff(ends)
                take = (n[row] >= MIN_ITEM) if items else np.ones(len(code), bool)
                if held_of is not None:
                    take &= member(held_of.value, code.view(np.int64))
                where = np.flatnonzero(take)
                for c in range(0, len(where), 1 << 15):
                    k = where[c:c + (1 << 15)]
                    near = _around(word, ends, at[k], row[k])
                    yield pa.RecordBatch.from_arrays([
                        pa.array(code[k].view(np.int64)), batch.column(0).slice(a, b - a).take(pa.array(row[k])), pa.array(n[row[k]], pa.int64()),
                        list_array(near.ravel().view(np.int64), np.arange(len(k) + 1) * _WIDTH, pa.int64())], names=["seed", "id", "n_words", "around"])

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"seed long, id {kind}, n_words long, around array<long>")


def _laid_out(joined: DataFrame, item_kind: str) -> DataFrame:
    """(rid, item, n_words, n_same) of the hits that hold a window of enough equal words."""

    def run(batches):
        for batch in batches:
            doc, item = (batch.column(k).flatten().to_numpy().reshape(-1, _WIDTH) for k in (2, 4))
            same, real = (doc == item) & (doc != 0), (doc != 0) & (item != 0)
            size = np.minimum(batch.column(3).to_numpy(), WINDOW)
            best = np.zeros(len(size), np.int64)
            for w in np.unique(size):
                k = np.flatnonzero(size == w)
                total = lambda x: np.cumsum(np.pad(x[k].astype(np.int64), ((0, 0), (1, 0))), axis=1)
                s, r = total(same), total(real)
                s, r = s[:, w:] - s[:, :-w], r[:, w:] - r[:, :-w]
                best[k] = np.where(r == w, s, 0).max(1)
            ok = best >= size - np.where(size == WINDOW, SUBSTITUTIONS, 1)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(size, pa.int64()), pa.array(best)],
                                             names=["rid", "item", "n_words", "n_same"]).filter(pa.array(ok))

    return joined.select("rid", "item", "around", "item_words", "item_around").mapInArrow(
        run, f"rid long, item {item_kind}, n_words long, n_same long")


def overlaps(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """(rid, item, n_words, n_same): every text (rid: xxhash64 of it) that overlaps with an item, the
    size of the window and the most equal words in one."""
    items = benchmark.select(F.col(item_id).alias("id"), F.col(item_text).alias("text"))
    item_seeds = materialize(_hits(items, None, True).dropDuplicates(["seed", "id", "around"]), "item_seeds")
    held = membership(item_seeds, "seed")
    rows = small_batches(docs).select(F.xxhash64(text).alias("id"), F.col(text).alias("text"))
    hits = _hits(rows, held, False).withColumnRenamed("id", "rid")
    joined = hits.join(item_seeds.select("seed", F.col("id").alias("item"), F.col("n_words").alias("item_words"),
                                         F.col("around").alias("item_around")), "seed")
    found = _laid_out(joined, benchmark.schema[item_id].dataType.simpleString())
    return found.groupBy("rid", "item").agg(F.max("n_words").alias("n_words"), F.max("n_same").alias("n_same"))


def contaminated(docs: DataFrame, benchmark: DataFrame, ident: str = "doc_id", text: str = "text") -> DataFrame:
    """(ident, item_id, n_words, n_same) of every document that overlaps with an item."""
    found = overlaps(docs, benchmark, text)
    rows = docs.select(ident, F.xxhash64(text).alias("rid"))
    return rows.join(found, "rid").select(ident, F.col("item").alias("item_id"), "n_words", "n_same")


def decontaminate(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """The documents that overlap with no item, all columns kept."""
    found = materialize(overlaps(docs, benchmark, text).select(F.col("rid").alias("__rid")).distinct(), "overlaps")
    return docs.withColumn("__rid", F.xxhash64(text)).join(found, "__rid", "left_anti").drop("__rid")
