"""Collocations by SON partitioning: shards mined at lowered support, candidates counted globally.

Texts are cut at ``.,;:!?`` and line ends into pieces and at spaces and tabs into words (A-Z lower-cased). A
phrase with f occurrences in a language is frequent if f >= ``support``. Rows are dealt into ``shards``
shards: by a hash of the file they come from, so that a task works on few shards, or of their text where there is no file. A
shard that holds the share s of a language's words mines it at the support ceil(s * support): a phrase below that in
every shard is below ``support`` in all, so the union of what shards find holds every frequent phrase.
The shards are mined completely, by levels (1, 2, then 3 and 4 words): a phrase is looked at where all its parts of the
level before are frequent in the shard. Then all candidates are counted globally in one more pass, and only these
counts are used.

A shard is a part of the table, not a task. Tasks count keys of 64 bits in sorted arrays and send them as blocks to buckets by
the keys' top bits; the number of buckets grows with the counted words, so a bucket's memory is bounded, and as keys are hashes
neither a hot text, word nor language is a hot bucket. Between levels goes a bitmap of the frequent keys (16 to 32 bits
a key, at most 2**MAX_BITS bits, 16 MB, put together from slices that tasks make): beyond that size it passes more, never less. In mining, two phrases with one key can only
add a candidate; in the global counts phrases are told apart by 64 bits of hash and 32 bits of lengths and byte sums. The words
of what is frequent are read in a last pass from one of the texts that hold it, and checked against these bits.

Defined results: a null text is empty, an empty one has no words; a null language is ``und``, as is a language of that
name; very long texts are read whole, in slices; repeated rows count as often as they stand; ties go to the
smaller cut, and in the ranking to the phrase first in UTF-8 order; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skein.llm import batches
from skein.llm.hashing import mix, prefix_hash, range_hash
from skein.session import materialize

MAX_WORDS = 4
MAX_BITS = 27  # log2 of the largest bitmap's bits
RAW = 1 << 18  # occurrences that a task gathers before it counts them
KEPT = 1 << 19  # different keys that a task holds before it sends them
BUCKET_WORDS = 1 << 21  # words of the table for each bucket, about

_CLASS = np.zeros(256, np.uint8)  # 0 word, 1 between words, 2 between pieces
_CLASS[[0x20, 0x09]] = 1
_CLASS[[ord(c) for c in ".,;:!?"] + [0x0A, 0x0B, 0x0C, 0x0D]] = 2
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32
_STEP = np.uint64(0xC2B2AE3D27D4EB4F)
_OTHER = np.uint64(0x165667B19E3779F9)
_LOW32 = np.uint64(0xFFFFFFFF)


def _first_bytes(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(whether a word begins at each byte, each byte's class); a row's first byte follows nothing."""
    kind = _CLASS[data]
    word = kind == 0
    first = word.copy()
    first[1:] &= ~word[:-1]
    begins = offs[:-1][np.diff(offs) > 0]
    first[begins] |= word[begins]
    return first, kind


def cut(data: np.ndarray, offs: np.ndarray):
    """(lower-cased bytes, start, end, piece, row) of every word of a slice; words of one piece share its number."""
    first, kind = _first_bytes(data, offs)
    word = kind == 0
    last = word.copy()
    last[:-1] &= ~word[1:]
    ends = offs[:-1][np.diff(offs) > 0][1:] - 1
    last[ends] |= word[ends]
    start = np.flatnonzero(first)
    end = np.flatnonzero(last) + 1
    row = np.repeat(np.arange(len(offs) - 1), np.diff(np.searchsorted(start, offs)))
    piece = np.cumsum(kind == 2, dtype=np.int32)[start] if len(start) else start
    return _LOWER[data], start, end, piece + row, row


def grams(words: np.ndarray, piece: np.ndarray, seed: np.ndarray, n: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For k = 1..n: (key of the k words from each place, whether they stand in one piece)."""
    out = [(mix(words + seed), np.ones(len(words), bool))]
    for k in range(2, n + 1):
        before, fits = out[-1]
        m = max(len(words) - k + 1, 0)
        out.append((mix(before[:m] * _STEP + words[k - 1:]), piece[:m] == piece[k - 1:] if m else fits[:0]))
    return out


def _column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def _seeds(column: pa.Array) -> np.ndarray:
    """A hash of each row's language."""
    memo: dict = {}
    values = column.to_pylist()
    for v in values:
        if v not in memo:
            raw = np.frombuffer((v or "").encode() + b"\x00", np.uint8)
            memo[v] = range_hash(prefix_hash(raw), np.array([0]), np.array([len(raw)]))[0]
    return np.array([memo[v] for v in values], np.uint64)


def _salt(shard: np.ndarray) -> np.ndarray:
    return shard.astype(np.uint64) * _OTHER


def _salted(keys: np.ndarray, shard: np.ndarray) -> np.ndarray:
    """A phrase's key in a shard; with the shard, it can be taken back."""
    return mix(keys ^ _salt(shard))


def _unmixed(x: np.ndarray) -> np.ndarray:
    """The inverse of ``mix``."""
    def unshifted(x: np.ndarray, by: int) -> np.ndarray:
        y = x
        for _ in range(64 // by):
            y = x ^ (y >> np.uint64(by))
        return y

    x = unshifted(x, 31) * np.uint64(pow(0x94D049BB133111EB, -1, 1 << 64))
    x = unshifted(x, 27) * np.uint64(pow(0xBF58476D1CE4E5B9, -1, 1 << 64))
    return unshifted(x, 30)


def _edges(keys: np.ndarray, bits: int) -> list[tuple[int, int, int]]:
    """(bucket, begin, end) of the runs of sorted keys with equal top ``bits`` bits."""
    if not len(keys):
        return []
    if not bits:
        return [(0, 0, len(keys))]
    bucket = (keys >> np.uint64(64 - bits)).astype(np.int64)
    at = np.append(np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])), len(keys))
    return [(int(bucket[a]), int(a), int(b)) for a, b in zip(at[:-1], at[1:])]


def _blocks(rows: list[tuple], names: list[str], kinds: list[pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=names)


def _counted(parts, tell: int = 0):
    """Tuples of (keys, other columns) -> (keys ascending, their numbers, other columns of the first of each), in blocks of about KEPT
    different keys. The first ``tell`` of the other columns tell equal keys apart, too."""

    def compact(held):
        cols = [np.concatenate(x) for x in zip(*held)]
        order = np.argsort(cols[0])
        cols = [c[order] for c in cols]
        new = np.ones(len(order), bool)
        new[1:] = cols[0][1:] != cols[0][:-1]
        for c in cols[2:2 + tell]:  # parts of a key may come twice then; its bucket adds them up
            new[1:] |= c[1:] != c[:-1]
        at = np.flatnonzero(new)
        return [cols[0][at], np.add.reduceat(cols[1], at, dtype=np.uint32), *(c[at] for c in cols[2:])]

    held: list = []
    fresh = 0
    for key, *others in parts:
        held.append([key, np.ones(len(key), np.uint32), *others])
        fresh += len(key)
        if fresh >= RAW:
            held, fresh = [compact(held)], 0
            if len(held[0][0]) >= KEPT:
                yield held.pop()
    if sum(len(h[0]) for h in held):
        yield compact(held)


def _mine(bitmap: np.ndarray | None, levels: tuple[int, ...], bits: int):
    """Arrow batches -> (bucket, shard, need, keys, counts) of the phrases of ``levels`` words whose parts, one word
    shorter than the least level, are frequent in the shard: sorted keys as a block, with their numbers."""

    def occurrences(stream):
        for batch in stream:
            for part, data, offs in batches.text_slices(batch, "text"):
                low, start, end, piece, row = cut(data, offs)
                if not len(start):
                    continue
                shard = _column(part, "shard").to_numpy(zero_copy_only=False).astype(np.int64)
                group = (shard << 32) | _column(part, "need").to_numpy(zero_copy_only=False).astype(np.int64)
                words = range_hash(prefix_hash(low), start, end)
                found = grams(words, piece, _seeds(_column(part, "lang"))[row], levels[-1])
                parts = None
                if bitmap is not None:
                    short = found[levels[0] - 2][0]
                    parts = member(bitmap, _salted(short, shard[row[:len(short)]]))
                for k in levels:
                    key, fits = found[k - 1]
                    take = fits
                    if parts is not None:
                        take = fits & parts[:len(key)]
                        for j in range(1, k - levels[0] + 2):
                            take &= parts[j:j + len(key)]
                    at = np.flatnonzero(take)
                    yield _salted(key[at], shard[row[at]]), group[row[at]]

    def run(stream):
        names, kinds = ["bucket", "shard", "need", "keys", "counts"], [pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary()]
        for keys, n, group in _counted(occurrences(stream)):
            for g in np.unique(group):  # a shard and its support
                own = group == g
                k, c = keys[own], n[own].astype("<u4")
                yield _blocks([(b, int(g) >> 32, int(g) & 0xFFFFFFFF, k[a:z].tobytes(), c[a:z].tobytes()) for b, a, z in _edges(k, bits)], names, kinds)

    return run


def _gathered(table: pa.Table, name: str, kind: str) -> np.ndarray:
    return np.frombuffer(b"".join(table[name].to_pylist()), kind)


def _summed(keys: list[np.ndarray], n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(positions of the first of equal keys, sums of n) by the last key first."""
    order = np.lexsort(keys)
    new = np.ones(len(order), bool)
    new[1:] = False
    for k in keys:
        new[1:] |= k[order[1:]] != k[order[:-1]]
    edge = np.flatnonzero(new)
    return order[edge], np.add.reduceat(n[order], edge) if len(edge) else n[:0]


def _frequent_in_shard(table: pa.Table) -> pa.Table:
    """All blocks of a bucket -> (own, key) of the phrases that reach their shard's support."""
    own, keys = [], []
    groups = np.stack([table["shard"].to_numpy(), table["need"].to_numpy()], axis=1)
    for shard, need in np.unique(groups, axis=0).tolist():
        part = table.filter(pa.array((groups == (shard, need)).all(axis=1)))
        k = _gathered(part, "keys", "<u8")
        at, n = _summed([k], _gathered(part, "counts", "<u4").astype(np.int64))
        k = k[at[n >= need]]
        own.append(k)
        keys.append(_unmixed(k) ^ _salt(np.array([shard])))
    return pa.table([pa.array(np.concatenate(x).view(np.int64)) for x in (own, keys)], names=["own", "key"])


def _tally(stream):
    """Arrow batches -> (lang, shard, words) of each row."""
    for batch in stream:
        n = np.zeros(batch.num_rows, np.int64)
        at = 0
        for part, data, offs in batches.text_slices(batch, "text"):
            before = np.append(0, np.cumsum(_first_bytes(data, offs)[0], dtype=np.int32))[offs]
            n[at:at + part.num_rows] = np.diff(before)
            at += part.num_rows
        yield pa.RecordBatch.from_arrays([_column(batch, "lang"), _column(batch, "shard"), pa.array(n)], names=["lang", "shard", "words"])


def _occurrences(part: pa.RecordBatch, data: np.ndarray, offs: np.ndarray, n_max: int, bitmap: np.ndarray):
    """For each size k: (k, places of candidates, their keys, checks, texts' hashes), and the words' ends, of a slice."""
    low, start, end, piece, row = cut(data, offs)
    if not len(start):
        return [], low, start, end, row
    prefix = prefix_hash(low)
    words = range_hash(prefix, start, end)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(low, dtype=np.uint64)])
    marks = mix((sums[end] - sums[start]) * _STEP + (end - start).astype(np.uint64))  # lengths and byte sums: not of the hash's making
    texts = range_hash(prefix, offs[:-1], offs[1:]) & _LOW32
    out = []
    for k, (key, fits) in enumerate(grams(words, piece, _seeds(_column(part, "lang"))[row], n_max), 1):
        at = np.flatnonzero(fits & member(bitmap, key))
        check = marks[at]
        for j in range(1, k):
            check = mix(check + marks[at + j] * _OTHER)
        out.append((k, at, key[at], check & _LOW32, texts[row[at]]))
    return out, low, start, end, row


def _count_all(bitmap: np.ndarray, n_max: int, bits: int):
    """Arrow batches -> (bucket, keys, checks, texts, counts): every occurrence of a candidate, as sorted blocks."""

    def run(stream):
        names, kinds = ["bucket", "keys", "checks", "texts", "counts"], [pa.int32()] + [pa.binary()] * 4
        parts = ((key, check.astype(np.uint32), text.astype(np.uint32)) for batch in stream for part, data, offs in batches.text_slices(batch, "text")
                 for _, _, key, check, text in _occurrences(part, data, offs, n_max, bitmap)[0])
        for key, n, check, text in _counted(parts, 1):
            cols = [x.astype("<u4") for x in (check, text, n)]
            yield _blocks([(b, key[a:z].tobytes(), *(x[a:z].tobytes() for x in cols)) for b, a, z in _edges(key, bits)], names, kinds)

    return run


def _frequent(support: int):
    def run(table: pa.Table) -> pa.Table:
        key, check, text = (_gathered(table, c, k) for c, k in (("keys", "<u8"), ("checks", "<u4"), ("texts", "<u4")))
        at, n = _summed([check, key], _gathered(table, "counts", "<u4").astype(np.int64))
        at, n = at[n >= support], n[n >= support]
        return pa.table([pa.array(key[at].view(np.int64)), pa.array(check[at].astype(np.int64)), pa.array(text[at].astype(np.int64)), pa.array(n)],
                        names=["key", "check", "text", "f"])

    return run


def _in_text(keys: np.ndarray, texts: np.ndarray) -> np.ndarray:
    return mix(keys ^ (texts * _STEP))


def _spelled(frequent: np.ndarray, spots: np.ndarray, n_max: int):
    """Arrow batches -> (key, check, lang, phrase, size) where a frequent phrase stands in the text that was noted for it."""

    def run(stream):
        seen: set = set()
        for batch in stream:
            out: list[list] = [[], [], [], [], []]
            for part, data, offs in batches.text_slices(batch, "text"):
                found, low, start, end, row = _occurrences(part, data, offs, n_max, frequent)
                raw = low.tobytes()
                langs = _column(part, "lang")
                for k, at, key, check, text in found:
                    here = np.flatnonzero(member(spots, _in_text(key, text)))
                    _, first = np.unique(key[here], return_index=True)
                    for i, x, c in zip(at[here[first]].tolist(), key[here[first]].view(np.int64).tolist(), check[here[first]].tolist()):
                        if (x, c) not in seen:
                            seen.add((x, c))
                            phrase = b" ".join(raw[start[i + j]:end[i + j]] for j in range(k)).decode("utf-8", "replace")
                            for o, v in zip(out, (x, c, langs[int(row[i])].as_py(), phrase, k)):
                                o.append(v)
            yield _blocks(list(zip(*out)), ["key", "check", "lang", "phrase", "size"], [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int32()])
            if len(seen) > 4 * KEPT:  # a phrase that is sent twice is merged later
                seen = set()

    return run


SLICES = 6  # log2 of the slices of a bitmap


def _bitmap(keys: DataFrame, column: str) -> np.ndarray:
    """Membership of the keys, by their top bits, in a bitmap of 16 to 32 bits a key, within 2**MAX_BITS bits.

    Each of 2**SLICES tasks makes a slice of it; the driver only lays them side by side."""
    bits = min(MAX_BITS, max(20, int(16 * keys.count()).bit_length()))

    def build(key, table):
        at = np.unique(table["key"].to_numpy().view(np.uint64) >> np.uint64(64 - bits)) & np.uint64((1 << (bits - SLICES)) - 1)
        out = np.zeros(1 << (bits - SLICES), np.uint8)
        out[at.astype(np.int64)] = 1
        return pa.table([pa.array([key[0].as_py()], pa.int64()), pa.array([np.packbits(out, bitorder="little").tobytes()])], names=["part", "bits"])

    top = F.shiftrightunsigned(F.col(column), 64 - SLICES).alias("part")
    parts = keys.select(top, F.col(column).alias("key")).groupBy("part").applyInArrow(build, "part long, bits binary").toArrow()
    whole = np.zeros(1 << (bits - 3), np.uint8)
    size = len(whole) >> SLICES
    for part, raw in zip(parts["part"].to_pylist(), parts["bits"]):
        whole[part * size:(part + 1) * size] = np.frombuffer(raw.as_buffer(), np.uint8)
    return whole


def member(bitmap: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Whether each key's bit is set."""
    at = keys >> np.uint64(64 - (len(bitmap) * 8 - 1).bit_length())
    return (bitmap[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1


def frequent_phrases(df: DataFrame, support: int, shards: int = 4, max_words: int = MAX_WORDS, lang: str = "lang",
                     text: str = "text") -> tuple[DataFrame, DataFrame]:
    """((lang, phrase, size, f) of all phrases of 1 to ``max_words`` words with f >= support, (lang, n) of all words)."""
    spark = df.sparkSession
    sc = spark.sparkContext
    file = F.input_file_name()  # the same in every pass, however the file is split
    docs = df.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), F.col(text).alias("text"),
                     F.pmod(F.when(file != "", F.xxhash64(file)).otherwise(F.xxhash64(F.col(text))), F.lit(shards)).cast("int").alias("shard"))
    docs = batches.small_batches(docs)
    words = docs.mapInArrow(_tally, "lang string, shard int, words long").groupBy("lang", "shard").agg(F.sum("words").alias("words"))
    words = materialize(words.filter("words > 0"), "words")
    totals = words.groupBy("lang").agg(F.sum("words").cast("long").alias("n"))
    n_words = words.agg(F.sum("words")).first()[0] or 0
    bits = max(0, min(30, (max(n_words // BUCKET_WORDS, int(spark.conf.get("spark.sql.shuffle.partitions"))) - 1).bit_length()))
    # the smallest count that reaches the shard's share of the support, in whole numbers: at most ``support`` different ones
    share = words.join(totals, "lang").select("lang", "shard", F.greatest(F.lit(1), F.expr(
        f"cast(ceil(cast(words as decimal(28,0)) * {int(support)} / cast(n as decimal(28,0))) as int)")).alias("need"))
    shared = docs.join(share, ["lang", "shard"]).select("text", "lang", "shard", "need")
    found = []
    bitmap = None
    for levels in [(1,), (2,), tuple(range(3, max_words + 1))]:
        levels = tuple(k for k in levels if k <= max_words)
        if not levels:
            break
        sent = sc.broadcast(bitmap)
        blocks = shared.mapInArrow(lambda stream, b=sent, k=levels: _mine(b.value, k, bits)(stream), "bucket int, shard int, need int, keys binary, counts binary")
        rows = materialize(blocks.groupBy("bucket").applyInArrow(_frequent_in_shard, "own long, key long"), "frequent")
        found.append(rows.select("key"))
        bitmap = _bitmap(rows, "own")
    union = found[0]
    for rows in found[1:]:
        union = union.union(rows)
    sent = sc.broadcast(_bitmap(union, "key"))
    blocks = docs.select("text", "lang").mapInArrow(lambda stream: _count_all(sent.value, max_words, bits)(stream),
                                                    "bucket int, keys binary, checks binary, texts binary, counts binary")
    counted = materialize(blocks.groupBy("bucket").applyInArrow(_frequent(support), "key long, check long, text long, f long"), "counted")

    def spots(stream):
        for batch in stream:
            key, at = (batch.column(i).to_numpy().astype(np.int64).view(np.uint64) for i in range(2))
            yield pa.RecordBatch.from_arrays([pa.array(_in_text(key, at).view(np.int64))], names=["spot"])

    noted = sc.broadcast((_bitmap(counted, "key"), _bitmap(counted.select("key", "text").mapInArrow(spots, "spot long"), "spot")))
    spelled = docs.select("text", "lang").mapInArrow(lambda stream: _spelled(*noted.value, max_words)(stream),
                                                     "key long, check long, lang string, phrase string, size int")
    spelled = spelled.groupBy("key", "check").agg(F.min(F.struct("lang", "phrase", "size")).alias("p"))
    named = counted.join(spelled, ["key", "check"]).select("p.lang", "p.phrase", "p.size", "f")
    return materialize(named, "phrases"), totals


def collocations(df: DataFrame, support: int = 30, top: int = 2000, percent: int = 80, scale: int = 2_000_000, shards: int = 4,
                 lang: str = "lang", text: str = "text") -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's ``top`` phrases of 2 to 4 words.

    l and r are the frequencies of the two parts at the cut with the lowest floor(scale * a / (l + r)). A phrase is
    left out if its words stand inside a longer candidate that has ``percent`` of its occurrences. Numbers are
    compared as decimals of up to 38 digits."""
    counts, totals = frequent_phrases(df, support, shards, MAX_WORDS, lang, text)
    words = F.split("phrase", "[ ]")
    cands = counts.filter("size >= 2").select("lang", "phrase", "size", F.col("f").alias("a"), words.alias("w"))
    joined = lambda a, n: F.array_join(F.slice("w", a, n), " ")
    cuts = cands.select("lang", "phrase", "size", "a", "w", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"))
    cuts = cuts.select("lang", "phrase", "a", "k", joined(F.lit(1), F.col("k")).alias("left"), joined(F.col("k") + 1, F.col("size") - F.col("k")).alias("right"))
    part = counts.select("lang", F.col("phrase").alias("left"), F.col("f").alias("l"))
    cuts = cuts.join(part, ["lang", "left"])
    cuts = cuts.join(part.select("lang", F.col("left").alias("right"), F.col("l").alias("r")), ["lang", "right"])
    cuts = cuts.withColumn("score", F.expr(f"cast({int(scale)} as decimal(10,0)) * cast(a as decimal(19,0)) div (cast(l as decimal(20,0)) + cast(r as decimal(20,0)))"))
    best = cuts.groupBy("lang", "phrase", "a").agg(F.min_by(F.struct("l", "r", "score"), F.struct("score", "k")).alias("b"))
    inner = cands.filter("size >= 3").select("lang", "a", "w", "size", F.explode(F.expr("sequence(2, size - 1)")).alias("m"))
    inner = inner.select("lang", "a", "w", "m", F.explode(F.expr("sequence(1, size - m + 1)")).alias("at"))
    inner = inner.groupBy("lang", joined(F.col("at"), F.col("m")).alias("phrase")).agg(F.max("a").alias("most"))
    kept = best.join(inner, ["lang", "phrase"], "left").filter(
        F.col("most").isNull() | F.expr(f"cast(100 as decimal(3,0)) * cast(most as decimal(19,0)) < cast({int(percent)} as decimal(3,0)) * cast(a as decimal(19,0))"))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = kept.select("lang", "phrase", "a", "b.l", "b.r", "b.score").withColumn("rank", F.row_number().over(order).cast("long")).filter(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
