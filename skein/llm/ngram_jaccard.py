"""N-gram Jaccard join: size-banded tiles, bitmap signatures, exact intersections.

A document's set holds the 52-bit hashes of its distinct word shingles. Documents of one set are
one class; links are sought between classes:

1. Prefix keys. With similarity t, two linked sets share one of the first n - ceil(t * n) + 1
   shingles of each in any common order. The order puts shingles last that a hashed
   count table of fixed size shows to be very common, so that shared passages
   are seldom keys. The table orders only; every order gives all links.
2. Stars. The smallest shingle hashes of a class (alike sets share them with high probability) lead
   to hubs: of each such hash, the class with the fewest uncommon shingles, which is the most
   central one of a large group of copies, and another one. The edges to the hubs that
   signatures leave room for are checked exactly; components of these links gather near copies.
3. Tiles. Keys held by more than one component are cut into tiles: a key's classes in two
   neighbouring size bands (similar sets are in the same or the next band), dealt into
   cells of bounded size. In a cell, sorted by size, pairs of different components in the size
   range are kept if their bitmaps leave room: a bit that is set in one signature only
   is a shingle that the other lacks, so bit counts bound the overlap from above. A
   signature grows with its set; cells hold it folded to a fixed width, and the pairs that
   pass there are bounded once more at full width.
4. The pairs that remain are intersected exactly as sorted arrays. Links inside a component need
   no check: they cannot change a component.

Copies are never expanded into pairs, no key's classes meet in one task, and no link
between different sets that could join two components is lost.

Defined results: a null, empty or white-space text has an empty set and is linked with
nothing; fewer words than a shingle make one shingle of all; repeated rows are copies; a null
id takes part, but names no component unless all ids in it are null; an empty table gives an
empty result; columns beside id and text are not read.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skein.llm.batches import list_array, slices, small_batches, text_bytes
from skein.llm.graph import components
from skein.llm.hashing import member, membership, mix, prefix_hash, range_hash, rows_of
from skein.session import materialize

HASH_BITS = 52  # of a shingle; the other 12 hold its row while a slice is sorted
SLICE_ROWS = 1 << (64 - HASH_BITS)
ORDER_BITS = 23  # log2 of the count table that orders shingles
ORDER_BLOCK = 1 << 17  # buckets of a block when tables are added up
SALTS = 64
STAR_KEYS = 4  # smallest hashes of a class whose stars are checked first
CELL = 512  # classes of a tile's cell, in the mean
EARLY = 8  # least shared keys of a class that go into cells with it
FOLDED = 1024  # bits of a bitmap signature in a cell; a whole one has 4 to 8 for each shingle, at least FOLDED

_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_WORD_AT = mix(np.arange(101, 165, dtype=np.uint64)) | np.uint64(1)  # a multiplier for each word of a shingle


def shingle_sets(data: np.ndarray, offs: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, rows + 1 offsets): each row's distinct shingle hashes, ascending."""
    rows = len(offs) - 1
    low = _LOWER[data]
    solid = ~_IS_SPACE[low]
    first = np.zeros(len(low) + 1, bool)
    first[offs] = True  # a row's edge parts words as white space does
    before = np.r_[False, solid[:-1]] if len(low) else solid
    after = np.r_[solid[1:], False] if len(low) else solid
    start = np.flatnonzero(solid & (~before | first[:-1]))
    end = np.flatnonzero(solid & (~after | first[1:])) + 1
    word = range_hash(prefix_hash(low), start, end)
    row = rows_of(start, offs)
    count = np.bincount(row, minlength=rows)
    begin = np.cumsum(count) - count
    last = np.maximum(count - words + 1, (count > 0).astype(count.dtype))  # shingles of each row
    of = np.repeat(np.arange(rows), last)
    at = np.arange(len(of)) - np.repeat(np.cumsum(last) - last, last) + begin[of]
    size = np.minimum(count, words)[of]
    code = size.astype(np.uint64) * np.uint64(0xA0761D6478BD642F)
    for k in range(words):
        inside = k < size
        code += np.where(inside, word[np.minimum(at + k, max(len(word) - 1, 0))] * _WORD_AT[k], np.uint64(0)) if len(word) else code
    code = np.sort((of.astype(np.uint64) << np.uint64(HASH_BITS)) | (mix(code) >> np.uint64(64 - HASH_BITS)))
    code = code[np.r_[True, code[1:] != code[:-1]]] if len(code) else code
    sizes = np.bincount((code >> np.uint64(HASH_BITS)).astype(np.int64), minlength=rows)
    return (code & np.uint64((1 << HASH_BITS) - 1)).astype(np.int64), np.r_[0, np.cumsum(sizes)].astype(np.int64)


def _sum_by_row(values: np.ndarray, offs: np.ndarray) -> np.ndarray:
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values, out=total[1:])
    return total[offs[1:]] - total[offs[:-1]]


def prefix_length(n, percent: int):
    return n - -(-percent * n // 100) + 1


def _row_slices(batch: pa.RecordBatch, column: str):
    data, offs = text_bytes(batch.column(batch.schema.get_field_index(column)))
    for a, b in slices(offs):
        for c in range(a, b, SLICE_ROWS):
            d = min(b, c + SLICE_ROWS)
            yield c, d, data[offs[c]:offs[d]], offs[c:d + 1] - offs[c]


def _packed(counts: np.ndarray) -> bytes:
    """Counts in as few bytes each as the largest needs, compressed."""
    kind = next(k for k in (np.uint8, np.uint16, np.uint32, np.uint64) if counts.max() <= np.iinfo(k).max)
    return np.dtype(kind).char.encode() + zlib.compress(counts.astype(kind).tobytes(), 1)


def _unpacked(raw: bytes) -> np.ndarray:
    return np.frombuffer(zlib.decompress(raw[1:]), np.dtype(raw[:1].decode())).astype(np.int64)


def common_buckets(docs: DataFrame, text: str, words: int) -> np.ndarray:
    """The count table's buckets (low bits of a shingle) of more shingles than chance gives, as a bitmap.

    Every task counts all its shingles in a table of fixed size; tables are added up block by block, first in
    SALTS parts, so no task holds the tables of all."""
    size = 1 << ORDER_BITS

    def run(batches):
        table = np.zeros(size, np.int32)
        for batch in batches:
            for _, _, data, offs in _row_slices(batch, "text"):
                np.add.at(table, shingle_sets(data, offs, words)[0] & (size - 1), 1)
        if table.any():
            salt = int(table[:: size >> 10].sum()) % SALTS
            for block, part in enumerate(table.reshape(-1, ORDER_BLOCK)):
                yield pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([salt], pa.int32()),
                                                  pa.array([_packed(part)], pa.binary())], names=["block", "salt", "counts"])

    def add(t: pa.Table) -> pa.Table:
        total = sum(_unpacked(x.as_py()) for x in t["counts"])
        return pa.table([t["block"].slice(0, 1), t["salt"].slice(0, 1), pa.array([_packed(total)], pa.binary())],
                        names=["block", "salt", "counts"])

    def judged(t: pa.Table) -> pa.Table:
        counts = sum(_unpacked(x.as_py()) for x in t["counts"])
        mean = counts.mean()
        often = np.flatnonzero(counts >= mean + 5 * mean**0.5 + 4) + t["block"][0].as_py() * ORDER_BLOCK
        return pa.table([pa.array(often, pa.int64())], names=["at"])

    kind = "block int, salt int, counts binary"
    counted = docs.select(F.col(text).alias("text")).mapInArrow(run, kind)
    counted = counted.groupBy("block", "salt").applyInArrow(add, kind).groupBy("block").applyInArrow(judged, "at long")
    return membership(counted, "at", ORDER_BITS)


def signatures(docs: DataFrame, common: np.ndarray, ident: str, text: str, words: int, percent: int) -> DataFrame:
    """(id, rid, a, b, n, rare, star, prefix, bits, folded) per document: a, b name its set, rid the row, rare is its
    number of uncommon shingles, star holds its smallest hashes."""
    common_of = docs.sparkSession.sparkContext.broadcast(common)  # fixed size

    def run(batches):
        common = common_of.value
        for batch in batches:
            for lo, hi, data, offs in _row_slices(batch, "text"):
                codes, ends = shingle_sets(data, offs, words)
                n = np.diff(ends)
                row = np.repeat(np.arange(len(n)), n)
                u = codes.view(np.uint64)
                a = _sum_by_row(mix(u + np.uint64(1)), ends).view(np.int64)
                b = _sum_by_row(mix(u ^ np.uint64(0x5851F42D4C957F2D)), ends).view(np.int64)
                late = member(common, codes)
                seen = np.cumsum(late) - late  # common ones before, in all rows
                mine = seen - seen[np.minimum(ends[:-1], max(len(seen) - 1, 0))][row] if len(codes) else seen
                at = np.arange(len(codes)) - ends[:-1][row]
                rare = n - np.bincount(row, late, len(n)).astype(np.int64)
                rank = np.where(late, rare[row] + mine, at - mine)
                take = np.flatnonzero(rank < prefix_length(n, percent)[row])
                order = take[np.lexsort((rank[take], row[take]))]
                held = np.bincount(row[order], minlength=len(n))
                least = np.flatnonzero(at < STAR_KEYS)
                stars = np.r_[0, np.cumsum(np.minimum(n, STAR_KEYS))]
                width = np.maximum(FOLDED, 1 << np.ceil(np.log2(np.maximum(4 * n, 1))).astype(np.int64))
                place = np.r_[0, np.cumsum(width)]
                bits = np.zeros(place[-1], bool)
                bits[place[row] + ((codes >> 20) & (width[row] - 1))] = True
                packed = np.packbits(bits).tobytes()
                folded = np.zeros((len(n), FOLDED), bool)
                folded[row, (codes >> 20) & (FOLDED - 1)] = True
                small = np.packbits(folded, axis=1).tobytes()
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(lo, hi - lo), batch.column(1).slice(lo, hi - lo), pa.array(a), pa.array(b), pa.array(n, pa.int64()),
                    pa.array(rare, pa.int64()), list_array(codes[least], stars, pa.int64()), list_array(codes[order], np.r_[0, np.cumsum(held)], pa.int64()),
                    pa.array([packed[x // 8:y // 8] for x, y in zip(place, place[1:])], pa.binary()),
                    pa.array([small[x:x + FOLDED // 8] for x in range(0, len(small), FOLDED // 8)], pa.binary())],
                    names=["id", "rid", "a", "b", "n", "rare", "star", "prefix", "bits", "folded"])

    rows = docs.select(F.col(ident).alias("id"), F.xxhash64(text, ident).alias("rid"), F.col(text).alias("text"))
    id_type = docs.schema[ident].dataType.simpleString()
    return rows.mapInArrow(run, f"id {id_type}, rid long, a long, b long, n long, rare long, star array<long>, prefix array<long>, bits binary, folded binary")


def _sets(docs: DataFrame, wanted: DataFrame, ident: str, text: str, words: int) -> DataFrame:
    """(a, set) of the rows whose rid is wanted (and a few others), hashed again from their texts."""
    bitmap_of = docs.sparkSession.sparkContext.broadcast(membership(wanted, "rid"))

    def run(batches):
        bitmap = bitmap_of.value
        for batch in batches:
            batch = batch.filter(pa.array(member(bitmap, batch.column(0).to_numpy(zero_copy_only=False))))
            for _, _, data, offs in _row_slices(batch, "text"):
                codes, ends = shingle_sets(data, offs, words)
                a = _sum_by_row(mix(codes.view(np.uint64) + np.uint64(1)), ends).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(a), list_array(codes, ends, pa.int64())], names=["a", "set"])

    rows = docs.select(F.xxhash64(text, ident).alias("rid"), F.col(text).alias("text"))
    return rows.mapInArrow(run, "a long, set array<long>")


def _verify(pairs: DataFrame, classes: DataFrame, docs: DataFrame, ident: str, text: str, words: int, percent: int) -> DataFrame:
    """The pairs (u, v) that link, by exact intersection of their sorted arrays."""
    nodes = pairs.select(F.col("u").alias("a")).union(pairs.select("v")).distinct()
    wanted = materialize(nodes.join(classes.select("a", "rid"), "a"), "wanted")
    sets = _sets(docs, wanted, ident, text, words).join(wanted.select("a"), "a", "left_semi").dropDuplicates(["a"])
    sets = materialize(sets, "sets")
    joined = pairs.join(sets.select(F.col("a").alias("u"), F.col("set").alias("x")), "u").join(
        sets.select(F.col("a").alias("v"), F.col("set").alias("y")), "v").select("u", "v", "x", "y")

    def run(batches):
        for whole in batches:
            for c in range(0, whole.num_rows, 256):
                batch = whole.slice(c, 256)
                parts, sizes = [], []
                for k in (2, 3):
                    col = batch.column(k)
                    size = np.diff(col.offsets.to_numpy())
                    parts.append((np.repeat(np.arange(len(size)), size).astype(np.uint64) << np.uint64(HASH_BITS))
                                 | col.flatten().to_numpy().view(np.uint64))
                    sizes.append(size)
                both = np.sort(np.concatenate(parts))
                twice = both[1:][both[1:] == both[:-1]]
                common = np.bincount((twice >> np.uint64(HASH_BITS)).astype(np.int64), minlength=batch.num_rows)
                linked = 100 * common >= percent * (sizes[0] + sizes[1] - common)
                yield batch.select([0, 1]).filter(pa.array(linked))

    return materialize(joined.mapInArrow(run, "u long, v long"), "links")


def _room(x: np.ndarray, y: np.ndarray, n: np.ndarray, m: np.ndarray, percent: int) -> np.ndarray:
    """Whether signatures x, y (rows of words) of sets of n, m shingles leave room for a link."""
    lacks_y = np.bitwise_count(x & ~y).sum(1, dtype=np.int64)
    lacks_x = np.bitwise_count(y & ~x).sum(1, dtype=np.int64)
    most = np.minimum(n - lacks_y, m - lacks_x)
    return 100 * most >= percent * (n + m - most)


def _cells(members: DataFrame, signed: DataFrame, percent: int) -> DataFrame:
    """Pairs (u, v) of different components that share a key and may link, from tiles of bounded cells.

    A pair comes out of one tile (that of the smaller band) and one cell (that of the two parts) of a key. Of the keys that it shares it
    comes out of the first one, if that is among the EARLY least keys of both; else of all."""
    band = F.floor(F.log(F.col("n").cast("double")) / math.log(100 / percent)).cast("int")
    early = members.groupBy("a").agg(F.slice(F.sort_array(F.collect_set("key")), 1, EARLY).alias("early"))  # a class's own prefix keys
    tiled = members.withColumn("band", band).withColumn("tile", F.explode(F.array(F.col("band") - 1, F.col("band"))))
    crowd = tiled.groupBy("key", "tile").agg(F.count(F.lit(1)).alias("m"), F.min("component").alias("lo"), F.max("component").alias("hi"))
    crowd = crowd.filter("lo <> hi").select("key", "tile", F.ceil(F.col("m") / CELL).cast("int").alias("parts"))
    own = F.pmod(F.xxhash64("a"), F.col("parts")).cast("int")
    dealt = tiled.join(crowd, ["key", "tile"]).withColumn("own", own).withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    dealt = dealt.select(F.xxhash64("key", "tile", F.least("own", "other"), F.greatest("own", "other")).alias("cell"), "n", "a", "component",
                         "key", (F.col("tile") == F.col("band")).alias("lower"), "own", (F.col("own") == F.col("other")).alias("diagonal"))
    bits = signed.select("a", "folded").dropDuplicates(["a"]).join(early, "a")
    dealt = dealt.join(bits, "a").select("cell", "n", "a", "component", "folded", "key", "lower", "own", "diagonal", "early")
    dealt = dealt.repartition("cell").sortWithinPartitions("cell", "n", "a")

    def pairs_of(t: pa.Table) -> pa.RecordBatch:
        cell, n, a, comp = (t.column(k).to_numpy() for k in range(4))
        bits = np.frombuffer(b"".join(t.column(4).to_pylist()), np.uint64).reshape(len(a), -1)
        key, lower, own, diagonal = (t.column(k).to_numpy() for k in range(5, 9))
        lists = t.column(9).combine_chunks()
        size = np.diff(lists.offsets.to_numpy())
        firsts = np.full((len(a), EARLY), -1, np.int64)  # keys are not negative
        firsts[np.repeat(np.arange(len(a)), size), np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)] = lists.flatten().to_numpy()
        out, i, d = [], np.arange(len(a)), 1
        while True:
            i = i[i + d < len(a)]
            i = i[(cell[i + d] == cell[i]) & (percent * n[i + d] <= 100 * n[i])]  # sorted by size: farther ones fail too
            if not len(i):
                break
            # here and nowhere else: the tile of the smaller band (the first in size), and of equal parts the cell with itself
            k = i[(comp[i] != comp[i + d]) & lower[i] & ((own[i] != own[i + d]) | diagonal[i])]
            for c in range(0, len(k), 1 << 14):
                x = k[c:c + (1 << 14)]
                y = x + d
                ok = _room(bits[x], bits[y], n[x], n[y], percent)
                x, y = x[ok], y[ok]
                before = np.where(firsts[x] < key[x][:, None], firsts[x], -1)
                met = ((before[:, :, None] == firsts[y][:, None, :]) & (before[:, :, None] >= 0)).any(axis=(1, 2))
                x, y = x[~met], y[~met]
                out.append(np.stack([np.minimum(a[x], a[y]), np.maximum(a[x], a[y])]))
            d += 1
        u, v = np.concatenate(out, axis=1) if out else np.zeros((2, 0), np.int64)
        return pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=["u", "v"])

    def run(batches):
        rest = None
        for batch in batches:  # a cell may reach over batches: its rows wait for their end
            t = pa.Table.from_batches([batch]) if rest is None else pa.concat_tables([rest, pa.Table.from_batches([batch])])
            cell = t.column(0).to_numpy()
            cut = int(np.searchsorted(cell, cell[-1]))
            if cut:
                yield pairs_of(t.slice(0, cut).combine_chunks())
            rest = t.slice(cut)
        if rest is not None:
            yield pairs_of(rest.combine_chunks())

    return dealt.mapInArrow(run, "u long, v long").distinct()


def _bounded(pairs: DataFrame, signed: DataFrame, percent: int) -> DataFrame:
    """The pairs that whole signatures leave room for."""
    bits = signed.select("a", "n", "bits").dropDuplicates(["a"])
    joined = pairs.join(bits.select(F.col("a").alias("u"), F.col("n").alias("un"), F.col("bits").alias("ub")), "u").join(
        bits.select(F.col("a").alias("v"), F.col("n").alias("vn"), F.col("bits").alias("vb")), "v").select("u", "v", "un", "vn", "ub", "vb")

    def run(batches):
        for batch in batches:
            n, m = batch.column(2).to_numpy(), batch.column(3).to_numpy()
            ok = np.zeros(batch.num_rows, bool)
            for i, (x, y) in enumerate(zip(batch.column(4).to_pylist(), batch.column(5).to_pylist())):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                least = min(len(x), len(y))  # the wider one is folded: its place modulo the width
                x, y = (np.bitwise_or.reduce(z.reshape(-1, least), axis=0)[None] for z in (x, y))
                ok[i] = _room(x, y, n[i:i + 1], m[i:i + 1], percent)[0]
            yield batch.select([0, 1]).filter(pa.array(ok))

    return joined.mapInArrow(run, "u long, v long")


def _keys(signed: DataFrame, component: DataFrame, held: np.ndarray) -> DataFrame:
    """(key, a, n, component) for the prefix keys that may be in ``held``."""
    held_of = signed.sparkSession.sparkContext.broadcast(held)

    def run(batches):
        held = held_of.value
        for batch in batches:
            col = batch.column(0)
            size = np.diff(col.offsets.to_numpy())
            keys = col.flatten().to_numpy()
            take = member(held, keys)
            row = pa.array(np.repeat(np.arange(len(size)), size)[take])
            yield pa.RecordBatch.from_arrays([pa.array(keys[take]), *(batch.column(k).take(row) for k in range(1, 4))],
                                             names=["key", "a", "n", "component"])

    rows = signed.select("prefix", "a", "n").join(component, "a", "left").select(
        "prefix", "a", "n", F.coalesce("component", "a").alias("component"))
    return rows.mapInArrow(run, "key long, a long, n long, component long")


def _linked(docs: DataFrame, ident: str, text: str, words: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """(signatures, (a, head)): head is the (id is null, id, rid) of its component's smallest document."""
    common = common_buckets(small_batches(docs), text, words)
    signed = materialize(signatures(docs, common, ident, text, words, percent), "signed")
    full = signed.filter("n > 0")
    head = F.struct(F.col("id").isNull().alias("no_id"), "id", "rid")
    classes = materialize(full.groupBy("a", "b").agg(F.min(head).alias("head")).withColumn("rid", F.col("head.rid")), "classes")

    firsts = full.select("a", "n", "rare", F.explode("star").alias("key"))
    hub, other = F.struct("rare", "a", "n"), F.struct("a", "n")
    hubs = firsts.groupBy("key").agg(F.min(hub).alias("hub"), F.min(other).alias("lo"), F.max(other).alias("hi")).filter("lo.a <> hi.a")
    hubs = hubs.select("key", F.array(F.struct("hub.a", "hub.n"), "hi").alias("hubs"))
    star = firsts.join(hubs, "key").select("a", "n", F.explode("hubs").alias("h")).filter(
        (F.col("a") != F.col("h.a")) & (percent * F.greatest("n", "h.n") <= 100 * F.least("n", "h.n")))
    star = star.select(F.least("a", "h.a").alias("u"), F.greatest("a", "h.a").alias("v")).distinct()
    star = materialize(_bounded(star, full, percent), "star")
    links = _verify(star, classes, docs, ident, text, words, percent)
    near = components(links).select(F.col("node").alias("a"), "component")

    keyed = full.select("a", "prefix").join(near, "a", "left").select(
        F.explode("prefix").alias("key"), F.coalesce("component", "a").alias("component"))
    mixed = keyed.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).filter("lo <> hi").select("key")
    mixed = materialize(mixed, "mixed_keys")
    members = _keys(full, near, membership(mixed, "key")).join(mixed, "key", "left_semi").dropDuplicates(["key", "a"])
    pairs = materialize(_cells(materialize(members, "members"), full, percent), "pairs")
    pairs = materialize(_bounded(pairs, full, percent), "bounded")
    found = _verify(pairs, classes, docs, ident, text, words, percent)

    to = near.select(F.col("a").alias("u"), F.col("component").alias("cu"))
    joined = found.join(to, "u", "left").join(to.select(F.col("u").alias("v"), F.col("cu").alias("cv")), "v", "left")
    late = components(joined.select(F.coalesce("cu", "u").alias("u"), F.coalesce("cv", "v").alias("v")))
    nodes = classes.select("a", "head").join(near, "a", "left").select("a", "head", F.coalesce("component", "a").alias("c"))
    nodes = nodes.join(late.select(F.col("node").alias("c"), F.col("component").alias("c2")), "c", "left").select(
        "a", "head", F.coalesce("c2", "c").alias("c"))
    smallest = nodes.groupBy("c").agg(F.min("head").alias("head"))
    return signed, nodes.select("a", "c").join(smallest, "c").select("a", "head")


def jaccard_components(docs: DataFrame, ident: str = "doc_id", text: str = "text", words: int = 5, percent: int = 80) -> DataFrame:
    """(ident, n_shingles, component_id) per row: documents link when 100 * intersection >= percent * union."""
    signed, heads = _linked(docs, ident, text, words, percent)
    out = signed.select("id", "a", "n").join(heads, "a", "left")
    return out.select(F.col("id").alias(ident), F.col("n").alias("n_shingles"),
                      F.when(F.col("n") > 0, F.col("head.id")).otherwise(F.col("id")).alias("component_id"))


def deduplicate(docs: DataFrame, ident: str = "doc_id", text: str = "text", words: int = 5, percent: int = 80) -> DataFrame:
    """One row of every component, the one with the smallest id, all columns kept; rows without words all stay."""
    signed, heads = _linked(docs, ident, text, words, percent)
    stay = heads.select(F.col("head.rid").alias("__rid"), F.lit(True).alias("__one")).distinct()
    stay = stay.union(signed.filter("n = 0").select("rid", F.lit(False)).distinct())
    rows = docs.withColumn("__rid", F.xxhash64(text, ident)).join(materialize(stay, "heads"), "__rid")
    one = rows.filter("__one").dropDuplicates(["__rid"])  # repeated rows are one component, too
    return one.unionByName(rows.filter("not __one")).select(*docs.columns)
