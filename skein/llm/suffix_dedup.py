"""Removal of repeated byte strings by a common-prefix-aware distributed merge sort.

A byte goes if a string of ``length`` bytes that covers it starts anywhere else, too. Not
every suffix is sorted, only enough of them to decide every window of ``length`` bytes:

1. Winnowing. In each window, the leftmost smallest hash among its grams of a quarter of ``length`` marks
   a position. Equal windows mark equal places, so equal windows share a marked gram
   at the same offset; about one position in ``3 * length / 8`` is marked.
2. A marked position's context holds all windows that it decides: up to three quarters of length
   before it and ``length`` bytes from it on. Contexts are counted by hash, first inside
   each task, then by gram. A context with a copy decides all its windows; a gram with
   one context and no copy is dropped. What is left are grams with different contexts.
3. Merge sort. Each map task sorts the suffixes that start at its left-over positions into one run for
   each bucket and front-codes it: a suffix is the length it shares with the one before it and the
   rest. Runs are exchanged and merged by loser trees that hold for each head how much it
   shares with the last suffix given out: heads with different values are ordered by
   these alone, others are compared from there on.
4. In the merged order a gram's contexts are neighbours. Windows that start d bytes before the
   gram are equal if the suffixes share length - d bytes and the texts before them d bytes: both
   are segments of a sorted order, so equal pairs of segments are equal windows.
   A gram with more than HOT contexts (a passage with many neighbours) is split first: windows that start
   lo to hi bytes before the gram share the lo bytes before it and the suffix's first length - hi. Contexts
   are grouped by these, range after range halved; a group of one is dropped, contexts alike in all windows of
   the range are decided by their count and one stands for them, and a group of HOT or less goes to one task.
5. The windows found are brought back to all positions by context, and merged per text.

Memory is bounded by batches, runs and buckets (whose number follows their count, with groups of HOT contexts
at most); copies are pre-aggregated over GATHERED positions, so a group of a third of all rows is a few rows of each such part.

Defined results: a null or empty text has no bytes and keeps none; texts shorter than
``length`` keep all; repeated rows are copies, so all their bytes go from ``length`` on;
an empty table stays empty; columns beside the text are passed through.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skein.llm.batches import list_array, slices, small_batches, text_bytes
from skein.llm.hashing import member, membership, mix, powers, prefix_hash, range_hash
from skein.session import materialize

BUCKET_SUFFIXES = 20_000  # suffixes of a bucket, in the mean, and of a run, at most
GATHERED = 200_000  # marked positions combined at once
_LAST = np.uint64(0xFFFFFFFFFFFFFFFF)
HOT = 5_000  # contexts of a gram, or of a part of its contexts, that one task may compare
PAIRWISE = 64  # up to so many contexts of a gram are compared two by two: quicker than all offsets at once


def gram_bytes(length: int) -> int:
    """Size of the grams that mark windows: longer ones mark more places, shorter ones leave more of them open."""
    return max(1, length // 4)


def marked(data: np.ndarray, offs: np.ndarray, length: int):
    """(positions, gram hashes, context hashes, bytes before, bytes from there on) of marked positions."""
    gram = gram_bytes(length)
    span = length - gram + 1  # grams of a window
    n, none = len(data), np.zeros(0, np.int64)
    if n < length:
        return none, none.view(np.uint64), none.view(np.uint64), none, none
    prefix = prefix_hash(data)
    places = n - gram + 1
    bits = max(22, int(n).bit_length())
    low = np.uint64((1 << bits) - 1)
    key = prefix[gram:] - prefix[:places]
    key *= powers(n)[1][:places]
    key *= np.uint64(0xD1342543DE82EF95)  # the high bits order the grams
    key &= ~low
    key |= np.arange(places, dtype=np.uint64)
    free = np.ones(n - length + 1, bool)  # windows inside one row
    for end in offs[1:-1].tolist():  # grams over a row's edge never win
        key[max(end - gram + 1, 0):end] = _LAST
        free[max(end - length + 1, 0):end] = False
    block = np.full(-(-places // span) * span, _LAST)
    block[:places] = key
    block = block.reshape(-1, span)
    head = np.minimum.accumulate(block, axis=1).ravel()
    tail = np.minimum.accumulate(block[:, ::-1], axis=1)[:, ::-1].ravel()
    least = np.minimum(tail[:len(free)], head[span - 1:span - 1 + len(free)])[free] & low
    if not len(least):
        return none, none.view(np.uint64), none.view(np.uint64), none, none
    pos = least[np.r_[True, least[1:] != least[:-1]]].astype(np.int64)  # they only move to the right
    code = range_hash(prefix, pos, pos + gram)
    row = np.searchsorted(offs, pos, side="right") - 1
    before = np.minimum(pos - offs[row], length - gram)
    after = np.minimum(offs[row + 1] - pos, length)
    context = mix(range_hash(prefix, pos - before, pos + after) + before.astype(np.uint64) * np.uint64(0x9FB21C651E98DF25))
    return pos, code, context, before, after


def _marked_rows(batch: pa.RecordBatch, length: int):
    """Slices of a (rid, text) batch: rid, bytes and marked positions in their rows."""
    rid = batch.column(0).to_numpy(zero_copy_only=False)
    data, offs = text_bytes(batch.column(1))
    for a, b in slices(offs):
        part, po = data[offs[a]:offs[b]], offs[a:b + 1] - offs[a]
        pos, gram, context, before, after = marked(part, po, length)
        row = np.searchsorted(po, pos, side="right") - 1
        yield part, rid[a + row], pos, pos - po[row], gram.view(np.int64), context.view(np.int64), before, after


def _gathered(parts):
    """Lists of (arrays, ...) of GATHERED rows or more together, so that copies are combined over many batches."""
    held, size = [], 0
    for part in parts:
        held.append(part)
        size += len(part[0])
        if size >= GATHERED:
            yield held
            held, size = [], 0
    if size:
        yield held


def _place(rid: np.ndarray, at: np.ndarray) -> np.ndarray:
    return mix(rid.view(np.uint64) + at.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)).view(np.int64)


def contexts(rows: DataFrame, length: int) -> DataFrame:
    """(gram, context, n, place, kinds, total): how often each context occurs, one place of it, and how many
    contexts and positions its gram has."""

    def run(batches):
        for got in _gathered((x[1], x[3], x[4], x[5]) for batch in batches for x in _marked_rows(batch, length)):
            rid, at, gram, context = (np.concatenate(x) for x in zip(*got))
            place = _place(rid, at)
            order = np.lexsort((place, context, gram))
            gram, context, place = gram[order], context[order], place[order]
            first = np.flatnonzero(np.r_[True, (gram[1:] != gram[:-1]) | (context[1:] != context[:-1])]) if len(gram) else order
            n = np.diff(np.r_[first, len(gram)])
            yield pa.RecordBatch.from_arrays([pa.array(gram[first]), pa.array(context[first]), pa.array(n, pa.int64()),
                                              pa.array(place[first])], names=["gram", "context", "n", "place"])

    seen = rows.mapInArrow(run, "gram long, context long, n long, place long")
    counted = materialize(seen.groupBy("gram", "context").agg(F.sum("n").alias("n"), F.min("place").alias("place")), "counted")
    by_gram = counted.groupBy("gram").agg(F.count(F.lit(1)).alias("kinds"), F.sum("n").alias("total")).filter("total > 1")
    return counted.join(by_gram, "gram").select("gram", "context", "n", "place", "kinds", "total")


def shared(a: bytes, b: bytes, known: int = 0) -> int:
    """Length of the common prefix, of which ``known`` bytes need no look."""
    n = min(len(a), len(b))
    h = known
    stop = min(n, h + 4)
    while h < stop and a[h] == b[h]:
        h += 1
    if h < stop or h == n:
        return h
    if a[h:n] == b[h:n]:
        return n
    lo, hi = h, n  # a[h:lo] agrees, a[h:hi] doesn't
    while hi - lo > 1:
        mid = (lo + hi) // 2
        if a[lo:mid] == b[lo:mid]:
            lo = mid
        else:
            hi = mid
    return lo


def front_code(sorted_suffixes: list[bytes]) -> tuple[list[int], list[bytes]]:
    """(shared with the one before, rest) of each."""
    out, rest, last = [], [], b""
    for s in sorted_suffixes:
        h = shared(last, s)
        out.append(h)
        rest.append(s[h:])
        last = s
    return out, rest


def merge_runs(runs: list[tuple[list[int], list[bytes]]]):
    """Merges front-coded sorted runs: yields (run, index in it, suffix, shared with the one before).

    A loser tree over the runs' heads. ``common[r]`` is what the head of run r shares with the last
    suffix given out (or with the winner it lost to, whose place in the order is the same): of two heads the one
    that shares more is smaller; if both share alike, bytes are compared from there on.
    """
    k = 1
    while k < len(runs):
        k *= 2
    at = [0] * len(runs)
    head: list[bytes | None] = [rest[0] if rest else None for _, rest in runs] + [None] * (k - len(runs))
    common = [0] * k
    loser = [0] * k

    def play(x: int, y: int) -> tuple[int, int]:
        """(winner, loser); the loser's common becomes what it shares with the winner."""
        a, b = head[x], head[y]
        if a is None or b is None:
            return (y, x) if a is None else (x, y)
        if common[x] != common[y]:
            return (x, y) if common[x] > common[y] else (y, x)
        h = shared(a, b, common[x])
        if h == len(a) or (h < len(b) and a[h] < b[h]):
            common[y] = h
            return x, y
        common[x] = h
        return y, x

    best = list(range(k))  # winners of the first round, bottom up
    node = k
    while len(best) > 1:
        node //= 2
        up = []
        for i in range(0, len(best), 2):
            win, lose = play(best[i], best[i + 1])
            loser[node + i // 2] = lose
            up.append(win)
        best = up
    win = best[0]
    while head[win] is not None:
        suffix = head[win]
        yield win, at[win], suffix, common[win]
        at[win] += 1
        lcps, rests = runs[win]
        if at[win] < len(rests):
            common[win] = lcps[at[win]]
            head[win] = suffix[:lcps[at[win]]] + rests[at[win]]
        else:
            head[win] = None
        node = (win + k) // 2
        while node:
            win, loser[node] = play(win, loser[node])
            node //= 2


def joined_ranges(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The same whole numbers in as few ranges [lo, hi] as can be."""
    out: list[tuple[int, int]] = []
    for lo, hi in sorted(ranges):
        if out and lo <= out[-1][1] + 1:
            out[-1] = (out[-1][0], max(out[-1][1], hi))
        else:
            out.append((lo, hi))
    return out


def equal_windows(before: list[bytes], suffixes: list[bytes], lcp: list[int], length: int) -> list[list[tuple[int, int]]]:
    """For each context of one gram, in suffix order: ranges [lo, hi] of d whose window, d bytes before the
    gram, another context has, too. before: the bytes before the gram, reversed; lcp[i]: suffixes i - 1 and i."""
    m, half = len(suffixes), length - gram_bytes(length)
    out: list[list[tuple[int, int]]] = [[] for _ in range(m)]
    if m <= PAIRWISE:
        for i in range(m):
            right = length
            for j in range(i + 1, m):
                right = min(right, lcp[j])
                left = shared(before[i], before[j])
                if left + right >= length:
                    out[i].append((length - right, left))
                    out[j].append((length - right, left))
        return [joined_ranges(r) for r in out]
    order = sorted(range(m), key=before.__getitem__)
    left = np.array([0] + [shared(before[order[i - 1]], before[order[i]]) for i in range(1, m)])
    place = np.empty(m, np.int64)
    place[order] = np.arange(m)
    right, reach, back = np.array(lcp), np.array([len(s) for s in suffixes]), np.array([len(b) for b in before])
    hit = np.zeros((half + 2, m), bool)  # [d + 1]
    for d in range(half + 1):
        pair = np.cumsum(right < length - d) * (m + 1) + np.cumsum(left < d)[place]
        can = np.flatnonzero((reach >= length - d) & (back >= d))
        _, of, count = np.unique(pair[can], return_inverse=True, return_counts=True)
        hit[d + 1, can] = count[of] > 1
    hit = np.vstack([hit, np.zeros((1, m), bool)])
    edge = np.diff(hit.astype(np.int8), axis=0)
    for i in np.flatnonzero(hit.any(0)):
        out[i] = list(zip(np.flatnonzero(edge[:, i] == 1).tolist(), (np.flatnonzero(edge[:, i] == -1) - 1).tolist()))
    return out


def _runs(rows: DataFrame, grams: np.ndarray, places: np.ndarray, hot: np.ndarray, buckets: int, length: int) -> DataFrame:
    """One sorted, front-coded run of suffixes per map task and bucket; ``hot`` grams are left to ``_split``."""
    sc = rows.sparkSession.sparkContext
    grams_of, places_of, hot_of = sc.broadcast(grams), sc.broadcast(places), sc.broadcast(hot)
    names = ["bucket", "lcp", "rest", "ends", "before", "before_ends", "gram", "context"]

    def give(kept: dict):
        by: dict[int, list] = {}
        for key, (suffix, before) in kept.items():
            by.setdefault(int(np.uint64(key[0] & 0xFFFFFFFFFFFFFFFF) >> np.uint64(20)) % buckets, []).append((suffix, before, *key))
        for bucket, run in by.items():
            run.sort()
            lcp, rest = front_code([x[0] for x in run])
            yield pa.RecordBatch.from_arrays([
                pa.array([bucket], pa.int32()), pa.array([lcp], pa.list_(pa.int32())), pa.array([b"".join(rest)], pa.binary()),
                pa.array([np.cumsum([len(x) for x in rest])], pa.list_(pa.int32())), pa.array([b"".join(x[1] for x in run)], pa.binary()),
                pa.array([np.cumsum([len(x[1]) for x in run])], pa.list_(pa.int32())), pa.array([[x[2] for x in run]], pa.list_(pa.int64())),
                pa.array([[x[3] for x in run]], pa.list_(pa.int64()))], names=names)

    def run(batches):
        grams, places, hot = grams_of.value, places_of.value, hot_of.value
        kept: dict = {}
        size = 0
        for batch in batches:
            for part, rid, pos, at, gram, context, before, after in _marked_rows(batch, length):
                for i in np.flatnonzero(member(grams, gram) & ~member(hot, gram) & member(places, _place(rid, at))):
                    key = (int(gram[i]), int(context[i]))
                    if key not in kept:
                        p = int(pos[i])
                        kept[key] = (part[p:p + int(after[i])].tobytes(), part[p - int(before[i]):p][::-1].tobytes())
                        size += 1
            if size > BUCKET_SUFFIXES:  # bounds a task's memory: more runs, not longer ones
                yield from give(kept)
                kept, size = {}, 0
        yield from give(kept)

    return rows.mapInArrow(run, "bucket int, lcp array<int>, rest binary, ends array<int>, before binary, before_ends array<int>, "
                                "gram array<long>, context array<long>")


def _merged(runs: DataFrame, length: int) -> DataFrame:
    """(gram, context, lo, hi): equal windows found in the merged order of each bucket."""
    gram_size = gram_bytes(length)

    def cut(raw: bytes, ends: list[int]) -> list[bytes]:
        return [raw[a:b] for a, b in zip([0, *ends], ends)]

    def merge(t: pa.Table) -> pa.Table:
        cols = t.to_pydict()
        before = [cut(b, e) for b, e in zip(cols["before"], cols["before_ends"])]
        found: list[tuple[int, int, int, int]] = []
        group: list[tuple[int, int, bytes]] = []
        lcps: list[int] = []

        def close():
            if len(group) > 1:
                # equal suffixes may have come with equal contexts from several tasks: one of them stands for all
                names = [(cols["gram"][r][i], cols["context"][r][i]) for r, i, _ in group]
                keep, low, seen, joined = [], 0, set(), []
                for x, name in enumerate(names):
                    low = min(low, lcps[x]) if x else 0
                    if name in seen:
                        continue
                    seen.add(name)
                    joined.append(low if keep else 0)
                    keep.append(x)
                    low = 1 << 30
                if len(keep) > 1:
                    windows = equal_windows([before[group[x][0]][group[x][1]] for x in keep], [group[x][2] for x in keep], joined, length)
                    for x, ranges in zip(keep, windows):
                        found.extend((*names[x], lo, hi) for lo, hi in set(ranges))
            group.clear()
            lcps.clear()

        for r, i, suffix, common in merge_runs([(lcp, cut(rest, ends)) for lcp, rest, ends in zip(cols["lcp"], cols["rest"], cols["ends"])]):
            if common < gram_size:
                close()
            group.append((r, i, suffix))
            lcps.append(common)
        close()
        gram, context, lo, hi = zip(*found) if found else ((), (), (), ())
        return pa.table([pa.array(gram, pa.int64()), pa.array(context, pa.int64()), pa.array(lo, pa.int32()), pa.array(hi, pa.int32())],
                        names=["gram", "context", "lo", "hi"])

    return runs.groupBy("bucket").applyInArrow(merge, "gram long, context long, lo int, hi int")


def _hot_contexts(rows: DataFrame, places: np.ndarray, hot: np.ndarray, length: int) -> DataFrame:
    """(gram, context, before, suffix) of the contexts of hot grams, each once; before is reversed."""
    sc = rows.sparkSession.sparkContext
    places_of, hot_of = sc.broadcast(places), sc.broadcast(hot)

    def run(batches):
        places, hot = places_of.value, hot_of.value
        for batch in batches:
            for part, rid, pos, at, gram, context, before, after in _marked_rows(batch, length):
                take = np.flatnonzero(member(hot, gram) & member(places, _place(rid, at)))
                ends = [(int(pos[i]), int(before[i]), int(after[i])) for i in take]
                yield pa.RecordBatch.from_arrays([
                    pa.array(gram[take]), pa.array(context[take]), pa.array([part[p - b:p][::-1].tobytes() for p, b, _ in ends], pa.binary()),
                    pa.array([part[p:p + a].tobytes() for p, _, a in ends], pa.binary())], names=["gram", "context", "before", "suffix"])

    got = rows.mapInArrow(run, "gram long, context long, before binary, suffix binary")
    return got.dropDuplicates(["gram", "context"])


def _compared(parts: DataFrame, buckets: int, length: int) -> DataFrame:
    """(gram, context, lo, hi): equal windows inside the groups (key) of HOT contexts or less."""

    def compare(t: pa.Table) -> pa.Table:
        cols = t.to_pydict()
        order = sorted(range(len(t)), key=lambda i: (cols["key"][i], cols["suffix"][i]))
        found: list[tuple[int, int, int, int]] = []
        start = 0
        for end in range(1, len(order) + 1):
            if end < len(order) and cols["key"][order[end]] == cols["key"][order[start]]:
                continue
            of = order[start:end]
            start = end
            suffixes = [cols["suffix"][i] for i in of]
            lcp = [0] + [shared(a, b) for a, b in zip(suffixes, suffixes[1:])]
            for i, ranges in zip(of, equal_windows([cols["before"][i] for i in of], suffixes, lcp, length)):
                inside = {(max(lo, cols["lo"][i]), min(hi, cols["hi"][i])) for lo, hi in ranges}
                found.extend((cols["gram"][i], cols["context"][i], lo, hi) for lo, hi in inside if lo <= hi)
        gram, context, lo, hi = zip(*found) if found else ((), (), (), ())
        return pa.table([pa.array(gram, pa.int64()), pa.array(context, pa.int64()), pa.array(lo, pa.int32()), pa.array(hi, pa.int32())],
                        names=["gram", "context", "lo", "hi"])

    bucket = F.pmod(F.col("key"), F.lit(buckets)).alias("bucket")
    rows = parts.select(bucket, "key", "gram", "context", "lo", "hi", "before", "suffix")
    return rows.groupBy("bucket").applyInArrow(compare, "gram long, context long, lo int, hi int")


def _split(hot: DataFrame, length: int) -> DataFrame:
    """(gram, context, lo, hi): equal windows of hot grams' contexts; nothing of a gram's size is in one task.

    A group shares ``lo`` bytes before the gram and the suffix's first ``length - hi``: all that windows from lo to hi bytes
    before it have in common. A range of one window is decided by counts alone, so halving ends there at the latest."""
    shuffles = int(hot.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    found = None
    todo = hot.select("gram", "context", "before", "suffix", F.lit(0).alias("lo"), F.lit(length - gram_bytes(length)).alias("hi"))
    while True:
        mid = F.expr("cast((lo + hi) div 2 as int)")
        halves = F.array(F.struct(F.col("lo"), mid.alias("hi")), F.struct((mid + 1).alias("lo"), F.col("hi")))
        part = todo.select("gram", "context", "before", "suffix", F.explode(halves).alias("r")).select(
            "gram", "context", "before", "suffix", "r.lo", "r.hi").filter(f"length(before) >= lo and length(suffix) >= {length} - hi")
        key = F.expr(f"xxhash64(gram, lo, hi, substring(before, 1, lo), substring(suffix, 1, {length} - hi))")
        alike = F.expr(f"case when length(before) >= hi and length(suffix) >= {length} - lo then unhex(sha2(concat("
                       f"substring(before, 1, hi), substring(suffix, 1, {length} - lo)), 256)) else cast(cast(context as string) as binary) end")
        part = materialize(part.withColumns({"key": key, "alike": alike}), "hot-part")
        kinds = part.groupBy("key", "alike").agg(F.count(F.lit(1)).alias("n"), F.min("context").alias("first"))
        sizes = kinds.groupBy("key").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("kinds")).filter("total > 1")
        part = materialize(part.join(kinds, ["key", "alike"]).join(sizes, "key"), "hot-groups")
        whole = part.filter("n > 1").select("gram", "context", "lo", "hi")
        left = part.filter("kinds > 1 and context = first and lo < hi").select("key", "kinds", "gram", "context", "before", "suffix", "lo", "hi")
        small, todo = left.filter(f"kinds <= {HOT}"), left.filter(f"kinds > {HOT}")
        buckets = max(shuffles, -(-small.count() // BUCKET_SUFFIXES))
        whole = whole.unionByName(_compared(small, buckets, length))
        found = whole if found is None else found.unionByName(whole)
        if todo.isEmpty():
            return found


def _brought_back(rows: DataFrame, decided: DataFrame, length: int) -> DataFrame:
    """(rid, spans): byte spans of each text that decided contexts (gram, context, ranges) cover."""
    held_of = rows.sparkSession.sparkContext.broadcast(membership(decided, "context"))

    def found(batches):
        held = held_of.value
        for batch in batches:
            for _, rid, _, at, gram, context, before, after in _marked_rows(batch, length):
                take = member(held, context)
                yield [x[take] for x in (rid, at, gram, context, before, after)]

    def run(batches):
        for got in _gathered(found(batches)):
            cols = [np.concatenate(x) for x in zip(*got)]
            order = np.lexsort((cols[1], cols[0]))  # copies give their positions once
            rid, at = cols[0][order], cols[1][order]
            new = np.r_[True, (rid[1:] != rid[:-1]) | (at[1:] != at[:-1])][:len(rid)]
            cols = [x[order][new] for x in cols]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int32()])],
                                             names=["rid", "at", "gram", "context", "before", "after"])

    places = rows.mapInArrow(run, "rid long, at int, gram long, context long, before int, after int")
    there = places.join(decided, ["gram", "context"])  # a row for each place at most
    inside = F.transform("ranges", lambda r: F.struct(F.greatest(r["lo"], F.lit(length) - F.col("after")).alias("lo"),
                                                      F.least(r["hi"], F.col("before")).alias("hi")))
    spans = F.transform(F.filter(inside, lambda r: r["lo"] <= r["hi"]), lambda r: F.struct(
        (F.col("at") - r["hi"]).alias("start"), (F.col("at") - r["lo"] + length).alias("end")))
    return there.select("rid", spans.alias("spans")).groupBy("rid").agg(F.flatten(F.collect_set("spans")).alias("spans"))


def repeated_spans(docs: DataFrame, text: str = "text", length: int = 400) -> DataFrame:
    """(rid, spans: array<struct<start, end>>) of the texts with repeated windows; rid is xxhash64 of the text."""
    rows = small_batches(docs).select(F.xxhash64(text).alias("rid"), F.col(text).alias("text")).filter(F.octet_length("text") >= length)
    seen = materialize(contexts(rows, length), "contexts")
    open_ = seen.filter("kinds > 1")
    buckets = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-open_.count() // BUCKET_SUFFIXES))
    places, hot = membership(open_, "place"), membership(seen.filter(f"kinds > {HOT}").select("gram").distinct(), "gram")
    windows = _merged(_runs(rows, membership(open_, "gram"), places, hot, buckets, length), length)
    if hot.any():
        windows = windows.unionByName(_split(_hot_contexts(rows, places, hot, length), length))
    whole = seen.filter("n > 1").select("gram", "context", F.lit(0).alias("lo"), F.lit(length).alias("hi"))
    both = whole.unionByName(windows).groupBy("gram", "context").agg(
        F.max(F.expr(f"lo = 0 and hi = {length}")).alias("whole"), F.collect_set(F.struct("lo", "hi")).alias("ranges"))
    every = F.array(F.struct(F.lit(0).alias("lo"), F.lit(length).alias("hi")))
    decided = materialize(both.select("gram", "context", F.when(F.col("whole"), every).otherwise(F.col("ranges")).alias("ranges")), "decided")
    return _brought_back(rows, decided, length)


def remove_repeats(docs: DataFrame, text: str = "text", length: int = 400, as_text: bool = False) -> DataFrame:
    """``docs`` with removed (merged spans, bytes) and kept (the remaining bytes; with ``as_text`` a string
    without the characters that lost a byte) in place of the text."""
    keep = [f for f in docs.schema.fields if f.name not in (text, "removed", "kept")]
    names = [f.name for f in keep]
    spans = repeated_spans(docs, text, length)
    joined = docs.select(*names, F.col(text).alias("__body"), F.xxhash64(text).alias("__rid")).join(
        spans.select(F.col("rid").alias("__rid"), F.col("spans").alias("__spans")), "__rid", "left").select(*names, "__body", "__spans")
    span = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))
    schema = T.StructType([*keep, T.StructField("removed", span), T.StructField("kept", T.StringType() if as_text else T.BinaryType())])

    def run(batches):
        for batch in batches:
            data, offs = text_bytes(batch.column(len(names)))
            spans = batch.column(len(names) + 1)
            removed, kept = [], []
            for i, s in enumerate(spans.to_pylist()):
                row = data[offs[i]:offs[i + 1]]
                out = []
                if s:
                    gone = np.zeros(len(row) + 1, np.int32)
                    np.add.at(gone, [x["start"] for x in s], 1)
                    np.add.at(gone, [x["end"] for x in s], -1)
                    gone = np.cumsum(gone)[:-1] > 0
                    edge = np.flatnonzero(np.diff(np.r_[False, gone, False].astype(np.int8)))
                    out = [{"start": int(a), "end": int(b)} for a, b in zip(edge[::2], edge[1::2])]
                    row = row[~gone]
                removed.append(out)
                kept.append(row.tobytes().decode("utf-8", "ignore") if as_text else row.tobytes())
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(k) for k in range(len(names))),
                 pa.array(removed, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), pa.array(kept, pa.string() if as_text else pa.binary())],
                names=[*names, "removed", "kept"])

    return joined.mapInArrow(run, schema)
