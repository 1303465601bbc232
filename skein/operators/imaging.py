"""Image-hash operators: hash rows, exact banded Hamming joins, video
similarity, multi-hash matching and crop-resistant segments.

Hamming joins are exact by pigeonhole: two ``bits``-bit hashes within
distance ``t`` agree on at least one of ``t + 1`` disjoint bit bands, so an
equi-join on (band, band value) finds every candidate and the exact
``bit_count(a ^ b) <= t`` filter keeps the true pairs.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skein.functions import imagehash as H
from skein.functions.bits import hamming64


def band_layout(bits: int, t: int) -> list[tuple[int, int]]:
    """(shift, width) of ``t + 1`` disjoint bands covering ``bits`` bits."""
    k = t + 1
    base, extra = divmod(bits, k)
    widths = [base + (1 if i < extra else 0) for i in range(k)]
    out, top = [], bits
    for w in widths:
        top -= w
        out.append((top, w))
    return out


def bands(h: Column, bits: int, t: int) -> Column:
    """array<struct<band, val>> of the hash's ``t + 1`` bands."""
    parts = [F.struct(F.lit(i).alias("band"),
                      F.shiftright(h, s).bitwiseAND(F.lit((1 << w) - 1)).alias("val"))
             for i, (s, w) in enumerate(band_layout(bits, t))]
    return F.array(*parts)


def first_equal_band(a: Column, b: Column, bits: int, t: int) -> Column:
    """Index of the first band on which hashes ``a`` and ``b`` agree (null if none)."""
    x = a.bitwiseXOR(b)
    return F.coalesce(*[F.when(F.shiftright(x, s).bitwiseAND(F.lit((1 << w) - 1)) == 0, F.lit(i))
                        for i, (s, w) in enumerate(band_layout(bits, t))])


def hash_value_pairs(lh: DataFrame, rh: DataFrame, bits: int, t: int) -> DataFrame:
    """(lh, rh, dist) for the distinct hash values of each side within ``t``.

    Values are exploded into ``t + 1`` (band, value) rows and equi-joined; a
    pair is kept only at the first band it agrees on, so it comes out once
    without a de-duplicating shuffle. Because only distinct values take part,
    a hash held by very many rows is one row here.
    """
    lb = lh.select("lh", F.explode(bands(F.col("lh"), bits, t)).alias("b")).select("lh", "b.band", "b.val")
    rb = rh.select("rh", F.explode(bands(F.col("rh"), bits, t)).alias("b")).select("rh", "b.band", "b.val")
    j = lb.join(rb, ["band", "val"])
    j = j.filter((hamming64("lh", "rh") <= t) & (F.col("band") == first_equal_band(F.col("lh"), F.col("rh"), bits, t)))
    return j.select("lh", "rh", hamming64("lh", "rh").alias("dist"))


def _distinct_values(df: DataFrame, name: str) -> DataFrame:
    return df.select(F.col("h").alias(name)).distinct()


def hamming_pairs(left: DataFrame, right: DataFrame, bits: int, t: int,
                  lkey: list[str], rkey: list[str]) -> DataFrame:
    """All (left, right) rows with ``hamming(h, h) <= t`` (columns ``h`` on both;
    ``lkey`` / ``rkey`` identify the rows).

    Distinct values are paired first (``hash_value_pairs``), then each side's
    rows are attached by equi-joins on the value: the work after the value
    join is the size of the true output, however many rows share a hash.
    """
    hp = hash_value_pairs(_distinct_values(left, "lh"), _distinct_values(right, "rh"), bits, t)
    lr = left.select(*lkey, F.col("h").alias("lh"))
    rr = right.select(*[F.col(c).alias(f"r_{c}") for c in rkey], F.col("h").alias("rh"))
    j = lr.join(hp, "lh").join(rr, "rh")
    return j.select(*lkey, *[f"r_{c}" for c in rkey], "lh", "rh", "dist")


def _video_value_hits(frames: DataFrame, bits: int, t: int) -> DataFrame:
    """(video, lh, other_video): video holds value ``lh`` and the other video
    holds a value within ``t`` of it. Computed on distinct (video, value)."""
    vh = frames.select("video", "h").distinct()
    hp = hash_value_pairs(_distinct_values(vh, "lh"), _distinct_values(vh, "rh"), bits, t)
    a = vh.select("video", F.col("h").alias("lh"))
    b = vh.select(F.col("video").alias("other_video"), F.col("h").alias("rh"))
    j = a.join(hp, "lh").join(b, "rh").filter(F.col("video") != F.col("other_video"))
    return j.select("video", "lh", "other_video").distinct()


def hamming_semi(frames: DataFrame, bits: int, t: int) -> DataFrame:
    """(frame, other video) pairs where the other video has a frame within ``t``.

    ``frames``: (video, frame, h). Frames of the same video are not compared.
    """
    hits = _video_value_hits(frames, bits, t)
    f = frames.select("video", "frame", F.col("h").alias("lh"))
    return f.join(hits, ["video", "lh"]).select("video", "frame", "other_video")


def video_similarity(frames: DataFrame, bits: int, t: int) -> DataFrame:
    """Matched frames of A / least(frames of A, frames of B), per video pair with a match.

    Q11: ``frames`` carries the hash of the named algorithm, so the compare uses it.
    Frames are counted per (video, value) first: a value repeated across many
    frames is matched once and weighted by its count."""
    per_value = frames.groupBy("video", F.col("h").alias("lh")).agg(F.count(F.lit(1)).alias("k"))
    hits = _video_value_hits(frames, bits, t).join(per_value, ["video", "lh"]).groupBy(
        "video", "other_video").agg(F.sum("k").alias("matched"))
    sizes = frames.groupBy("video").agg(F.count(F.lit(1)).alias("n"))
    s2 = sizes.select(F.col("video").alias("other_video"), F.col("n").alias("n_other"))
    j = hits.join(sizes, "video").join(s2, "other_video")
    return j.select("video", "other_video", "matched",
                    F.try_divide(F.col("matched"), F.least("n", "n_other")).alias("similarity"))


GRID = 12  # blocks of images on each side of the multi-hash grid: GRID * GRID cells, each one task
AT_ONCE = 1 << 20  # candidates of a cell that are expanded at once
LOOKED_UP = 20  # bits of a hash up to which a table has a place for every value
TOGETHER = 1 << 13  # images of the right block that are matched together: so few ids come next to each other that a Parquet writer keeps numbering them


def _field(v: np.ndarray, shift: int, width: int) -> np.ndarray:
    """The ``width`` bits of every hash from bit ``shift`` on (the numpy form of ``bands``)."""
    return (v >> shift) & ((1 << width) - 1 if width < 64 else -1)


def _runs(start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """All positions of the runs that begin at ``start`` and have ``count`` entries, one run after the other."""
    return np.arange(count.sum()) - np.repeat(np.cumsum(count) - count - start, count)


def _slices(weight: np.ndarray, most: int) -> Iterator[slice]:
    """Neighbouring entries with a summed weight of about ``most`` (one entry at least)."""
    part = (np.cumsum(weight) - weight) // most
    edges = [*np.flatnonzero(np.diff(part, prepend=-1)), len(weight)]
    return (slice(a, b) for a, b in zip(edges, edges[1:]))


def near_values(a: np.ndarray, b: np.ndarray, bits: int, t: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(position in a, position in b, distance) of the hashes within ``t`` bits, ordered by the first; a and b hold distinct
    hashes. Candidates agree on a band (``band_layout``), each pair comes from the first of its bands. Of short hashes, all
    within ``t`` bits of one of b are looked up where that is less."""
    layout = band_layout(bits, t)
    found = [(np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.uint8))]
    spans = []
    for shift, width in layout:
        key = _field(b, shift, width)
        order = np.argsort(key, kind="stable")
        spans.append((order, *(np.searchsorted(key[order], _field(a, shift, width), side) for side in ("left", "right"))))
    if bits <= LOOKED_UP and all(v.min(initial=0) >= 0 and v.max(initial=0) >> bits == 0 for v in (a, b)):
        flips = np.flatnonzero(np.bitwise_count(np.arange(1 << bits)) <= t)
        if len(flips) * len(b) < sum((end - start).sum() for _, start, end in spans):
            at = np.full(1 << bits, -1)
            at[a] = np.arange(len(a))
            for part in _slices(np.full(len(b), len(flips)), AT_ONCE):
                x = at[b[part, None] ^ flips]
                y, flip = np.nonzero(x >= 0)
                found.append((x[y, flip], y + part.start, np.bitwise_count(flips[flip])))
            spans = []
    for i, (order, start, end) in enumerate(spans):
        for part in _slices(end - start, AT_ONCE):
            count = (end - start)[part]
            x, y = np.repeat(np.arange(part.start, part.stop), count), order[_runs(start[part], count)]
            apart = a[x] ^ b[y]
            dist = np.bitwise_count(apart.view(np.uint64))
            kept = dist <= t
            for s, w in layout[:i]:
                kept &= _field(apart, s, w) != 0
            found.append((x[kept], y[kept], dist[kept]))
    x, y, dist = (np.concatenate(part) for part in zip(*found))
    order = np.argsort(x, kind="stable")
    return x[order], y[order], dist[order]


def _changes(*sorted_by: np.ndarray) -> np.ndarray:
    """Positions at which a new run of equal entries begins in any of the arrays."""
    new = np.ones(len(sorted_by[0]), bool)
    np.not_equal(sorted_by[0][1:], sorted_by[0][:-1], out=new[1:])
    for v in sorted_by[1:]:
        new[1:] |= v[1:] != v[:-1]
    return np.flatnonzero(new)


def match_cell(left: tuple[np.ndarray, ...], right: tuple[np.ndarray, ...], bits: int, t: int) -> Iterator[tuple[np.ndarray, ...]]:
    """(image, other, matches, sum of distances) of the images of ``left`` (image, segment, hash) and ``right`` (image, hash); images and
    segments are numbers from 0. TOGETHER images of ``right`` after the other are matched with a slice of ``left`` after the other; a part's
    rows are ordered by matches, sum of distances, image and other, so that all but the other are long runs.

    Distinct hashes are paired once for the images taken together; what is expanded is the candidates of AT_ONCE, or of one image, at a time."""
    img, seg, h = np.unique(np.stack(left), axis=1)
    other, other_h = np.unique(np.stack(right), axis=1)
    values, at = np.unique(h, return_inverse=True)
    images, first = np.unique(img, return_index=True)
    rows_end = np.append(first[1:], len(img))
    # a key has the image, the other image, the segment and the distance, from the highest bit on
    low_bits, seg_bits, other_bits = t.bit_length(), int(seg.max(initial=0)).bit_length(), int(other.max(initial=0)).bit_length()
    pair_at = seg_bits + low_bits
    block = _changes(other)[::TOGETHER]
    for begin, end in zip(block, [*block[1:], len(other)]):
        held = np.argsort(other_h[begin:end], kind="stable") + begin
        other_values, held_start, held_count = np.unique(other_h[held], return_index=True, return_counts=True)
        other_key = other[held] << pair_at
        x, y, dist = near_values(values, other_values, bits, t)
        hits = np.bincount(x, minlength=len(values))
        hit_start = np.cumsum(hits) - hits
        weight = np.bincount(x, held_count[y], len(values)).astype(np.int64)
        for part in _slices(np.add.reduceat(weight[at], first) if len(first) else first, AT_ONCE):
            rows = slice(first[part.start], rows_end[part.stop - 1])
            row_key = (img[rows] - img[rows.start] << other_bits + pair_at) + (seg[rows] << low_bits)
            hit = _runs(hit_start[at[rows]], hits[at[rows]])
            hit_key, of = np.repeat(row_key, hits[at[rows]]) + dist[hit], y[hit]
            key = np.repeat(hit_key, held_count[of])
            key += other_key[_runs(held_start[of], held_count[of])]
            if not len(key):
                continue
            key.sort()
            key = key[_changes(key >> low_bits)]  # the first of a segment is its lowest
            pair = key >> pair_at
            start = _changes(pair)
            matches, distance, pair = np.diff(start, append=len(pair)), np.add.reduceat(key & (1 << low_bits) - 1, start), pair[start]
            kind = matches * (distance.max() + 1) + distance
            order = np.argsort(kind.astype(np.min_scalar_type(kind.max())), kind="stable")
            pair = pair[order]
            yield (pair >> other_bits) + img[rows.start], pair & (1 << other_bits) - 1, matches[order], distance[order]


def multihash_diff(segs: DataFrame, bits: int, cutoff: int, counted: bool = False, packed: bool = False) -> DataFrame:
    """Per image pair (A, B), A != B: matching segments of A (lowest distance
    to any segment of B within ``cutoff``) and the sum of those distances.

    ``segs``: (img, seg, h). Pairs without any match are left out (their
    result is (0, 0) by definition). ``counted`` adds n_segs, the segments of A; ``packed`` leaves the images B with
    equal values together in an array ``others`` (several rows per image and values).

    The result has a row per pair of similar images, so only the segments are shuffled, never pairs: images are
    dealt into GRID blocks by their id, and the task of cell (i, j) gets block i and block j and makes all their pairs.
    The shuffle is 2 * GRID times the segments. A task's rows are ordered so that they are written small (``match_cell``).
    """
    block = F.pmod(F.xxhash64("img"), F.lit(GRID)).cast("int")
    line = F.transform(F.sequence(F.lit(0), F.lit(GRID - 1)), lambda j: F.struct((block * GRID + j).alias("cell"), F.lit(True).alias("left")))
    column = F.transform(F.sequence(F.lit(0), F.lit(GRID - 1)), lambda j: F.struct((j * GRID + block).alias("cell"), F.lit(False).alias("left")))
    dealt = segs.filter(F.col("img").isNotNull()).select("img", "seg", "h", F.explode(F.concat(line, column)).alias("to"))
    cells = dealt.select("to.cell", "to.left", "img", "seg", F.col("h").cast("long").alias("h")).repartitionById(GRID * GRID, "cell")

    def run(batches):
        parts = [b for b in batches if b.num_rows]
        if not parts:
            return
        t = pa.Table.from_batches(parts)
        ids = t["img"].combine_chunks().dictionary_encode()
        img = ids.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        seg = pc.fill_null(t["seg"].combine_chunks().dictionary_encode().indices, -1).to_numpy(zero_copy_only=False).astype(np.int64) + 1
        hashed = t["h"].is_valid().to_numpy()
        h = pc.fill_null(t["h"], 0).to_numpy()
        on_left = t["left"].to_numpy()
        a, b = on_left & hashed, ~on_left & hashed
        n_segs = np.bincount(img[on_left], minlength=len(ids.dictionary))
        for x, y, matches, distance in match_cell((img[a], seg[a], h[a]), (img[b], h[b]), bits, cutoff):
            if (same := x == y).any():
                x, y, matches, distance = (v[~same] for v in (x, y, matches, distance))
            if not len(x):
                continue
            start = _changes(matches, distance, x)
            others = pa.ListArray.from_arrays(pa.array(np.append(start, len(x)).astype(np.int32)), ids.dictionary.take(pa.array(y)))
            of = x[start]
            out = {"img": ids.dictionary.take(pa.array(of)), "others": others, "matches": pa.array(matches[start]), "sum_distance": pa.array(distance[start])}
            yield pa.RecordBatch.from_pydict(out | ({"n_segs": pa.array(n_segs[of])} if counted else {}))

    img_type = segs.schema["img"].dataType.simpleString()
    pairs = cells.mapInArrow(run, f"img {img_type}, others array<{img_type}>, matches long, sum_distance long" + (", n_segs long" if counted else ""))
    return pairs if packed else _unpacked(pairs)


def _unpacked(pairs: DataFrame) -> DataFrame:
    return pairs.select(*[F.explode(c).alias("other") if c == "others" else c for c in pairs.columns])


def multihash_score(diff: DataFrame, segs: DataFrame, bits: int, region_cutoff: int = 1, digits: int | None = None) -> DataFrame:
    """``__sub__`` score (lower is better; rounded to ``digits``) and the match test (>= region_cutoff).

    The segments of an image come with ``diff`` (``counted``), or are counted and joined to its pairs. Of ``packed`` pairs the
    score is made once for all others of a row, which are laid out at the end."""
    d = diff if "n_segs" in diff.columns else diff.join(segs.groupBy("img").agg(F.count(F.lit(1)).alias("n_segs")), "img")
    tie = -(F.col("sum_distance") / (F.col("matches") * bits))
    score = F.when(F.col("matches") == 0, F.col("n_segs").cast("double")).otherwise(
        F.col("n_segs") - (F.col("matches") + tie))
    packed = "others" in d.columns
    scored = d.select("img", "others" if packed else "other", "matches", "sum_distance", (score if digits is None else F.round(score, digits)).alias("score"),
                      (F.col("matches") >= region_cutoff).alias("is_match"))
    return _unpacked(scored) if packed else scored


def multihash_best(scored: DataFrame) -> DataFrame:
    """Per image the candidate with the lowest score (ties: smaller id).

    An image has few scores (they come of small counts), so the smallest id per score is combined by hash where the
    pairs are made, before anything is sorted or shuffled."""
    per_score = scored.groupBy("img", "score").agg(F.min("other").alias("other"))
    best = per_score.groupBy("img").agg(F.min(F.struct("score", "other")).alias("b"))
    return best.select("img", F.col("b.other").alias("best"), F.col("b.score").alias("score"))


# --------------------------------------------------------------- X4 segments
STACK_PIXELS = 1 << 22  # pixels of the images that are labelled at once


def joined(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest member of every one of ``n`` nodes' component under the edges a-b (union by hooking the larger
    root to the smaller, with all paths cut short after each round)."""
    root = np.arange(n)
    while len(a):
        ra, rb = root[a], root[b]
        apart = ra != rb
        a, b, ra, rb = a[apart], b[apart], ra[apart], rb[apart]
        np.minimum.at(root, np.maximum(ra, rb), np.minimum(ra, rb))
        while True:
            up = root[root]
            if (up == root).all():
                break
            root = up
    return root


def stack_segments(stack: np.ndarray, threshold: float) -> dict[str, np.ndarray]:
    """4-connected bright (> threshold) and dark regions of a stack of images (images x rows x columns), all at once.

    Every row is cut into runs of one brightness; runs of neighbouring rows that overlap are joined. Returns one entry per region: img,
    bright, first (its first pixel in reading order), size and box (max exclusive), ordered by img, bright ones first, then first."""
    n, h, w = stack.shape
    bright = (stack > threshold).reshape(n * h, w)
    new = np.ones((n * h, w), bool)
    new[:, 1:] = bright[:, 1:] != bright[:, :-1]
    start = np.flatnonzero(new.ravel())  # runs cover every pixel, so the run of a pixel is found by its position
    end = np.append(start[1:], n * h * w)
    line = start // w
    kind = bright.ravel()[start]
    above = np.flatnonzero(line % h < h - 1)
    lo = np.searchsorted(start, start[above] + w, side="right") - 1
    hi = np.searchsorted(start, end[above] - 1 + w, side="right")
    a = np.repeat(above, hi - lo)
    b = np.arange(len(a)) - np.repeat(np.cumsum(hi - lo) - (hi - lo), hi - lo) + np.repeat(lo, hi - lo)
    same = kind[a] == kind[b]
    root = joined(len(start), a[same], b[same])
    top, region = np.unique(root, return_inverse=True)
    order = np.argsort(region, kind="stable")
    edge = np.searchsorted(region[order], np.arange(len(top)))
    least = lambda v: np.minimum.reduceat(v[order], edge)
    most = lambda v: np.maximum.reduceat(v[order], edge)
    column, row = start - line * w, line % h
    out = {"img": line[top] // h, "bright": kind[top], "first": start[top], "size": np.add.reduceat((end - start)[order], edge),
           "min_x": least(column), "max_x": most(end - line * w), "min_y": least(row), "max_y": most(row) + 1}
    by = np.lexsort((out["first"], ~out["bright"], out["img"]))
    return {k: v[by] for k, v in out.items()}


def _box_hashes(stack: np.ndarray, seg: dict[str, np.ndarray], size: int) -> np.ndarray:
    """Average hash of every region's box, by the nearest pixels of a size x size raster (first bit on top, signed)."""
    if size * size > 64:
        raise ValueError("a segment's hash has at most 64 bits")
    step = np.arange(size)
    rows = seg["min_y"][:, None] + step * (seg["max_y"] - seg["min_y"])[:, None] // size
    cols = seg["min_x"][:, None] + step * (seg["max_x"] - seg["min_x"])[:, None] // size
    spots = stack[seg["img"][:, None, None], rows[:, :, None], cols[:, None, :]].reshape(len(rows), size * size)
    bits = spots > spots.mean(1)[:, None]
    weights = np.uint64(1) << np.arange(size * size - 1, -1, -1).astype(np.uint64)
    return np.where(bits, weights, np.uint64(0)).sum(1, dtype=np.uint64).view(np.int64)


SEGMENT_SCHEMA = ("img long, seg int, size int, min_x int, min_y int, max_x int, max_y int, h long")


def _neighbours(stack: np.ndarray) -> np.ndarray:
    """The 3 x 3 surroundings of every pixel (edges repeated), as a last axis."""
    p = np.pad(stack, [(0, 0)] * (stack.ndim - 2) + [(1, 1), (1, 1)], mode="edge")
    h, w = stack.shape[-2:]
    return np.stack([p[..., r:r + h, c:c + w] for r in range(3) for c in range(3)], axis=-1)


def smoothed(stack: np.ndarray) -> np.ndarray:
    """A small Gaussian blur (weights 1 2 1), then a 3 x 3 median: specks don't become segments."""
    near = _neighbours(stack)
    blurred = near @ (np.outer([1, 2, 1], [1, 2, 1]).ravel() / 16)
    return np.median(_neighbours(blurred), axis=-1)


def kept_segments(seg: dict[str, np.ndarray], n: int, w: int, h: int, min_size: int, limit: int | None) -> dict[str, np.ndarray]:
    """Regions of more than ``min_size`` pixels, at most the ``limit`` largest of an image; an image without any is one
    region of size 2 (its corners). Adds ``seg``, their number inside the image."""
    seg = {k: v[seg["size"] > min_size] for k, v in seg.items()}
    if limit:
        seg = {k: v[np.lexsort((-seg["size"], seg["img"]))] for k, v in seg.items()}
    at = np.arange(len(seg["img"])) - np.searchsorted(seg["img"], seg["img"])
    seg["seg"] = at
    if limit:
        seg = {k: v[at < limit] for k, v in seg.items()}
    bare = np.setdiff1d(np.arange(n), seg["img"])
    whole = {"size": 2, "min_x": 0, "min_y": 0, "max_x": w, "max_y": h, "seg": 0, "bright": False, "first": 0}
    return {k: np.concatenate([v, bare if k == "img" else np.full(len(bare), whole[k], v.dtype)]) for k, v in seg.items()}


def crop_segments(grids: DataFrame, w: int, h: int, threshold: int = 128, min_size: int = 2,
                  hash_size: int = 4, limit: int | None = None, smooth: bool = False,
                  hash_func: Callable[[np.ndarray], int] | None = None, scale: tuple[float, float] = (1.0, 1.0)) -> DataFrame:
    """Crop-resistant segments of each image with a hash of each bounding box.

    ``grids``: (img, grid array<int> of w*h). One image is one row, so the
    regions of all images of a batch are found in ``mapInPandas`` (run lengths and a
    union of overlapping runs, up to STACK_PIXELS pixels at once) with no
    shuffle. Without any segment the whole image is one segment. ``limit``
    keeps the largest segments (O7). ``smooth`` looks for segments in the blurred,
    median-filtered image. ``hash_func`` hashes a box's pixels (default: average
    hash of the box at ``hash_size``); ``scale`` (width, height) takes the boxes
    back to an original of another size.
    """
    at_once = max(1, STACK_PIXELS // (w * h))

    def run(batches):
        for pdf in batches:
            for a in range(0, len(pdf), at_once):
                part = pdf.iloc[a:a + at_once]
                stack = np.stack([np.asarray(g, dtype=np.float64) for g in part["grid"]]).reshape(-1, h, w)
                seg = stack_segments(smoothed(stack) if smooth else stack, threshold)
                seg = kept_segments(seg, len(stack), w, h, min_size, limit)
                if hash_func is None:
                    hashes = _box_hashes(stack, seg, hash_size)
                else:
                    boxes = zip(*(seg[k].tolist() for k in ("img", "min_y", "max_y", "min_x", "max_x")))
                    hashes = np.array([hash_func(stack[i, top:low, left:right]) for i, top, low, left, right in boxes], np.int64)
                scaled = {k: (seg[k] * scale[k.endswith("y")]).astype(np.int32) for k in ("min_x", "min_y", "max_x", "max_y")}
                yield pd.DataFrame({"img": part["img"].to_numpy(np.int64)[seg["img"]], "seg": seg["seg"].astype(np.int32), "size": seg["size"].astype(np.int32),
                                    **scaled, "h": hashes})

    return grids.select("img", "grid").mapInPandas(run, SEGMENT_SCHEMA)


def hash_rows(grids: DataFrame, w: int, h: int) -> DataFrame:
    """every hash of every image as hex, wide."""
    g = F.col("grid")
    return grids.select(
        "img",
        H.hash_hex(H.average_hash(g), w * h).alias("ahash"),
        H.hash_hex(H.dhash(g, w, h), (w - 1) * h).alias("dhash"),
        H.hash_hex(H.dhash_vertical(g, w, h), w * (h - 1)).alias("dhash_vertical"),
        H.hash_hex(H.phash(g, w, "median"), min(w, 8) ** 2).alias("phash"),
        H.hash_hex(H.wavelet_hash(g), w * h).alias("whash"),
    )


def hashes_long(wide: DataFrame, algos: list[str]) -> DataFrame:
    """wide hash row -> (img, algorithm, hash) via ``stack``."""
    parts = ", ".join(f"'{a}', `{a}`" for a in algos)
    return wide.selectExpr("img", f"stack({len(algos)}, {parts}) as (algorithm, hash)")


HASHERS = {
    "ahash": lambda g, w, h: (H.average_hash(g), w * h),
    "dhash": lambda g, w, h: (H.dhash(g, w, h), (w - 1) * h),
    "dhash_vertical": lambda g, w, h: (H.dhash_vertical(g, w, h), w * (h - 1)),
    "phash": lambda g, w, h: (H.phash(g, w, "median"), min(w, 8) ** 2),
    "phash_mean": lambda g, w, h: (H.phash(g, w, "mean_no_dc"), min(w, 8) ** 2),
    "phash_simple": lambda g, w, h: (H.phash(g, w, "simple"), min(w, 8) * min(w - 1, 8)),
    "whash": lambda g, w, h: (H.wavelet_hash(g), w * h),
}


def hasher(name: str):
    """Pick a hash function by name; an unknown name is an error."""
    if name not in HASHERS:
        raise ValueError(f"unknown hash algorithm {name!r}; known: {sorted(HASHERS)}")
    return HASHERS[name]
