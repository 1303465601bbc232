"""Similarity joins of hashes wider than 64 bits (J6, J9), exact by multi-index probing.

``bands`` disjoint bands cover the hash. Two hashes within ``t`` bits differ in at most t // bands bits in one band at
least, so a join of one side's bands with the other side's bands and all their values up to that many bits
away finds every pair: t + 1 bands need no probes, fewer and wider ones are more selective, which pays
when many hashes share short bands. A pair is kept at the first band that brings it, and compared whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skein.functions import wide


def wide_value_pairs(lh: DataFrame, rh: DataFrame, bits: int, t: int, bands: int | None = None) -> DataFrame:
    """(lh, rh, dist) of the distinct hashes of both sides (columns ``lh``, ``rh``: words) within ``t`` bits."""
    n = bands or min(t + 1, bits)
    layout = wide.wide_bands(bits, n)
    radius = t // n
    sizes = {size for _, size in layout}
    left = lh.select("lh", F.posexplode(wide.band_values(F.col("lh"), bits, layout)).alias("band", "val"))
    right = rh.select("rh", F.posexplode(wide.band_values(F.col("rh"), bits, layout)).alias("band", "val"))
    if radius:
        near = F.lit(None).cast("array<array<bigint>>")
        for size in sorted(sizes):
            near = F.when(F.get(F.array(*[F.lit(s) for _, s in layout]), F.col("band")) == size, wide.probes(F.col("val"), size, radius)).otherwise(near)
        right = right.select("rh", "band", F.explode(near).alias("val"))
    j = left.join(right, ["band", "val"])
    dist = wide.band_distances(F.col("lh"), F.col("rh"), bits, layout)
    first = F.coalesce(*[F.when(d <= radius, F.lit(i)) for i, d in enumerate(dist)])
    total = wide.hamming_words("lh", "rh")
    return j.filter((total <= t) & (F.col("band") == first)).select("lh", "rh", total.alias("dist"))


def hamming_pairs_wide(left: DataFrame, right: DataFrame, bits: int, t: int, lkey: list[str], rkey: list[str],
                       bands: int | None = None) -> DataFrame:
    """All (left, right) rows whose hashes ``h`` (words) are within ``t`` bits; distinct hashes are paired first."""
    pairs = wide_value_pairs(left.select(F.col("h").alias("lh")).distinct(), right.select(F.col("h").alias("rh")).distinct(), bits, t, bands)
    out = left.select(*lkey, F.col("h").alias("lh")).join(pairs, "lh")
    out = out.join(right.select(*[F.col(c).alias(f"r_{c}") for c in rkey], F.col("h").alias("rh")), "rh")
    return out.select(*lkey, *[f"r_{c}" for c in rkey], "lh", "rh", "dist")


def multihash_diff_wide(segs: DataFrame, bits: int, cutoff: int, bands: int | None = None) -> DataFrame:
    """J9 on wide hashes: per image pair, matching segments and the sum of their lowest distances."""
    p = hamming_pairs_wide(segs, segs, bits, cutoff, ["img", "seg"], ["img", "seg"], bands).filter(F.col("img") != F.col("r_img"))
    low = p.groupBy("img", "seg", "r_img").agg(F.min("dist").alias("lowest"))
    return low.groupBy("img", F.col("r_img").alias("other")).agg(F.count(F.lit(1)).alias("matches"), F.sum("lowest").cast("long").alias("sum_distance"))
