"""Matching recordings against the fingerprint index.

J3 inverted-index join, A11 per-song stats, A12 target-zone filter, J5
relative-timing score, A13 score table with names, O4 top-k per recording.

Matches are ``(request_id, song_id, address, s_ms, d_ms)``: the recording's
anchor time ``s`` and the stored anchor time ``d`` for one shared address.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skein.operators.audio import TIMING_TOLERANCE_MS, ZONE_MIN_HITS

PAIR_KEYS = ["request_id", "song_id"]


def fingerprint_join(sample_fp: DataFrame, index: DataFrame) -> DataFrame:
    """``sample(request_id, address, s_ms)`` joined to ``index(address, anchor_ms, song_id)``.

    No hint: AQE measures the sample side after its shuffle and broadcasts it
    when it is under the broadcast threshold (a few recordings); a large batch
    stays a shuffle join on ``address`` where AQE splits hot addresses.
    """
    s = sample_fp.select("request_id", "address", "s_ms")
    idx = index.select("address", F.col("anchor_ms").alias("d_ms"), "song_id")
    return s.join(idx, "address")


def match_stats(m: DataFrame) -> DataFrame:
    """Per (recording, song) the earliest stored time and the match count."""
    return m.groupBy(*PAIR_KEYS).agg(
        F.min("d_ms").alias("first_ms"), F.count(F.lit(1)).alias("matches"))


def zone_hits(m: DataFrame) -> DataFrame:
    """Hits per (recording, song, stored anchor time)."""
    return m.groupBy(*PAIR_KEYS, "d_ms").agg(F.count(F.lit(1)).alias("hits"))


def target_zone_filter(m: DataFrame, threshold: int, min_hits: int = ZONE_MIN_HITS) -> DataFrame:
    """Keep the (recording, song) pairs having at least ``threshold`` anchor
    times with ``min_hits`` or more hits; returns the surviving matches."""
    zones = zone_hits(m).filter(F.col("hits") >= min_hits)
    keep = zones.groupBy(*PAIR_KEYS).agg(F.count(F.lit(1)).alias("zones")).filter(
        F.col("zones") >= threshold)
    return m.join(keep.select(*PAIR_KEYS), PAIR_KEYS, "left_semi")


def relative_timing(m: DataFrame, tol: int = TIMING_TOLERANCE_MS) -> DataFrame:
    """Per (recording, song) the number of match pairs whose time gaps agree:
    ``|(s_b - s_a) - (d_b - d_a)| < tol`` and both gaps point the same way (Q4).

    No pair is materialised. With ``off = s - d`` the first condition is
    ``|off_b - off_a| < tol``, counted per offset by a window over the next ``tol`` offsets.
    Pairs whose gaps point opposite ways have both gaps below ``tol`` and are
    subtracted from a small neighbourhood join on (s, d) counts.
    """
    return timing(match_points(m, tol), tol).select(*PAIR_KEYS, "score")


def match_points(m: DataFrame, tol: int = TIMING_TOLERANCE_MS) -> DataFrame:
    """``(request_id, song_id, s_ms, d_ms, c, points, close)``: counts per distinct (s, d), with the number of those of their recording
    and song, and whether others of these lie within ``tol`` in s and in d; written once, all that follows reads it. Matches are
    dealt once, by recording and song, which serves every count."""
    from skein.session import materialize

    pts = m.select(*PAIR_KEYS, "s_ms", "d_ms").repartition(*PAIR_KEYS).groupBy(*PAIR_KEYS, "s_ms", "d_ms").agg(F.count(F.lit(1)).alias("c"))
    pair = Window.partitionBy(*PAIR_KEYS)

    def close(c: str):
        w = pair.orderBy(c)
        return F.max(c).over(w.rangeBetween(-tol, -1)).isNotNull() | F.max(c).over(w.rangeBetween(1, tol)).isNotNull()

    pts = pts.withColumn("points", F.count(F.lit(1)).over(pair)).withColumn("close", close("s_ms")).withColumn("close", F.col("close") & close("d_ms"))
    return materialize(pts, "match_points")


def timing(pts: DataFrame, tol: int = TIMING_TOLERANCE_MS) -> DataFrame:
    """J5 and A11 on ``match_points``: ``(request_id, song_id, first_ms, matches, score, best_offset)``.

    Most recordings and songs share one point by chance: that row is the answer. The points of the others are dealt once."""
    off = (F.col("s_ms") - F.col("d_ms")).cast("long").alias("off")
    alone = pts.filter("points = 1").select(*PAIR_KEYS, F.col("d_ms").alias("first_ms"), F.col("c").alias("matches"),
                                            F.expr("c * (c - 1) div 2").cast("long").alias("agree"), off.alias("best_offset"))

    # (1) pairs with off2 - off1 < tol: equal offsets from their count, others from the sum over the following offsets
    per_off = pts.filter("points > 1").repartition(*PAIR_KEYS).groupBy(*PAIR_KEYS, off).agg(F.sum("c").alias("c"), F.min("d_ms").alias("first_ms"))
    following = Window.partitionBy(*PAIR_KEYS).orderBy("off").rangeBetween(1, tol - 1)
    per_off = per_off.withColumn("next", F.coalesce(F.sum("c").over(following), F.lit(0)))
    many = per_off.groupBy(*PAIR_KEYS).agg(
        F.min("first_ms").alias("first_ms"), F.sum("c").alias("matches"), F.sum(F.expr("c * (c - 1) div 2 + c * next")).cast("long").alias("agree"),
        F.max_by("off", F.struct("c", -F.col("off"))).alias("best_offset"))

    # (2) opposite-direction pairs: s2 > s1, d2 < d1, (s2 - s1) + (d1 - d2) < tol, among points that are close to others
    near = pts.filter("close")
    cs = F.floor(F.col("s_ms") / tol).cast("long")
    cd = F.floor(F.col("d_ms") / tol).cast("long")
    p1 = near.select(*PAIR_KEYS, F.col("s_ms").alias("s1"), F.col("d_ms").alias("d1"), F.col("c").alias("c1"),
                     cs.alias("cs"), cd.alias("cd"))
    p1 = p1.withColumn("ds", F.explode(F.array(F.lit(0), F.lit(1)))).withColumn(
        "dd", F.explode(F.array(F.lit(-1), F.lit(0))))
    p1 = p1.select(*PAIR_KEYS, "s1", "d1", "c1", (F.col("cs") + F.col("ds")).alias("cs"),
                   (F.col("cd") + F.col("dd")).alias("cd"))
    p2 = near.select(*PAIR_KEYS, F.col("s_ms").alias("s2"), F.col("d_ms").alias("d2"), F.col("c").alias("c2"),
                     cs.alias("cs"), cd.alias("cd"))
    disc = p1.join(p2, PAIR_KEYS + ["cs", "cd"]).filter(
        (F.col("s2") > F.col("s1")) & (F.col("d2") < F.col("d1"))
        & ((F.col("s2") - F.col("s1")) + (F.col("d1") - F.col("d2")) < tol)
    ).groupBy(*PAIR_KEYS).agg(F.sum(F.col("c1") * F.col("c2")).cast("long").alias("disc"))

    return many.join(disc, PAIR_KEYS, "left").select(
        *PAIR_KEYS, "first_ms", "matches", (F.col("agree") - F.coalesce("disc", F.lit(0))).cast("long").alias("score"), "best_offset"
    ).unionByName(alone.withColumnRenamed("agree", "score"))


def match_scores(m: DataFrame, songs: DataFrame) -> DataFrame:
    """A13 + J4: score per (recording, song) with earliest time, names and the most common offset s - d (Q5;
    ties: the smaller).

    The matches are reduced once to counts per distinct (s, d) and that table
    is written to the shared folder; the statistics and the timing score are
    then read from it. Songs unknown to the catalogue are dropped (inner join).
    """
    scored = timing(match_points(m).dropna(subset=PAIR_KEYS))
    cat = songs.select("song_id", "title", "artist")
    return scored.join(cat, "song_id").select(*PAIR_KEYS, "title", "artist", "first_ms", "matches", "score", "best_offset")


def top_matches(scores: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` best songs per recording by score (ties: smaller song id)."""
    w = Window.partitionBy("request_id").orderBy(F.col("score").desc(), F.col("song_id").asc())
    return scores.withColumn("rank", F.row_number().over(w).cast("long")).filter(F.col("rank") <= k)
