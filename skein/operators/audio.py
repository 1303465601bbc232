"""Audio fingerprint chain as DataFrame steps.

Long tables throughout: samples ``(song_id, i, v)``, frames
``(song_id, frame, pos, x)``, spectrum ``(song_id, frame, k, re, im, mag)``,
peaks ``(song_id, idx, t_ms, freq)`` and the index
``(address, anchor_ms, song_id)``.

Signal steps (W2 low-pass, A15 downsample, W3 frames, X1 STFT, A16 band
peaks, A17 peak filter), then the pair steps (W1 target zone, F1 address,
A19 last write wins). Ordered work inside a song is cut into blocks so a
song of any length is spread over many tasks.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skein.functions.bits import pair_address
from skein.operators.grouped import apply_sorted_groups
from skein.operators.sizing import null_safe_join
from skein.session import materialize

# Fixed values of the reference algorithm.
FRAME_SIZE = 1024
HOP_SIZE = FRAME_SIZE // 32
TARGET_ZONE = 5
BAND_EDGES = [0, 10, 20, 40, 80, 160, 512]
TIMING_TOLERANCE_MS = 100
ZONE_MIN_HITS = 5


# ---------------------------------------------------------------- W2 low-pass
def _alpha(cutoff_hz: float, sample_rate: float) -> float:
    rc = 1.0 / (2 * math.pi * cutoff_hz)
    dt = 1.0 / sample_rate
    return dt / (rc + dt)


def _lowpass_block(x: np.ndarray, alpha: float, y0: float = 0.0) -> np.ndarray:
    """y_n = a x_n + (1-a) y_{n-1}, y_{-1} = y0, vectorised in sub-blocks."""
    r = 1.0 - alpha
    n = len(x)
    out = np.empty(n)
    if r <= 0.0:
        out[:] = alpha * x
        return out
    # sub-block length so that r**-B stays far from overflow
    step = max(1, min(n if n else 1, int(600 / max(1e-12, -math.log10(r)))))
    carry = y0
    for s in range(0, n, step):
        xs = x[s:s + step]
        m = len(xs)
        pw = r ** np.arange(m)
        acc = np.cumsum(xs / pw)
        ys = alpha * pw * acc + carry * r ** np.arange(1, m + 1)
        out[s:s + m] = ys
        carry = ys[-1]
    return out


CHAIN = 256  # chunk ends that are chained as one array


def _entering(ends: DataFrame, ratio: float, levels: int = 3) -> DataFrame:
    """(song_id, c, enter): the state before each of a song's values ``last`` at 0, 1, 2, ... (column c), where
    state_c = last_c + ratio * state_{c - 1}.

    Values are chained in arrays of CHAIN; the arrays' ends are values of the next level, whose entering
    states come back to them. With three levels one array holds the ends of CHAIN**3 values.
    """
    blocks = ends.withColumn("block", F.floor(F.col("c") / CHAIN).cast("long")).groupBy("song_id", "block").agg(
        F.sort_array(F.collect_list(F.struct("c", "last"))).alias("values"))
    step = lambda y, e: e["last"] + F.lit(ratio) * y
    if levels:
        tops = blocks.select("song_id", F.col("block").alias("c"), F.aggregate("values", F.lit(0.0), step).alias("last"))
        blocks = null_safe_join(blocks, _entering(tops, ratio**CHAIN, levels - 1).withColumnRenamed("c", "block"), ["song_id", "block"])
    else:
        blocks = blocks.withColumn("enter", F.lit(0.0))
    none = F.array().cast("array<struct<c: bigint, enter: double>>")
    walked = F.aggregate("values", F.struct(F.col("enter").alias("y"), none.alias("out")), lambda s, e: F.struct(
        step(s["y"], e).alias("y"), F.concat(s["out"], F.array(F.struct(e["c"].alias("c"), s["y"].alias("enter")))).alias("out")))
    return blocks.select("song_id", F.inline(walked["out"]))


def low_pass(samples: DataFrame, cutoff_hz: float, sample_rate: float, chunk: int = 65536) -> DataFrame:
    """First-order low-pass per song, exact, in parallel chunks.

    1. each (song, chunk) is filtered from a zero state (numpy); the result is written once, as the
       chunk ends and the last step read it;
    2. the chunk ends, chained in arrays of bounded size on several levels, give the state that enters
       each chunk (positions ``i`` are dense, so every earlier chunk is full);
    3. ``y_n = local_n + (1-a)^(pos+1) * enter`` is a plain column expression.
    """
    a = _alpha(cutoff_hz, sample_rate)
    r = 1.0 - a
    s = samples.withColumn("chunk", F.floor(F.col("i") / chunk).cast("long"))

    def local(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("i")
        y = _lowpass_block(pdf["v"].to_numpy(dtype=float), a)
        return pd.DataFrame({"song_id": pdf["song_id"].to_numpy(), "i": pdf["i"].to_numpy(),
                             "chunk": pdf["chunk"].to_numpy(), "local": y})

    loc = materialize(apply_sorted_groups(s.select("song_id", "i", "chunk", "v"), ["song_id", "chunk"], ["i"], local,
                                          "song_id long, i long, chunk long, local double"), "low_pass")
    ends = loc.groupBy("song_id", F.col("chunk").alias("c")).agg(F.max_by("local", "i").alias("last"))
    enter = _entering(ends, r**chunk).withColumnRenamed("c", "chunk")
    pos = F.col("i") - F.col("chunk") * chunk
    return null_safe_join(loc, enter, ["song_id", "chunk"]).select(
        "song_id", "i", (F.col("local") + F.pow(F.lit(r), pos + 1) * F.col("enter")).alias("v"))


# --------------------------------------------------------------- A15 downsample
def downsample(samples: DataFrame, ratio: int) -> DataFrame:
    """Mean of each block of ``ratio`` samples (a short last block too)."""
    return samples.groupBy("song_id", F.floor(F.col("i") / ratio).cast("long").alias("i")).agg(
        F.avg("v").alias("v"))


# ----------------------------------------------------------------- W3 frames
def frame_count(n: Column, size: int, hop: int, mode: str = "reference") -> Column:
    """Q3: ``reference`` = n // (size - hop) frames; ``full`` = every start < n."""
    if mode == "reference":
        return F.floor(n / (size - hop)).cast("long")
    if mode == "full":
        return F.greatest(F.floor((n - 1) / hop) + 1, F.lit(0)).cast("long")
    raise ValueError(mode)


def hamming_weight(pos: Column, size: int) -> Column:
    return F.lit(0.54) - F.lit(0.46) * F.cos(F.lit(2 * math.pi) * pos / F.lit(size - 1))


def frames(samples: DataFrame, size: int = FRAME_SIZE, hop: int = HOP_SIZE,
           mode: str = "reference") -> DataFrame:
    """Windowed frames ``(song_id, frame, pos, x)``; positions past the end are zeros
    (they are simply absent: a zero adds nothing to the transform)."""
    lens = samples.groupBy("song_id").agg(F.count(F.lit(1)).alias("n_samples"))
    lens = lens.withColumn("n_frames", frame_count(F.col("n_samples"), size, hop, mode))
    s = null_safe_join(samples, lens, ["song_id"])
    lo = F.greatest(F.ceil((F.col("i") - size + 1) / hop), F.lit(0)).cast("long")
    hi = F.least(F.floor(F.col("i") / hop), F.col("n_frames") - 1).cast("long")
    s = s.filter(lo <= hi).withColumn("frame", F.explode(F.sequence(lo, hi)))
    pos = F.col("i") - F.col("frame") * hop
    return s.select("song_id", "frame", pos.alias("pos"),
                    (F.col("v") * hamming_weight(pos, size)).alias("x"), "n_frames", "n_samples")


# ------------------------------------------------------------------ X1 STFT
def dft_table(spark, size: int, n_bins: int) -> DataFrame:
    """Cosine / sine table ``(pos, k, c, s)`` for the relational DFT (size*n_bins rows)."""
    t = spark.range(size * n_bins).select((F.col("id") / n_bins).cast("long").alias("pos"),
                                          (F.col("id") % n_bins).alias("k"))
    ang = F.lit(-2 * math.pi) * F.col("pos") * F.col("k") / F.lit(size)
    return t.select("pos", "k", F.cos(ang).alias("c"), F.sin(ang).alias("s"))


def stft_relational(fr: DataFrame, size: int, n_bins: int) -> DataFrame:
    """X1 (oracle form): sum over positions of x * e^{-2 pi i k pos / size}."""
    tab = dft_table(fr.sparkSession, size, n_bins)
    j = fr.join(tab, "pos")
    return j.groupBy("song_id", "frame").agg(F.first("n_frames").alias("n_frames"),
                                             F.first("n_samples").alias("n_samples")).join(
        j.groupBy("song_id", "frame", "k").agg(F.sum(F.col("x") * F.col("c")).alias("re"),
                                               F.sum(F.col("x") * F.col("s")).alias("im")),
        ["song_id", "frame"]).withColumn("mag", F.sqrt(F.col("re") ** 2 + F.col("im") ** 2))


def _frame_blocks(samples: DataFrame, size: int, hop: int, mode: str, frames_per_task: int) -> DataFrame:
    """Samples by (song, block of ``frames_per_task`` frames): a block also gets the ``size - hop`` samples after it, so each
    sample goes to one block and at most a few neighbours (not ``size/hop`` copies)."""
    lens = samples.groupBy("song_id").agg(F.count(F.lit(1)).alias("n_samples"))
    lens = lens.withColumn("n_frames", frame_count(F.col("n_samples"), size, hop, mode))
    span = frames_per_task * hop
    s = null_safe_join(samples, lens, ["song_id"])
    # block b holds frames [b*F, (b+1)*F) -> samples [b*span, b*span + span + size - hop)
    lo = F.greatest(F.floor((F.col("i") - (span + size - hop)) / span) + 1, F.lit(0))
    hi = F.floor(F.col("i") / span)
    s = s.withColumn("blk", F.explode(F.sequence(lo.cast("long"), hi.cast("long"))))
    s = s.filter(F.col("blk") * frames_per_task < F.col("n_frames"))
    return s.select("song_id", "blk", "i", "v", "n_frames", "n_samples")


def _block_spectrum(pdf: pd.DataFrame, size: int, hop: int, n_bins: int, frames_per_task: int) -> tuple[np.ndarray, int]:
    """(complex bins of a block's frames, its first frame)."""
    b, nf = int(pdf["blk"].iloc[0]), int(pdf["n_frames"].iloc[0])
    base = b * frames_per_task * hop
    f0, f1 = b * frames_per_task, min(nf, (b + 1) * frames_per_task)
    buf = np.zeros(frames_per_task * hop + size)
    buf[pdf["i"].to_numpy() - base] = pdf["v"].to_numpy(dtype=float)
    window = 0.54 - 0.46 * np.cos(2 * np.pi * np.arange(size) / (size - 1))
    fr = np.stack([buf[st:st + size] for st in (np.arange(f0, f1) - f0) * hop]) * window
    return np.fft.fft(fr, axis=1)[:, :n_bins], f0


def _block_rows(pdf: pd.DataFrame, frames: np.ndarray, **columns: np.ndarray) -> pd.DataFrame:
    song, n = pdf["song_id"].iloc[0], len(frames)
    return pd.DataFrame({"song_id": pd.array([None if pd.isna(song) else int(song)] * n, "Int64"), "frame": frames, **columns,
                         "n_frames": np.full(n, int(pdf["n_frames"].iloc[0]), dtype=np.int64), "n_samples": np.full(n, int(pdf["n_samples"].iloc[0]), dtype=np.int64)})


def stft(samples: DataFrame, size: int = FRAME_SIZE, hop: int = HOP_SIZE, n_bins: int | None = None,
         mode: str = "reference", frames_per_task: int = 256) -> DataFrame:
    """X1 at scale: numpy FFT on blocks of frames, every bin a row."""
    n_bins = n_bins or size // 2

    def block_fft(pdf: pd.DataFrame) -> pd.DataFrame:
        spec, f0 = _block_spectrum(pdf, size, hop, n_bins, frames_per_task)
        frames = np.repeat(np.arange(f0, f0 + len(spec), dtype=np.int64), n_bins)
        return _block_rows(pdf, frames, k=np.tile(np.arange(n_bins, dtype=np.int64), len(spec)), re=spec.real.ravel(), im=spec.imag.ravel(), mag=np.abs(spec).ravel())

    return apply_sorted_groups(
        _frame_blocks(samples, size, hop, mode, frames_per_task), ["song_id", "blk"], ["i"], block_fft,
        "song_id long, frame long, k long, re double, im double, mag double, n_frames long, n_samples long")


def stft_peaks(samples: DataFrame, edges: list[int] | None = None, size: int = FRAME_SIZE, hop: int = HOP_SIZE, n_bins: int | None = None,
               mode: str = "reference", frames_per_task: int = 256, digits: int | None = None) -> DataFrame:
    """X1 + A16 in one pass: the rows of ``band_peaks(stft(...))``, of which only these leave Python (bands per frame, not bins).

    ``digits``: magnitudes are rounded (halves up) before they are compared."""
    edges = edges or BAND_EDGES
    n_bins = n_bins or size // 2

    def block_peaks(pdf: pd.DataFrame) -> pd.DataFrame:
        spec, f0 = _block_spectrum(pdf, size, hop, n_bins, frames_per_task)
        mag = np.abs(spec)
        if digits is not None:
            mag = np.floor(mag * 10**digits + 0.5) / 10**digits
        frames = np.arange(len(spec))
        inside = [(b, lo, min(hi, n_bins)) for b, (lo, hi) in enumerate(zip(edges, edges[1:])) if lo < min(hi, n_bins)]
        k = np.stack([mag[:, lo:hi].argmax(axis=1) + lo for _, lo, hi in inside], axis=1)  # the first of equal ones
        top = mag[frames[:, None], k]
        silent = top <= 0
        k = np.where(silent, 0, k)
        re = np.where(silent, 0.0, spec.real[frames[:, None], k])
        bands = np.tile(np.array([b for b, _, _ in inside], np.int32), len(spec))
        return _block_rows(pdf, np.repeat(frames + f0, len(inside)).astype(np.int64), band=bands, mag=top.ravel(), k=k.ravel().astype(np.int64), re=re.ravel())

    out = apply_sorted_groups(
        _frame_blocks(samples, size, hop, mode, frames_per_task), ["song_id", "blk"], ["i"], block_peaks,
        "song_id long, frame long, band int, mag double, k long, re double, n_frames long, n_samples long")
    return out.select("song_id", "frame", "band", "n_frames", "n_samples", "mag", "k", "re")


# ------------------------------------------------------------- A16 / A17 peaks
def band_of(k: Column, edges: list[int] = BAND_EDGES) -> Column:
    expr = F.lit(None).cast("int")
    for b in range(len(edges) - 2, -1, -1):
        expr = F.when((k >= edges[b]) & (k < edges[b + 1]), F.lit(b)).otherwise(expr)
    return expr


def band_peaks(spec: DataFrame, edges: list[int] = BAND_EDGES) -> DataFrame:
    """Per frame and band the bin of largest magnitude (ties: lowest bin;
    an all-zero band reports bin 0 with magnitude 0, as the reference does)."""
    s = spec.withColumn("band", band_of(F.col("k"), edges)).filter(F.col("band").isNotNull())
    best = F.max(F.struct(F.col("mag"), (-F.col("k")).alias("nk"), F.col("re").alias("re")))
    g = s.groupBy("song_id", "frame", "band").agg(
        best.alias("b"), F.first("n_frames").alias("n_frames"), F.first("n_samples").alias("n_samples"))
    zero = F.col("b.mag") <= 0
    return g.select(
        "song_id", "frame", "band", "n_frames", "n_samples",
        F.when(zero, 0.0).otherwise(F.col("b.mag")).alias("mag"),
        F.when(zero, 0).otherwise(-F.col("b.nk")).cast("long").alias("k"),
        F.when(zero, 0.0).otherwise(F.col("b.re")).alias("re"),
    )


def extract_peaks(bp: DataFrame, sample_rate: float, frame_size: int = FRAME_SIZE,
                  freq: str = "bin") -> DataFrame:
    """Keep band maxima above the frame's mean of band maxima.

    time = (frame + k / frame_size) * bin_duration, bin_duration = duration / n_frames.
    ``freq='bin'`` keys peaks by bin; ``'real'`` by the truncated real part (Q2).
    """
    w = Window.partitionBy("song_id", "frame")
    duration = F.col("n_samples") / F.lit(float(sample_rate))
    bin_dur = duration / F.col("n_frames")
    t = (F.col("frame") + F.col("k") / F.lit(float(frame_size))) * bin_dur
    f = F.col("k") if freq == "bin" else F.col("re").cast("long")
    return (
        bp.withColumn("avg_mag", F.avg("mag").over(w))
        .filter(F.col("mag") > F.col("avg_mag"))
        .select("song_id", "frame", "band", (t * 1000).alias("t_ms_exact"),
                F.floor(t * 1000).cast("long").alias("t_ms"), f.cast("long").alias("freq"))
    )


# --------------------------------------------------------- A18 / F2 on spectra
def heat_map(spec: DataFrame, mag: str = "mag") -> DataFrame:
    """Intensity floor(255 * mag / global max) per (song, frame, bin).

    The global maximum is a scalar subquery (partial max per task, one value
    to the driver), so no row is joined or broadcast. It reads ``spec`` a
    second time: pass a written spectrum when it is expensive to recompute."""
    top = spec.agg(F.max(mag).alias("__max")).scalar()
    return spec.withColumn("intensity", F.floor(F.lit(255.0) * F.try_divide(F.col(mag), top)).cast("int"))


# Fixed values of the quantised 4-peak key.
PEAK_RANGES = [40, 80, 120, 180, 300]
PEAK_FUZZ = 2
PEAK_WEIGHTS = [1, 100, 100_000, 100_000_000]


def four_peak_key(spec: DataFrame, ranges: list[int] = PEAK_RANGES, fuzz: int = PEAK_FUZZ) -> DataFrame:
    """per frame, the loudest bin (by log(mag + 1), first bin on ties) in each
    range of bins ``[ranges[0], ranges[-1])``, and the key
    sum(weight_i * (p_i - p_i % fuzz)) over the first four ranges."""
    lo, hi = ranges[0], ranges[-1]
    s = spec.filter((F.col("k") >= lo) & (F.col("k") < hi))
    idx = sum((F.col("k") > r).cast("int") for r in ranges)
    s = s.withColumn("rng", idx).withColumn("lm", F.log(F.col("mag") + 1))
    best = s.groupBy("song_id", "frame", "rng").agg(F.max(F.struct("lm", (-F.col("k")).alias("nk"))).alias("b"))
    best = best.select("song_id", "frame", "rng", (-F.col("b.nk")).alias("p"))
    wide = best.groupBy("song_id", "frame").agg(*[
        F.coalesce(F.max(F.when(F.col("rng") == i, F.col("p"))), F.lit(0)).alias(f"p{i}") for i in range(4)])
    key = sum(F.lit(w).cast("long") * (F.col(f"p{i}") - F.col(f"p{i}") % fuzz) for i, w in enumerate(PEAK_WEIGHTS))
    return wide.select("song_id", "frame", key.cast("long").alias("key"))


# ------------------------------------------------- W1 / F1 / A19 fingerprints
def target_pairs(peaks: DataFrame, key: str = "song_id", zone: int = TARGET_ZONE, also: tuple[str, ...] = ()) -> DataFrame:
    """Each peak (position ``idx`` inside ``key``) paired with the next ``zone`` peaks.

    ``delta_ms`` truncates the difference of the exact times (``t_ms_exact``, where the peaks have it), not the
    difference of truncated times, so a sound's addresses don't depend on where it starts. Columns named in
    ``also`` come along as ``a_...`` and ``b_...``.

    An equi-join on (key, idx + d) instead of a per-key window: the work of
    one long song is spread by position. The positioned peaks feed both sides,
    so they are written once to the shared folder (four narrow columns):
    neither side re-derives the positions, and a lost executor costs a re-read.
    """
    exact = F.col("t_ms_exact" if "t_ms_exact" in peaks.columns else "t_ms")
    more = [c for c in also if c not in (key, "idx", "t_ms", "freq")]
    peaks = materialize(peaks.select(key, "idx", "t_ms", "freq", exact.alias("t_x"), *more), "positioned_peaks")
    a = peaks.select(F.col(key), F.col("idx").alias("a_idx"), F.col("t_ms").alias("a_ms"), F.col("t_x").alias("a_x"),
                     F.col("freq").alias("a_freq"), *[F.col(c).alias(f"a_{c}") for c in more])
    a = a.withColumn("d", F.explode(F.sequence(F.lit(1).cast("long"), F.lit(zone).cast("long"))))
    a = a.withColumn("t_idx", F.col("a_idx") + F.col("d"))
    b = peaks.select(F.col(key), F.col("idx").alias("t_idx"), F.col("t_ms").alias("b_ms"), F.col("t_x").alias("b_x"),
                     F.col("freq").alias("b_freq"), *[F.col(c).alias(f"b_{c}") for c in more])
    pairs = null_safe_join(a, b, [key, "t_idx"]).withColumn("delta_ms", F.floor(F.col("b_x") - F.col("a_x")).cast("long"))
    return pairs.drop("a_x", "b_x")


def fingerprints(peaks: DataFrame, key: str = "song_id", zone: int = TARGET_ZONE) -> DataFrame:
    """F1 + A19: ``(address, anchor_ms, key)``; within a key the last pair
    written for an address wins (pairs are written anchor by anchor, then by
    target distance)."""
    return index_of_pairs(target_pairs(peaks, key, zone), key, F.col("a_ms"), zone)


def index_of_pairs(pairs: DataFrame, key: str, anchor_ms: Column, zone: int = TARGET_ZONE) -> DataFrame:
    """F1 + A19 on pairs."""
    p = pairs.withColumn("address", pair_address("a_freq", "b_freq", F.col("delta_ms")))
    order = F.col("a_idx") * (zone + 1) + F.col("d")
    return p.groupBy("address", key).agg(F.max_by(anchor_ms, order).alias("anchor_ms"))
