"""Audio fingerprint search on the driver tables.

Role mapping: ``events`` is the audio. The library: each user is a song; its
peaks are its events (time = ms since the song's first event, frequency bin =
floor(value) & 511). The recordings to recognise: every (user, calendar
week) slice of events is one clip (``request_id = user_id * 10000 + week``),
its times counted from the start of that week. Every event is thus both in
the library and in exactly one clip, and every clip should find its user.
``customer`` is the song catalogue (title = c_name, artist = c_mktsegment).
"""

from __future__ import annotations

import math
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skein.operators import audio, match
from skein.operators.windows import dense_index
from skein.plans.common import DAY_MS, SAMPLES_SQL, WEEK_MS, epoch_ms, event_samples
from skein.plans.registry import ORACLE_SQL, query
from skein.session import materialize, scratch_path
from skein.sources import fpindex
from skein.sources.tables import Tables

ZONE_THRESHOLD = 3
TOP_K = 10

# --------------------------------------------------------------- derivations


def _events_ms(t: Tables) -> DataFrame:
    return _events_of(t.events)


def _events_of(events: DataFrame) -> DataFrame:
    return events.select("event_id", "user_id", epoch_ms("ts").alias("ms"),
                           (F.floor("value").cast("long").bitwiseAND(F.lit(511))).alias("freq"))


def positioned_peaks(t: Tables, events: DataFrame | None = None) -> DataFrame:
    """Library peaks with their clip: (song_id, idx, t_ms, freq, request_id, clip_ms). A clip is a run of its
    song's peaks in the same order, so one positioning serves both."""
    ev = _events_ms(t) if events is None else _events_of(events)
    start = ev.groupBy("user_id").agg(F.min("ms").alias("m0"))
    wk = F.floor(F.col("ms") / WEEK_MS).cast("long")
    p = ev.join(start, "user_id").select(
        F.col("user_id").alias("song_id"), (F.col("ms") - F.col("m0")).alias("t_ms"), "freq", "event_id",
        (F.col("user_id") * 10000 + wk).alias("request_id"), (F.col("ms") - wk * WEEK_MS).alias("clip_ms"))
    return dense_index(p, ["song_id"], None,
                       [F.col("t_ms"), F.col("freq"), F.col("event_id")])


def library_peaks(t: Tables, events: DataFrame | None = None) -> DataFrame:
    return positioned_peaks(t, events).select("song_id", "t_ms", "freq", "event_id", "idx")


def peak_pairs(t: Tables, events: DataFrame | None = None) -> DataFrame:
    """Target-zone pairs of the library; those inside one clip are that clip's pairs, too."""
    return audio.target_pairs(positioned_peaks(t, events), also=("request_id", "clip_ms"))


def index_from(pairs: DataFrame) -> DataFrame:
    return audio.index_of_pairs(pairs, "song_id", F.col("a_ms"))


def clips_from(pairs: DataFrame) -> DataFrame:
    inside = pairs.filter(F.col("a_request_id") == F.col("b_request_id")).withColumnRenamed("a_request_id", "request_id")
    return audio.index_of_pairs(inside, "request_id", F.col("a_clip_ms")).withColumnRenamed("anchor_ms", "s_ms")


def library_index(t: Tables, events: DataFrame | None = None) -> DataFrame:
    return index_from(peak_pairs(t, events))


def clip_fingerprints(t: Tables, events: DataFrame | None = None) -> DataFrame:
    return clips_from(peak_pairs(t, events))


def songs(t: Tables) -> DataFrame:
    return t.customer.select(F.col("c_custkey").alias("song_id"), F.col("c_name").alias("title"),
                             F.col("c_mktsegment").alias("artist"))


def matches(t: Tables) -> DataFrame:
    pairs = peak_pairs(t)
    return match.fingerprint_join(clips_from(pairs), index_from(pairs))


# ------------------------------------------------------------------ oracle SQL
_PEAKS_SQL = f"""
  ev AS (SELECT event_id, user_id, epoch_us(ts) // 1000 AS ms, (floor(value)::BIGINT & 511) AS freq FROM events),
  lib AS (SELECT user_id AS song_id, ms - min(ms) OVER (PARTITION BY user_id) AS t_ms, freq, event_id FROM ev),
  lpk AS (SELECT song_id, t_ms, freq,
                 row_number() OVER (PARTITION BY song_id ORDER BY t_ms, freq, event_id) - 1 AS idx FROM lib),
  clp AS (SELECT user_id * 10000 + (ms // {WEEK_MS}) AS request_id, ms - (ms // {WEEK_MS}) * {WEEK_MS} AS t_ms,
                 freq, event_id FROM ev),
  cpk AS (SELECT request_id, t_ms, freq,
                 row_number() OVER (PARTITION BY request_id ORDER BY t_ms, freq, event_id) - 1 AS idx FROM clp)
"""


def _pairs_sql(src: str, key: str, address: bool = True) -> str:
    addr = (", (((a.freq << 23) | (b.freq << 14) | ((b.t_ms - a.t_ms) & 4294967295)) & 4294967295) AS address"
            if address else "")
    return f"""SELECT a.{key}, a.idx AS a_idx, b.idx - a.idx AS d, a.t_ms AS a_ms, b.t_ms AS b_ms,
                      a.freq AS a_freq, b.freq AS b_freq {addr}
               FROM {src} a JOIN {src} b ON a.{key} = b.{key} AND b.idx BETWEEN a.idx + 1 AND a.idx + 5"""


def index_sql(name: str, where: str = "") -> str:
    """CTEs building the library index ``name`` from the events passing ``where``."""
    return f"""
  {name}_ev AS (SELECT event_id, user_id, epoch_us(ts) // 1000 AS ms, (floor(value)::BIGINT & 511) AS freq
                FROM events {where}),
  {name}_lib AS (SELECT user_id AS song_id, ms - min(ms) OVER (PARTITION BY user_id) AS t_ms, freq, event_id FROM {name}_ev),
  {name}_pk AS (SELECT song_id, t_ms, freq,
                       row_number() OVER (PARTITION BY song_id ORDER BY t_ms, freq, event_id) - 1 AS idx FROM {name}_lib),
  {name} AS (SELECT address, song_id, arg_max(a_ms, a_idx * 6 + d) AS anchor_ms
             FROM ({_pairs_sql(name + '_pk', 'song_id')}) GROUP BY ALL)"""


_FP_SQL = f"""WITH {_PEAKS_SQL},
  lpairs AS ({_pairs_sql('lpk', 'song_id')}),
  cpairs AS ({_pairs_sql('cpk', 'request_id')}),
  idx AS (SELECT address, song_id, arg_max(a_ms, a_idx * 6 + d) AS anchor_ms FROM lpairs GROUP BY ALL),
  cfp AS (SELECT address, request_id, arg_max(a_ms, a_idx * 6 + d) AS s_ms FROM cpairs GROUP BY ALL),
  m AS (SELECT c.request_id, i.song_id, c.address, c.s_ms, i.anchor_ms AS d_ms
        FROM cfp c JOIN idx i ON c.address = i.address)"""

_TIMING_SQL = """
  timing AS (
    SELECT a.request_id, a.song_id, count(*)::BIGINT AS score
    FROM m a JOIN m b ON a.request_id = b.request_id AND a.song_id = b.song_id AND a.address < b.address
    WHERE abs((b.s_ms - a.s_ms) - (b.d_ms - a.d_ms)) < 100
      AND (b.s_ms - a.s_ms) * (b.d_ms - a.d_ms) >= 0
    GROUP BY ALL),
  stats AS (SELECT request_id, song_id, min(d_ms) AS first_ms, count(*) AS matches FROM m GROUP BY ALL),
  offs AS (SELECT request_id, song_id, arg_max(off, (n, -off)) AS best_offset
           FROM (SELECT request_id, song_id, s_ms - d_ms AS off, count(*) AS n FROM m GROUP BY ALL) GROUP BY ALL),
  scores AS (
    SELECT s.request_id, s.song_id, c.c_name AS title, c.c_mktsegment AS artist, s.first_ms, s.matches,
           coalesce(t.score, 0)::BIGINT AS score, o.best_offset
    FROM stats s LEFT JOIN timing t USING (request_id, song_id) JOIN offs o USING (request_id, song_id)
    JOIN customer c ON c.c_custkey = s.song_id)"""


# -------------------------------------------------------------------- queries
@query("target_pairs", sql=f"WITH {_PEAKS_SQL} " + _pairs_sql("lpk", "song_id", address=False))
def q_target_pairs(spark, sf_dir):
    """Every library peak with each of its next five peaks."""
    p = audio.target_pairs(library_peaks(Tables(spark, sf_dir)))
    return p.select("song_id", "a_idx", "d", "a_ms", "b_ms", "a_freq", "b_freq")


@query("fingerprints", sql=f"{_FP_SQL} SELECT address, song_id, anchor_ms FROM idx")
def q_fingerprints(spark, sf_dir):
    """F1 + A19: the library index (address, song_id, anchor_ms)."""
    return library_index(Tables(spark, sf_dir)).select("address", "song_id", "anchor_ms")


@query("fingerprint_join", sql=f"{_FP_SQL} SELECT * FROM m")
def q_fingerprint_join(spark, sf_dir):
    """Every clip fingerprint joined to the stored couples of its address."""
    return matches(Tables(spark, sf_dir)).select("request_id", "song_id", "address", "s_ms", "d_ms")


@query("match_stats", sql=f"""{_FP_SQL}
    SELECT request_id, song_id, min(d_ms) AS first_ms, count(*) AS matches FROM m GROUP BY ALL""")
def q_match_stats(spark, sf_dir):
    return match.match_stats(matches(Tables(spark, sf_dir)))


@query("target_zone_filter", sql=f"""{_FP_SQL},
  z AS (SELECT request_id, song_id, d_ms, count(*) AS hits FROM m GROUP BY ALL HAVING count(*) >= 5),
  keep AS (SELECT request_id, song_id FROM z GROUP BY ALL HAVING count(*) >= {ZONE_THRESHOLD})
    SELECT m.* FROM m SEMI JOIN keep USING (request_id, song_id)""")
def q_target_zone_filter(spark, sf_dir):
    """Matches of songs with at least 3 anchor times hit 5 times."""
    m = matches(Tables(spark, sf_dir))
    return match.target_zone_filter(m, ZONE_THRESHOLD).select(
        "request_id", "song_id", "address", "s_ms", "d_ms")


@query("relative_timing", sql=f"{_FP_SQL}, {_TIMING_SQL} SELECT * FROM timing WHERE score > 0")
def q_relative_timing(spark, sf_dir):
    """Pairs of matches whose time gaps agree within 100 ms (pairs never built)."""
    r = match.relative_timing(matches(Tables(spark, sf_dir)))
    return r.filter(F.col("score") > 0)


@query("match_scores", sql=f"{_FP_SQL}, {_TIMING_SQL} SELECT * FROM scores")
def q_match_scores(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return match.match_scores(matches(t), songs(t))


@query("top_matches", sql=f"""{_FP_SQL}, {_TIMING_SQL}
    SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY request_id ORDER BY score DESC, song_id)::BIGINT AS rank
                   FROM scores) WHERE rank <= {TOP_K}""")
def q_top_matches(spark, sf_dir):
    """O4 (flagship): the ten best songs for every clip."""
    t = Tables(spark, sf_dir)
    return match.top_matches(match.match_scores(matches(t), songs(t)), TOP_K)


INDEX_BUCKETS = 32


def stored_index(spark, t: Tables, pairs: DataFrame) -> DataFrame:
    """The library index as a bucketed table, stored in two overlapping batches: the songs of even users, then all."""
    name = f"skein_index_{uuid.uuid4().hex}"
    path = scratch_path(spark, f"tables/{spark.sparkContext.applicationId}/{name}")
    index = materialize(index_from(pairs).select("address", "song_id", "anchor_ms"), "index_rows")
    fpindex.create_index(spark, name, path, INDEX_BUCKETS)
    fpindex.append_to_index(spark, name, index.filter(F.col("song_id") % 2 == 0))
    fpindex.append_to_index(spark, name, index)
    return spark.table(name)


@query("indexed_match", sql=ORACLE_SQL["top_matches"])
def q_indexed_match(spark, sf_dir):
    """S9 + J3 + O4: the ten best songs for every clip, from the stored, bucketed index."""
    t = Tables(spark, sf_dir)
    pairs = peak_pairs(t)
    index = stored_index(spark, t, pairs)
    found = fpindex.probe_index(clips_from(pairs), index)
    return match.top_matches(match.match_scores(found, songs(t)), TOP_K)


# ---------------------------------------------------------------- signal steps
LP_CUTOFF, LP_RATE = 50.0, 1000.0
FR_SIZE, FR_HOP, FR_BINS = 16, 4, 8
SMALL_BANDS = [0, 1, 2, 3, 4, 6, 8]


def _alpha_r() -> tuple[float, float]:
    a = audio._alpha(LP_CUTOFF, LP_RATE)
    return a, 1 - a


@query("downsample", sql=f"""
    SELECT song_id, (i // 4)::BIGINT AS i, avg(v) AS v FROM ({SAMPLES_SQL}) GROUP BY ALL""")
def q_downsample(spark, sf_dir):
    """Mean of every 4 samples."""
    return audio.downsample(event_samples(Tables(spark, sf_dir)), 4)


@query("low_pass", sql=f"""
    WITH s AS ({SAMPLES_SQL})
    SELECT a.song_id, a.i, round(sum({_alpha_r()[0]!r} * pow({_alpha_r()[1]!r}, a.i - b.i) * b.v), 6) AS v
    FROM s a JOIN s b ON a.song_id = b.song_id AND b.i <= a.i GROUP BY ALL""")
def q_low_pass(spark, sf_dir):
    """y = a x + (1 - a) y_prev per song (cut-off 50 Hz at 1 kHz)."""
    lp = audio.low_pass(event_samples(Tables(spark, sf_dir)), LP_CUTOFF, LP_RATE)
    return lp.withColumn("v", F.round("v", 6))


_FRAMES_SQL = f"""
    WITH s AS ({SAMPLES_SQL}),
    n AS (SELECT song_id, count(*) AS n_samples FROM s GROUP BY ALL),
    f AS (SELECT s.song_id, s.i, s.v, unnest(generate_series(
              greatest(ceil((s.i - {FR_SIZE} + 1) / {FR_HOP}), 0)::BIGINT,
              least(s.i // {FR_HOP}, (n.n_samples - 1) // {FR_HOP})::BIGINT)) AS frame
          FROM s JOIN n USING (song_id)),
    fr AS (SELECT song_id, frame, i - frame * {FR_HOP} AS pos,
                  v * (0.54 - 0.46 * cos(2 * pi() * (i - frame * {FR_HOP}) / {FR_SIZE - 1})) AS x FROM f)"""


@query("frames", sql=_FRAMES_SQL + " SELECT song_id, frame, pos, round(x, 6) AS x FROM fr")
def q_frames(spark, sf_dir):
    """Hamming-windowed frames of 16 samples every 4 (all of the signal)."""
    fr = audio.frames(event_samples(Tables(spark, sf_dir)), FR_SIZE, FR_HOP, mode="full")
    return fr.select("song_id", "frame", "pos", F.round("x", 6).alias("x"))


_DFT_SQL = _FRAMES_SQL + f""",
    tab AS (SELECT p.pos, k.k, cos(-2 * pi() * p.pos * k.k / {FR_SIZE}) AS c, sin(-2 * pi() * p.pos * k.k / {FR_SIZE}) AS s
            FROM range({FR_SIZE}) p(pos), range({FR_BINS}) k(k)),
    spec AS (SELECT song_id, frame, k, sum(x * c) AS re, sum(x * s) AS im FROM fr JOIN tab USING (pos) GROUP BY ALL)"""


def _spectrum(spark, sf_dir) -> DataFrame:
    return audio.stft(event_samples(Tables(spark, sf_dir)), FR_SIZE, FR_HOP, FR_BINS, mode="full")


@query("stft", sql=_DFT_SQL + " SELECT song_id, frame, k, round(sqrt(re*re + im*im), 3) AS mag FROM spec")
def q_stft(spark, sf_dir):
    """Magnitude spectrum, first 8 bins of 16-sample frames (numpy FFT per frame block)."""
    return _spectrum(spark, sf_dir).select("song_id", "frame", "k", F.round("mag", 3).alias("mag"))


_BANDS_SQL = _DFT_SQL + f""",
    sm AS (SELECT song_id, frame, k, round(sqrt(re*re + im*im), 3) AS mag,
                  CASE {' '.join(f'WHEN k >= {SMALL_BANDS[b]} AND k < {SMALL_BANDS[b + 1]} THEN {b}' for b in range(6))} END AS band
           FROM spec),
    bp AS (SELECT song_id, frame, band, max(mag) AS mag, arg_min(k, (-mag, k)) AS k FROM sm GROUP BY ALL),
    n2 AS (SELECT song_id, count(*) AS n_samples, ((count(*) - 1) // {FR_HOP}) + 1 AS n_frames FROM s GROUP BY ALL)"""


def _band_peaks(spark, sf_dir) -> DataFrame:
    return audio.stft_peaks(event_samples(Tables(spark, sf_dir)), SMALL_BANDS, FR_SIZE, FR_HOP, FR_BINS, mode="full", digits=3)


@query("band_peaks", sql=_BANDS_SQL + """
    SELECT song_id, frame, band, mag, CASE WHEN mag <= 0 THEN 0 ELSE k END::BIGINT AS k FROM bp""")
def q_band_peaks(spark, sf_dir):
    """Per frame and band the loudest bin (ties to the lower bin)."""
    return _band_peaks(spark, sf_dir).select("song_id", "frame", "band", "mag", "k")


@query("extract_peaks", sql=_BANDS_SQL + f""",
    av AS (SELECT *, avg(mag) OVER (PARTITION BY song_id, frame) AS avg_mag FROM bp)
    SELECT song_id, frame, band, k AS freq,
           round((frame + k / {float(FR_SIZE)}) * (n_samples / 1000.0 / n_frames) * 1000, 3) AS t_ms
    FROM av JOIN n2 USING (song_id) WHERE mag > avg_mag""")
def q_extract_peaks(spark, sf_dir):
    """Band maxima above the frame's mean, timed inside the frame (rate 1 kHz)."""
    p = audio.extract_peaks(_band_peaks(spark, sf_dir), 1000.0, FR_SIZE)
    return p.select("song_id", "frame", "band", "freq", F.round("t_ms_exact", 3).alias("t_ms"))


@query("heat_map", sql=_DFT_SQL + """,
    sp AS (SELECT song_id, frame, k, round(sqrt(re*re + im*im), 3) AS mag FROM spec)
    SELECT song_id, frame, k, mag, floor(255.0 * mag / (SELECT max(mag) FROM sp))::INTEGER AS intensity FROM sp""")
def q_heat_map(spark, sf_dir):
    """Spectrum magnitudes as grey levels against the global maximum."""
    sp = _spectrum(spark, sf_dir).select("song_id", "frame", "k", F.round("mag", 3).alias("mag"))
    return audio.heat_map(materialize(sp, "spectrum"))  # read for the maximum and for the result: one FFT


# F2 reads bins 40..299, so it takes a long-frame spectrum: one 1024-sample
# frame every 1024 samples (every song here fits in one frame).
KEY_SIZE, KEY_BINS = 1024, audio.PEAK_RANGES[-1]


@query("four_peak_key", sql=f"""
    WITH s AS ({SAMPLES_SQL}),
    f AS (SELECT song_id, i // {KEY_SIZE} AS frame, i % {KEY_SIZE} AS pos,
                 v * (0.54 - 0.46 * cos(2 * pi() * (i % {KEY_SIZE}) / {KEY_SIZE - 1})) AS x FROM s),
    sp AS (SELECT song_id, frame, k,
                  round(sqrt(pow(sum(x * cos(-2 * pi() * pos * k / {KEY_SIZE})), 2)
                           + pow(sum(x * sin(-2 * pi() * pos * k / {KEY_SIZE})), 2)), 6) AS mag
           FROM f, range({audio.PEAK_RANGES[0]}, {KEY_BINS}) r(k) GROUP BY ALL),
    rg AS (SELECT *, ({' + '.join(f'(k > {r})::INTEGER' for r in audio.PEAK_RANGES)}) AS rng FROM sp),
    best AS (SELECT song_id, frame, rng, arg_min(k, (-ln(mag + 1), k)) AS p FROM rg GROUP BY ALL)
    SELECT song_id, frame,
           ({' + '.join(f'{w} * coalesce(max(CASE WHEN rng = {i} THEN p - p % {audio.PEAK_FUZZ} END), 0)'
                         for i, w in enumerate(audio.PEAK_WEIGHTS))})::BIGINT AS key
    FROM best GROUP BY ALL""")
def q_four_peak_key(spark, sf_dir):
    """quantised key of the loudest bins in four frequency ranges per frame."""
    sp = audio.stft(event_samples(Tables(spark, sf_dir)), KEY_SIZE, KEY_SIZE, KEY_BINS, mode="full")
    return audio.four_peak_key(sp.withColumn("mag", F.round("mag", 6)))


@query("song_fingerprints")
def q_song_fingerprints(spark, sf_dir):
    """Samples -> low-pass -> downsample -> frames -> FFT -> peaks -> pairs -> index, one plan."""
    s = event_samples(Tables(spark, sf_dir))
    s = audio.low_pass(s, LP_CUTOFF, LP_RATE)
    s = audio.downsample(s, 2)
    peaks = audio.extract_peaks(audio.stft_peaks(s, SMALL_BANDS, FR_SIZE, FR_HOP, FR_BINS, mode="full"), LP_RATE / 2, FR_SIZE)
    peaks = dense_index(peaks, ["song_id"], None, [F.col("t_ms_exact"), F.col("band")])
    return audio.fingerprints(peaks, key="song_id")
