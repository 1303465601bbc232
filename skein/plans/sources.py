"""Source / sink queries on the driver tables."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from skein.operators import variants
from skein.plans import fingerprint as fp
from skein.plans.registry import ORACLE_SQL, query
from skein.session import materialize, scratch_path
from skein.sources import files, store, wav
from skein.sources.tables import Tables


@query("json_props", sql="SELECT event_id, json_extract(props, '$.k')::INTEGER AS k FROM events")
def q_json_props(spark, sf_dir):
    """JSON text parsed with an explicit schema."""
    e = Tables(spark, sf_dir).events
    return e.select("event_id", F.from_json("props", "k int")["k"].alias("k"))


@query("scan_all", sql="SELECT * FROM part")
def q_scan_all(spark, sf_dir):
    """Whole-table scan."""
    return Tables(spark, sf_dir).part


@query("incremental_new", sql="""
    SELECT * FROM orders WHERE year(o_orderdate) >= 1998
      AND o_custkey NOT IN (SELECT o_custkey FROM orders WHERE year(o_orderdate) < 1998)""")
def q_incremental_new(spark, sf_dir):
    """New orders of customers not processed in earlier years."""
    o = Tables(spark, sf_dir).orders
    cut = F.lit("1998-01-01 00:00:00").cast("timestamp_ntz")  # a range, so it reaches the parquet scan
    incoming = o.filter(F.col("o_orderdate") >= cut)
    manifest = o.filter(F.col("o_orderdate") < cut).select("o_custkey")
    return store.incremental_new(incoming, manifest, "o_custkey")


_CUT = "2024-01-15 00:00:00"


@query("fingerprint_store", sql=f"""WITH {fp.index_sql('early', f"WHERE ts < TIMESTAMP '{_CUT}'")},
  {fp.index_sql('full_idx')}
    SELECT address, song_id, anchor_ms FROM early
    UNION ALL SELECT * FROM (SELECT address, song_id, anchor_ms FROM full_idx
                             EXCEPT SELECT address, song_id, anchor_ms FROM early)""")
def q_fingerprint_store(spark, sf_dir):
    """The index of the first two weeks, then the full index appended with
    primary-key duplicates replaced."""
    t = Tables(spark, sf_dir)
    cut = F.lit(_CUT).cast("timestamp_ntz")
    early = fp.library_index(t, t.events.filter(F.col("ts") < cut))
    full = fp.library_index(t)
    return store.store_append(early.select("address", "song_id", "anchor_ms"),
                              full.select("address", "song_id", "anchor_ms"), ["address", "song_id", "anchor_ms"])


@query("fingerprint_nested", sql=fp._FP_SQL + """,
    c AS (SELECT *, ((anchor_ms * 31 + song_id) % 16)::BIGINT AS chunk FROM idx)
    SELECT address, chunk, list({'anchor_ms': anchor_ms, 'song_id': song_id} ORDER BY anchor_ms, song_id) AS couples
    FROM c GROUP BY address, chunk""")
def q_fingerprint_nested(spark, sf_dir):
    """Address -> sorted couples (anchor time, song), in bounded chunks."""
    idx = fp.library_index(Tables(spark, sf_dir))
    return store.nested_by_key(idx, "address", ["song_id"], ["anchor_ms", "song_id"], 16)


@query("pcm_decode", sql="""
    WITH s AS (SELECT event_id AS rec_id, unnest([0, 1, 2]) AS i, value / 500 - 0.5 AS s FROM events)
    SELECT rec_id, i::BIGINT AS i, trunc(CASE i WHEN 0 THEN s WHEN 1 THEN -s ELSE s / 2 END * 32767) / 32768 AS v FROM s""")
def q_pcm_decode(spark, sf_dir):
    """Recordings (base64 16-bit PCM, one per event: three samples derived
    from its value) decoded to samples."""
    e = Tables(spark, sf_dir).events
    s = (F.col("value") / 500 - 0.5)

    def le16(x):
        u = F.pmod((x * 32767).cast("int"), F.lit(65536))
        h = F.lpad(F.hex(u), 4, "0")
        return F.concat(F.substring(h, 3, 2), F.substring(h, 1, 2))

    hexs = F.concat(le16(s), le16(-s), le16(s / 2))
    rec = e.select(F.col("event_id").alias("rec_id"), F.base64(F.unhex(hexs)).alias("audio"))
    return files.pcm16_decode(rec)


FILE_FRAMES = 4096


def write_event_files(events, path: str):
    """WAV files under ``path``, one per FILE_FRAMES event ids: an event is a frame of three channels (the samples of ``pcm_decode``).
    Returns (rec_id, file, frame). A file is written by the task that has its events, and again alike if that is repeated."""
    def write(key, pdf):
        import numpy as np

        from skein.sources.wav import opened, wav_bytes

        pdf = pdf.sort_values("event_id", kind="stable", ignore_index=True)
        s = pdf["value"].to_numpy() / 500 - 0.5
        frames = np.trunc(np.stack([s, -s, s / 2], axis=1) * 32767).astype("<i2")
        name = f"part-{key[0]:012d}.wav"
        system, where = opened(f"{path}/{name}")
        system.create_dir(where.rsplit("/", 1)[0], recursive=True)
        with system.open_output_stream(where) as out:
            out.write(wav_bytes(frames.tobytes(), channels=3))
        return pdf.assign(rec_id=pdf["event_id"], file=name, frame=np.arange(len(pdf)))[["rec_id", "file", "frame"]]

    block = F.floor(F.col("event_id") / FILE_FRAMES).cast("long")
    return events.select("event_id", "value").groupBy(block.alias("block")).applyInPandas(write, "rec_id long, file string, frame long")


@query("wav_samples", sql=ORACLE_SQL["pcm_decode"])
def q_wav_samples(spark, sf_dir):
    """S12 + S13: the samples of ``pcm_decode``, written as WAV files and read by byte ranges."""
    path = scratch_path(spark, f"tables/{spark.sparkContext.applicationId}/wav-{uuid.uuid4().hex}")
    written = materialize(write_event_files(Tables(spark, sf_dir).events, path), "wav_files")
    samples = wav.read_wav(spark, path, range_bytes=6 * 1024).select(F.element_at(F.split("path", "/"), -1).alias("file"), F.col("i").alias("frame"), "channel", "v")
    return samples.join(written, ["file", "frame"]).select("rec_id", F.col("channel").cast("long").alias("i"), "v")


@query("variant_flatten", sql="""
    SELECT event_id, '$.' || key AS path, json_extract_string(props, '$.' || key) AS value,
           CASE json_type(props, '$.' || key) WHEN 'UBIGINT' THEN 'BIGINT' WHEN 'VARCHAR' THEN 'STRING' ELSE json_type(props, '$.' || key) END AS kind
    FROM (SELECT event_id, props, unnest(json_keys(props)) AS key FROM events)""")
def q_variant_flatten(spark, sf_dir):
    """S1 + P1: every scalar of the JSON properties with its path and kind, without a schema."""
    e = Tables(spark, sf_dir).events.select("event_id", variants.parsed("props").alias("props"))
    return variants.leaves(e, "props", 1)
