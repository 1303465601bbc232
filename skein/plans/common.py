"""Shared derivations of the driver tables used by several query modules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skein.operators.windows import dense_index
from skein.sources.tables import Tables

DAY_MS = 86_400_000
WEEK_MS = 7 * DAY_MS


def epoch_ms(c: str | Column) -> Column:
    """Milliseconds since 1970 of a TIMESTAMP_NTZ column, independent of the session zone."""
    c = F.col(c) if isinstance(c, str) else c
    us = F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), c)
    return F.floor(us / 1000).cast("long")


def event_samples(t: Tables) -> DataFrame:
    """Events as audio samples: song = user, sample value = ``value``, position by (ts, event_id)."""
    ev = t.events.select("event_id", "user_id", "ts", "value")
    ev = ev.withColumn("ms", epoch_ms("ts"))
    s = dense_index(ev, ["user_id"], None,
                    [F.col("ms"), F.col("event_id")], out="i")
    return s.select(F.col("user_id").alias("song_id"), "i", F.col("value").alias("v"))


SAMPLES_SQL = """
    SELECT user_id AS song_id,
           (row_number() OVER (PARTITION BY user_id ORDER BY epoch_us(ts) // 1000, event_id) - 1)::BIGINT AS i,
           value AS v
    FROM events
"""
