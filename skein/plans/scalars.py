"""Scalar-function queries (F10-F17) on the driver tables (whole texts)."""

from __future__ import annotations

from pyspark.sql import functions as F

from skein.functions import scalars as S
from skein.plans.registry import query
from skein.sources.tables import Tables

_DUR_TEXT_SQL = """CASE event_type
      WHEN 'click' THEN user_id::VARCHAR || ':' || floor(value)::BIGINT::VARCHAR
      WHEN 'view' THEN '1:' || (user_id % 60)::VARCHAR || ':' || floor(value)::BIGINT::VARCHAR
      WHEN 'error' THEN 'x:' || floor(value)::BIGINT::VARCHAR
      WHEN 'purchase' THEN '1:2:3:' || floor(value)::BIGINT::VARCHAR
      ELSE floor(value)::BIGINT::VARCHAR END"""


def _dur_text():
    v = F.floor("value").cast("long").cast("string")
    u = F.col("user_id").cast("string")
    return (F.when(F.col("event_type") == "click", F.concat(u, F.lit(":"), v))
            .when(F.col("event_type") == "view",
                  F.concat(F.lit("1:"), (F.col("user_id") % 60).cast("string"), F.lit(":"), v))
            .when(F.col("event_type") == "error", F.concat(F.lit("x:"), v))
            .when(F.col("event_type") == "purchase", F.concat(F.lit("1:2:3:"), v))
            .otherwise(v))


@query("duration_seconds", sql=f"""
    SELECT event_id, {_DUR_TEXT_SQL} AS text,
      (CASE len(string_split({_DUR_TEXT_SQL}, ':'))
         WHEN 1 THEN coalesce(try_cast(string_split({_DUR_TEXT_SQL}, ':')[1] AS INTEGER), 0)
         WHEN 2 THEN coalesce(try_cast(string_split({_DUR_TEXT_SQL}, ':')[1] AS INTEGER), 0) * 60
                   + coalesce(try_cast(string_split({_DUR_TEXT_SQL}, ':')[2] AS INTEGER), 0)
         WHEN 3 THEN coalesce(try_cast(string_split({_DUR_TEXT_SQL}, ':')[1] AS INTEGER), 0) * 3600
                   + coalesce(try_cast(string_split({_DUR_TEXT_SQL}, ':')[2] AS INTEGER), 0) * 60
                   + coalesce(try_cast(string_split({_DUR_TEXT_SQL}, ':')[3] AS INTEGER), 0)
         ELSE 0 END)::INTEGER AS seconds
    FROM events""")
def q_duration_seconds(spark, sf_dir):
    """"H:M:S" text -> seconds; bad parts 0, four parts 0."""
    e = Tables(spark, sf_dir).events.withColumn("text", _dur_text())
    return e.select("event_id", "text", S.duration_seconds("text").alias("seconds"))


@query("ascii_lower", sql="""
    SELECT conv_id, turn, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS lower_text
    FROM conversations""")
def q_ascii_lower(spark, sf_dir):
    """ASCII-only lower case of whole messages (accented letters unchanged)."""
    c = Tables(spark, sf_dir).conversations
    return c.select("conv_id", "turn", S.ascii_lower("text").alias("lower_text"))


@query("clean_name", sql="""
    SELECT page_id, replace(url, '/', '\\') AS unix_name,
           regexp_replace(url, '[<>:"\\\\/|?*]', '', 'g') AS windows_name FROM pages""")
def q_clean_name(spark, sf_dir):
    """file-name cleaning, both platform rules."""
    p = Tables(spark, sf_dir).pages
    return p.select("page_id", S.clean_file_name("url").alias("unix_name"),
                    S.clean_file_name("url", windows=True).alias("windows_name"))


@query("url_encoded", sql="""
    SELECT conv_id, turn, replace(replace(replace(url_encode(text), '%20', '+'), '%2A', '*'), '~', '%7E') AS encoded FROM conversations""")
def q_url_encoded(spark, sf_dir):
    """query-string (form) encoding of whole messages."""
    c = Tables(spark, sf_dir).conversations
    return c.select("conv_id", "turn", S.query_encode("text").alias("encoded"))


@query("time_formats", sql="""
    SELECT event_id, strftime(ts, '%Y-%m-%d') AS day, strftime(ts, '%H %M %S') AS clock,
           strftime(ts, '%Y-%m-%dT%H:%M:%S.%g') || 'Z' AS iso,
           strftime(ts, '%a, %d %b %Y %H:%M:%S') || ' GMT' AS rfc1123,
           try_strptime(CASE WHEN event_type = 'error' THEN 'no date' ELSE strftime(ts, '%Y-%m-%d') END,
                        '%Y-%m-%d')::DATE AS parsed
    FROM events""")
def q_time_formats(spark, sf_dir):
    """date / clock / ISO / RFC-1123 formatting and tolerant date parsing."""
    e = Tables(spark, sf_dir).events
    text = F.when(F.col("event_type") == "error", F.lit("no date")).otherwise(F.date_format("ts", "yyyy-MM-dd"))
    return e.select(
        "event_id",
        F.date_format("ts", "yyyy-MM-dd").alias("day"),
        F.date_format("ts", "HH mm ss").alias("clock"),
        F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS"), F.lit("Z")).alias("iso"),
        F.concat(F.date_format("ts", "EEE, dd MMM yyyy HH:mm:ss"), F.lit(" GMT")).alias("rfc1123"),
        F.try_to_date(text, "yyyy-MM-dd").alias("parsed"),
    )


@query("epoch_dates", sql="""
    SELECT o_orderkey, epoch_us(o_orderdate) // 1000 AS ms,
           make_timestamp((epoch_us(o_orderdate) // 1000) * 1000) AS back, o_orderdate::DATE AS day
    FROM orders""")
def q_epoch_dates(spark, sf_dir):
    """timestamps <-> epoch milliseconds."""
    o = Tables(spark, sf_dir).orders.withColumn("ms", S.epoch_millis_ntz("o_orderdate"))
    return o.select("o_orderkey", "ms", S.ntz_from_millis("ms").alias("back"),
                    F.to_date("o_orderdate").alias("day"))


@query("pcm_quantise", sql="""
    SELECT event_id, trunc((value / 500 - 0.5 + 1.0) * 127.5)::INTEGER AS pcm8,
           trunc((value / 500 - 0.5) * 32767.0)::INTEGER AS pcm16,
           trunc((value / 500 - 0.5) * 8388607.0)::INTEGER AS pcm24,
           trunc((value / 500 - 0.5) * 2147483647.0)::BIGINT AS pcm32
    FROM events""")
def q_pcm_quantise(spark, sf_dir):
    """F16: amplitudes in [-1, 1] to 8/16/24/32-bit PCM integers."""
    e = Tables(spark, sf_dir).events.withColumn("s", F.col("value") / 500 - 0.5)
    return e.select("event_id", *[S.pcm_quantise("s", b).alias(f"pcm{b}") for b in (8, 16, 24, 32)])


@query("sanitize_html", sql=f"SELECT page_id, {S.sanitize_sql('html')} AS clean FROM pages")
def q_sanitize_html(spark, sf_dir):
    """whole pages cleaned to text plus safe-list tags."""
    p = Tables(spark, sf_dir).pages
    return p.select("page_id", S.sanitize_html("html").alias("clean"))
