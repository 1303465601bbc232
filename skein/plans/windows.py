"""Window and ordering queries (W4-W9, O5-O7) on the driver tables.

``events`` plays quotes per symbol (event_type) and per-user state.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from skein.operators import paging, windows
from skein.plans.common import DAY_MS, epoch_ms
from skein.plans.registry import query
from skein.sources.tables import Tables

N_HISTORY = 50


def _quotes(t):
    return t.events.select(F.col("event_type").alias("symbol"), "ts", "event_id", F.col("value").alias("price"))


@query("rolling_history", sql=f"""
    SELECT event_id, event_type AS symbol,
           list(value) OVER (PARTITION BY event_type ORDER BY ts, event_id
                             ROWS BETWEEN {N_HISTORY - 1} PRECEDING AND CURRENT ROW) AS history
    FROM events""")
def q_rolling_history(spark, sf_dir):
    """The last 50 prices of the symbol at every quote."""
    q = _quotes(Tables(spark, sf_dir))
    h = windows.history_last_n(q, "symbol", [F.col("ts"), F.col("event_id")], "price", N_HISTORY)
    return h.select("event_id", "symbol", "history")


@query("count_blocks", sql=f"""
    SELECT symbol, (rn // {N_HISTORY})::BIGINT AS block, count(*) AS n FROM (
      SELECT event_type AS symbol, row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) - 1 AS rn
      FROM events) GROUP BY ALL""")
def q_count_blocks(spark, sf_dir):
    """Blocks of 50 consecutive quotes per symbol and their sizes."""
    q = _quotes(Tables(spark, sf_dir)).withColumn("ms", epoch_ms("ts"))
    ix = windows.dense_index(q, ["symbol"], None, [F.col("ts"), F.col("event_id")])
    return ix.groupBy("symbol", F.floor(F.col("idx") / N_HISTORY).cast("long").alias("block")).agg(
        F.count(F.lit(1)).alias("n"))


@query("step_ratio", sql="""
    SELECT event_id, round(r, 6) AS ratio, (r >= 0.95 AND r < 1.05) AS in_bound FROM (
      SELECT event_id, value / lag(value) OVER (PARTITION BY event_type ORDER BY ts, event_id) AS r FROM events)""")
def q_step_ratio(spark, sf_dir):
    """next/last price ratio and whether it stays inside [0.95, 1.05)."""
    q = _quotes(Tables(spark, sf_dir))
    s = windows.step_ratio(q, "symbol", [F.col("ts"), F.col("event_id")], "price")
    return s.select("event_id", F.round("ratio", 6).alias("ratio"), "in_bound")


@query("sample_interval", sql=f"""
    SELECT user_id, frame_order, event_id FROM (
      SELECT user_id, (epoch_us(ts) // 1000 // {DAY_MS})::BIGINT AS frame_order, event_id,
             row_number() OVER (PARTITION BY user_id, epoch_us(ts) // 1000 // {DAY_MS} ORDER BY ts, event_id) AS rn
      FROM events) WHERE rn = 1""")
def q_sample_interval(spark, sf_dir):
    """The first event at or after each day boundary, per user."""
    e = Tables(spark, sf_dir).events
    s = windows.first_per_interval(e, "user_id", epoch_ms("ts"), [F.col("ts"), F.col("event_id")], DAY_MS)
    return s.select("user_id", "frame_order", "event_id")


@query("assign_ids", sql="""
    SELECT event_id, (999 + row_number() OVER (ORDER BY ts, event_id))::BIGINT AS id FROM events""")
def q_assign_ids(spark, sf_dir):
    """Dense ids from 1000 in (ts, event_id) order, numbered per day block."""
    e = Tables(spark, sf_dir).events.select("event_id", "ts")
    out = windows.assign_ids(e, [F.col("ts"), F.col("event_id")], start=1000)
    return out.select("event_id", "id")


@query("latest_state", sql="""
    SELECT user_id, value FROM (
      SELECT user_id, value, event_type, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn
      FROM events) WHERE rn = 1 AND event_type <> 'error'""")
def q_latest_state(spark, sf_dir):
    """Last-writer-wins map per user: any event puts its value, an error removes it."""
    e = Tables(spark, sf_dir).events
    last = windows.latest_per_key(e.select("user_id", "ts", "event_id", "event_type", "value"), ["user_id"],
                                  [F.col("ts"), F.col("event_id")])
    return last.filter(F.col("event_type") != "error").select("user_id", "value")


@query("natural_sort", sql="""
    SELECT page_id, url, array_to_string(list_transform(regexp_extract_all(url, '(\\d+|\\D+)', 1),
        lambda p: CASE WHEN regexp_full_match(p, '\\d+')
                       THEN lpad(length(regexp_replace(p, '^0+(\\d)', '\\1'))::VARCHAR, 10, '0') || regexp_replace(p, '^0+(\\d)', '\\1')
                       ELSE lower(p) END), chr(1)) AS sort_key FROM pages""")
def q_natural_sort(spark, sf_dir):
    """Natural sort key (digit runs compare as numbers)."""
    p = Tables(spark, sf_dir).pages
    return p.select("page_id", "url", paging.natural_sort_key("url").alias("sort_key"))


@query("options", sql="""
    SELECT n_nationkey::VARCHAR AS value, n_name AS label, row_number() OVER (ORDER BY n_name, n_nationkey)::BIGINT AS rank
    FROM nation""")
def q_options(spark, sf_dir):
    """Option list (id as text, name) ordered by name; positions by the
    distributed ``dense_index`` (no single task numbers the list)."""
    from skein.plans.listing import companies

    c = companies(Tables(spark, sf_dir))
    r = windows.dense_index(c, [], None, [F.col("n_name"), F.col("n_nationkey")], out="rank", start=1)
    return r.select(F.col("n_nationkey").cast("string").alias("value"), F.col("n_name").alias("label"), "rank")


@query("largest_groups", sql="""
    SELECT user_id, n, rank FROM (
      SELECT user_id, count(*) AS n, row_number() OVER (ORDER BY count(*) DESC, user_id)::BIGINT AS rank
      FROM events GROUP BY user_id) WHERE rank <= 10""")
def q_largest_groups(spark, sf_dir):
    """Keep the 10 largest groups."""
    g = Tables(spark, sf_dir).events.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
    keys = [F.col("n").desc(), F.col("user_id")]
    return paging.page(g, keys, 0, 10).select("user_id", "n", "rank")
