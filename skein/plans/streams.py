"""Streaming queries: each replays a table as three micro-batches and drains
that stream (``availableNow``) into a sink under the shared checkpoint folder. The
oracle is the batch rule, including what the final watermark leaves open."""

from __future__ import annotations

from pyspark.sql import functions as F

from skein.operators import match
from skein.plans import fingerprint as fp
from skein.plans.common import WEEK_MS
from skein.plans.registry import ORACLE_SQL, query
from skein.session import materialize
from skein.sources.tables import Tables
from skein.functions import scalars as SC
from skein.streaming import stateful
from skein.streaming import streams as S

# The default watch list (symbols of the quote stream).
DEFAULT_WATCH = ["click", "view", "purchase"]
SYMBOLS = ["signup", "error", "click", "view", "purchase"]


#: where the events' replay is cut into micro-batches
CUTS = ["2024-01-10 12:00:00", "2024-01-20 12:00:00"]


def _events(spark, sf_dir):
    return S.replayed(Tables(spark, sf_dir).events, "ts", CUTS)


def _quotes(spark, sf_dir):
    e = _events(spark, sf_dir)
    return e.select(F.col("event_type").alias("symbol"), "ts", "event_id", F.col("value").alias("price"))


@query("throttle", sql="""
    SELECT event_type AS symbol, make_timestamp((epoch_us(ts) // 75000) * 75000) AS window_start,
           arg_max(value, (ts, event_id)) AS price
    FROM events GROUP BY ALL
    HAVING ((epoch_us(ts) // 75000) + 1) * 75000 <= (SELECT epoch_us(max(ts)) FROM events)""")
def q_throttle(spark, sf_dir):
    """The latest price per symbol per 75 ms window (drained stream)."""
    return S.run_to_table(S.throttle(_quotes(spark, sf_dir)), "throttle")


@query("stream_history", sql="""
    SELECT symbol, list(price ORDER BY ts, event_id) AS history, any_value(n) AS seen FROM (
      SELECT event_type AS symbol, value AS price, ts, event_id, count(*) OVER (PARTITION BY event_type) AS n,
             row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, event_id DESC) AS rn FROM events)
    WHERE rn <= 50 GROUP BY symbol""")
def q_stream_history(spark, sf_dir):
    """Per symbol the last 50 prices kept in streaming state (latest emission)."""
    return S.merged_history(S.run_to_table(S.keyed_history(_quotes(spark, sf_dir)), "history"))


_WATCH_SQL = f"""
  cut AS (SELECT * FROM (VALUES (0, TIMESTAMP '1970-01-01', TIMESTAMP '{CUTS[0]}'), (1, TIMESTAMP '{CUTS[0]}', TIMESTAMP '{CUTS[1]}'),
                                (2, TIMESTAMP '{CUTS[1]}', TIMESTAMP '2100-01-01')) v(batch, low, high)),
  cmd AS (SELECT user_id, ['signup','error','click','view','purchase'][json_extract(props, '$.k')::INTEGER % 5 + 1] AS symbol,
                 CASE WHEN event_type = 'signup' THEN 'watch' ELSE 'unwatch' END AS action, ts, event_id
          FROM events WHERE event_type IN ('signup', 'error')),
  last AS (SELECT batch, user_id, symbol, arg_max(action, (ts, event_id)) AS action FROM cmd JOIN cut ON ts < low GROUP BY ALL),
  dflt AS (SELECT batch, u.user_id, s.symbol FROM cut, (SELECT DISTINCT user_id FROM events) u,
                  (SELECT unnest({DEFAULT_WATCH!r}) AS symbol) s),
  watching AS (SELECT batch, user_id, symbol FROM last WHERE action = 'watch'
               UNION ALL SELECT d.* FROM dflt d ANTI JOIN last l USING (batch, user_id, symbol)),
  sums AS (SELECT batch, event_type AS symbol, count(*) AS quotes, sum(value) AS total_price
           FROM events JOIN cut ON ts >= low AND ts < high GROUP BY ALL)"""


@query("stream_watch", sql=f"""WITH {_WATCH_SQL}
    SELECT batch, user_id, symbol, quotes, round(total_price, 4) AS total_price FROM watching JOIN sums USING (batch, symbol)""")
def q_stream_watch(spark, sf_dir):
    """T4: what every watcher got in each micro-batch; watch and unwatch commands arrive in the same stream and take
    effect between micro-batches. An event without a time is in no batch of the rule."""
    e = _events(spark, sf_dir).filter(F.col("ts").isNotNull())
    symbol = F.element_at(F.array(*[F.lit(s) for s in SYMBOLS]), (F.get_json_object("props", "$.k").cast("int") % 5 + 1))
    action = F.when(F.col("event_type") == "signup", "watch").when(F.col("event_type") == "error", "unwatch")
    common = ["user_id", F.col("value").alias("price"), "ts", "event_id"]
    quotes = e.select(F.lit("quote").alias("kind"), F.col("event_type").alias("symbol"), F.lit(None).cast("string").alias("action"), *common)
    commands = e.filter(action.isNotNull()).select(F.lit("command").alias("kind"), symbol.alias("symbol"), action.alias("action"), *common)
    users = Tables(spark, sf_dir).events.select("user_id").distinct()
    out = S.run_to_table(quotes.unionByName(commands), "watch", foreach=S.deliver(users, DEFAULT_WATCH))
    return out.select(F.col("batch").cast("int").alias("batch"), "user_id", "symbol", "quotes", F.round("total_price", 4).alias("total_price"))


def _commands(e):
    symbol = F.element_at(F.array(*[F.lit(s) for s in SYMBOLS]), (F.get_json_object("props", "$.k").cast("int") % 5 + 1))
    action = F.when(F.col("event_type") == "signup", "watch").when(F.col("event_type") == "error", "unwatch")
    return e.filter(action.isNotNull()).select("user_id", symbol.alias("symbol"), action.alias("action"), "ts", "event_id")


@query("watch_intervals", sql=f"""
  WITH cmd AS (SELECT user_id, ['signup','error','click','view','purchase'][json_extract(props, '$.k')::INTEGER % 5 + 1] AS symbol,
                      event_type = 'signup' AS on_, ts, event_id FROM events WHERE event_type IN ('signup', 'error')),
  edge AS (SELECT *, coalesce(lag(on_) OVER (PARTITION BY user_id, symbol ORDER BY ts, event_id), symbol IN {tuple(DEFAULT_WATCH)!r}) AS was FROM cmd),
  flip AS (SELECT * FROM edge WHERE on_ <> was),
  iv AS (SELECT user_id, symbol, on_, lag(ts) OVER w AS a, lag(event_id) OVER w AS a_id, ts AS b, event_id AS b_id FROM flip
         WINDOW w AS (PARTITION BY user_id, symbol ORDER BY ts, event_id)),
  q AS (SELECT event_type AS symbol, ts, event_id, value FROM events)
  SELECT iv.user_id, iv.symbol, a AS watch_from, b AS watch_to, count(q.ts) AS quotes, round(coalesce(sum(q.value), 0), 4) AS total_price
  FROM iv LEFT JOIN q ON q.symbol = iv.symbol AND (q.ts, q.event_id) < (b, b_id) AND (a IS NULL OR (q.ts, q.event_id) > (a, a_id))
  WHERE NOT on_ AND date_trunc('millisecond', b) < (SELECT date_trunc('millisecond', max(ts)) FROM events) GROUP BY iv.user_id, iv.symbol, a, b, b_id""")
def q_watch_intervals(spark, sf_dir):
    """T4 in event time: each closed interval in which a user watched a symbol, with its quotes."""
    e = _events(spark, sf_dir)
    quotes = e.select(F.col("event_type").alias("symbol"), "ts", "event_id", F.col("value").alias("price"))
    out = stateful.run_stateful(stateful.watch_intervals(quotes, _commands(e), DEFAULT_WATCH), "watch-intervals")
    ntz = lambda c: F.col(c).cast("timestamp_ntz").alias(c)
    return out.select("user_id", "symbol", ntz("watch_from"), ntz("watch_to"), "quotes", F.round("total_price", 4).alias("total_price"))


@query("stream_merge", sql="""
    SELECT 'events' AS source, event_id AS key, event_type AS text FROM events
    UNION ALL SELECT 'chat', conv_id * 1000 + turn, role FROM conversations""")
def q_stream_merge(spark, sf_dir):
    """T5: two producers merged into one stream, fanned out to two sinks per batch."""
    a = _events(spark, sf_dir).select(
        F.lit("events").alias("source"), F.col("event_id").alias("key"), F.col("event_type").alias("text"))
    b = S.table_stream(spark, sf_dir, "conversations").select(
        F.lit("chat").alias("source"), (F.col("conv_id") * 1000 + F.col("turn")).alias("key"),
        F.col("role").alias("text"))
    return S.run_to_table(a.unionByName(b), "merge", foreach=S.fan_out(["copy"])).drop("batch")


@query("stream_sanitize", sql=f"SELECT page_id, {SC.sanitize_sql('html')} AS clean, html IS NULL AS rejected FROM pages")
def q_stream_sanitize(spark, sf_dir):
    """Messages cleaned as they stream; rows without text flagged, not fatal."""
    p = S.table_stream(spark, sf_dir, "pages")
    return S.run_to_table(S.sanitize_messages(p).select("page_id", "clean", "rejected"), "sanitize")


@query("sessions", sql="""
    WITH e AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) < INTERVAL 5 MINUTE
                                        THEN 0 ELSE 1 END AS brk FROM events),
    s AS (SELECT user_id, ts, sum(brk) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS sid FROM e)
    SELECT user_id, min(ts) AS session_start, max(ts) + INTERVAL 5 MINUTE AS session_end, count(*) AS events
    FROM s GROUP BY user_id, sid HAVING max(ts) + INTERVAL 5 MINUTE <= (SELECT max(ts) FROM events)""")
def q_sessions(spark, sf_dir):
    """5-minute sessions per user from the drained stream."""
    return S.run_to_table(S.sessions(_events(spark, sf_dir)), "sessions")


@query("running_count", sql="""
    SELECT user_id AS key, event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n FROM events""")
def q_running_count(spark, sf_dir):
    """A running counter per user, the new value for every increment."""
    return S.run_to_table(_events(spark, sf_dir), "count", foreach=S.number_batches("user_id")).drop("batch")


@query("session_cache", sql="""
    WITH e AS (SELECT user_id, ts, event_id, event_type = 'error' AS bad,
                      lag(ts) OVER w AS before, coalesce(lag(event_type) OVER w = 'error', true) AS after_bad
               FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
    f AS (SELECT *, NOT bad AND (after_bad OR ts - before >= INTERVAL 5 MINUTE) AS starts,
                 bad AND NOT after_bad AND ts - before < INTERVAL 5 MINUTE AS evicts,
                 bad AND NOT after_bad AND ts - before >= INTERVAL 5 MINUTE AS too_late FROM e),
    g AS (SELECT *, sum(starts::INTEGER) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS sid FROM f
          WHERE starts OR NOT bad OR evicts),
    s AS (SELECT user_id, sid, min(ts) AS session_start, max(ts) AS last_seen, count(*) AS events,
                 CASE WHEN bool_or(evicts) THEN 'evicted' ELSE 'expired' END AS ended FROM g GROUP BY user_id, sid)
    SELECT user_id, session_start, last_seen, events, ended FROM s
    WHERE ended = 'evicted' OR last_seen + INTERVAL 5 MINUTE <= (SELECT max(ts) FROM events)""")
def q_session_cache(spark, sf_dir):
    """T7 with explicit eviction: an error event ends its user's session at once."""
    out = S.run_to_table(_events(spark, sf_dir), "cache", foreach=S.session_batches())
    ntz = lambda c: F.col(c).cast("timestamp_ntz").alias(c)
    return out.select("user_id", ntz("session_start"), ntz("last_seen"), "events", "ended")


@query("session_state", sql=ORACLE_SQL["session_cache"])
def q_session_state(spark, sf_dir):
    """T7 with explicit eviction on keyed state with timers: users dealt over slices of time, their runs merged by a second operator."""
    out = stateful.run_stateful(stateful.stateful_sessions(_events(spark, sf_dir)), "session-state")
    ntz = lambda c: F.col(c).cast("timestamp_ntz").alias(c)
    return out.select("user_id", ntz("session_start"), ntz("last_seen"), "events", "ended")


@query("history_state", sql=ORACLE_SQL["stream_history"])
def q_history_state(spark, sf_dir):
    """T3/T9 on keyed list state: per symbol the last 50 prices."""
    rows = S.history_rows(_quotes(spark, sf_dir))
    return S.merged_history(stateful.run_stateful(stateful.stateful_history(rows, 50), "history-state"))


@query("status_counts", sql="SELECT event_type AS status, count(*) AS n FROM events GROUP BY ALL")
def q_status_counts(spark, sf_dir):
    """Totals per status (complete mode, newest totals replace the table)."""
    return S.run_to_table(S.status_counts(_events(spark, sf_dir)), "status",
                          mode="complete", foreach=S.overwrite_batches)


@query("stream_match", sql=fp._FP_SQL + ", " + fp._TIMING_SQL + f"""
    SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY request_id ORDER BY score DESC, song_id)::BIGINT AS rank
                   FROM scores) WHERE rank <= {fp.TOP_K}
      AND (request_id % 10000 + 1) * {WEEK_MS} <= (SELECT epoch_ms(max(ts)) FROM events)""")
def q_stream_match(spark, sf_dir):
    """Recordings arrive as a stream; a clip's events are collected until the watermark has passed its week,
    then it is fingerprinted, matched against the stored index and answered with its top 10, once."""
    t = Tables(spark, sf_dir)
    index = materialize(fp.library_index(t), "stored_index")
    songs = fp.songs(t)

    def answer(events, batch_id, out):
        clips = fp.clip_fingerprints(t, events)
        top = match.top_matches(match.match_scores(match.fingerprint_join(clips, index), songs), fp.TOP_K)
        top.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    events = _events(spark, sf_dir).select("user_id", "event_id", "ts", "value")
    return S.run_to_table(events, "match", foreach=S.closed_windows("ts", "7 days", answer)).drop("batch")
