"""Structured Streaming operators.

Each operator maps a streaming DataFrame to a streaming DataFrame (or runs a
``foreachBatch``). Event time is the ``ts`` column; a TIMESTAMP_NTZ column
is cast to TIMESTAMP before ``withWatermark`` (watermarks need it). State
is kept by Spark's state store and checkpointed, so a query restarted after
an executor or driver loss resumes where it stopped. Checkpoints and file
sinks live under the shared ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupStateTimeout

from skein.functions.scalars import sanitize_html
from skein.operators.sizing import null_safe_join
from skein.operators.windows import dense_index
from skein.session import _tables_dir, materialize


# ------------------------------------------------------------------- plumbing
def table_stream(spark: SparkSession, sf_dir: str, name: str, max_files: int | None = None) -> DataFrame:
    """A parquet table, one file or a folder of files, replayed as a stream."""
    path = f"{sf_dir}/{name}.parquet"
    r = spark.readStream.schema(spark.read.parquet(path).schema)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.parquet(f"{path[:-1]}[{path[-1]}]")  # as a pattern: a stream takes a plain path for a folder


_LIVE = "__live"


def replayed(df: DataFrame, ts: str, cuts: list[str]) -> DataFrame:
    """``df`` as a stream of ``len(cuts) + 1`` micro-batches: the rows before the first cut, those between each two,
    and the rest with those without a time, in this order. Inside a batch rows come in no particular order.

    One write deals the rows to a folder per part and the same number of files in each (of as many as ``df`` has partitions,
    shuffle partitions at most); a row of its own keeps a file without rows. Files are given the times of their parts, which
    is the order that the stream reads them in."""
    spark = df.sparkSession
    base = f"{_tables_dir(spark)}/streams/replay-{uuid.uuid4().hex}"
    files = max(1, min(df.rdd.getNumPartitions(), int(spark.conf.get("spark.sql.shuffle.partitions"))))
    kind = df.schema[ts].dataType
    part = F.lit(len(cuts))
    for i, cut in reversed(list(enumerate(cuts))):  # a NULL time is below no cut
        part = F.when(F.col(ts) < F.lit(cut).cast(kind), F.lit(i)).otherwise(part)
    slots = (len(cuts) + 1) * files
    rows = df.withColumns({"__part": part, "__slot": F.pmod(F.monotonically_increasing_id(), F.lit(files)).cast("int"), _LIVE: F.lit(True)})
    marks = spark.range(slots).select(F.expr(f"cast(id div {files} as int)").alias("__part"), (F.col("id") % files).cast("int").alias("__slot"), F.lit(False).alias(_LIVE))
    rows = rows.unionByName(marks, allowMissingColumns=True)
    dealt = rows.repartitionById(slots, F.col("__part") * files + F.col("__slot")).drop("__slot")
    dealt.write.partitionBy("__part").option("maxRecordsPerFile", 0).parquet(base)
    _in_order_of_parts(spark, base, len(cuts) + 1)
    schema = T.StructType([*df.schema.fields, T.StructField(_LIVE, T.BooleanType()), T.StructField("__part", T.IntegerType())])
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(base)
    return stream.filter(_LIVE).drop(_LIVE, "__part")


def _in_order_of_parts(spark: SparkSession, base: str, parts: int) -> None:
    """Sets the files' times to their part's number, in seconds after the first one written (names and times only, no data)."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs = path(base).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    first = fs.getFileStatus(path(base)).getModificationTime()
    for i in range(parts):
        for status in fs.listStatus(path(f"{base}/__part={i}")):
            fs.setTimes(status.getPath(), first + 1000 * i, -1)


def with_event_time(df: DataFrame, ts: str = "ts", out: str = "ets") -> DataFrame:
    return df.withColumn(out, F.col(ts).cast("timestamp"))


def run_to_table(df: DataFrame, name: str, mode: str = "append",
                 foreach: Callable | None = None) -> DataFrame:
    """Drain ``df`` (``availableNow``) into a parquet sink in the shared checkpoint
    folder and return the sink as a batch DataFrame."""
    spark = df.sparkSession
    base = f"{_tables_dir(spark)}/streams/{name}-{uuid.uuid4().hex}"  # released with the other written tables
    w = df.writeStream.option("checkpointLocation", f"{base}/_checkpoint").trigger(availableNow=True)
    if foreach is not None:
        q = w.foreachBatch(lambda b, i: foreach(b, i, f"{base}/out")).outputMode(mode).start()
    else:
        q = w.format("parquet").option("path", f"{base}/out").outputMode(mode).start()
    q.awaitTermination()
    return spark.read.parquet(f"{base}/out")


# ------------------------------------------------------------------ operators
def clock_stream(spark: SparkSession, rows_per_second: int = 10) -> DataFrame:
    """One row per 1/rows_per_second s with the time formatted two ways."""
    r = spark.readStream.format("rate").option("rowsPerSecond", rows_per_second).load()
    return r.select("timestamp", F.date_format("timestamp", "HH mm ss").alias("clock"),
                    F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSXXX").alias("iso"))


def throttle(quotes: DataFrame, every: str = "75 milliseconds", delay: str = "0 seconds") -> DataFrame:
    """At most one update per symbol per interval: the latest price of each
    tumbling window (of equal times the one with the largest id), emitted once the watermark passes the window."""
    q = with_event_time(quotes).withWatermark("ets", delay)
    g = q.groupBy("symbol", F.window("ets", every).alias("w")).agg(F.max_by("price", F.struct("ets", "event_id")).alias("price"))
    return g.select("symbol", F.col("w.start").cast("timestamp_ntz").alias("window_start"), "price")


HISTORY_SCHEMA = "symbol string, part int, ts array<long>, ids array<long>, prices array<double>, seen long"
HISTORY_STATE = "ts array<long>, ids array<long>, prices array<double>, seen long"
HISTORY_PARTS = 8
NO_TIME = -(1 << 63)  # a quote without a time: older than all others, but last in the history


def keyed_history(quotes: DataFrame, n: int = 50, parts: int = HISTORY_PARTS) -> DataFrame:
    """The last ``n`` prices of each symbol, by (ts, event_id), updated every micro-batch.

    A symbol is dealt over ``parts`` states (by a hash of the event), so a few hot symbols don't carry the stream
    in a few tasks; each state keeps the newest ``n`` of its rows, in whatever order and chunks they come.
    ``merged_history`` puts the parts together."""

    def fn(key, pdfs, state):
        kept = pd.DataFrame({"ts": [], "event_id": [], "price": []})
        seen = 0
        if state.exists:
            ts, ids, prices, seen = state.get
            kept = pd.DataFrame({"ts": list(ts), "event_id": list(ids), "price": list(prices)})
        for pdf in pdfs:
            seen += len(pdf)
            kept = pd.concat([kept, pdf[["ts", "event_id", "price"]]]).sort_values(["ts", "event_id"]).tail(n)
        ts, ids, prices = kept["ts"].astype("int64").tolist(), kept["event_id"].astype("int64").tolist(), kept["price"].tolist()
        state.update((ts, ids, prices, int(seen)))
        yield pd.DataFrame({"symbol": [key[0]], "part": [key[1]], "ts": [ts], "ids": [ids], "prices": [prices], "seen": [seen]})

    return history_rows(quotes, parts).groupBy("symbol", "part").applyInPandasWithState(fn, HISTORY_SCHEMA, HISTORY_STATE, "append", GroupStateTimeout.NoTimeout)


def history_rows(quotes: DataFrame, parts: int = HISTORY_PARTS) -> DataFrame:
    """Quotes as (symbol, part, ts in microseconds, event_id, price)."""
    micros = F.unix_micros(F.col("ts").cast("timestamp"))
    part = F.pmod(F.xxhash64("event_id"), F.lit(parts)).cast("int")
    return quotes.select("symbol", part.alias("part"), F.coalesce(micros, F.lit(NO_TIME)).alias("ts"), F.col("event_id").cast("long").alias("event_id"),
                         F.col("price").cast("double").alias("price"))


def merged_history(parts: DataFrame, n: int = 50) -> DataFrame:
    """(symbol, history, seen) from the newest emission of each part."""
    last = parts.groupBy("symbol", "part").agg(F.max_by(F.struct("ts", "ids", "prices", "seen"), "seen").alias("x"))
    seen = last.groupBy("symbol").agg(F.sum("x.seen").alias("seen"))
    rows = last.select("symbol", F.inline(F.arrays_zip("x.ts", "x.ids", "x.prices")))
    top = rows.groupBy("symbol").agg(F.sort_array(F.collect_list(F.struct("ts", "ids", "prices"))).alias("rows"))  # parts * n at most
    newest = F.slice("rows", F.greatest(F.size("rows") - n + 1, F.lit(1)), n)
    last_none = F.concat(F.filter(newest, lambda r: r["ts"] != NO_TIME), F.filter(newest, lambda r: r["ts"] == NO_TIME))
    history = F.transform(last_none, lambda r: r["prices"])
    return top.select("symbol", history.alias("history")).join(seen, "symbol")


def watched_quotes(quotes: DataFrame, watching: DataFrame) -> DataFrame:
    """T4: what every watcher gets: (user_id, symbol, quotes, total_price). Quotes are summed up per symbol first,
    so the join has one row per watcher and symbol, not one per watcher and quote."""
    sums = quotes.groupBy("symbol").agg(F.count(F.lit(1)).alias("quotes"), F.sum("price").alias("total_price"))
    return watching.join(sums, "symbol").select("user_id", "symbol", "quotes", "total_price")


def deliver(users: DataFrame, defaults: list[str]) -> Callable:
    """T4 as a ``foreachBatch`` writer over rows (kind "quote" or "command", user_id, symbol, action, price, ts,
    event_id): a batch's quotes go to those who watch by the commands of earlier batches; its own commands take effect
    with the next batch. The last command of each user and symbol is kept as a table per batch, so a batch reads that and not
    all commands there ever were. Replaying a batch writes the same files again."""

    def write(batch: DataFrame, batch_id: int, out: str):
        spark = batch.sparkSession
        command = batch.filter("kind = 'command'").select("user_id", "symbol", "action", "ts", F.col("event_id").alias("seq"))
        before = spark.read.parquet(f"{out}_commands/batch={batch_id - 1}") if batch_id else command.limit(0)
        got = watched_quotes(batch.filter("kind = 'quote'"), watch_state(before, users, defaults))
        got.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")
        last = F.max_by(F.struct("action", "ts", "seq"), F.struct("ts", "seq")).alias("last")
        kept = before.unionByName(command).groupBy("user_id", "symbol").agg(last).select("user_id", "symbol", "last.*")
        kept.write.mode("overwrite").parquet(f"{out}_commands/batch={batch_id}")

    return write


def watch_state(commands: DataFrame, users: DataFrame, defaults: list[str]) -> DataFrame:
    """T4 state: latest command per (user, symbol) wins; every user starts with
    ``defaults`` (a literal list exploded per user, no cross join); watching
    twice is the same as once (Q18: one entry per symbol is kept)."""
    last = commands.groupBy("user_id", "symbol").agg(
        F.max_by("action", F.struct("ts", "seq")).alias("action"))
    default = users.select("user_id", F.explode(F.array(*[F.lit(s) for s in defaults])).alias("symbol"))
    dflt = default.join(last, ["user_id", "symbol"], "left_anti").withColumn("action", F.lit("watch"))
    return last.unionByName(dflt).filter(F.col("action") == "watch").select("user_id", "symbol")


def fan_out(sinks: list[str]) -> Callable:
    """T5: ``foreachBatch`` writer to many sinks; batch ``i`` goes to
    ``<sink>/batch=<i>`` with overwrite, so a replayed batch replaces itself."""

    def write(batch: DataFrame, batch_id: int, out: str):
        batch.persist()
        for s in [out] + [f"{out}_{k}" for k in sinks]:
            batch.write.mode("overwrite").parquet(f"{s}/batch={batch_id}")
        batch.unpersist()

    return write


def sanitize_messages(msgs: DataFrame, text: str = "html") -> DataFrame:
    """Stateless clean-up; rows without text go to a reject flag, never stop the stream."""
    return msgs.withColumn("clean", sanitize_html(text)).withColumn("rejected", F.col(text).isNull())


def sessions(events: DataFrame, key: str = "user_id", gap: str = "5 minutes", delay: str = "0 seconds") -> DataFrame:
    """Sessions that any event extends by ``gap``; a session closes once the
    watermark passes its end."""
    e = with_event_time(events).withWatermark("ets", delay)
    g = e.groupBy(key, F.session_window("ets", gap).alias("s")).agg(F.count(F.lit(1)).alias("events"))
    return g.select(key, F.col("s.start").cast("timestamp_ntz").alias("session_start"),
                    F.col("s.end").cast("timestamp_ntz").alias("session_end"), "events")


SESSION_OUT = "user_id long, session_start timestamp, last_seen timestamp, events long, ended string"
SESSION_STATE = "session_start timestamp, last_seen timestamp, events long"


def session_cache(events: DataFrame, gap_ms: int = 300_000, evict_type: str = "error") -> DataFrame:
    """T7 with explicit eviction: put/get (any event) refreshes the session,
    an ``evict_type`` event ends it at once, silence for ``gap_ms`` ends it on
    the event-time timeout. One key's rows of a micro-batch are put in order
    as a whole (they come in several chunks), in one task: ``session_batches`` is for sources without a bound on them."""

    def fn(key, pdfs, state):
        out = []
        if state.hasTimedOut:
            st, ls, n = state.get
            out.append((key[0], st, ls, n, "expired"))
            state.remove()
        else:
            cur = state.get if state.exists else None
            for pdf in [pd.concat(list(pdfs))]:
                for row in pdf.sort_values(["ets", "event_id"]).itertuples():
                    t = row.ets
                    if cur is not None and (t - cur[1]).total_seconds() * 1000 >= gap_ms:
                        out.append((key[0], cur[0], cur[1], cur[2], "expired"))
                        cur = None
                    if row.event_type == evict_type:
                        if cur is not None:
                            out.append((key[0], cur[0], t, cur[2] + 1, "evicted"))
                        cur = None
                        continue
                    cur = (t, t, 1) if cur is None else (cur[0], t, cur[2] + 1)
            if cur is None:
                if state.exists:
                    state.remove()
            else:
                state.update(cur)
                state.setTimeoutTimestamp(int(pd.Timestamp(cur[1]).timestamp() * 1000) + gap_ms)
        if out:
            yield pd.DataFrame(out, columns=["user_id", "session_start", "last_seen", "events", "ended"])

    e = with_event_time(events).withWatermark("ets", "0 seconds")
    return e.groupBy("user_id").applyInPandasWithState(
        fn, SESSION_OUT, SESSION_STATE, "append", GroupStateTimeout.EventTimeTimeout)


RUN_BLOCK = 10_000  # rows of a key whose session starts are counted by one task


def _clock(batch: DataFrame, batch_id: int, out: str, ts: str) -> tuple[int, int]:
    """(the latest time of the batches before, and with this one) in microseconds; kept as a row per batch."""
    spark = batch.sparkSession
    now = batch.select(F.max(F.unix_micros(F.col(ts).cast("timestamp"))).alias("at"))
    floor = -(1 << 63)
    before = spark.read.parquet(f"{out}_clock/batch={batch_id - 1}").first()["at"] if batch_id else floor
    now.select(F.greatest(F.coalesce("at", F.lit(floor)), F.lit(before)).alias("at")).write.mode("overwrite").parquet(f"{out}_clock/batch={batch_id}")
    return before, spark.read.parquet(f"{out}_clock/batch={batch_id}").first()["at"]


def session_batches(gap_ms: int = 300_000, evict_type: str = "error") -> Callable:
    """T7 with explicit eviction as a ``foreachBatch`` writer, for keys of any size: the sessions of ``session_cache``.

    A batch's rows follow their user's open session by distributed positions; a row starts a session by the row before
    it (a join), and sessions are numbered from counts per block of positions. The session that stays open is kept as a table
    per batch and expires once the latest time seen is ``gap_ms`` past it. Events without a time are in no session.
    Replaying a batch writes the same files again."""
    gap = gap_ms * 1000

    def write(batch: DataFrame, batch_id: int, out: str):
        spark = batch.sparkSession
        _, now = _clock(batch, batch_id, out, "ts")
        rows = with_event_time(batch).filter(F.col("ets").isNotNull()).select(
            "user_id", "ets", F.col("event_id").cast("long").alias("event_id"), F.coalesce(F.col("event_type") == evict_type, F.lit(False)).alias("bad"),
            F.lit(False).alias("held"), F.col("ets").alias("session_start"), F.lit(1).cast("long").alias("n"))
        if batch_id:
            held = spark.read.parquet(f"{out}_open/batch={batch_id - 1}")
            rows = rows.unionByName(held.select("user_id", F.col("last_seen").alias("ets"), F.lit(None).cast("long").alias("event_id"), F.lit(False).alias("bad"),
                                                F.lit(True).alias("held"), "session_start", F.col("events").alias("n")))
        order = [F.col("held").desc(), F.col("ets"), F.col("event_id")]  # the open session comes first
        at = materialize(dense_index(rows, ["user_id"], None, order, out="at"), "session-rows")
        last = at.select("user_id", (F.col("at") + 1).alias("at"), F.unix_micros("ets").alias("before"), F.col("bad").alias("after_bad"))
        joined = at.join(last.withColumnsRenamed({"user_id": "u", "at": "a"}), F.col("user_id").eqNullSafe(F.col("u")) & (F.col("at") == F.col("a")), "left")
        apart = F.coalesce(F.unix_micros("ets") - F.col("before") >= gap, F.lit(True))
        alone = F.coalesce("after_bad", F.lit(True))
        told = materialize(joined.select(
            "user_id", "at", "ets", "bad", "session_start", "n", F.expr(f"at div {RUN_BLOCK}").alias("block"),
            (~F.col("bad") & (alone | apart)).cast("int").alias("starts"), (F.col("bad") & ~alone & ~apart).alias("evicts")), "session-starts")
        blocks = told.groupBy("user_id", "block").agg(F.sum("starts").alias("here"))
        run = Window.partitionBy("user_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
        blocks = blocks.select("user_id", "block", F.coalesce(F.sum("here").over(run), F.lit(0)).alias("past"))
        inside = Window.partitionBy("user_id", "block").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
        sid = (F.col("past") + F.sum("starts").over(inside)).alias("sid")
        named = null_safe_join(told, blocks, ["user_id", "block"]).select("user_id", "at", "ets", "bad", "session_start", "n", "evicts", sid)
        tail = named.groupBy("user_id").agg(F.max("sid").alias("sid"), F.max_by("bad", "at").alias("over"))
        done = named.filter(~F.col("bad") | F.col("evicts")).groupBy("user_id", "sid").agg(
            F.min("session_start").alias("session_start"), F.max("ets").alias("last_seen"), F.sum("n").alias("events"), F.bool_or("evicts").alias("evicted"))
        both = done.join(tail.withColumnsRenamed({"user_id": "u", "sid": "s"}), F.col("user_id").eqNullSafe(F.col("u")) & (F.col("sid") == F.col("s")), "left")
        closed = F.col("evicted") | F.coalesce("over", F.lit(True)) | (F.unix_micros("last_seen") + gap <= now)
        both = materialize(both.select("user_id", "session_start", "last_seen", "events", "evicted", closed.alias("closed")), "session-ends")
        ended = F.when(F.col("evicted"), "evicted").otherwise("expired").alias("ended")
        both.filter("closed").select("user_id", "session_start", "last_seen", "events", ended).write.mode("overwrite").parquet(f"{out}/batch={batch_id}")
        both.filter("not closed").select("user_id", "session_start", "last_seen", "events").write.mode("overwrite").parquet(f"{out}_open/batch={batch_id}")

    return write


def number_batches(key: str = "user_id") -> Callable:
    """``foreachBatch`` writer of a counter per key: every increment (key, event_id, n) with the new value.

    Inside a batch rows are numbered by (ts, event_id) through distributed positions, after the key's total of the
    batches before; totals are kept as a table per batch. Replaying a batch writes the same files again."""

    def write(batch: DataFrame, batch_id: int, out: str):
        spark = batch.sparkSession
        totals = f"{out}_totals"
        rows = batch.select(F.col(key).alias("key"), "event_id", "ts")
        numbered = dense_index(rows, ["key"], None, [F.col("ts").isNull(), F.col("ts"), F.col("event_id")], out="n", start=1)
        counted = numbered.groupBy("key").agg(F.max("n").alias("n"))
        if batch_id:
            before = spark.read.parquet(f"{totals}/batch={batch_id - 1}").select("key", F.col("n").alias("before"))
        else:
            before = counted.select("key", F.lit(0).cast("long").alias("before")).limit(0)
        same = F.col("key").eqNullSafe(F.col("k"))
        more = before.withColumnRenamed("key", "k")
        done = numbered.join(more, same, "left").select("key", "event_id", (F.col("n") + F.coalesce("before", F.lit(0))).alias("n"))
        done.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")
        both = counted.unionByName(before.withColumnRenamed("before", "n"))
        both.groupBy("key").agg(F.sum("n").alias("n")).write.mode("overwrite").parquet(f"{totals}/batch={batch_id}")

    return write


def closed_groups(rows: DataFrame, keys: list, ts: str, every: str, values: list[str]) -> DataFrame:
    """(keys, window_start, rows): the rows of each key and window of event time, once, when the watermark has passed
    the window; until then they are state, whatever batches they come in. A group is one row: ``closed_windows`` has no such bound."""
    e = with_event_time(rows, ts).withWatermark("ets", "0 seconds")
    return e.groupBy(*keys, F.window("ets", every).alias("w")).agg(F.collect_list(F.struct(*values)).alias("rows")).select(
        *keys, F.col("w.start").alias("window_start"), "rows")


def closed_windows(ts: str, every: str, answer: Callable) -> Callable:
    """``closed_groups`` as a ``foreachBatch`` writer, for groups of any size: rows are kept in a table partitioned by the end of
    their window, and the rows of the windows that the latest time has passed with this batch go to ``answer(rows, batch_id, out)``, each
    window once. Only these partitions are read, and windows that an earlier batch has answered are dropped. Rows without a time are in
    no window. Replaying a batch writes and answers the same again."""

    def write(batch: DataFrame, batch_id: int, out: str):
        spark = batch.sparkSession
        before, now = _clock(batch, batch_id, out, ts)
        rows = batch.filter(F.col(ts).isNotNull()).withColumn("__end", F.unix_micros(F.window(F.col(ts).cast("timestamp"), every)["end"]))
        rows = rows.withColumn("__batch", F.lit(batch_id))
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("__end", "__batch").parquet(f"{out}_rows")
        kept = spark.read.schema(rows.schema).parquet(f"{out}_rows")
        closed = kept.filter((F.col("__end") > before) & (F.col("__end") <= now) & (F.col("__batch") <= batch_id)).drop("__batch", "__end")
        if not closed.isEmpty():
            answer(closed, batch_id, out)
        _drop_partitions(spark, f"{out}_rows", "__end", before)  # answered by a batch that is committed

    return write


def _drop_partitions(spark: SparkSession, table: str, column: str, upto: int) -> None:
    """Deletes the folders of a table's partitions with ``column`` <= ``upto``."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs = path(table).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for status in fs.listStatus(path(table)) if fs.exists(path(table)) else []:
        name = status.getPath().getName()
        if name.startswith(f"{column}=") and int(name.removeprefix(f"{column}=")) <= upto:
            fs.delete(status.getPath(), True)


def status_counts(events: DataFrame, status: str = "event_type") -> DataFrame:
    """Running totals per status (complete mode; poll with a processing-time trigger)."""
    return events.groupBy(F.col(status).alias("status")).agg(F.count(F.lit(1)).alias("n"))


def overwrite_batches(batch: DataFrame, batch_id: int, out: str):
    """foreachBatch writer for complete-mode results: the newest batch replaces the table."""
    batch.write.mode("overwrite").parquet(out)
