"""Keyed stream state on Spark's state API (T3, T4, T7): list, value and timer state in RocksDB.

State that grows with a key lies in the state store and not in a worker's memory, time comes from the watermark and its
timers, and a hot key is dealt over many states whose small results a second stateful operator puts together. Queries need the RocksDB
state store; ``run_stateful`` sets it for the query that it starts and leaves the session as it was.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from skein.session import _tables_dir

ROCKS = {"spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"}


def run_stateful(df: DataFrame, name: str, base: str | None = None, foreach: Callable | None = None) -> DataFrame:
    """Drain ``df`` into a parquet sink under ``base`` (a new folder of this application's written tables by default). Run again on the same
    ``base``, it goes on from the checkpoint there."""
    spark = df.sparkSession
    base = base or f"{_tables_dir(spark)}/streams/{name}-{uuid.uuid4().hex}"
    before = {k: spark.conf.get(k, None) for k in ROCKS}
    for k, v in ROCKS.items():
        spark.conf.set(k, v)
    try:
        w = df.writeStream.option("checkpointLocation", f"{base}/_checkpoint").outputMode("append").trigger(availableNow=True)
        w = w.foreachBatch(lambda b, i: foreach(b, i, f"{base}/out")) if foreach else w.format("parquet").option("path", f"{base}/out")
        q = w.start()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    q.awaitTermination()
    return spark.read.parquet(f"{base}/out")


# ----------------------------------------------------- rows packed into state
def _packed(pdf: pd.DataFrame, kind: np.dtype) -> bytes:
    """The columns named by ``kind`` as one binary value: a state holds a chunk of rows per entry, not a round trip per row."""
    rows = np.empty(len(pdf), kind)
    for c in kind.names:
        rows[c] = pdf[c].to_numpy()
    return rows.tobytes()


def _unpacked(chunks: Iterable, kind: np.dtype) -> pd.DataFrame:
    return pd.DataFrame(np.frombuffer(b"".join(bytes(x[0]) for x in chunks), kind))


class PendingRows(StatefulProcessor):
    """Rows of one key and one slice of time wait as packed chunks of a list state until the watermark has passed them and go
    to ``taken`` then, in no order."""

    kind: np.dtype

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.pending = handle.getListState("pending", "rows binary")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        least = None
        for pdf in rows:
            if len(pdf):
                self.pending.appendValue((_packed(pdf, self.kind),))
                least = min(int(pdf["t"].min()), least) if least is not None else int(pdf["t"].min())
        if least is not None:
            self.handle.registerTimer(least // 1000 + 1)
        yield pd.DataFrame()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        now = timerValues.getCurrentWatermarkInMs()
        rows = _unpacked(self.pending.get(), self.kind)
        past = rows["t"] // 1000 < now
        if not past.any():  # taken at another timer of this key
            yield pd.DataFrame()
            return
        later = rows[~past]
        self.pending.clear()
        if len(later):
            self.pending.appendValue((_packed(later, self.kind),))
            self.handle.registerTimer(int(later["t"].min()) // 1000 + 1)
        yield self.taken(key, rows[past], pd.Timestamp(now + 1, unit="ms"))

    def taken(self, key, due: pd.DataFrame, as_of: pd.Timestamp) -> pd.DataFrame:
        raise NotImplementedError

    def close(self) -> None:
        pass


# ------------------------------------------------------------- T7 sessions
SLICE = "1 day"
USER_PARTS = 32
TOKENS = "part int, no_user boolean, user_id long, as_of timestamp, first long, last long, events long, bad boolean, seq int"
SESSIONS = "user_id long, session_start timestamp, last_seen timestamp, events long, ended string"


class SliceRuns(PendingRows):
    """Events of a part of the users and one slice of time -> each user's runs of events with gaps below ``gap`` and evictions, in
    order, as soon as the watermark has passed them."""

    kind = np.dtype([("no_user", "?"), ("user_id", "i8"), ("t", "i8"), ("event_id", "i8"), ("bad", "?")])

    def __init__(self, gap: int):
        self.gap = gap

    def taken(self, key, due: pd.DataFrame, as_of: pd.Timestamp) -> pd.DataFrame:
        due = due.sort_values(["no_user", "user_id", "t", "event_id", "bad"], ignore_index=True)
        same = (due["user_id"] == due["user_id"].shift(1)) & (due["no_user"] == due["no_user"].shift(1))
        after_bad = same & due["bad"].shift(1).eq(True)
        apart = due["t"].diff() >= self.gap
        due = due.assign(starts=due["bad"] | ~same | after_bad | apart)[~(due["bad"] & after_bad)]  # of evictions in a row the first one counts
        run = due["starts"].cumsum().rename("seq")
        out = due.groupby(run).agg(no_user=("no_user", "first"), user_id=("user_id", "first"), first=("t", "min"), last=("t", "max"),
                                   events=("bad", "size"), bad=("bad", "first")).reset_index()
        out["events"] = out["events"].where(~out["bad"], 0)
        return out.assign(part=int(key[0]), as_of=as_of)[["part", "no_user", "user_id", "as_of", "first", "last", "events", "bad", "seq"]]


class MergedSessions(StatefulProcessor):
    """The runs and evictions of a part of the users, slice after slice -> sessions. Their open sessions are the only state, packed into one
    value; silence ends them by a timer."""

    kind = np.dtype([("no_user", "?"), ("user_id", "i8"), ("first", "i8"), ("last", "i8"), ("events", "i8")])

    def __init__(self, gap: int):
        self.gap = gap

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getValueState("open", "rows binary")

    def _held(self) -> pd.DataFrame:
        return _unpacked([self.open.get()] if self.open.exists() else [], self.kind)

    def _hold(self, rows: pd.DataFrame) -> None:
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        if len(rows):
            self.open.update((_packed(rows, self.kind),))
            self.handle.registerTimer((int(rows["last"].min()) + self.gap) // 1000)
        else:
            self.open.clear()

    def _rows(self, done: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"user_id": done["user_id"].astype("Int64").mask(done["no_user"].astype(bool)), "session_start": pd.to_datetime(done["first"], unit="us"),
                             "last_seen": pd.to_datetime(done["last"], unit="us"), "events": done["events"], "ended": done["ended"]})

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        user = ["no_user", "user_id"]
        held = self._held().assign(bad=False, seq=-1, held=0)
        tokens = [x.drop(columns=["part", "as_of"], errors="ignore").assign(held=1) for x in rows]  # runs, not events
        x = pd.concat(([held] if len(held) else []) + tokens).sort_values([*user, "held", "first", "seq"], ignore_index=True)
        same = (x["user_id"] == x["user_id"].shift(1)) & (x["no_user"] == x["no_user"].shift(1))
        gap = x["first"].to_numpy() - np.roll(x["last"].to_numpy(), 1)
        goes_on = same & ~x["bad"].shift(1).eq(True) & (gap < self.gap)
        last = ~((x["user_id"] == x["user_id"].shift(-1)) & (x["no_user"] == x["no_user"].shift(-1)))
        x = x.assign(sid=(~x["bad"] & ~goes_on).cumsum(), evicts=x["bad"] & goes_on, is_last=last)
        x["events"] = x["events"].where(~x["bad"], 1)
        x = x[~x["bad"] | x["evicts"]]
        s = x.groupby("sid").agg(no_user=("no_user", "first"), user_id=("user_id", "first"), first=("first", "min"), last=("last", "max"),
                                 events=("events", "sum"), evicted=("evicts", "any"), is_last=("is_last", "any"))
        s["ended"] = np.where(s["evicted"], "evicted", "expired")
        still = ~s["evicted"] & s["is_last"]
        self._hold(s[still])
        yield self._rows(s[~still])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        held = self._held()
        over = (held["last"] + self.gap) // 1000 <= timerValues.getCurrentWatermarkInMs()
        self._hold(held[~over])
        yield self._rows(held[over].assign(ended="expired"))

    def close(self) -> None:
        pass


NO_ID = (1 << 63) - 1  # an event without an id comes after the others of its time


def stateful_sessions(events: DataFrame, gap_ms: int = 300_000, evict_type: str = "error", delay: str = "0 seconds", slice_of: str = SLICE,
                      parts: int = USER_PARTS) -> DataFrame:
    """T7 with explicit eviction as a stream: any event refreshes its user's session, an ``evict_type`` event ends it at once, silence for
    ``gap_ms`` ends it when the watermark has passed. The users are dealt over ``parts``, and a part's events over states by slices of time,
    which make runs of them; a second operator merges a part's runs. There is a state per part and slice, and none per user, so
    the round trips to the state store do not grow with the users. Events without a time are in no session; events later than
    ``delay`` are dropped."""
    e = events.select("user_id", "ts", F.coalesce(F.col("event_id").cast("long"), F.lit(NO_ID)).alias("event_id"),
                      F.coalesce(F.col("event_type") == evict_type, F.lit(False)).alias("bad"))
    e = e.filter(F.col("ts").isNotNull()).withColumn("ets", F.col("ts").cast("timestamp")).withWatermark("ets", delay)
    e = e.select("ets", F.pmod(F.xxhash64("user_id"), F.lit(parts)).cast("int").alias("part"), F.col("user_id").isNull().alias("no_user"),
                 F.coalesce("user_id", F.lit(0)).cast("long").alias("user_id"),
                 F.unix_micros(F.window("ets", slice_of)["start"]).alias("slice"), F.unix_micros("ets").alias("t"), "event_id", "bad")
    gap = gap_ms * 1000
    runs = e.groupBy("part", "slice").transformWithStateInPandas(
        SliceRuns(gap), TOKENS, "append", "eventTime", eventTimeColumnName="as_of")
    return runs.groupBy("part").transformWithStateInPandas(MergedSessions(gap), SESSIONS, "append", "eventTime")


# -------------------------------------------------------------- T3 history
HISTORY = "symbol string, part int, ts array<long>, ids array<long>, prices array<double>, seen long"


class LastRows(StatefulProcessor):
    """The newest ``n`` rows of one part of a symbol, by (ts, event_id), as a list state of at most ``n`` entries."""

    def __init__(self, n: int):
        self.n = n

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.rows = handle.getListState("rows", "ts long, id long, price double")
        self.seen = handle.getValueState("seen", "n long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        kept = list(self.rows.get())
        seen = self.seen.get()[0] if self.seen.exists() else 0
        for pdf in rows:
            seen += len(pdf)
            kept = sorted([*kept, *pdf[["ts", "event_id", "price"]].itertuples(index=False, name=None)])[-self.n:]
        self.rows.put([(int(a), int(b), float(c)) for a, b, c in kept])
        self.seen.update((int(seen),))
        ts, ids, prices = ([x[i] for x in kept] for i in range(3))
        yield pd.DataFrame({"symbol": [key[0]], "part": [key[1]], "ts": [ts], "ids": [ids], "prices": [prices], "seen": [seen]})

    def close(self) -> None:
        pass


def stateful_history(rows: DataFrame, n: int) -> DataFrame:
    """The newest ``n`` of (symbol, part, ts, event_id, price), per symbol and part, after each micro-batch that has some."""
    return rows.groupBy("symbol", "part").transformWithStateInPandas(LastRows(n), HISTORY, "append", "none")


# ------------------------------------------------------- T4 watch intervals
INTERVALS = "user_id long, symbol string, watch_from timestamp, watch_to timestamp, quotes long, total_price double"


class SliceCounts(PendingRows):
    """Quotes and commands of one symbol and one slice of time -> when the watermark has passed them, each command with the count and sum of
    the slice's quotes before it (``kind`` 1 or -1), and the slice's own count and sum once per part of the users (``kind`` 0). A quote
    is held and read once, however many users and parts there are."""

    kind = np.dtype([("t", "i8"), ("event_id", "i8"), ("command", "i1"), ("user_id", "i8"), ("price", "f8"), ("part", "i4")])

    def __init__(self, parts: int):
        self.parts = parts

    def taken(self, key, due: pd.DataFrame, as_of: pd.Timestamp) -> pd.DataFrame:
        due = due.sort_values(["t", "event_id", "command", "user_id", "price"], ignore_index=True)
        quote = due["command"] == 0
        due = due.assign(n=quote.cumsum(), total=due["price"].where(quote, 0.0).cumsum(), seq=np.arange(len(due)))
        sums = due.iloc[[-1] * self.parts].assign(command=0, part=np.arange(self.parts))
        out = pd.concat([due[~quote], sums], ignore_index=True).assign(symbol=key[0], slice=int(key[1]), as_of=as_of)
        return out[["symbol", "part", "as_of", "slice", "seq", "t", "command", "user_id", "n", "total"]]


class Watchers(StatefulProcessor):
    """The counted commands and slices of one symbol, for one part of the users -> the intervals in which a user watched, when they end.

    The symbol's quotes are only a running count and sum; a user's entry holds them as they were at the beginning of the interval. All entries
    of the part are one packed value, so a micro-batch costs the state store a few round trips and none per command."""

    kind = np.dtype([("user_id", "i8"), ("watching", "?"), ("since", "i8"), ("n", "i8"), ("total", "f8")])

    def __init__(self, defaults: tuple[str, ...]):
        self.defaults = defaults

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.totals = handle.getValueState("totals", "quotes long, price double")
        self.users = handle.getValueState("users", "rows binary")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        symbol = key[0]
        x = pd.concat(list(rows), ignore_index=True)
        quotes, price = self.totals.get() if self.totals.exists() else (0, 0.0)
        sums = x[x["command"] == 0].groupby("slice")[["n", "total"]].sum()  # slices in order of time
        base = sums.cumsum() - sums
        self.totals.update((int(quotes + sums["n"].sum()), float(price + sums["total"].sum())))
        c = x[x["command"] != 0].sort_values(["user_id", "slice", "seq"])
        c = c.assign(on=c["command"] > 0, n=c["n"] + c["slice"].map(base["n"]) + quotes, total=c["total"] + c["slice"].map(base["total"]) + price)
        held = _unpacked([self.users.get()] if self.users.exists() else [], self.kind).set_index("user_id")
        held = held.reindex(held.index.union(c["user_id"].unique()))
        held["watching"] = held["watching"].astype("boolean").fillna(symbol in self.defaults).astype(bool)
        held = held.fillna({"since": NO_START, "n": 0, "total": 0.0}).astype({"since": "int64", "n": "int64"})
        again = c["user_id"] == c["user_id"].shift(1)
        was = c["on"].shift(1).eq(True).where(again, c["user_id"].map(held["watching"]).astype(bool))
        c = c[c["on"] != was]  # watching twice is the same as once
        again = c["user_id"] == c["user_id"].shift(1)
        begun = {a: c[b].shift(1).where(again, c["user_id"].map(held[a])) for a, b in (("since", "t"), ("n", "n"), ("total", "total"))}
        out = pd.DataFrame({"user_id": c["user_id"], "symbol": symbol, "watch_from": begun["since"], "watch_to": pd.to_datetime(c["t"], unit="us"),
                            "quotes": c["n"] - begun["n"], "total_price": c["total"] - begun["total"]})[~c["on"]]
        since = out["watch_from"].astype("int64")
        out["watch_from"] = pd.to_datetime(since.where(since != NO_START, 0), unit="us").where(since != NO_START)
        last = c.groupby("user_id").tail(1).set_index("user_id")
        held.loc[last.index, "watching"] = last["on"]
        held.loc[last.index, ["n", "total"]] = last[["n", "total"]]
        held.loc[last.index, "since"] = last["t"]
        self.users.update((_packed(held.reset_index(names="user_id"), self.kind),))
        yield out.astype({"quotes": "int64"})

    def close(self) -> None:
        pass


NO_START = -(1 << 62)  # watched from the beginning
COUNTS = "symbol string, part int, as_of timestamp, slice long, seq long, t long, command int, user_id long, n long, total double"
WATCH_SLICE = "6 hours"


def watch_intervals(quotes: DataFrame, commands: DataFrame, defaults: list[str], parts: int = 16, delay: str = "0 seconds", slice_of: str = WATCH_SLICE) -> DataFrame:
    """T4 in event time: for every interval [watch, unwatch) of a user and symbol, when it ends, the number and sum of the quotes in
    it. ``quotes`` (symbol, ts, event_id, price) and ``commands`` (user_id, symbol, action, ts, event_id) are streams; at one time, the smaller event_id
    comes first. A user watches ``defaults`` from the beginning (``watch_from`` NULL); watching twice is the same as once.

    A symbol's rows are dealt over states by slices of time, which count the quotes before each command; a second operator follows
    the users, dealt over ``parts`` states of a symbol. Rows without a time, symbol or user are left out; rows later than ``delay`` are dropped."""
    q = quotes.select("symbol", "ts", F.col("event_id").cast("long").alias("event_id"), F.lit(0).alias("command"), F.lit(0).cast("long").alias("user_id"),
                      F.col("price").cast("double").alias("price"), F.lit(0).alias("part"))
    kind = F.when(F.col("action") == "watch", 1).when(F.col("action") == "unwatch", -1)
    c = commands.select("symbol", "ts", F.col("event_id").cast("long").alias("event_id"), kind.alias("command"), F.col("user_id").cast("long").alias("user_id"),
                        F.lit(0.0).alias("price"), F.pmod(F.xxhash64("user_id"), F.lit(parts)).cast("int").alias("part"))
    both = q.unionByName(c.filter(F.col("command").isNotNull())).filter("symbol is not null and ts is not null and user_id is not null and price is not null")
    both = both.withColumn("event_id", F.coalesce("event_id", F.lit(NO_ID))).withColumn("ets", F.col("ts").cast("timestamp")).withWatermark("ets", delay)
    both = both.withColumn("t", F.unix_micros("ets")).withColumn("slice", F.unix_micros(F.window("ets", slice_of)["start"]))
    counted = both.groupBy("symbol", "slice").transformWithStateInPandas(SliceCounts(parts), COUNTS, "append", "eventTime", eventTimeColumnName="as_of")
    return counted.groupBy("symbol", "part").transformWithStateInPandas(Watchers(tuple(defaults)), INTERVALS, "append", "eventTime")
