"""Keyed state with timers (T3, T4, T7): against plain walks, over batches, restarts and hot keys."""

import random
import uuid

import pandas as pd
import pytest
from pyspark.sql import functions as F

from skein.session import _tables_dir
from skein.streaming import stateful as ST
from skein.streaming import streams as S


def folder(spark):
    return f"{_tables_dir(spark)}/streams/test-{uuid.uuid4().hex}"


def walk(rows, gap, now):
    """Sessions of (user, id, t, bad), as a single pass over the rows in order sees them."""
    done, cur = [], {}
    for user, _, t, bad in sorted(rows, key=lambda r: (r[2], r[1])):
        c = cur.pop(user, None)
        if c and t - c[1] >= gap:
            done.append((user, *c, "expired"))
            c = None
        if bad:
            if c:
                done.append((user, c[0], t, c[2] + 1, "evicted"))
        else:
            cur[user] = (c[0], t, c[2] + 1) if c else (t, t, 1)
    return done + [(u, *c, "expired") for u, c in cur.items() if c[1] + gap <= now]


def events(seed, n):
    rng = random.Random(seed)
    rows, t = [], 0
    for i in range(n):
        t += rng.choice([1, 20, 100, 299, 300, 301])
        rows.append((1 if rng.random() < 0.85 else rng.choice([2, 3, None]), i, t, rng.random() < 0.1))
    return rows


def frame(spark, rows):
    df = spark.createDataFrame(rows, "user_id long, event_id long, s long, bad boolean")
    return df.select("user_id", "event_id", F.timestamp_seconds("s").cast("timestamp_ntz").alias("ts"), F.when(F.col("bad"), "error").otherwise("view").alias("event_type"))


def sessions_of(df):
    return sorted(map(str, (tuple(r) for r in df.select("user_id", F.unix_seconds("session_start"), F.unix_seconds("last_seen"), "events", "ended").collect())))


@pytest.mark.parametrize("slice_of", ["10 minutes", "1 day"])
def test_sessions_over_batches_and_slices(spark, slice_of):
    rows = events(7, 600)
    now = rows[-1][2]
    shuffled = rows[:]
    random.Random(1).shuffle(shuffled)
    shuffled.append((1, 10_000, None, False))  # no time
    df = frame(spark, shuffled).coalesce(2)
    got = ST.run_stateful(ST.stateful_sessions(S.replayed(df, "ts", ["1970-01-01 09:00:00", "1970-01-01 15:00:00"]), slice_of=slice_of), "sessions")
    # the last millisecond is not yet behind the watermark
    want = walk([r for r in rows if r[2] < now], 300, now)
    assert sessions_of(got) == sorted(map(str, want))


def test_sessions_go_on_from_the_checkpoint(spark, tmp_path):
    rows = events(9, 300)
    cut = rows[150][2]
    source, base = str(tmp_path / "in"), folder(spark)
    schema = frame(spark, []).schema
    for i, part in enumerate(([r for r in rows if r[2] < cut], [r for r in rows if r[2] >= cut])):
        frame(spark, part).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(source)
        got = ST.run_stateful(ST.stateful_sessions(stream), "restart", base=base)
        if i == 0:
            first = sessions_of(got)
    assert set(first) < set(sessions_of(got))
    assert sessions_of(got) == sorted(map(str, walk([r for r in rows if r[2] < rows[-1][2]], 300, rows[-1][2])))


def counted(monkeypatch, spark, name):
    """The accumulator of the calls with rows that the processor ``name`` gets: one per key and micro-batch."""
    calls = spark.sparkContext.accumulator(0)

    class Counted(getattr(ST, name)):
        def handleInputRows(self, key, rows, timerValues):  # noqa: N802, N803
            calls.add(1)
            yield from super().handleInputRows(key, rows, timerValues)

    monkeypatch.setattr(ST, name, Counted)
    return calls


def test_sessions_of_many_users_take_few_states(spark, monkeypatch):
    rng = random.Random(3)
    rows = [(rng.randrange(400), i, 7 * i + 7, rng.random() < 0.1) for i in range(1500)]
    first, second = (counted(monkeypatch, spark, n) for n in ("SliceRuns", "MergedSessions"))
    df = frame(spark, rows).coalesce(1)
    got = ST.run_stateful(ST.stateful_sessions(S.replayed(df, "ts", ["1970-01-01 01:00:00"]), gap_ms=3_600_000), "many")
    assert sessions_of(got) == sorted(map(str, walk(rows[:-1], 3600, rows[-1][2])))
    assert 0 < first.value <= 2 * ST.USER_PARTS and 0 < second.value <= 4 * ST.USER_PARTS


def test_the_session_keeps_its_settings(spark):
    before = {k: spark.conf.get(k, None) for k in ST.ROCKS}
    ST.run_stateful(ST.stateful_history(S.history_rows(S.replayed(quotes(spark, 50), "ts", [])), 5), "conf")
    assert {k: spark.conf.get(k, None) for k in ST.ROCKS} == before


def quotes(spark, n):
    pdf = pd.DataFrame([("hot" if i % 10 else "rare", i, float(i)) for i in range(n)], columns=["symbol", "event_id", "price"])
    pdf["ts"] = pd.Timestamp("2024-01-01") + pd.to_timedelta(pdf["event_id"], unit="s")
    return spark.createDataFrame(pdf.sample(frac=1, random_state=2)).withColumn("ts", F.col("ts").cast("timestamp_ntz")).coalesce(1)


def test_history_of_a_hot_symbol(spark):
    rows = S.history_rows(S.replayed(quotes(spark, 3000), "ts", ["2024-01-01 00:20:00", "2024-01-01 00:40:00"]), 4)
    got = {r.symbol: (r.history, r.seen) for r in S.merged_history(ST.run_stateful(ST.stateful_history(rows, 7), "history"), 7).collect()}
    want = {s: [float(i) for i in range(3000) if (i % 10 == 0) == (s == "rare")] for s in ("hot", "rare")}
    assert got == {s: (v[-7:], len(v)) for s, v in want.items()}


def test_watch_intervals_equal_a_walk(spark):
    rng = random.Random(4)
    rows = []  # (t, id, kind, user, symbol, price)
    for i in range(900):
        t = i * 3 + rng.randrange(3)
        if rng.random() < 0.3:
            rows.append((t, i, rng.choice(["watch", "unwatch"]), rng.randrange(6), rng.choice("xyz"), None))
        else:
            rows.append((t, i, "quote", 0, rng.choice("xxxyz"), float(rng.randrange(100))))
    rows.append((5000, 901, "quote", 0, "x", 1.0))
    want, state, seen = [], {}, {s: (0, 0.0) for s in "xyz"}
    for t, _, kind, user, symbol, price in sorted(rows)[:-1]:
        n, p = seen[symbol]
        if kind == "quote":
            seen[symbol] = (n + 1, p + price)
            continue
        on = state.get((user, symbol), (None, 0, 0.0) if symbol == "x" else False)
        if kind == "watch" and on is False:
            state[user, symbol] = (t, n, p)
        elif kind == "unwatch" and on is not False:
            want.append((user, symbol, on[0], t, n - on[1], p - on[2]))
            state[user, symbol] = False
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame(rows, "s long, event_id long, kind string, user_id long, symbol string, price double")
    df = df.withColumn("ts", F.timestamp_seconds("s").cast("timestamp_ntz")).coalesce(1)
    stream = S.replayed(df, "ts", ["1970-01-01 00:10:00", "1970-01-01 00:30:00"])
    out = ST.run_stateful(ST.watch_intervals(stream.filter("kind = 'quote'"), stream.filter("kind <> 'quote'").withColumnRenamed("kind", "action"), ["x"], 3), "watch")
    got = [tuple(r) for r in out.select("user_id", "symbol", F.unix_seconds("watch_from"), F.unix_seconds("watch_to"), "quotes", "total_price").collect()]
    assert sorted(got, key=str) == sorted(want, key=str) and len(got) > 50


def test_quotes_are_held_once(spark, monkeypatch):
    """A quote waits in one state, not in one per part of the users; what follows has the commands and a row per slice and part."""
    rows = [(i + 1, i, "quote", 0, "x", 1.0) for i in range(2000)] + [(10 * i + 1, 5000 + i, "unwatch" if i < 30 else "watch", i % 30, "x", 0.0) for i in range(60)]
    df = spark.createDataFrame(rows, "s long, event_id long, kind string, user_id long, symbol string, price double")
    stream = S.replayed(df.withColumn("ts", F.timestamp_seconds("s").cast("timestamp_ntz")).coalesce(1), "ts", [])
    seen = spark.sparkContext.accumulator(0)

    class Counted(ST.Watchers):
        def handleInputRows(self, key, rows, timerValues):  # noqa: N802, N803
            rows = list(rows)
            seen.add(sum(map(len, rows)))
            yield from super().handleInputRows(key, iter(rows), timerValues)

    monkeypatch.setattr(ST, "Watchers", Counted)
    out = ST.run_stateful(ST.watch_intervals(stream.filter("kind = 'quote'"), stream.filter("kind <> 'quote'").withColumnRenamed("kind", "action"), ["x"], 4), "held")
    got = sorted(tuple(r) for r in out.select("user_id", "watch_from", F.unix_seconds("watch_to"), "quotes").collect())
    assert got == [(i, None, 10 * i + 1, 10 * i + 1) for i in range(30)]
    assert seen.value == 60 + 4
