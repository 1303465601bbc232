"""Streaming state over several micro-batches and Arrow chunks, rows in no order inside a batch."""

import os
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from skein.session import _tables_dir, release_scratch
from skein.streaming import streams as S

N = 30_000
CUTS = ["2024-01-01 02:00:00", "2024-01-01 05:00:00"]


@pytest.fixture(scope="module")
def quotes(spark):
    """One hot symbol and a rare one, shuffled; a row a second."""
    rows = [("hot" if i % 1000 else "rare", i, float(i)) for i in range(N)]
    random.Random(1).shuffle(rows)
    pdf = pd.DataFrame(rows, columns=["symbol", "event_id", "price"])
    pdf["ts"] = pd.Timestamp("2024-01-01") + pd.to_timedelta(pdf["event_id"], unit="s")
    return spark.createDataFrame(pdf).withColumn("ts", F.col("ts").cast("timestamp_ntz")).coalesce(1)


def test_replay_gives_a_batch_per_file(spark, quotes):
    def sizes(batch, batch_id, out):
        batch.groupBy().agg(F.count(F.lit(1)).alias("n"), F.max("event_id").alias("last")).write.parquet(f"{out}/batch={batch_id}")

    got = S.run_to_table(S.replayed(quotes, "ts", CUTS), "sizes", foreach=sizes)
    assert [(r.n, r["last"]) for r in got.orderBy("batch").collect()] == [(7200, 7199), (10800, 17999), (12000, 29999)]


@pytest.mark.parametrize("parts", [1, 5])
def test_rows_without_a_time_come_last(spark, quotes, parts):
    """No row is lost, a part may be many files or empty, and every part is one micro-batch."""
    def sizes(batch, batch_id, out):
        batch.groupBy().agg(F.count(F.lit(1)).alias("n"), F.count("ts").alias("timed")).write.parquet(f"{out}/batch={batch_id}")

    holes = quotes.filter("event_id < 9000").withColumn("ts", F.when(F.col("event_id") % 10 != 0, F.col("ts"))).repartition(parts)
    got = S.run_to_table(S.replayed(holes, "ts", CUTS), "sizes", foreach=sizes).orderBy("batch").collect()
    assert [(r.n, r.timed) for r in got] == [(6480, 6480), (1620, 1620), (900, 0)]
    counts = S.run_to_table(S.status_counts(S.replayed(holes, "ts", CUTS), "symbol"), "status", mode="complete", foreach=S.overwrite_batches)
    assert {r.status: r.n for r in counts.collect()} == {"hot": 8991, "rare": 9}
    history = S.merged_history(S.run_to_table(S.keyed_history(S.replayed(holes, "ts", CUTS)), "history"))
    assert {r.symbol: r.seen for r in history.collect()} == {"hot": 8991, "rare": 9}
    numbered = S.run_to_table(S.replayed(holes, "ts", CUTS), "count", foreach=S.number_batches("symbol"))
    hot = [i for i in range(9000) if i % 1000]
    want = [i for i in hot if i % 10] + [i for i in hot if i % 10 == 0]
    assert [r.event_id for r in numbered.filter("key = 'hot'").orderBy("n").collect()] == want


def test_history_of_a_hot_key(spark, quotes):
    out = S.run_to_table(S.keyed_history(S.replayed(quotes, "ts", CUTS)), "history")
    got = {r.symbol: (r.history, r.seen) for r in S.merged_history(out).collect()}
    want = {s: [float(i) for i in range(N) if (i % 1000 == 0) == (s == "rare")] for s in ("hot", "rare")}
    assert got == {s: (v[-50:], len(v)) for s, v in want.items()}


def test_counter_of_a_hot_key(spark, quotes):
    got = S.run_to_table(S.replayed(quotes, "ts", CUTS), "count", foreach=S.number_batches("symbol"))
    hot = [r.n for r in got.filter("key = 'hot'").orderBy("event_id").collect()]
    assert hot == list(range(1, N - N // 1000 + 1))
    assert sorted(r.n for r in got.filter("key = 'rare'").collect()) == list(range(1, N // 1000 + 1))


def test_sessions_in_one_shuffled_batch(spark, quotes):
    e = quotes.select(F.when(F.col("symbol") == "hot", 1).otherwise(2).cast("long").alias("user_id"), "event_id", "ts", F.lit("view").alias("event_type"))
    out = S.run_to_table(S.session_cache(S.replayed(e, "ts", CUTS)), "sessions")
    rare = out.filter("user_id = 2").orderBy("session_start").collect()
    assert all(r.events == 1 and r.ended == "expired" for r in rare) and len(rare) == 30
    assert out.filter("user_id = 1").count() == 0  # never silent, and still open


def test_sessions_of_a_hot_user(spark, monkeypatch):
    """The sessions of a plain walk over each user's rows, over three batches and many blocks of positions."""
    monkeypatch.setattr(S, "RUN_BLOCK", 50)
    rng = random.Random(7)
    rows, t = [], 0
    for i in range(1500):
        t += rng.choice([1, 20, 100, 299, 300, 301])
        rows.append((1 if rng.random() < 0.9 else rng.choice([2, None]), i, t, "error" if rng.random() < 0.1 else "view"))
    want, cur = [], {}
    for user, _, t, kind in rows:
        c = cur.pop(user, None)
        if c and t - c[1] >= 300:
            want.append((user, *c, "expired"))
            c = None
        if kind == "error":
            if c:
                want.append((user, c[0], t, c[2] + 1, "evicted"))
        else:
            cur[user] = (c[0], t, c[2] + 1) if c else (t, t, 1)
    want += [(u, *c, "expired") for u, c in cur.items() if c[1] + 300 <= rows[-1][2]]
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame(rows, "user_id long, event_id long, s long, event_type string").withColumn("ts", F.timestamp_seconds("s").cast("timestamp_ntz")).drop("s")
    cuts = ["1970-01-01 20:00:00", "1970-01-02 10:00:00"]
    got = S.run_to_table(S.replayed(df.coalesce(1), "ts", cuts), "hot", foreach=S.session_batches())
    got = got.select("user_id", F.unix_seconds("session_start"), F.unix_seconds("last_seen"), "events", "ended").collect()
    assert sorted(map(str, (tuple(r) for r in got))) == sorted(map(str, want))


def test_closed_windows_are_answered_once(spark, quotes):
    def answer(rows, batch_id, out):
        n = rows.groupBy("symbol", F.window(F.col("ts").cast("timestamp"), "3 hours").alias("w")).agg(F.count(F.lit(1)).alias("n"))
        n.select("symbol", "w.start", "n").write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    rows = S.run_to_table(S.replayed(quotes, "ts", CUTS), "closed", foreach=S.closed_windows("ts", "3 hours", answer)).collect()
    assert len(rows) == len({(r.symbol, r.start) for r in rows}) == 4
    assert sorted(r.n for r in rows if r.symbol == "hot") == [10789, 10789]


def test_a_group_over_two_batches_closes_once(spark, quotes):
    got = S.closed_groups(S.replayed(quotes, "ts", CUTS), ["symbol"], "ts", "3 hours", ["event_id"])
    rows = S.run_to_table(got.select("symbol", "window_start", F.size("rows").alias("n")), "closed").collect()
    assert len(rows) == len({(r.symbol, r.window_start) for r in rows})
    assert sorted(r.n for r in rows if r.symbol == "hot") == [10789, 10789]


def test_commands_take_effect_with_the_next_batch(spark):
    base = [("quote", 0, "x", None, 1.0, 1, 1), ("command", 7, "x", "unwatch", None, 2, 2), ("quote", 0, "x", None, 2.0, 100, 3),
            ("command", 8, "y", "watch", None, 101, 4), ("quote", 0, "y", None, 5.0, 200, 5), ("quote", 0, "x", None, 4.0, 201, 6)]
    df = spark.createDataFrame(base, "kind string, user_id long, symbol string, action string, price double, s int, event_id long")
    df = df.withColumn("ts", F.timestamp_seconds("s").cast("timestamp_ntz")).drop("s")
    users = spark.createDataFrame([(7,), (8,)], "user_id long")
    out = S.run_to_table(S.replayed(df, "ts", ["1970-01-01 00:01:00", "1970-01-01 00:03:00"]), "watch", foreach=S.deliver(users, ["x"]))
    got = {(r.batch, r.user_id, r.symbol, r.total_price) for r in out.collect()}
    assert got == {(0, 7, "x", 1.0), (0, 8, "x", 1.0), (1, 8, "x", 2.0), (2, 8, "x", 4.0), (2, 8, "y", 5.0)}


def test_stream_folders_are_released(spark, quotes):
    S.run_to_table(S.status_counts(S.replayed(quotes, "ts", CUTS), "symbol"), "status", mode="complete", foreach=S.overwrite_batches)
    folder = _tables_dir(spark).removeprefix("file://").removeprefix("file:")
    assert os.path.isdir(f"{folder}/streams")
    release_scratch(spark)
    assert not os.path.exists(folder)


def test_a_batch_reads_its_closed_windows_only(spark):
    """Ten batches of an hour, two windows each: every one reads the rows of the windows it closes, and answered ones are dropped."""
    rows = spark.range(36_000).select((F.col("id")).alias("event_id"), F.timestamp_seconds("id").cast("timestamp_ntz").alias("ts")).coalesce(1)
    read = []

    def answer(closed, batch_id, out):
        read.append((closed.count(), len(closed.inputFiles()), len({f.rsplit("/", 2)[0] for f in closed.inputFiles()})))
        closed.groupBy().count().write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    S.run_to_table(S.replayed(rows, "ts", [f"1970-01-01 {h:02d}:00:00" for h in range(1, 10)]), "windows", foreach=S.closed_windows("ts", "30 minutes", answer))
    assert len(read) >= 9 and sum(n for n, _, _ in read) == 36_000 - 1800
    assert max(n for n, _, _ in read) <= 3600 and max(f for _, f, _ in read) <= 8


def test_replay_is_one_write(spark, quotes, monkeypatch):
    from pyspark.sql.readwriter import DataFrameWriter

    writes = []
    real = DataFrameWriter.parquet
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda self, path, *a, **k: writes.append(path) or real(self, path, *a, **k))
    S.replayed(quotes, "ts", [f"2024-01-01 0{h}:00:00" for h in range(1, 9)])
    assert len(writes) == 1


def test_tables_stream_as_files_and_as_folders(spark, tmp_path):
    """A larger table is a folder of part files: all its rows are in the stream."""
    from skein.plans.streams import q_stream_sanitize

    pages = spark.createDataFrame([(i, f"<p>{i}</p><script>x</script>" if i % 4 else None) for i in range(20)], "page_id long, html string")
    pages.repartition(3).write.parquet(str(tmp_path / "folder" / "pages.parquet"))
    pages.coalesce(1).write.parquet(str(tmp_path / "one"))
    (tmp_path / "file").mkdir()
    next((tmp_path / "one").glob("*.parquet")).rename(tmp_path / "file" / "pages.parquet")
    for kind in ("folder", "file"):
        got = sorted((r.page_id, r.clean, r.rejected) for r in q_stream_sanitize(spark, str(tmp_path / kind)).collect())
        assert got == [(i, f"<p>{i}</p>" if i % 4 else None, i % 4 == 0) for i in range(20)]
