"""Rows with NULL keys, long values and awkward batches are neither lost nor bent."""

import base64
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from skein.functions.bits import bits_to_long
from skein.operators import audio, changes, joins, ml, paging, profile, windows
from skein.sources import files


def rows(df, *cols):
    return sorted((tuple(r) for r in (df.select(*cols) if cols else df).collect()), key=repr)


def test_positions_history_and_steps_keep_null_keys(spark):
    df = spark.createDataFrame([(None, 1, 2.0), (None, 2, 2.1), ("a", 1, 5.0)], "k string, o int, v double")
    assert rows(windows.dense_index(df, ["k"], None, [F.col("o")]), "k", "o", "idx") == [("a", 1, 0), (None, 1, 0), (None, 2, 1)]
    got = windows.history_last_n(df, "k", [F.col("o")], "v", 2)
    assert rows(got, "k", "o", "history") == [("a", 1, [5.0]), (None, 1, [2.0]), (None, 2, [2.0, 2.1])]
    got = windows.step_ratio(df, "k", [F.col("o")], "v")
    assert [(k, o, r and round(r, 6)) for k, o, r in rows(got, "k", "o", "ratio")] == [("a", 1, None), (None, 1, None), (None, 2, 1.05)]


def test_low_pass_and_spectrum_keep_a_song_without_id(spark):
    x = [1.0, 3.0, -2.0, 0.5, 4.0] * 4
    df = spark.createDataFrame([(s, i, v) for s in (None, 7) for i, v in enumerate(x)], "song_id long, i long, v double")
    got = audio.low_pass(df, 50.0, 1000.0, chunk=6)
    by = {s: [r.v for r in got.orderBy("i").collect() if r.song_id == s] for s in (None, 7)}
    assert len(by[None]) == 20 and np.allclose(by[None], by[7])
    spec = audio.stft(df, 8, 4, 4, mode="full").groupBy("song_id").count()
    assert rows(spec) == [(7, 20), (None, 20)]


def test_percentiles_keep_null_keys_and_empty_columns(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 3.0), ("a", 5.0), ("b", None)], "k string, x double")
    assert rows(profile.exact_percentiles(df, "x", [0.5], ["k"])) == [("a", 5.0), (None, 2.0)]
    got = profile.summary_long(df.withColumn("none", F.lit(None).cast("double")))
    assert rows(got, "column", "count", "p50") == [("none", 0, None), ("x", 3, 3.0)]


@pytest.mark.parametrize("reuse", ["true", "false"])
def test_percentiles_do_not_depend_on_exchange_reuse(spark, reuse):
    df = spark.read.parquet("/root/testdata/sf0.1/lineitem.parquet").repartition(4)
    spark.conf.set("spark.sql.exchange.reuse", reuse)
    try:
        got = profile.exact_percentiles(df, "l_extendedprice", [0.25, 0.5]).collect()[0]
    finally:
        spark.conf.unset("spark.sql.exchange.reuse")
    want = np.percentile(df.select("l_extendedprice").toPandas()["l_extendedprice"].astype(float), [25, 50])
    assert np.allclose([got.p25, got.p50], want, rtol=1e-12)


def test_scaling_drops_nothing_unasked(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (None,)], "x double")
    with pytest.raises(Exception, match="(?i)null"):
        ml.scale(df, ["x"]).collect()
    assert ml.scale(df, ["x"], invalid="skip").count() == 2


def test_split_flag_of_large_and_many_keys(spark):
    df = spark.range(2000).select((F.col("id") + 10**12).alias("k"), F.col("id").alias("m"))
    share = lambda *c: df.filter(ml.split_flag(*c)).count() / 2000
    assert 0.77 < share(F.col("k")) < 0.83
    four = [F.lit(1), F.lit(2), F.lit(3), F.col("m") * 7919]
    assert 0.77 < share(*four) < 0.83  # the fourth key counts
    big = spark.createDataFrame([(4_000_000_000,), (-(2**63),), (2**63 - 1,)], "k long")
    want = [(k % 2**32 * 2654435761 % 2**32) / 2**32 < 0.8 for k in (4_000_000_000, -(2**63), 2**63 - 1)]
    assert [r[0] for r in big.select(ml.split_flag(F.col("k"))).collect()] == want


def test_odd_recordings_are_an_error_and_listed(spark):
    good, odd = base64.b64encode(struct.pack("<hh", 16384, -32768)).decode(), base64.b64encode(b"abc").decode()
    df = spark.createDataFrame([(1, good), (2, odd), (3, None)], "rec_id long, audio string")
    assert rows(files.pcm16_invalid(df)) == [(2, "3 bytes are not 16-bit samples")]
    assert rows(files.pcm16_decode(df.filter("rec_id <> 2"))) == [(1, 0, 0.5), (1, 1, -1.0)]
    with pytest.raises(Exception, match="recording 2"):
        files.pcm16_decode(df).collect()


def test_recordings_are_decoded_many_at_a_time(spark, monkeypatch):
    import pandas as pd

    text = [base64.b64encode(struct.pack(f"<{n}h", *range(n))).decode() for n in range(5)]
    df = spark.createDataFrame([(i, text[i % 5]) for i in range(40)] + [(None, text[1])], "rec_id long, audio string").coalesce(1)
    frames = spark.sparkContext.accumulator(0)
    make = pd.DataFrame

    def counted(decode):
        def run(batches):
            for out in decode(batches):
                frames.add(1)
                yield make(out)
        return run

    monkeypatch.setattr(type(df), "mapInPandas", lambda self, f, schema, _map=type(df).mapInPandas: _map(self, counted(f), schema))
    monkeypatch.setattr(files, "DECODED", 30)
    want = [(i, j, j / 32768) for i in range(40) for j in range(i % 5)] + [(None, 0, 0.0)]
    assert sorted(map(str, rows(files.pcm16_decode(df)))) == sorted(map(str, want))
    assert frames.value < 10  # not a frame per recording


def test_seed_does_not_append_to_what_it_cannot_read(spark, tmp_path):
    seed = spark.createDataFrame([(1,)], "x int")
    path = str(tmp_path / "t")
    assert files.seed_if_empty(spark, path, seed) and not files.seed_if_empty(spark, path, seed)
    (tmp_path / "broken").mkdir()
    (tmp_path / "broken" / "a.parquet").write_bytes(b"not parquet")
    with pytest.raises(Exception):
        files.seed_if_empty(spark, str(tmp_path / "broken"), seed)


def test_natural_sort_of_long_digit_runs(spark):
    names = ["v" + "9" * 25, "v1" + "0" * 25, "v0" + "9" * 24, "v2", "V10"]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    got = [r[0] for r in df.orderBy(paging.natural_sort_key("n")).collect()]
    assert got == ["v2", "V10", "v0" + "9" * 24, "v" + "9" * 25, "v1" + "0" * 25]


def test_more_than_64_bits_are_an_error(spark):
    df = spark.range(1).select(F.array_repeat(F.lit(True), 65).alias("b"), F.array_repeat(F.lit(True), 64).alias("ok"))
    assert df.select(bits_to_long(F.col("ok"))).collect()[0][0] == -1
    with pytest.raises(Exception, match="64 bits"):
        df.select(bits_to_long(F.col("b"))).collect()


def test_options_of_any_number(spark):
    row = spark.createDataFrame([(1, "x")], "id int, name string")
    options = spark.range(1000).select(F.col("id").cast("string").alias("value"), F.lpad(F.col("id").cast("string"), 4, "0").alias("label"))
    got = joins.row_with_options(row, options, "value", "label")
    assert rows(got, "id", "position", "value")[:2] == [(1, 0, "0"), (1, 1, "1")] and got.count() == 1000


def test_a_rejected_row_blocks_nobody(spark):
    base = spark.createDataFrame([(1, "Z")], "k int, n string")
    batch = spark.createDataFrame([(1, "A", 1), (2, "A", 2), (2, "B", 3), (3, "B", 4), (None, "C", 5), (None, "C", 6), (None, None, 7), (None, None, 8)],
                                  "k int, n string, o int")
    ok, no = changes.unique_insert(base, batch, ["k", "n"], [F.col("o")])
    assert [r.o for r in ok.orderBy("o").collect()] == [2, 4, 5, 7, 8]
    assert rows(no, "o", "reason") == [(1, "k exists"), (3, "k repeated"), (6, "n repeated")]
    ok, no = changes.unique_insert(base, batch, [("k", "n")], [F.col("o")])
    assert ok.count() == 8 and no.count() == 0


def test_unique_insert_equals_row_by_row(spark):
    rng = np.random.default_rng(7)
    data = [(int(a), int(b), i) for i, (a, b) in enumerate(rng.integers(0, 40, (150, 2)))]
    taken_a, taken_b, want = {3}, {3}, []
    for a, b, i in data:
        if a not in taken_a and b not in taken_b:
            taken_a.add(a)
            taken_b.add(b)
            want.append(i)
    ok, no = changes.unique_insert(spark.createDataFrame([(3, 3)], "a int, b int"), spark.createDataFrame(data, "a int, b int, o int"),
                                   ["a", "b"], [F.col("o")])
    assert sorted(r.o for r in ok.collect()) == want and no.count() == 150 - len(want)


def test_two_changes_of_a_key_update_once(spark):
    base = spark.createDataFrame([(1, 10), (2, 20)], "k int, v int")
    change = spark.createDataFrame([(1, 5, 2), (1, None, 3), (1, 7, 1)], "k int, v int, o int")
    assert rows(changes.apply_updates(base, change, "k", ["v"], [F.col("o")])) == [(1, None), (2, 20)]
    assert rows(changes.apply_updates(base, change.drop("o"), "k", ["v"])) == [(1, 7), (2, 20)]


def test_addresses_do_not_depend_on_the_start_phase(spark):
    """The time between two peaks is the truncated difference of their exact times."""
    at = lambda shift: spark.createDataFrame(
        [(1, i, t + shift, int(t + shift), f) for i, (t, f) in enumerate([(0.0, 5), (10.6, 6), (21.2, 7)])],
        "song_id long, idx long, t_ms_exact double, t_ms long, freq long")
    deltas = lambda shift: rows(audio.target_pairs(at(shift)), "a_idx", "d", "delta_ms")
    assert deltas(0.0) == deltas(0.5) == deltas(0.9) == [(0, 1, 10), (0, 2, 21), (1, 1, 10)]


def test_wav_headers_stay_in_the_jvm(spark):
    head = b"RIFF" + struct.pack("<I", 36) + b"WAVEfmt " + struct.pack("<IHHIIHH", 16, 1, 2, 44100, 176400, 4, 16) + b"data" + struct.pack("<I", 352800)
    df = spark.createDataFrame([("ok", bytearray(head)), ("mp3", bytearray(b"ID3" * 20)), ("short", bytearray(b"RIFF")),
                                ("float", bytearray(head[:20] + struct.pack("<H", 3) + head[22:])), ("none", None)], "path string, content binary")
    got = files.wav_info(df)
    assert "Python" not in got._jdf.queryExecution().executedPlan().toString()
    assert rows(got, "path", "ok", "reason", "channels", "sample_rate", "duration") == [
        ("float", False, "not PCM", 2, 44100, None), ("mp3", False, "not a RIFF/WAVE file", None, None, None),
        ("none", False, "not a RIFF/WAVE file", None, None, None), ("ok", True, None, 2, 44100, 2.0),
        ("short", False, "not a RIFF/WAVE file", None, None, None)]


def _insert_one_by_one(base, batch):
    ids, names, out = {i for i, _ in base}, {n for _, n in base}, []
    for i, n, order in sorted(batch, key=lambda r: r[2]):
        why = "id exists" if i in {x for x, _ in base} else "name exists" if n in {x for _, x in base} else None
        why = why or ("id repeated" if i is not None and i in ids else "name repeated" if n is not None and n in names else None)
        if why is None:
            ids.add(i)
            names.add(n)
        out.append((i, n, order, why))
    return sorted(out, key=lambda r: r[2])


def test_a_long_chain_of_conflicts_takes_few_rounds(spark, monkeypatch):
    """Row k shares its id with the row before and its name with the row after: each one's fate hangs on all before it."""
    from skein.operators import changes

    rounds = []
    real = changes._alternating
    monkeypatch.setattr(changes, "_alternating", lambda rows, keys: rounds.append(1) or real(rows, keys))
    batch = [(k // 2, f"n{(k + 1) // 2}", k) for k in range(2000)]
    df = spark.createDataFrame(batch, "id long, name string, at long").repartition(4)
    accepted, rejected = changes.unique_insert(spark.createDataFrame([], "id long, name string"), df, ["id", "name"], [F.col("at")])
    got = [(*r, None) for r in accepted.collect()] + [tuple(r) for r in rejected.collect()]
    assert sorted(got, key=lambda r: r[2]) == _insert_one_by_one([], batch)
    assert len(rounds) <= 15


@pytest.mark.parametrize("seed", [1, 2])
def test_unique_insert_equals_one_by_one(spark, seed):
    import random

    from skein.operators import changes

    rng = random.Random(seed)
    pick = lambda n: None if rng.random() < 0.1 else rng.randrange(n)
    base = [(i, f"b{i}") for i in range(5)]
    batch = [(pick(25), None if rng.random() < 0.1 else rng.choice([f"b{rng.randrange(9)}", f"n{rng.randrange(30)}"]), k) for k in range(80)]
    accepted, rejected = changes.unique_insert(spark.createDataFrame(base, "id long, name string"), spark.createDataFrame(batch, "id long, name string, at long"),
                                               ["id", "name"], [F.col("at")])
    got = [(*r, None) for r in accepted.collect()] + [tuple(r) for r in rejected.collect()]
    assert sorted(got, key=lambda r: r[2]) == _insert_one_by_one(base, batch)
