"""WAV files by byte ranges, chunk walk, streams."""

import io
import os
import struct

import numpy as np
import pytest

from skein.sources import wav


def chunk(name, body):
    return name + struct.pack("<I", len(body)) + body + b"\0" * (len(body) % 2)


def fmt(channels=1, rate=8000, bits=16, code=1, extra=b""):
    return struct.pack("<HHIIHH", code, channels, rate, rate * channels * bits // 8, channels * bits // 8, bits) + extra


def riff(*chunks):
    body = b"WAVE" + b"".join(chunks)
    return b"RIFF" + struct.pack("<I", len(body)) + body


def write(folder, name, data):
    with open(os.path.join(folder, name), "wb") as f:
        f.write(data)


def rows(df):
    return {(os.path.basename(r.path), r.channel, r.i, r.v) for r in df.collect()}


def expected(name, samples, channels):
    frames = samples[: len(samples) // channels * channels].reshape(-1, channels)
    return {(name, c, i, float(v) / 32768) for i, f in enumerate(frames) for c, v in enumerate(f)}


def test_chunks_anywhere_and_ranges(spark, tmp_dir):
    rng = np.random.default_rng(1)
    one, two, three = (rng.integers(-32768, 32768, n).astype("<i2") for n in (1001, 600, 301))
    write(tmp_dir, "a.wav", wav.wav_bytes(one.tobytes()))
    write(tmp_dir, "b.WAV", riff(chunk(b"JUNK", b"x" * 33), chunk(b"fmt ", fmt(2)), chunk(b"LIST", b"info!"), chunk(b"data", two.tobytes()), chunk(b"id3 ", b"tag")))
    os.mkdir(os.path.join(tmp_dir, "sub"))
    extensible = fmt(3, code=0xFFFE, extra=struct.pack("<HHI", 22, 16, 7) + struct.pack("<H", 1) + b"\0" * 14)
    write(os.path.join(tmp_dir, "sub"), "c.wav", riff(chunk(b"fmt ", extensible), chunk(b"data", three.tobytes())))
    write(tmp_dir, "none.wav", wav.wav_bytes(b""))
    write(tmp_dir, "other.txt", b"no sound")
    want = expected("a.wav", one, 1) | expected("b.WAV", two, 2) | expected("c.wav", three, 3)
    for size in (64, 1000, 1 << 20):
        df = wav.read_wav(spark, tmp_dir, range_bytes=size)
        assert rows(df) == want
    assert wav.read_wav(spark, tmp_dir, range_bytes=1000).rdd.getNumPartitions() >= 3 + 2 + 1
    assert rows(wav.read_wav(spark, "file://" + os.path.join(tmp_dir, "a.wav"))) == expected("a.wav", one, 1)


@pytest.mark.parametrize("data,what", [
    (b"not a wave file at all", "not a RIFF/WAVE file"), (b"", "not a RIFF/WAVE file"), (riff(chunk(b"data", b"1234")), "data before fmt"),
    (riff(chunk(b"fmt ", fmt(bits=8))), "not 16-bit"), (riff(chunk(b"fmt ", fmt(code=3))), "not PCM"), (riff(chunk(b"fmt ", fmt())), "no data chunk"),
    (riff(chunk(b"JUNK", b"12")), "no fmt chunk"), (riff(chunk(b"fmt ", b"short")), "less than 16"), (riff(chunk(b"fmt ", fmt(channels=0))), "no channels"),
])
def test_files_that_are_no_sound(spark, tmp_dir, data, what):
    with pytest.raises(ValueError, match=what):
        wav.wav_chunks(io.BytesIO(data), len(data))
    write(tmp_dir, "bad.wav", data)
    good = np.arange(10, dtype="<i2")
    write(tmp_dir, "good.wav", wav.wav_bytes(good.tobytes()))
    with pytest.raises(Exception, match=what):
        wav.read_wav(spark, tmp_dir).collect()
    assert rows(wav.read_wav(spark, tmp_dir, skip=True)) == expected("good.wav", good, 1)


def test_cut_off_recording_and_half_frame(spark, tmp_dir):
    s = np.arange(-50, 51, dtype="<i2")
    whole = wav.wav_bytes(s.tobytes(), channels=2)
    write(tmp_dir, "half.wav", whole)  # 101 samples: the last frame is half
    write(tmp_dir, "cut.wav", whole[:-30])
    unknown = bytearray(whole)
    unknown[40:44] = struct.pack("<I", 0xFFFFFFFF)
    write(tmp_dir, "live.wav", bytes(unknown))
    assert rows(wav.read_wav(spark, tmp_dir)) == expected("half.wav", s, 2) | expected("cut.wav", s[:86], 2) | expected("live.wav", s, 2)


def test_a_long_recording_is_many_tasks(spark, tmp_dir):
    n = 25 << 20
    path = os.path.join(tmp_dir, "long.wav")
    with open(path, "wb") as f:
        f.write(wav.wav_bytes(b"", rate=44100)[:40] + struct.pack("<I", 2 * n))
        for _ in range(25):
            f.write(np.arange(1 << 20, dtype="<i4").astype("<i2").tobytes())
    df = wav.read_wav(spark, path, range_bytes=8 << 20)
    assert df.rdd.getNumPartitions() == 7
    got = df.selectExpr("count(*) as n", "max(i) as last", "sum(cast(v * 32768 as long)) as total").first()
    assert (got.n, got.last) == (n, n - 1) and got.total == 25 * int(np.arange(1 << 20, dtype="<i4").astype("<i2").astype(np.int64).sum())


def test_stream_reads_new_files(spark, tmp_path):
    folder = str(tmp_path / "in")
    os.mkdir(folder)
    name = wav.register(spark)
    first, second = np.arange(5, dtype="<i2"), np.arange(7, dtype="<i2") * 3

    def drain():
        q = (spark.readStream.format(name).load(folder).writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "cp"))
             .option("path", str(tmp_path / "out")).trigger(processingTime="0 seconds").start())
        try:
            q.processAllAvailable()
        finally:
            q.stop()
        return rows(spark.read.parquet(str(tmp_path / "out")))

    write(folder, "2024-01.wav", wav.wav_bytes(first.tobytes()))
    assert drain() == expected("2024-01.wav", first, 1)
    write(folder, "2024-02.wav", wav.wav_bytes(second.tobytes()))
    assert drain() == expected("2024-01.wav", first, 1) | expected("2024-02.wav", second, 1)  # from the checkpoint
