"""WAV files as a Spark data source (S12, S13): read by byte ranges, never whole.

``spark.read.format("skein_wav")`` plans each file from its chunk headers (a walk over the RIFF chunks, so
``fmt `` and ``data`` may stand anywhere, with other chunks before, between and after) and cuts the samples into ranges
of whole frames: a long recording becomes many tasks, and no task reads more than its range, in pieces of ``PIECE_FRAMES``
frames. The stream reader lists the folder again for every batch and reads files that it has not seen.

Paths may be local or of any file system that Arrow opens by URI. Rows: ``(path, channel, i, v)`` with v = sample / 32768.
Files that are no 16-bit PCM WAV are an error, or, with option ``skip=true``, left out; ``wav_chunks`` says why.
"""

from __future__ import annotations

import json
import posixpath
import struct
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition, DataSourceStreamReader

SCHEMA = "path string, channel int, i long, v double"
NAME = "skein_wav"
RANGE_BYTES = 32 << 20  # bytes of samples that one task reads, about
PIECE_FRAMES = 1 << 16  # frames of one Arrow batch


@dataclass
class Sound:
    """Where a file's samples lie."""

    channels: int
    rate: int
    start: int
    frames: int

    @property
    def frame_bytes(self) -> int:
        return 2 * self.channels


def opened(path: str):
    """(file system, path on it) of a local path or a URI."""
    from pyarrow import fs

    if "://" in path or path.startswith("file:"):
        return fs.FileSystem.from_uri(path if "://" in path else path.replace("file:", "file://", 1))
    return fs.LocalFileSystem(), path


def wav_chunks(file, size: int) -> Sound:
    """Walk the chunks of an open file; ValueError says what is wrong with it.

    A data chunk whose length exceeds the file (a recording that was cut off, or a stream of unknown length) ends with the file;
    a half frame at the end is no sample. Chunks are padded to even lengths."""
    head = file.read(12)
    if len(head) < 12 or head[:4] != b"RIFF" or head[8:12] != b"WAVE":
        raise ValueError("not a RIFF/WAVE file")
    at, kind = 12, None
    while at + 8 <= size:
        file.seek(at)
        name, length = struct.unpack("<4sI", file.read(8))
        if name == b"fmt ":
            body = file.read(min(length, 40))
            if len(body) < 16:
                raise ValueError("a fmt chunk of less than 16 bytes")
            code, channels, rate, _, _, bits = struct.unpack("<HHIIHH", body[:16])
            if code == 0xFFFE and len(body) >= 26:  # the extensible form has the code in its sub-format
                code = struct.unpack("<H", body[24:26])[0]
            if code != 1:
                raise ValueError("not PCM")
            if bits != 16:
                raise ValueError("not 16-bit")
            if channels < 1:
                raise ValueError("no channels")
            kind = (channels, rate)
        elif name == b"data":
            if kind is None:
                raise ValueError("data before fmt")
            return Sound(*kind, at + 8, min(length, size - at - 8) // (2 * kind[0]))
        at += 8 + length + length % 2
    raise ValueError("no data chunk" if kind else "no fmt chunk")


@dataclass
class Range(InputPartition):
    """Frames a..b-1 of a file."""

    path: str
    channels: int
    start: int
    a: int
    b: int


def files_under(path: str) -> list[tuple[str, int]]:
    """(path, bytes) of the WAV files at or below ``path``, in order of their paths."""
    from pyarrow import fs

    system, where = opened(path)
    prefix = path[: len(path) - len(where)] if path.endswith(where) else ""
    info = system.get_file_info(where)
    found = [info] if info.type == fs.FileType.File else system.get_file_info(fs.FileSelector(where, recursive=True))
    return sorted((prefix + f.path, f.size) for f in found if f.type == fs.FileType.File and posixpath.splitext(f.path)[1].lower() == ".wav")


def ranges_of(path: str, size: int, limit: int, skip: bool) -> list[Range]:
    system, where = opened(path)
    with system.open_input_file(where) as f:
        try:
            s = wav_chunks(f, size)
        except ValueError as e:
            if skip:
                return []
            raise ValueError(f"{path}: {e}") from None
    step = max(1, limit // s.frame_bytes)
    return [Range(path, s.channels, s.start, a, min(a + step, s.frames)) for a in range(0, s.frames, step)]


def samples_of(r: Range) -> Iterator:
    """The range's samples as Arrow batches of at most PIECE_FRAMES frames."""
    import numpy as np
    import pyarrow as pa

    system, where = opened(r.path)
    with system.open_input_file(where) as f:
        for a in range(r.a, r.b, PIECE_FRAMES):
            n = min(PIECE_FRAMES, r.b - a)
            raw = f.read_at(n * 2 * r.channels, r.start + a * 2 * r.channels)
            v = np.frombuffer(raw, dtype="<i2").astype(np.float64) / 32768.0
            yield pa.RecordBatch.from_arrays([
                pa.DictionaryArray.from_arrays(pa.array(np.zeros(len(v), np.int32)), pa.array([r.path])).cast(pa.string()),
                pa.array(np.tile(np.arange(r.channels, dtype=np.int32), n)), pa.array(np.repeat(np.arange(a, a + n), r.channels)), pa.array(v)],
                names=["path", "channel", "i", "v"])


class _Options:
    def __init__(self, options):
        self.path = options["path"]
        self.limit = int(options.get("rangebytes", options.get("rangeBytes", RANGE_BYTES)))
        self.skip = str(options.get("skip", "false")).lower() == "true"


class WavReader(DataSourceReader, _Options):
    def partitions(self):
        out = [r for path, size in files_under(self.path) for r in ranges_of(path, size, self.limit, self.skip)]
        return out or [Range("", 1, 0, 0, 0)]

    def read(self, partition: Range):
        if partition.path:
            yield from samples_of(partition)


class WavStream(DataSourceStreamReader, _Options):
    """Each batch is the files that are new in the folder, as ranges; the offset is the last name that was read, so files must
    come with ascending names (as recorders name them by time), complete (written elsewhere and moved in)."""

    def initialOffset(self) -> dict:  # noqa: N802
        return {"upto": ""}

    def latestOffset(self) -> dict:  # noqa: N802
        files = files_under(self.path)
        return {"upto": files[-1][0] if files else ""}

    def partitions(self, start: dict, end: dict):
        new = [f for f in files_under(self.path) if start["upto"] < f[0] <= end["upto"]]
        return [r for path, size in new for r in ranges_of(path, size, self.limit, self.skip)] or [Range("", 1, 0, 0, 0)]

    def read(self, partition: Range):
        if partition.path:
            yield from samples_of(partition)


class WavSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> WavReader:
        return WavReader(self.options)

    def streamReader(self, schema) -> WavStream:  # noqa: N802
        return WavStream(self.options)


def register(spark: SparkSession) -> str:
    """Make the format known to the session; returns its name."""
    spark.dataSource.register(WavSource)
    return NAME


def read_wav(spark: SparkSession, path: str, range_bytes: int = RANGE_BYTES, skip: bool = False):
    """(path, channel, i, v) of all WAV files at or below ``path``."""
    return spark.read.format(register(spark)).option("rangeBytes", range_bytes).option("skip", json.dumps(skip)).load(path)


def wav_bytes(samples: bytes, channels: int = 1, rate: int = 8000) -> bytes:
    """A WAV file of 16-bit samples."""
    fmt = struct.pack("<HHIIHH", 1, channels, rate, rate * 2 * channels, 2 * channels, 16)
    return b"RIFF" + struct.pack("<I", 36 + len(samples)) + b"WAVEfmt " + struct.pack("<I", 16) + fmt + b"data" + struct.pack("<I", len(samples)) + samples
