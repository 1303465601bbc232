"""File sources and sinks (S1-S5, S7, S11-S16) and snapshot tables.

Every writer targets a folder given by the caller (a shared file system on a
cluster); nothing is written to a machine-local temporary folder, and no
data passes through the driver.
"""

from __future__ import annotations

import uuid

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_json_documents(spark: SparkSession, path: str, schema: T.StructType | None = None,
                        multiline: bool = True) -> DataFrame:
    """JSON files (array-of-object or one object each), permissive; bad
    records kept in ``_corrupt_record``. Pass a schema at scale (inference
    reads everything once more)."""
    r = spark.read.option("multiLine", multiline).option("mode", "PERMISSIVE").option(
        "columnNameOfCorruptRecord", "_corrupt_record")
    if schema is not None:
        if "_corrupt_record" not in schema.fieldNames():
            schema = T.StructType(schema.fields + [T.StructField("_corrupt_record", T.StringType())])
        r = r.schema(schema)
    return r.json(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = None, sep: str = ",",
             header: bool = True) -> DataFrame:
    """Delimited text with a header; a schema avoids the inference pass."""
    r = spark.read.option("header", header).option("sep", sep)
    return (r.schema(schema) if schema is not None else r.option("inferSchema", True)).csv(path)


# Media file extensions.
IMAGE_EXTS = ["gif", "jfif", "png", "jpg", "jpeg"]
VIDEO_EXTS = ["mp4", "avi", "mov", "mkv", "m4v"]


def list_media(spark: SparkSession, root: str, exts: list[str] = IMAGE_EXTS) -> DataFrame:
    """Files under ``root`` (recursive) whose extension, any case, is listed.

    Only (path, length, modificationTime) are selected, so the file bytes
    are never read.
    """
    rx = r"\.(" + "|".join(exts) + r")$"
    df = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    return df.select("path", "length", "modificationTime").filter(F.lower("path").rlike(rx))


def write_hash_csv(df: DataFrame, path: str, columns: list[str]) -> None:
    """Hash table as ``;``-separated CSV with a header, fixed column order (Q9)."""
    df.select(*columns).write.mode("overwrite").option("sep", ";").option("header", True).csv(path)


def write_once(df: DataFrame, path: str, fmt: str = "json") -> None:
    """Write unless the target already exists (``mode('ignore')``)."""
    df.write.mode("ignore").format(fmt).save(path)


def seed_if_empty(spark: SparkSession, path: str, seed: DataFrame, fmt: str = "parquet") -> bool:
    """Append the seed rows only when the table at ``path`` is missing or empty."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    there = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where)
    empty = not there or spark.read.format(fmt).load(path).isEmpty()  # a table that can't be read is an error
    if empty:
        seed.write.mode("append").format(fmt).save(path)
    return empty


DECODED = 1 << 18  # samples of the recordings that are decoded at once


def pcm16_decode(recordings: DataFrame, id_col: str = "rec_id", audio_col: str = "audio") -> DataFrame:
    """base64 text -> 16-bit little-endian PCM -> samples in [-1, 1) as
    ``(rec_id, i, v)``. Decoding runs in ``mapInPandas`` (numpy), many
    recordings per output frame. An odd number of bytes is an error; ``pcm16_invalid`` lists
    such recordings for a caller that wants to go on without them."""
    rec = recordings.select(F.coalesce(F.col(id_col), F.lit(0)).cast("long").alias("rec_id"), F.col(id_col).isNull().alias("no_id"), F.unbase64(audio_col).alias("pcm"))

    def run(batches):
        for pdf in batches:
            pdf = pdf[pdf["pcm"].notna()]
            sizes = pdf["pcm"].map(len).to_numpy(dtype=np.int64)
            for odd in np.flatnonzero(sizes % 2)[:1]:
                raise ValueError(f"recording {pdf['rec_id'].iloc[odd]}: {sizes[odd]} bytes are not 16-bit samples")
            ends = np.cumsum(sizes // 2)
            at = 0
            while at < len(pdf):  # whole recordings of up to DECODED samples, or a longer one alone
                upto = max(int(np.searchsorted(ends, (ends[at - 1] if at else 0) + DECODED, "right")), at + 1)
                part, n = pdf.iloc[at:upto], sizes[at:upto] // 2
                v = np.frombuffer(b"".join(part["pcm"]), dtype="<i2").astype(np.float64) / 32768.0
                i = np.arange(len(v), dtype=np.int64) - np.repeat(np.cumsum(n) - n, n)
                ids = pd.arrays.IntegerArray(np.repeat(part["rec_id"].to_numpy(), n), np.repeat(part["no_id"].to_numpy(), n))
                yield pd.DataFrame({"rec_id": ids, "i": i, "v": v})
                at = upto

    return rec.mapInPandas(run, "rec_id long, i long, v double")


def pcm16_invalid(recordings: DataFrame, id_col: str = "rec_id", audio_col: str = "audio") -> DataFrame:
    """(rec_id, reason) of recordings that ``pcm16_decode`` does not accept."""
    size = F.octet_length(F.unbase64(audio_col))
    return recordings.filter(size % 2 != 0).select(F.col(id_col).alias("rec_id"), F.concat(
        size.cast("string"), F.lit(" bytes are not 16-bit samples")).alias("reason"))


def _little_endian(head: Column, at: int, size: int) -> Column:
    """Unsigned little-endian number of ``size`` bytes at offset ``at`` of a binary column."""
    part = F.reverse(F.transform(F.sequence(F.lit(at + 1), F.lit(at + size)), lambda i: F.hex(head.substr(i, F.lit(1)))))
    return F.conv(F.array_join(part, ""), 16, 10).cast("long")


def wav_info(files: DataFrame) -> DataFrame:
    """S13 + A24: RIFF/WAVE header check (PCM, 16-bit), channels, rate and
    duration = data bytes / (channels * 2 * rate). ``files``: a binaryFile
    scan (path, content). Bad files come back with ``ok = false`` and a reason.
    Only column functions on the first 44 bytes: no file content leaves the JVM."""
    head = F.substring("content", 1, 44)
    f = files.select("path", head.alias("h"))
    h = F.col("h")
    riff = (F.octet_length(h) == 44) & (h.substr(1, 4) == F.lit(b"RIFF")) & (h.substr(9, 4) == F.lit(b"WAVE"))
    fields = {"fmt": _little_endian(h, 20, 2), "channels": _little_endian(h, 22, 2), "sample_rate": _little_endian(h, 24, 4),
              "bits": _little_endian(h, 34, 2), "data_bytes": _little_endian(h, 40, 4)}
    f = f.withColumn("riff", riff).select("path", "riff", *[F.when(F.col("riff"), c).alias(n) for n, c in fields.items()])
    reason = (F.when(~F.coalesce("riff", F.lit(False)), "not a RIFF/WAVE file").when(F.col("fmt") != 1, "not PCM")
              .when(F.col("bits") != 16, "not 16-bit"))
    f = f.withColumn("reason", reason).withColumn("ok", F.col("reason").isNull())
    rate = F.col("channels") * 2 * F.col("sample_rate")
    duration = F.when(F.col("ok") & (rate > 0), F.col("data_bytes") / rate)
    return f.select("path", "ok", "reason", F.col("channels").cast("int").alias("channels"),
                    F.col("sample_rate").cast("int").alias("sample_rate"), F.col("bits").cast("int").alias("bits"),
                    "data_bytes", duration.alias("duration"))


def upload_sizes(files: DataFrame) -> DataFrame:
    """Total bytes received per file extension (from the file listing only)."""
    ext = F.lower(F.regexp_extract("path", r"\.([A-Za-z0-9]+)$", 1))
    return files.groupBy(ext.alias("ext")).agg(F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"))


def save_model(model, path: str) -> None:
    """Save or overwrite a fitted model."""
    model.write().overwrite().save(path)


def drop_table(spark: SparkSession, name: str) -> None:
    """Drop a catalogue table if it exists."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def new_snapshot_path(base: str) -> str:
    """A fresh folder name for a copy-on-write snapshot under ``base``."""
    return f"{base.rstrip('/')}/snap-{uuid.uuid4().hex}"
