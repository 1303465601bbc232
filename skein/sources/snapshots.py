"""Keyed tables as hash-partitioned snapshots, changed in place of what a change touches.

A snapshot is a parquet folder partitioned by ``bucket = pmod(xxhash64(key), buckets)``. A batch of changes
decides which buckets it touches; only these partitions are read (partition pruning by a list of at most
``buckets`` numbers) and only these are replaced, by a dynamic partition overwrite. All other files stay as
they are, name and content: the cost of a change follows the touched buckets, not the table.

Choose ``buckets`` so that one bucket is a few hundred MB; ``files`` splits a bucket into that many files and
tasks. The schema and the key are kept beside the data (``_snapshot``), so an empty table can be read and a
wrong key is an error.

Recovery: a change is a function of the snapshot and the batch, by key, and applying it twice gives the same
snapshot as once; after a crash, the batch is applied again. There is one writer at a time.

Rows with a null key have a bucket, and no change finds them. Of several changes of a key the last by
``order`` counts.
"""

from __future__ import annotations

import json
import os
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skein.operators import changes

BUCKET = "__bucket"
#: false in the one row that a rewrite adds to each bucket, so that a bucket without rows is replaced, too
_LIVE = "__live"
_ABOUT = "_snapshot"


def bucket_of(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(F.col(key)), F.lit(buckets)).cast("int")


def create_snapshot(df: DataFrame, path: str, key: str, buckets: int, files: int = 1) -> None:
    """Write ``df`` as a new snapshot at ``path`` (which is replaced)."""
    _write(_placed(df, key, buckets), path, key, files, dynamic=False)
    about = {"key": key, "buckets": buckets, "files": files, "schema": df.schema.jsonValue()}
    spark = df.sparkSession
    spark.createDataFrame([(json.dumps(about),)], "value string").coalesce(1).write.mode("overwrite").text(os.path.join(path, _ABOUT))


def about_snapshot(spark: SparkSession, path: str) -> dict:
    return json.loads(spark.read.text(os.path.join(path, _ABOUT)).first()[0])


def read_snapshot(spark: SparkSession, path: str, touched: list[int] | None = None) -> DataFrame:
    """The whole snapshot, or the partitions ``touched`` (a list prunes partitions at planning)."""
    about = about_snapshot(spark, path)
    schema = T.StructType.fromJson(about["schema"])
    own = [T.StructField(_LIVE, T.BooleanType()), T.StructField(BUCKET, T.IntegerType())]
    whole = spark.read.schema(T.StructType([*schema.fields, *own])).parquet(path).filter(_LIVE)
    if touched is not None:
        whole = whole.filter(F.col(BUCKET).isin(touched))
    return whole.select(*schema.fieldNames())


def touched_buckets(batch: DataFrame, key: str, buckets: int) -> list[int]:
    """The buckets that hold keys of ``batch``: at most ``buckets`` numbers come to the driver."""
    rows = batch.filter(F.col(key).isNotNull()).select(bucket_of(key, buckets).alias("b")).distinct().collect()
    return sorted(r.b for r in rows)


def update_snapshot(spark: SparkSession, path: str, batch: DataFrame, cols: list[str], order: list[Column] | None = None) -> list[int]:
    """Update ``cols`` of the rows whose key is in ``batch``. Returns the touched buckets."""
    return _rewrite(spark, path, batch, lambda old, key: changes.apply_updates(old, batch, key, cols, order))


def delete_from_snapshot(spark: SparkSession, path: str, batch: DataFrame) -> list[int]:
    """Delete the rows whose key is in ``batch``."""
    return _rewrite(spark, path, batch, lambda old, key: changes.except_keys(old, batch, key))


def upsert_snapshot(spark: SparkSession, path: str, batch: DataFrame, order: list[Column] | None = None) -> list[int]:
    """D3: insert or replace the rows of ``batch`` by key. A null key is no key: such rows of the batch are left out."""
    def change(old: DataFrame, key: str) -> DataFrame:
        done = changes.apply_upserts(old, batch.filter(F.col(key).isNotNull()), key, order)
        return done.select(*[F.col(f.name).cast(f.dataType) for f in old.schema.fields])

    return _rewrite(spark, path, batch, change)


def _rewrite(spark: SparkSession, path: str, batch: DataFrame, change: Callable[[DataFrame, str], DataFrame]) -> list[int]:
    about = about_snapshot(spark, path)
    key, buckets = about["key"], about["buckets"]
    if key not in batch.columns:
        raise ValueError(f"the batch has no key column {key!r}")
    touched = touched_buckets(batch, key, buckets)
    if touched:
        done = _placed(change(read_snapshot(spark, path, touched), key), key, buckets)
        marks = spark.createDataFrame([(b,) for b in touched], f"{BUCKET} int").withColumn(_LIVE, F.lit(False))
        _write(done.unionByName(marks, allowMissingColumns=True), path, key, about["files"], dynamic=True)
    return touched


def _placed(df: DataFrame, key: str, buckets: int) -> DataFrame:
    return df.withColumn(BUCKET, bucket_of(key, buckets)).withColumn(_LIVE, F.lit(True))


def _write(df: DataFrame, path: str, key: str, files: int, dynamic: bool) -> None:
    by = [F.col(BUCKET)] + ([F.pmod(F.hash(key), F.lit(files))] if files > 1 else [])
    writer = df.repartition(*by).write.mode("overwrite").partitionBy(BUCKET)
    if dynamic:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    writer.parquet(path)
