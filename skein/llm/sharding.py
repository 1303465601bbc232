"""Rendezvous hashing of record keys over weighted shards, with gapless slots.

Every (key, shard) gets a pseudo-random score -weight / ln(u), u in (0, 1) from a
64-bit hash of the two; the record belongs to the shard with the highest score.
A new shard only adds a score of its own, so it can only draw records to itself.
All of it is column arithmetic on one narrow row per record.

Slots number each shard's records from 0 without gaps. The narrow rows are written
once with the number of the input block they came from; each (shard, block) is
numbered on its own and shifted by the sizes of the shard's earlier blocks, so
neither a shard, a key nor a group of equal texts is ever in one task.

Defined results: a null key is a key like any other (all null keys share a shard);
a null text counts as no bytes (size 1, checksum 0) and an empty one alike; repeated
rows share their shard and get slots of their own; an empty table stays empty;
columns other than key and text are not read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skein.session import materialize


def _score(key: Column, shard: int, weight: float) -> Column:
    """Larger wins; u is an odd multiple of 2**-53, so neither 0 nor 1."""
    u = (F.shiftrightunsigned(F.xxhash64(key, F.lit(shard)), 12).cast("double") * 2 + 1) / F.lit(float(1 << 53))
    return F.lit(-float(weight)) / F.ln(u)


def rendezvous(key: Column, weights: Sequence[float]) -> Column:
    """Index of the winning shard; of equal scores the smaller index."""
    if not weights or any(not w > 0 for w in weights):
        raise ValueError("weights must be positive, one per shard")
    scores = [F.struct(_score(key, i, w).alias("s"), F.lit(-i).alias("i")) for i, w in enumerate(weights)]
    return (-F.array_max(F.array(*scores))["i"]).cast("int")


def assign_shards(df: DataFrame, weights: Sequence[float], grown: Sequence[float] | None = None, key: str = "doc_id",
                  text: str = "text") -> DataFrame:
    """(key, size, text_crc32, shard, block[, grown_shard]) per record; ``grown`` are the weights
    after a change of the shard set. A projection of the scan: no shuffle."""
    body = F.coalesce(F.col(text).cast("binary"), F.lit(b""))
    cols = [F.col(key), (F.octet_length(body) + 1).cast("long").alias("size"), F.crc32(body).cast("long").alias("text_crc32"),
            rendezvous(F.col(key), weights).alias("shard"), F.spark_partition_id().alias("block")]
    if grown is not None:
        cols.append(rendezvous(F.col(key), grown).alias("grown_shard"))
    return df.select(*cols)


def number_slots(assigned: DataFrame) -> DataFrame:
    """Adds ``slot``: 0, 1, 2, ... inside each shard. ``assigned`` has shard and block and must be
    stable (written), since its blocks are read twice."""
    sizes = assigned.groupBy("shard", "block").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.withColumn("__start", F.coalesce(F.sum("__n").over(before), F.lit(0))).drop("__n")
    own = Window.partitionBy("shard", "block").orderBy("text_crc32", "size")
    placed = assigned.withColumn("__at", F.row_number().over(own) - 1).join(starts, ["shard", "block"])
    return placed.withColumn("slot", (F.col("__start") + F.col("__at")).cast("long")).drop("__start", "__at", "block")


def shard_documents(df: DataFrame, weights: Sequence[float], grown: Sequence[float] | None = None, key: str = "doc_id",
                    text: str = "text") -> DataFrame:
    """Shard, size, checksum and slot of every record."""
    return number_slots(materialize(assign_shards(df, weights, grown, key, text), "shards"))
