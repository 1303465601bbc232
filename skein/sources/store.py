"""Keyed stores: incremental ingest (S8), fingerprint persistence (S9) and the
nested address -> couples form (S10)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def incremental_new(incoming: DataFrame, manifest: DataFrame, key: str) -> DataFrame:
    """Incoming rows whose key is not in the manifest of processed keys."""
    return incoming.join(manifest.select(key).distinct(), key, "left_anti")


def store_append(existing: DataFrame, batch: DataFrame, pk: list[str]) -> DataFrame:
    """The store after appending ``batch``: duplicates on the primary key are
    replaced (a key already stored keeps one row; the batch is de-duplicated)."""
    b = batch.dropDuplicates(pk)
    return existing.unionByName(b.join(existing.select(*pk), pk, "left_anti"))


def nested_by_key(df: DataFrame, key: str, items: list[str], order: list[str], chunks: int = 16) -> DataFrame:
    """``(key, chunk) -> sorted array<struct<items>>``.

    Every key is cut in the same way, whatever its size: an item's chunk is its hash modulo ``chunks``, so the
    arrays of a hot key are ``chunks`` times smaller, and chunks without items have no row. Choose ``chunks`` for
    the largest key; ``chunks=1`` gives one row per key.
    """
    mix = F.lit(0).cast("long")
    for c in order:
        mix = F.pmod(mix * 31 + F.pmod(F.col(c).cast("long"), F.lit(1 << 40)), F.lit(1 << 40))
    d = df.withColumn("chunk", F.pmod(mix, F.lit(chunks)).cast("long"))
    return d.groupBy(key, "chunk").agg(
        F.sort_array(F.collect_list(F.struct(*[F.col(c) for c in order + [i for i in items if i not in order]])))
        .alias("couples"))
