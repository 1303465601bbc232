"""Window operators: positions, last-N history, latest state, sampling, steps.

Positions inside a key (W8 and the ordered audio steps) are built from
per-(key, block) counts plus running offsets, so no single task has to sort
a whole key: only one block of one key is ordered at a time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skein.operators.sizing import null_safe_join


def dense_index(df: DataFrame, keys: list[str], block: Column | None, order: list[Column],
                out: str = "idx", start: int = 0) -> DataFrame:
    """0-based (plus ``start``) position of each row inside ``keys`` by ``order``.

    Rows are cut into blocks that follow ``order``: by default Spark's range
    partitioning on (keys, order) (sampled bounds, so a hot key is spread over
    many balanced blocks; the blocked rows are written once to the shared
    folder so every branch sees the same blocks); or a caller's ``block``
    column that is monotone in ``order`` (no write). Counts per (key, block) are tiny and pre-aggregated; their
    running sum gives each block's offset; rows are numbered inside their
    block only, so no task orders a whole key.
    """
    keys = list(keys)
    if block is None:
        from skein.session import materialize

        # range bounds come from a sample, so the blocked rows are written once:
        # both branches below must see the very same blocks
        parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        b = materialize(df.repartitionByRange(parts, *[F.col(k) for k in keys], *order).withColumn(
            "__blk", F.spark_partition_id().cast("long")), "blocks")
    else:
        b = df.withColumn("__blk", block)
    counts = b.groupBy(*keys, "__blk").agg(F.count(F.lit(1)).alias("__n"))
    w = (Window.partitionBy(*keys).orderBy("__blk") if keys else Window.orderBy("__blk")).rowsBetween(
        Window.unboundedPreceding, -1)
    offsets = counts.withColumn("__off", F.coalesce(F.sum("__n").over(w), F.lit(0))).drop("__n")
    j = null_safe_join(b, offsets, keys + ["__blk"])
    wr = Window.partitionBy(*keys, "__blk").orderBy(*order)
    return (
        j.withColumn(out, (F.col("__off") + F.row_number().over(wr) - 1 + start).cast("long"))
        .drop("__blk", "__off")
    )


def assign_ids(df: DataFrame, order: list[Column], block: Column | None = None, start: int = 1000,
               out: str = "id") -> DataFrame:
    """Dense ids from a sequence start, in an explicit order (range-partitioned
    blocks unless the caller passes a bounded monotone ``block``)."""
    return dense_index(df.withColumn("__all", F.lit(0)), ["__all"], block, order, out, start).drop("__all")


def history_last_n(df: DataFrame, key: str, order: list[Column], value: str, n: int,
                   out: str = "history", block_rows: int = 100_000) -> DataFrame:
    """For every row, the last ``n`` values of its key (oldest first).

    Positions come from ``dense_index``; rows are windowed per (key, block of
    ``block_rows`` positions), each block also receiving the last ``n - 1``
    rows of the block before it as context. A hot key is thus spread over
    ``rows / block_rows`` tasks.
    """
    ix = dense_index(df, [key], None, order, out="__i")
    blk = F.floor(F.col("__i") / block_rows).cast("long")
    own = ix.withColumn("__b", blk).withColumn("__own", F.lit(True))
    ctx = ix.filter(F.col("__i") % block_rows >= block_rows - (n - 1)).withColumn("__b", blk + 1).withColumn(
        "__own", F.lit(False))
    w = Window.partitionBy(key, "__b").orderBy("__i").rowsBetween(-(n - 1), 0)
    h = own.unionByName(ctx).withColumn(out, F.collect_list(value).over(w))
    return h.filter("__own").drop("__i", "__b", "__own")


def latest_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The last row per key by ``order``, as an aggregate (``max_by`` combines
    partially before the shuffle, so a hot key costs one row per map task)."""
    others = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.max_by(F.struct(*others), F.struct(*order)).alias("__last")).select(
        *keys, "__last.*")


def step_ratio(df: DataFrame, key: str, order: list[Column], value: str,
               low: float = 0.95, high: float = 1.05) -> DataFrame:
    """Next / previous ratio and whether it stays in [low, high).

    The previous row is found by an equi-join on (key, position - 1), so no
    task has to walk a whole key.
    """
    ix = dense_index(df, [key], None, order, out="__i")
    prev = ix.select(F.col(key), (F.col("__i") + 1).alias("__i"), F.col(value).alias("__prev"))
    j = null_safe_join(ix, prev, [key, "__i"], "left")
    ratio = F.try_divide(F.col(value), F.col("__prev"))
    return j.withColumn("ratio", ratio).withColumn(
        "in_bound", (F.col("ratio") >= low) & (F.col("ratio") < high)).drop("__i", "__prev")


def first_per_interval(df: DataFrame, key: str, time_ms: Column, order: list[Column],
                       interval_ms: int) -> DataFrame:
    """First row at or after each multiple of ``interval_ms``; frame_order = slot."""
    slot = F.floor(time_ms / F.lit(interval_ms)).cast("long")
    d = df.withColumn("frame_order", slot)
    others = [c for c in d.columns if c not in (key, "frame_order")]
    # first row per slot as an aggregate: combined partially before the shuffle
    g = d.groupBy(key, "frame_order").agg(F.min_by(F.struct(*others), F.struct(*order)).alias("__first"))
    return g.select(key, "frame_order", "__first.*")
