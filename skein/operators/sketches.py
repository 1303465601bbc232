"""Mergeable column profiles (A3, A4, A7 without another pass over old rows).

Each batch of a growing table is profiled once: per column the counts, extremes and sum, a KLL sketch (quantiles and
ranks) and an HLL sketch (distinct values). These rows, a few kB a column, are stored by batch; the profile of the whole
table merges the stored sketches, so a profile after an append reads the new rows only. All of it is Spark's
own sketch aggregates, combined on the map side.

Bounds: the rank of a quantile is within ``RANK_ERROR`` of the asked one, and a distinct count within ``COUNT_ERROR`` of the true
one, each with high probability whatever the number of batches. NULLs are counted apart and are in no sketch; NaN is a value
for the counts of values, but no number for the quantiles, the extremes and the sum.
"""

from __future__ import annotations

import os
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

K = 400  # KLL: items of a sketch's top level
LG_K = 13  # HLL: log2 of the registers
RANK_ERROR = 0.0133  # published for both sides of a single rank at k = 200; half at 400, asked for with room
COUNT_ERROR = 3 * 1.04 / 2 ** (LG_K / 2)  # three standard errors

SCHEMA = "column string, rows bigint, nulls bigint, low double, high double, total double, numbers bigint, quantiles binary, uniques binary"


def batch_profile(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row per numeric column of a batch: counts and sketches, in one pass."""
    def row(c: str) -> Column:
        v = F.col(c).cast("double")
        number = F.when(~F.isnan(v), v)
        return F.struct(F.lit(c).alias("column"), F.count(F.lit(1)).alias("rows"), (F.count(F.lit(1)) - F.count(v)).alias("nulls"), F.min(number).alias("low"),
                        F.max(number).alias("high"), F.sum(number).alias("total"), F.count(number).alias("numbers"),
                        F.kll_sketch_agg_double(number, K).alias("quantiles"),
                        # a number as text has one form, whatever its type; -0.0 is 0.0
                        F.hll_sketch_agg((v + F.lit(0.0)).cast("string"), LG_K).alias("uniques"))

    return df.agg(F.array(*[row(c) for c in columns]).alias("__p")).select(F.inline("__p"))


def store_profile(df: DataFrame, columns: list[str], path: str, batch: str) -> None:
    """Profile the rows of one batch and store that; a batch that is stored again replaces itself."""
    batch_profile(df, columns).coalesce(1).write.mode("overwrite").parquet(os.path.join(path, f"batch={batch}"))


def stored_profiles(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SCHEMA + ", batch string").parquet(path)


def merged_profile(profiles: DataFrame, ranks: list[float], keys: list[str] | None = None) -> DataFrame:
    """(column, rows, nulls, low, high, mean, distinct, quantiles) over all batches of each column (and of ``keys``)."""
    keys = ["column", *(keys or [])]
    merged = profiles.groupBy(*keys).agg(
        F.sum("rows").alias("rows"), F.sum("nulls").alias("nulls"), F.min("low").alias("low"), F.max("high").alias("high"), F.sum("total").alias("__t"),
        F.sum("numbers").alias("numbers"), F.kll_merge_agg_double(F.when(F.col("numbers") > 0, F.col("quantiles")), K).alias("__q"),
        F.hll_union_agg("uniques").alias("__u"))
    asked = F.array(*[F.lit(float(r)) for r in ranks])
    at = F.when(F.col("numbers") > 0, F.kll_sketch_get_quantile_double("__q", asked))
    return merged.select(*keys, "rows", "nulls", "low", "high", F.try_divide("__t", "numbers").alias("mean"), F.hll_sketch_estimate("__u").alias("distinct"),
                         at.alias("quantiles"))


def rank_errors(df: DataFrame, profile: DataFrame, columns: list[str], ranks: list[float]) -> DataFrame:
    """(column, distinct_error, rank_error): how far a merged profile is from ``df`` itself, in one pass over ``df`` per kind.

    distinct_error is relative; rank_error is the largest distance between an asked rank and the ranks that its quantile really has."""
    wide = profile.groupBy().pivot("column", columns).agg(F.first("quantiles"))
    bound = {c: wide.select(F.col(c)).scalar() for c in columns}

    def row(c: str) -> Column:
        v = F.col(c).cast("double")
        number = F.when(~F.isnan(v), v)
        n = F.count(number)
        gaps = []
        for i, r in enumerate(ranks):
            q = F.get(bound[c], F.lit(i))
            below, upto = F.count_if(number < q) / n, F.count_if(number <= q) / n
            gaps.append(F.greatest(below - F.lit(float(r)), F.lit(float(r)) - upto, F.lit(0.0)))
        return F.struct(F.lit(c).alias("column"), F.countDistinct(v).alias("__d"), reduce(F.greatest, gaps).alias("rank_error"))

    real = df.agg(F.array(*[row(c) for c in columns]).alias("__p")).select(F.inline("__p"))
    joined = real.join(profile.select("column", "distinct"), "column")
    return joined.select("column", F.try_divide(F.abs(F.col("distinct") - F.col("__d")), F.col("__d")).alias("distinct_error"), "rank_error")
