"""Column profiling (A1-A9), quantiles, sentiment roll-up (A10), chart range (A22),
request rate (A23). One pass per table wherever the statistic allows it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skein.operators.sizing import null_safe_join
from skein.session import materialize


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def shape(df: DataFrame) -> DataFrame:
    """A2: (rows, columns) as one row."""
    return df.agg(F.count(F.lit(1)).alias("rows")).select(
        "rows", F.lit(len(df.columns)).cast("int").alias("columns"))


def _long_form(wide: DataFrame, cols: list[str], stats: list[str]) -> DataFrame:
    """Wide one-row stats ``{stat}__{col}`` -> rows (column, stat...), via ``stack``."""
    parts = ", ".join(f"'{c}', " + ", ".join(f"`{s}__{c}`" for s in stats) for c in cols)
    return wide.selectExpr(f"stack({len(cols)}, {parts}) as (column, {', '.join(stats)})")


def describe_long(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """A3: count, mean, stddev, min, max per numeric column, one pass, long form."""
    cols = cols or numeric_columns(df)
    aggs = []
    for c in cols:
        x = F.col(c).cast("double")
        aggs += [F.count(x).alias(f"count__{c}"), F.avg(x).alias(f"mean__{c}"),
                 F.stddev_samp(x).alias(f"stddev__{c}"), F.min(x).alias(f"min__{c}"),
                 F.max(x).alias(f"max__{c}")]
    return _long_form(df.agg(*aggs), cols, ["count", "mean", "stddev", "min", "max"])


def describe_text(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """A3 for text columns: count of values, smallest and largest, one pass, long form (mean and deviation have no
    meaning there)."""
    cols = cols or [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    aggs = []
    for c in cols:
        aggs += [F.count(F.col(c)).alias(f"count__{c}"), F.min(c).alias(f"min__{c}"), F.max(c).alias(f"max__{c}")]
    return _long_form(df.agg(*aggs), cols, ["count", "min", "max"])


def exact_percentiles(df: DataFrame, col: str, ps: list[float], keys: list[str] = (),
                      buckets: int | None = None) -> DataFrame:
    """Exact linear-interpolated percentiles (``percentile_cont``) without one big buffer.

    Values are reduced to (value, count) and range-partitioned by (keys,
    value): every partition then holds one contiguous value range (equal
    values never straddle two). Per-partition totals give offsets, a running
    count inside each partition gives every distinct value its rank interval,
    and the two values around rank ``(n-1)p`` are picked by an aggregation.
    Memory per task is one range of distinct values, whatever the skew. The
    partitioned pairs are written once: their bounds come from a sample, and the
    offsets must see the very same ranges whether or not Spark reuses an exchange.
    Keys may be NULL; a key without any value is not in the result.
    """
    keys = list(keys)
    spark = df.sparkSession
    nb = buckets or max(8, int(spark.conf.get("spark.sql.shuffle.partitions")))
    v = df.select(*keys, F.col(col).cast("double").alias("v")).filter(F.col("v").isNotNull())
    vc = v.groupBy(*keys, "v").agg(F.count(F.lit(1)).alias("cnt"))
    vc = materialize(vc.repartitionByRange(nb, *keys, "v").withColumn("bkt", F.spark_partition_id()), "value_counts")
    per_b = vc.groupBy(*keys, "bkt").agg(F.sum("cnt").alias("bc"))
    wo = (Window.partitionBy(*keys).orderBy("bkt") if keys else Window.orderBy("bkt")).rowsBetween(
        Window.unboundedPreceding, -1)
    per_b = per_b.withColumn("off", F.coalesce(F.sum("bc").over(wo), F.lit(0)))
    # totals per key over the (keys x buckets) rows: a window, not a join
    per_b = per_b.withColumn("n", F.sum("bc").over(Window.partitionBy(*keys))).drop("bc")
    j = null_safe_join(vc, per_b, keys + ["bkt"])
    wi = Window.partitionBy(*keys, "bkt").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    j = j.withColumn("hi_r", F.col("off") + F.sum("cnt").over(wi)).withColumn("lo_r", F.col("hi_r") - F.col("cnt"))
    aggs = []
    for i, p in enumerate(ps):
        h = (F.col("n") - 1) * F.lit(float(p))
        r_lo, r_hi = F.floor(h), F.ceil(h)
        aggs += [F.max(F.when((F.col("lo_r") <= r_lo) & (r_lo < F.col("hi_r")), F.col("v"))).alias(f"__lo{i}"),
                 F.max(F.when((F.col("lo_r") <= r_hi) & (r_hi < F.col("hi_r")), F.col("v"))).alias(f"__hi{i}"),
                 F.max(h - r_lo).alias(f"__fr{i}")]
    g = j.groupBy(*keys).agg(*aggs) if keys else j.agg(*aggs)
    out = [F.col(k) for k in keys]
    for i, p in enumerate(ps):
        lo, hi, fr = F.col(f"__lo{i}"), F.col(f"__hi{i}"), F.col(f"__fr{i}")
        out.append((lo + fr * (hi - lo)).alias(f"p{int(round(p * 100))}"))
    return g.select(*out)


def stack_columns(df: DataFrame, cols: list[str], name: str = "column", value: str = "v") -> DataFrame:
    """Wide numeric columns -> long (column, value) rows (``stack``, no shuffle)."""
    parts = ", ".join(f"'{c}', CAST(`{c}` AS DOUBLE)" for c in cols)
    return df.selectExpr(f"stack({len(cols)}, {parts}) as ({name}, {value})")


def summary_long(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """A4: describe plus exact 25 / 50 / 75 % quantiles per numeric column."""
    cols = cols or numeric_columns(df)
    d = describe_long(df, cols)
    qs = exact_percentiles(stack_columns(df, cols), "v", [0.25, 0.5, 0.75], keys=["column"])
    return d.join(qs, "column", "left")  # a column without values has no quantiles, but is a column


def null_counts(df: DataFrame) -> DataFrame:
    """A5: nulls per column in one pass, long form (column, nulls)."""
    cols = df.columns
    wide = df.agg(*[F.sum(F.col(f"`{c}`").isNull().cast("long")).alias(f"nulls__{c}") for c in cols])
    return _long_form(wide, cols, ["nulls"])


def rounded_means(df: DataFrame, cols: list[str] | None = None, digits: int = 0) -> DataFrame:
    """Mean of each numeric column, rounded, one pass (one row)."""
    cols = cols or numeric_columns(df)
    return df.agg(*[F.round(F.avg(F.col(c)), digits).alias(c) for c in cols])


def distinct_counts(df: DataFrame, cols: list[str] | None = None, exact: bool = True) -> DataFrame:
    """Distinct values per column; exact or HyperLogLog (``approx_count_distinct``)."""
    cols = cols or df.columns
    f = F.count_distinct if exact else F.approx_count_distinct
    wide = df.agg(*[f(F.col(c)).alias(f"distinct__{c}") for c in cols])
    return _long_form(wide, cols, ["distinct"])


# Fixed values of the sentiment roll-up.
NEUTRAL_THRESHOLD = 0.5


def sentiment_label(scores: DataFrame, symbols: DataFrame, key: str = "symbol") -> DataFrame:
    """A10: average neg / neutral / pos per symbol (0 when a symbol has none),
    label neutral if neutral > 0.5, else neg if neg > pos, else pos (Q15)."""
    avg = scores.groupBy(key).agg(F.avg("neg").alias("neg"), F.avg("neutral").alias("neutral"),
                                  F.avg("pos").alias("pos"))
    s = symbols.select(key).distinct().join(avg, key, "left").fillna(0.0, ["neg", "neutral", "pos"])
    label = (F.when(F.col("neutral") > NEUTRAL_THRESHOLD, "neutral")
             .when(F.col("neg") > F.col("pos"), "neg").otherwise("pos"))
    return s.withColumn("label", label)


def chart_range(last_prices: DataFrame, key: str, price: str, low: float = 0.9, high: float = 1.1) -> DataFrame:
    """Y-axis range of a price chart: min * 0.9, max * 1.1 per key."""
    return last_prices.groupBy(key).agg((F.min(price) * low).alias("y_min"), (F.max(price) * high).alias("y_max"))


def rate_latency(df: DataFrame, ts: str, latency: str, every: str = "1 day", percentiles: tuple[float, ...] = (0.5, 0.95, 0.99)) -> DataFrame:
    """Requests, mean, maximum and exact percentiles (p50, ...) of the latency per time window (tumbling)."""
    rows = df.select(F.window(ts, every)["start"].alias("window_start"), F.col(latency).alias("__v"))
    per = rows.groupBy("window_start").agg(
        F.count(F.lit(1)).alias("requests"), F.avg("__v").alias("avg_latency"), F.max("__v").alias("max_latency"))
    qs = exact_percentiles(rows, "__v", list(percentiles), keys=["window_start"])
    return null_safe_join(per, qs, ["window_start"], "left")
