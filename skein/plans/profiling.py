"""Profiling queries (A2-A10, A22, A23) on the driver tables.

``documents`` left join ``labels`` supplies NULLs; ``events`` plays quotes
(symbol = event_type, price = value) and the request log (latency = value).
Floating results are rounded to 4 digits on both sides of the oracle check.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from skein.operators import paging, profile, sketches
from skein.plans.registry import query
from skein.session import materialize, scratch_path
from skein.sources.tables import Tables

NUM_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _r(c, d=4):
    return F.round(F.col(c), d).alias(c)


@query("shape", sql="SELECT count(*) AS rows, 11 AS columns FROM lineitem")
def q_shape(spark, sf_dir):
    """A2: (rows, columns) of a table."""
    return profile.shape(Tables(spark, sf_dir).lineitem)


def _describe_sql(cols):
    return " UNION ALL ".join(
        f"SELECT '{c}' AS column, count({c}) AS count, round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS stddev, "
        f"round(min({c}), 4) AS min, round(max({c}), 4) AS max FROM lineitem" for c in cols)


@query("describe_long", sql=_describe_sql(NUM_COLS))
def q_describe_long(spark, sf_dir):
    """A3: describe() of the numeric columns, one pass, long form."""
    d = profile.describe_long(Tables(spark, sf_dir).lineitem, NUM_COLS)
    return d.select("column", "count", *[_r(c) for c in ["mean", "stddev", "min", "max"]])


@query("summary_long", sql=" UNION ALL ".join(
    f"SELECT '{c}' AS column, count({c}) AS count, round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS stddev, "
    f"round(min({c}), 4) AS min, round(max({c}), 4) AS max, round(quantile_cont({c}, 0.25), 4) AS p25, "
    f"round(quantile_cont({c}, 0.5), 4) AS p50, round(quantile_cont({c}, 0.75), 4) AS p75 FROM lineitem"
    for c in NUM_COLS))
def q_summary_long(spark, sf_dir):
    """A4: summary() with exact quartiles (distributed exact percentiles)."""
    s = profile.summary_long(Tables(spark, sf_dir).lineitem, NUM_COLS)
    return s.select("column", "count", *[_r(c) for c in ["mean", "stddev", "min", "max", "p25", "p50", "p75"]])


_DOC_LABELS_SQL = """SELECT d.doc_id, d.lang, d.source, d.n_chars, l.quality, l.toxic
                     FROM documents d LEFT JOIN labels l USING (doc_id)"""


def _doc_labels(t):
    d = t.documents.select("doc_id", "lang", "source", "n_chars")
    return d.join(t.labels, "doc_id", "left")


@query("null_counts", sql=" UNION ALL ".join(
    f"SELECT '{c}' AS column, count(*) FILTER (WHERE {c} IS NULL) AS nulls FROM ({_DOC_LABELS_SQL})"
    for c in ["doc_id", "lang", "source", "n_chars", "quality", "toxic"]))
def q_null_counts(spark, sf_dir):
    """A5: null count per column, one pass."""
    return profile.null_counts(_doc_labels(Tables(spark, sf_dir)))


@query("rounded_means", sql="SELECT " + ", ".join(f"round(avg({c}), 0) AS {c}" for c in NUM_COLS) + " FROM lineitem")
def q_rounded_means(spark, sf_dir):
    """Rounded mean of every numeric column."""
    return profile.rounded_means(Tables(spark, sf_dir).lineitem, NUM_COLS, 0)


_DV_COLS = ["o_orderstatus", "o_orderpriority"]


@query("distinct_values", sql=" UNION ALL ".join(
    f"SELECT DISTINCT '{c}' AS column, {c}::VARCHAR AS value FROM orders" for c in _DV_COLS))
def q_distinct_values(spark, sf_dir):
    """The distinct values of chosen columns (long form)."""
    o = Tables(spark, sf_dir).orders
    out = None
    for c in _DV_COLS:
        d = o.select(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")).distinct()
        out = d if out is None else out.unionByName(d)
    return out


@query("distinct_counts", sql=" UNION ALL ".join(
    f"SELECT '{c}' AS column, count(DISTINCT {c}) AS distinct FROM orders"
    for c in ["o_custkey", "o_orderstatus", "o_orderpriority"]))
def q_distinct_counts(spark, sf_dir):
    """Distinct count per column, one pass."""
    return profile.distinct_counts(Tables(spark, sf_dir).orders, ["o_custkey", "o_orderstatus", "o_orderpriority"])


@query("median_value", sql="SELECT round(quantile_cont(l_extendedprice, 0.5), 2) AS median FROM lineitem")
def q_median_value(spark, sf_dir):
    """Median rounded to 2 digits (exact, distributed)."""
    m = profile.exact_percentiles(Tables(spark, sf_dir).lineitem, "l_extendedprice", [0.5])
    return m.select(F.round("p50", 2).alias("median"))


@query("distinct_rows", sql="SELECT DISTINCT l_returnflag, l_linestatus FROM lineitem")
def q_distinct_rows(spark, sf_dir):
    """Distinct rows."""
    return Tables(spark, sf_dir).lineitem.select("l_returnflag", "l_linestatus").distinct()


_SENT_SQL = """(SELECT event_type AS symbol, (floor(value) % 10) / 10.0 AS neutral,
                       (1 - (floor(value) % 10) / 10.0) * (value - floor(value)) AS neg FROM events)"""


@query("sentiment_label", sql=f"""
    SELECT symbol, round(avg(neg), 4) AS neg, round(avg(neutral), 4) AS neutral, round(avg(1 - neutral - neg), 4) AS pos,
           CASE WHEN avg(neutral) > 0.5 THEN 'neutral' WHEN avg(neg) > avg(1 - neutral - neg) THEN 'neg' ELSE 'pos' END AS label
    FROM {_SENT_SQL} GROUP BY symbol""")
def q_sentiment_label(spark, sf_dir):
    """A10: average sentiment per symbol and its label."""
    e = Tables(spark, sf_dir).events
    neutral = (F.floor("value") % 10) / 10.0
    neg = (1 - neutral) * (F.col("value") - F.floor("value"))
    scores = e.select(F.col("event_type").alias("symbol"), neutral.alias("neutral"), neg.alias("neg")).withColumn(
        "pos", 1 - F.col("neutral") - F.col("neg"))
    s = profile.sentiment_label(scores, scores.select("symbol"))
    return s.select("symbol", _r("neg"), _r("neutral"), _r("pos"), "label")


@query("price_range", sql="""
    SELECT symbol, round(min(price) * 0.9, 4) AS y_min, round(max(price) * 1.1, 4) AS y_max FROM (
      SELECT event_type AS symbol, value AS price,
             row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, event_id DESC) AS rn FROM events)
    WHERE rn <= 50 GROUP BY symbol""")
def q_price_range(spark, sf_dir):
    """Chart range over the last 50 prices of each symbol."""
    e = Tables(spark, sf_dir).events.select(F.col("event_type").alias("symbol"), F.col("value").alias("price"),
                                            "ts", "event_id")
    last = paging.top_k_per_group(e, ["symbol"], [F.col("ts").desc(), F.col("event_id").desc()], 50)
    r = profile.chart_range(last, "symbol", "price")
    return r.select("symbol", _r("y_min"), _r("y_max"))


@query("rate_latency", sql="""
    SELECT date_trunc('day', ts) AS window_start, count(*) AS requests, round(avg(value), 4) AS avg_latency,
           max(value) AS max_latency, round(quantile_cont(value, 0.5), 4) AS p50, round(quantile_cont(value, 0.95), 4) AS p95,
           round(quantile_cont(value, 0.99), 4) AS p99 FROM events GROUP BY ALL""")
def q_rate_latency(spark, sf_dir):
    """Requests, mean, maximum and percentiles of the latency per day."""
    r = profile.rate_latency(Tables(spark, sf_dir).events, "ts", "value", "1 day")
    return r.select("window_start", "requests", _r("avg_latency"), "max_latency", _r("p50"), _r("p95"), _r("p99"))


@query("describe_text", sql=" UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count({c}) AS count, min({c}) AS min, max({c}) AS max FROM customer" for c in ("c_name", "c_mktsegment")))
def q_describe_text(spark, sf_dir):
    """A3: the text columns of a table described."""
    return profile.describe_text(Tables(spark, sf_dir).customer)


RANKS = [0.01, 0.25, 0.5, 0.75, 0.99]
_SKETCHED = ["l_partkey", *NUM_COLS]


@query("profile_incremental", sql=" UNION ALL ".join(
    f"SELECT '{c}' AS column, count(*) AS rows, count(*) - count({c}) AS nulls, min({c})::DOUBLE AS low, max({c})::DOUBLE AS high, "
    f"round(avg({c}), 4) AS mean, true AS distinct_within, true AS ranks_within FROM lineitem" for c in _SKETCHED))
def q_profile_incremental(spark, sf_dir):
    """A profile merged from the stored sketches of seven batches (by line number), and whether its distinct counts
    and quantiles are within their bounds of the table's own."""
    rows = Tables(spark, sf_dir).lineitem
    path = scratch_path(spark, f"tables/{spark.sparkContext.applicationId}/profile-{uuid.uuid4().hex}")
    for batch in range(1, 8):  # line numbers are 1 to 7; each append reads its own rows
        sketches.store_profile(rows.filter(F.col("l_linenumber") == batch), _SKETCHED, path, str(batch))
    merged = materialize(sketches.merged_profile(sketches.stored_profiles(spark, path), RANKS), "merged_profile")
    off = sketches.rank_errors(rows, merged, _SKETCHED, RANKS)
    return merged.join(off, "column").select("column", "rows", "nulls", "low", "high", F.round("mean", 4).alias("mean"),
                                             (F.col("distinct_error") <= sketches.COUNT_ERROR).alias("distinct_within"),
                                             (F.col("rank_error") <= sketches.RANK_ERROR).alias("ranks_within"))
