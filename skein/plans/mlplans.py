"""Regression pipeline and validation queries (M1-M7, P20)."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from skein.operators import ml, validate
from skein.plans.profiling import _DOC_LABELS_SQL, _doc_labels
from skein.plans.registry import query
from skein.sources.tables import Tables

_SPLIT_SQL = "((l_orderkey * 2654435761 + l_linenumber * 40503) % 4294967296) / 4294967296.0 < 0.8"


@query("drop_nulls", sql=f"SELECT * FROM ({_DOC_LABELS_SQL}) WHERE quality IS NOT NULL AND toxic IS NOT NULL")
def q_drop_nulls(spark, sf_dir):
    """M1: rows without NULLs."""
    return ml.drop_nulls(_doc_labels(Tables(spark, sf_dir)))


@query("impute", sql=f"""
    SELECT doc_id, lang, source, n_chars, coalesce(quality::DOUBLE, (SELECT quantile_cont(quality, 0.5) FROM ({_DOC_LABELS_SQL}))) AS quality,
           coalesce(toxic, 0) AS toxic FROM ({_DOC_LABELS_SQL})""")
def q_impute(spark, sf_dir):
    """M2: median for one column, a constant for another."""
    return ml.impute(_doc_labels(Tables(spark, sf_dir)), ["quality"], {"toxic": 0})


@query("scaled", sql="""
    SELECT l_orderkey, l_linenumber, round(l_quantity / (SELECT stddev_samp(l_quantity) FROM lineitem), 6) AS l_quantity_scaled,
           round(l_discount / (SELECT stddev_samp(l_discount) FROM lineitem), 6) AS l_discount_scaled FROM lineitem""")
def q_scaled(spark, sf_dir):
    """M4: standard scaler (unit std, no centering)."""
    li = Tables(spark, sf_dir).lineitem.select("l_orderkey", "l_linenumber", "l_quantity", "l_discount")
    s = ml.scale(li, ["l_quantity", "l_discount"])
    return s.select("l_orderkey", "l_linenumber", F.round("l_quantity_scaled", 6).alias("l_quantity_scaled"),
                    F.round("l_discount_scaled", 6).alias("l_discount_scaled"))


@query("train_test", sql=f"""
    SELECT CASE WHEN {_SPLIT_SQL} THEN 'train' ELSE 'test' END AS split, count(*) AS n FROM lineitem GROUP BY ALL""")
def q_train_test(spark, sf_dir):
    """M5: deterministic 80/20 split (counts per side)."""
    li = Tables(spark, sf_dir).lineitem
    flag = ml.split_flag(F.col("l_orderkey"), F.col("l_linenumber"))
    return li.groupBy(F.when(flag, "train").otherwise("test").alias("split")).agg(F.count(F.lit(1)).alias("n"))


def _fit(spark, sf_dir):
    li = Tables(spark, sf_dir).lineitem
    flag = ml.split_flag(F.col("l_orderkey"), F.col("l_linenumber"))
    d = li.select("l_quantity", "l_extendedprice", flag.alias("train"))
    model = ml.fit_linear(d.filter("train"), ["l_quantity"], "l_extendedprice")
    return d, model


@query("linreg_fit", sql=f"""
    SELECT round(regr_intercept(l_extendedprice, l_quantity), 4) AS intercept,
           round(regr_slope(l_extendedprice, l_quantity), 4) AS slope FROM lineitem WHERE {_SPLIT_SQL}""")
def q_linreg_fit(spark, sf_dir):
    """M6: linear regression fit on the training side (assembler + regression pipeline)."""
    _, model = _fit(spark, sf_dir)
    lr = model.stages[-1]
    return spark.createDataFrame([(float(lr.intercept), float(lr.coefficients[0]))], "intercept double, slope double").select(
        F.round("intercept", 4).alias("intercept"), F.round("slope", 4).alias("slope"))


@query("rmse", sql=f"""
    WITH c AS (SELECT regr_intercept(l_extendedprice, l_quantity) AS a, regr_slope(l_extendedprice, l_quantity) AS b
               FROM lineitem WHERE {_SPLIT_SQL})
    SELECT round(sqrt(avg(power(a + b * l_quantity - l_extendedprice, 2))), 4) AS rmse FROM lineitem, c WHERE NOT ({_SPLIT_SQL})""")
def q_rmse(spark, sf_dir):
    """M7: RMSE of the fitted model on the test side."""
    d, model = _fit(spark, sf_dir)
    pred = model.transform(d.filter(~F.col("train")))
    return ml.rmse(pred, "l_extendedprice").select(F.round("rmse", 4).alias("rmse"))


RULES = [
    validate.Rule("name", "nonempty"),
    validate.Rule("acctbal", "min", 0),
    validate.Rule("acctbal", "max", 9000),
    validate.Rule("joined", "date", "yyyy-MM-dd"),
    validate.Rule("email", "email"),
    validate.Rule("segment", "required"),
]


@query("validate_rows", sql="""
    WITH v AS (SELECT c_custkey AS id, c_name AS name, c_acctbal AS acctbal,
                      CASE WHEN c_nationkey % 7 = 0 THEN 'no date' ELSE '2011-12-' || lpad((c_nationkey + 1)::VARCHAR, 2, '0') END AS joined,
                      CASE WHEN c_mktsegment = 'BUILDING' THEN lower(c_name) ELSE replace(lower(c_name), '#', '.') END || '@example.com' AS email,
                      nullif(c_mktsegment, 'MACHINERY') AS segment FROM customer)
    SELECT id, list_filter([
        CASE WHEN name IS NULL OR trim(name) = '' THEN 'name:error.nonempty' END,
        CASE WHEN acctbal IS NULL OR acctbal < 0 THEN 'acctbal:error.min' END,
        CASE WHEN acctbal IS NULL OR acctbal > 9000 THEN 'acctbal:error.max' END,
        CASE WHEN joined IS NULL OR try_strptime(joined, '%Y-%m-%d') IS NULL THEN 'joined:error.date' END,
        CASE WHEN email IS NULL OR NOT regexp_matches(email, '^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\\.[A-Za-z]{2,}$') THEN 'email:error.email' END,
        CASE WHEN segment IS NULL THEN 'segment:error.required' END], lambda x: x IS NOT NULL) AS errors
    FROM v""")
def q_validate_rows(spark, sf_dir):
    """P20: rule list -> error list per row (empty = valid)."""
    c = Tables(spark, sf_dir).customer
    joined = F.when(F.col("c_nationkey") % 7 == 0, F.lit("no date")).otherwise(
        F.concat(F.lit("2011-12-"), F.lpad((F.col("c_nationkey") + 1).cast("string"), 2, "0")))
    email = F.concat(F.when(F.col("c_mktsegment") == "BUILDING", F.lower("c_name")).otherwise(
        F.replace(F.lower("c_name"), F.lit("#"), F.lit("."))), F.lit("@example.com"))
    v = c.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("acctbal"),
                 joined.alias("joined"), email.alias("email"),
                 F.nullif(F.col("c_mktsegment"), F.lit("MACHINERY")).alias("segment"))
    return validate.validate(v, RULES).select("id", "errors")
