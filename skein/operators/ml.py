"""Regression pipeline steps (M1-M7) on Spark ML."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skein.operators.profile import exact_percentiles


_MULTIPLIERS = (2654435761, 40503, 97)


def drop_nulls(df: DataFrame, subset: list[str] | None = None) -> DataFrame:
    """M1: rows without NULLs (the result is used, unlike the reference; Q17)."""
    return df.na.drop(subset=subset)


def impute(df: DataFrame, median_cols: list[str], constants: dict) -> DataFrame:
    """M2: fill NULLs with the column's exact median (computed distributed) and constants."""
    out = df
    for c in median_cols:
        med = exact_percentiles(df, c, [0.5]).select("p50").scalar()  # one value, a scalar subquery
        out = out.withColumn(c, F.coalesce(F.col(c).cast("double"), med))
    return out.fillna(constants)


def assemble(df: DataFrame, inputs: list[str], out: str = "features", invalid: str = "error") -> DataFrame:
    """M3: feature vector. NULL or NaN inputs are an error, or kept as NaN with ``invalid="keep"``; rows are
    dropped only where the caller asks for it (M1, or ``invalid="skip"``)."""
    return VectorAssembler(inputCols=inputs, outputCol=out, handleInvalid=invalid).transform(df)


def scale(df: DataFrame, inputs: list[str], invalid: str = "error") -> DataFrame:
    """M4: standard scaler with the defaults (unit std, no centering); columns out."""
    a = assemble(df, inputs, "__f", invalid)
    model = StandardScaler(inputCol="__f", outputCol="__s", withStd=True, withMean=False).fit(a)
    arr = vector_to_array(F.col("__s"))
    return model.transform(a).select(*df.columns, *[arr[i].alias(f"{c}_scaled") for i, c in enumerate(inputs)])


def split_flag(*keys: Column, train: float = 0.8) -> Column:
    """M5: deterministic 80/20 split by a multiplicative hash of all keys modulo
    2**32, the same on any partitioning (``randomSplit`` depends on it). Each
    product is taken in 16-bit halves, so no key can overflow."""
    top = F.lit(1 << 32)
    h = F.lit(0).cast("long")
    for i, k in enumerate(keys):
        mult = _MULTIPLIERS[i] if i < len(_MULTIPLIERS) else _MULTIPLIERS[0] + 2 * i
        part = F.pmod(k.cast("long"), top)
        low, high = part % 65536, F.shiftright(part, 16)
        h = h + F.pmod(low * mult + F.pmod(high * mult, top) * 65536, top)
    return (F.pmod(h, top) / 4294967296.0) < train


def fit_linear(df: DataFrame, inputs: list[str], label: str):
    """M6: VectorAssembler + LinearRegression as a Pipeline; returns the fitted model."""
    pipe = Pipeline(stages=[VectorAssembler(inputCols=inputs, outputCol="features"),
                            LinearRegression(featuresCol="features", labelCol=label, predictionCol="prediction")])
    return pipe.fit(df)


def rmse(pred: DataFrame, label: str, prediction: str = "prediction") -> DataFrame:
    """M7: root mean squared error as one row."""
    return pred.agg(F.sqrt(F.avg((F.col(prediction) - F.col(label)) ** 2)).alias("rmse"))
