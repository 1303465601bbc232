"""Joins on keys that may be NULL."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def null_safe_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Equi-join in which NULL keys equal each other, as they do in ``groupBy`` and ``partitionBy``; the keys
    come from ``left``. ``<=>`` plans as a hash or merge join; which side is broadcast, if any, is decided at
    run time from measured bytes."""
    renamed = right.withColumnsRenamed({k: f"__r_{k}" for k in keys})
    on = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__r_{k}")) for k in keys])
    return left.join(renamed, on, how).drop(*[f"__r_{k}" for k in keys])
