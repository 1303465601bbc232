"""Joins beyond the listing and the fingerprint search."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def anti_known(candidates: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """Candidates whose key is not known yet."""
    return candidates.join(known.select(key).distinct(), key, "left_anti")


def range_first(queries: DataFrame, cands: DataFrame, qkey: str, qval: str, cval: str, rank: list[str],
                width: float) -> DataFrame:
    """Per query the best-ranked candidate with ``|cval - qval| <= width``
    (``rank``: the ranking columns, ending with a tie-break).

    Candidates belong to their query (equi key), the range is a filter, the
    first by rank is a ``min_by`` aggregate combined before the shuffle.
    """
    j = queries.join(cands, qkey).filter(F.abs(F.col(cval) - F.col(qval)) <= width)
    others = [c for c in j.columns if c != qkey]
    # top-1 by rank as an aggregate (partial before the shuffle), not a window
    g = j.groupBy(qkey).agg(F.min_by(F.struct(*others), F.struct(*rank)).alias("__best"))
    return g.select(qkey, "__best.*")


def orphans(child: DataFrame, parent: DataFrame, fk: str, pk: str) -> DataFrame:
    """Child rows whose non-NULL foreign key has no parent."""
    p = parent.select(F.col(pk).alias(fk)).distinct()
    return child.filter(F.col(fk).isNotNull()).join(p, fk, "left_anti")


def row_with_options(row: DataFrame, options: DataFrame, value: str, label: str) -> DataFrame:
    """A row plus its option list in long form, one row per option: the row's columns, the option's label
    and value, and its position by (label, value).

    No list is folded into one cell, so the options may be of any number. The row enters the scan of the options
    as a scalar subquery; positions come from range-partitioned blocks.
    """
    from skein.operators.windows import dense_index

    one = row.select(F.struct("*").alias("row")).scalar()
    listed = options.select(F.col(label).alias("label"), F.col(value).alias("value"))
    placed = dense_index(listed, [], None, [F.col("label"), F.col("value")], out="position")
    return placed.withColumn("__row", one).select("__row.*", "label", "value", "position")
