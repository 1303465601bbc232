"""Listing operators: dimension join, text filter, ordering, paging, totals.

J1 left join to a dimension, P9 case-insensitive contains, O1 ordinal order
with nulls last, O2 named order, O3 limit/offset page, A1 counts, A21 page
metadata, O6 option lists, O5 natural sort key, O4/O7 top-k.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def left_join_dim(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str) -> DataFrame:
    """Every fact row, with the dimension's columns or NULLs (broadcast or not: by measured bytes)."""
    return fact.join(dim, fact[fact_key] == dim[dim_key], "left")


def contains_ci(c: Column | str, text: str) -> Column:
    """``name LIKE %text%`` ignoring case (``ilike``); ``%``/``_`` in text stay wildcards."""
    c = F.col(c) if isinstance(c, str) else c
    return c.ilike(f"%{text}%")


def order_columns(df: DataFrame, by: str | int, descending: bool = False,
                  tie: str | None = None) -> list[Column]:
    """O1/O2: sort key by name or 1-based column number, nulls last, id tie-break (Q14:
    every listing gets a total order)."""
    name = df.columns[by - 1] if isinstance(by, int) else by
    if name not in df.columns:
        raise ValueError(f"unknown sort column {name!r}")
    c = F.col(name)
    keys = [c.desc_nulls_last() if descending else c.asc_nulls_last()]
    if tie is not None and tie != name:
        keys.append(F.col(tie).asc())
    return keys


def ranked(df: DataFrame, keys: list[Column], rank_col: str = "rank") -> DataFrame:
    """Attach a 1-based global position for ``keys`` (explicit order for checks).

    A global ``row_number`` runs in one task, so it is only used on results
    that are already bounded (a page, a top-k); see ``page``.
    """
    return df.withColumn(rank_col, F.row_number().over(Window.orderBy(*keys)).cast("long"))


def page(df: DataFrame, keys: list[Column], page_no: int, page_size: int,
         rank_col: str = "rank") -> DataFrame:
    """O3: rows ``page_no*page_size+1 .. +page_size`` of the order ``keys``.

    ``orderBy().limit()`` plans as TakeOrderedAndProject: every partition keeps
    only its best ``offset+size`` rows, so no global sort of the table happens.
    The rank is then computed over that bounded set.
    """
    offset = page_no * page_size
    top = df.orderBy(*keys).limit(offset + page_size)
    return ranked(top, keys, rank_col).filter(F.col(rank_col) > offset)


def page_after(df: DataFrame, order: list[tuple[str, bool]], last: list, page_size: int) -> DataFrame:
    """O3 for deep pages: the ``page_size`` rows after the row whose order columns are ``last``, by ``order``
    ((column, descending), NULLs last, ending with a unique column).

    The position is a condition on the key, not a count of rows to skip: every task keeps at most
    ``page_size`` rows, whatever the depth, and the condition on the first column can reach the scan.
    """
    after, same = F.lit(False), F.lit(True)
    for (name, down), value in zip(order, last):
        c = F.col(name)
        if value is None:  # NULLs are last: only the next column can still be greater
            same = same & c.isNull()
            continue
        beyond = (c < F.lit(value)) if down else (c > F.lit(value))
        after = after | (same & (beyond | c.isNull()))
        same = same & (c == F.lit(value))
    keys = [F.col(n).desc_nulls_last() if down else F.col(n).asc_nulls_last() for n, down in order]
    return df.filter(F.coalesce(after, F.lit(False))).orderBy(*keys).limit(page_size)


def page_meta(total: Column, page_no: int, page_size: int) -> list[Column]:
    """Page count and has-prev / has-next flags from a total."""
    return [
        total.alias("total"),
        F.lit(page_no).cast("long").alias("page"),
        F.lit(page_no * page_size).cast("long").alias("offset"),
        F.ceil(total / F.lit(page_size)).cast("long").alias("pages"),
        F.lit(page_no > 0).alias("has_prev"),
        (F.lit((page_no + 1) * page_size) < total).alias("has_next"),
    ]


def _counted(digits: Column) -> Column:
    return F.concat(F.lpad(F.length(digits).cast("string"), 10, "0"), digits)


def natural_sort_key(c: Column | str) -> Column:
    """text/digit runs; a digit run, without leading zeros, is preceded by its length, so runs of
    any length compare as numbers."""
    c = F.col(c) if isinstance(c, str) else c
    parts = F.regexp_extract_all(c, F.lit(r"(\d+|\D+)"), 1)
    padded = F.transform(
        parts,
        lambda p: F.when(p.rlike(r"^\d+$"), _counted(F.regexp_replace(p, r"^0+(?=\d)", "")))
        .otherwise(F.lower(p)),
    )
    return F.array_join(padded, "\u0001")


def top_k_per_group(df: DataFrame, group: list[str], keys: list[Column], k: int,
                    rank_col: str = "rank") -> DataFrame:
    """Best ``k`` rows per group by ``keys``.

    Spark plans ``row_number() <= k`` with a WindowGroupLimit before the
    shuffle, so each partition forwards at most ``k`` rows per group: a hot
    group does not ship all of its rows to one task.
    """
    w = Window.partitionBy(*group).orderBy(*keys)
    return df.withColumn(rank_col, F.row_number().over(w).cast("long")).filter(F.col(rank_col) <= k)
