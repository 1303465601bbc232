"""Registry of named queries: name -> (spark, sf_dir) -> DataFrame, plus oracle SQL."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE_SQL: dict[str, str] = {}

_MODULES = (
    "listing",
    "fingerprint",
    "shaping",
    "scalars",
    "profiling",
    "changes",
    "joins",
    "windows",
    "imaging",
    "mlplans",
    "sources",
    "streams",
    "roundtrips",
)


def query(name: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir) -> DataFrame`` under ``name``.

    ``sql`` is the DuckDB statement that must return the same rows; ``None``
    means the operator is not SQL-expressible and gets a rows-only check.
    """

    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE_SQL[name] = sql.strip()
        return fn

    return deco


def load_all() -> None:
    for m in _MODULES:
        importlib.import_module(f"skein.plans.{m}")
