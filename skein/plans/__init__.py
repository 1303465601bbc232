"""Named queries on the driver tables, each with its DuckDB oracle SQL."""

from skein.plans.registry import QUERIES, ORACLE_SQL, load_all  # noqa: F401
