"""skein — Spark-native user-level data operators (batch + Structured Streaming).

Every operator is a plain function over DataFrames / Columns; the plans in
``skein.plans`` bind them to the driver's test tables and register each one as
a named query with its DuckDB oracle SQL.
"""

__version__ = "0.1.0"
