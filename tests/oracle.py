"""Compare a Spark query with its DuckDB oracle: rows, schema and values.

Used by tests/test_oracle.py and runnable directly for a quick loop:
    python -m tests.oracle [sf_dir] [name ...]
"""

from __future__ import annotations

import datetime as _dt
import decimal
import math
import os
import sys
import time

import duckdb

from skein.sources.tables import TABLES

_SPARK_TO_DUCK = {
    "bigint": "BIGINT", "int": "INTEGER", "smallint": "SMALLINT", "tinyint": "TINYINT",
    "double": "DOUBLE", "float": "FLOAT", "string": "VARCHAR", "boolean": "BOOLEAN",
    "date": "DATE", "timestamp_ntz": "TIMESTAMP", "binary": "BLOB",
}


def duck_type_of(spark_type: str) -> str:
    if spark_type.startswith("array<") and spark_type.endswith(">"):
        return duck_type_of(spark_type[6:-1]) + "[]"
    if spark_type.startswith("struct<"):
        return "STRUCT"
    return _SPARK_TO_DUCK.get(spark_type, spark_type.upper())


def _duck_family(t: str) -> str:
    t = t.upper()
    if t.startswith("STRUCT"):
        return "STRUCT"
    if t.startswith("STRUCT(") and t.endswith("[]"):
        return "STRUCT[]"
    return t


def norm(v, digits: int = 6):
    if v is None:
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        r = round(v, digits)
        return 0.0 if r == 0 else r
    if isinstance(v, decimal.Decimal):
        return norm(float(v), digits)
    if isinstance(v, dict):
        return tuple(norm(x, digits) for x in v.values())
    if isinstance(v, (list, tuple)):
        return tuple(norm(x, digits) for x in v)
    if isinstance(v, (bytes, bytearray, memoryview)):
        return bytes(v)
    if isinstance(v, _dt.datetime):
        return v.replace(tzinfo=None)
    return v


def duck_connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(sf_dir, t + '.parquet')}')")
    return con


def compare(spark, con, name: str, fn, sql: str | None, sf_dir: str) -> dict:
    t0 = time.time()
    df = fn(spark, sf_dir)
    s_cols = df.columns
    s_types = dict(df.dtypes)
    s_rows = [tuple(r) for r in df.collect()]
    t_spark = time.time() - t0
    out = {"name": name, "spark_rows": len(s_rows), "spark_sec": round(t_spark, 2)}
    if sql is None:
        out["ok"] = True
        out["mode"] = "rows-only"
        return out
    rel = con.sql(sql)
    d_cols = rel.columns
    d_types = dict(zip(d_cols, [str(x) for x in rel.types]))
    d_rows = rel.fetchall()
    out["duck_rows"] = len(d_rows)
    problems = []
    if sorted(s_cols) != sorted(d_cols):
        problems.append(f"columns spark={sorted(s_cols)} duck={sorted(d_cols)}")
    else:
        for c in s_cols:
            want = duck_type_of(s_types[c])
            got = _duck_family(d_types[c])
            if want != got and not (want == "STRUCT" and got.startswith("STRUCT")) and not (
                want.startswith("STRUCT") and got.startswith("STRUCT")
            ):
                problems.append(f"type {c}: spark={s_types[c]} duck={d_types[c]}")
        order = sorted(range(len(s_cols)), key=lambda i: s_cols[i])
        d_index = {c: i for i, c in enumerate(d_cols)}
        s_norm = sorted((tuple(norm(r[i]) for i in order) for r in s_rows), key=repr)
        d_norm = sorted((tuple(norm(r[d_index[s_cols[i]]]) for i in order) for r in d_rows), key=repr)
        if len(s_norm) != len(d_norm):
            problems.append(f"rows spark={len(s_norm)} duck={len(d_norm)}")
        if s_norm != d_norm:
            sd = set(map(repr, s_norm))
            dd = set(map(repr, d_norm))
            only_s = sorted(sd - dd)[:3]
            only_d = sorted(dd - sd)[:3]
            problems.append(f"values differ; spark-only {only_s} duck-only {only_d}")
    out["ok"] = not problems
    out["problems"] = problems
    out["mode"] = "sql"
    return out


def main(argv: list[str]) -> int:
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as E
    from skein.session import local_session

    sf_dir = "/root/testdata/sf0.01"
    names = []
    for a in argv:
        if a.startswith("/"):
            sf_dir = a
        else:
            names.append(a)
    spark = local_session()
    qs, sqls = E.queries(), E.oracle_sql()
    con = duck_connect(sf_dir)
    bad = 0
    for n in names or sorted(qs):
        try:
            r = compare(spark, con, n, qs[n], sqls.get(n), sf_dir)
        except Exception as e:  # report and go on with the rest
            r = {"name": n, "ok": False, "problems": [f"{type(e).__name__}: {str(e)[:400]}"]}
        bad += not r["ok"]
        print(("OK  " if r["ok"] else "BAD ") + repr(r), flush=True)
    print(f"{bad} bad of {len(names or qs)}")
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main(sys.argv[1:]))
