"""Spark-vs-DuckDB comparison in the spirit of the driver's correctness gate:
same column names, same row count, same multiset of rows."""

from __future__ import annotations

import datetime as dt
import math

import duckdb

from ledgerflow.sources.fixtures import TABLES


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


STRICT = False  # True: floats must be bit-identical (no re-rounding here)


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return v if STRICT else round(v, 4)
    if isinstance(v, dt.datetime):
        return v.isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if hasattr(v, "item"):
        return _norm(v.item())
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _key(row):
    return tuple((x is None, str(type(x)), x if x is not None else 0) for x in row)


DUCK_TO_SPARK = {"INTEGER": "int", "BIGINT": "bigint", "DOUBLE": "double", "VARCHAR": "string", "DATE": "date",
                 "BOOLEAN": "boolean"}


def type_problems(spark_df, con, sql):
    """Column types must agree (int/bigint/double/string/date/boolean)."""
    rel = con.sql(sql)
    spark_types = dict(spark_df.dtypes)
    return [f"type of {c}: spark={spark_types.get(c)} duck={t}" for c, t in zip(rel.columns, map(str, rel.types))
            if DUCK_TO_SPARK.get(t, t) != spark_types.get(c)]


def compare(spark_df, con, sql):
    types = type_problems(spark_df, con, sql)
    if types:
        return types
    cols = sorted(spark_df.columns)
    srows = [tuple(_norm(r[c]) for c in cols) for r in spark_df.collect()]
    res = con.execute(sql)
    dcols = [d[0] for d in res.description]
    drows_raw = res.fetchall()
    problems = []
    if sorted(dcols) != cols:
        problems.append(f"columns differ: spark={cols} duck={sorted(dcols)}")
        return problems
    idx = [dcols.index(c) for c in cols]
    drows = [tuple(_norm(r[i]) for i in idx) for r in drows_raw]
    if len(srows) != len(drows):
        problems.append(f"row count spark={len(srows)} duck={len(drows)}")
    s_sorted = sorted(srows, key=_key)
    d_sorted = sorted(drows, key=_key)
    if s_sorted != d_sorted:
        diff = [(a, b) for a, b in zip(s_sorted, d_sorted) if a != b][:3]
        problems.append(f"values differ, first: {diff}")
    return problems
