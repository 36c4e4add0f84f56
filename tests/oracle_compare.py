"""Order-insensitive comparison of a Spark result with DuckDB oracle SQL."""

from __future__ import annotations

import math
from decimal import Decimal

import duckdb

from strata.sources.tables import TABLE_NAMES


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLE_NAMES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def norm(v, strict: bool = True):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return (0, "")
    if isinstance(v, float):
        return (1, repr(v) if strict else f"{v:.6e}")
    if isinstance(v, Decimal):
        return (1, f"{float(v):.6e}" if not strict else str(v.normalize()))
    if hasattr(v, "isoformat"):
        return (1, v.isoformat(sep=" ") if hasattr(v, "hour") else v.isoformat())
    return (1, str(v))


def canonical(columns, records, strict: bool = True):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(norm(r[i], strict) for i in order) for r in records)


def compare(df, con, sql: str, strict: bool = True) -> str | None:
    """None when equal, else a short description of the first difference."""
    scols = df.columns
    srows = [tuple(r) for r in df.collect()]
    res = con.execute(sql)
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    if sorted(scols) != sorted(dcols):
        return f"columns differ: spark={sorted(scols)} duckdb={sorted(dcols)}"
    a, b = canonical(scols, srows, strict), canonical(dcols, drows, strict)
    if len(a) != len(b):
        return f"row count: spark={len(a)} duckdb={len(b)}"
    for x, y in zip(a, b):
        if x != y:
            return f"first difference: spark={x} duckdb={y}"
    return None
