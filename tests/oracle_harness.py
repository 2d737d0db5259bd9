"""Side-by-side check of a Spark query against its DuckDB oracle SQL.

Mirrors the correctness gate: row count, column names, and an
order-insensitive comparison of values (floats compared after rounding).
"""

from __future__ import annotations

import datetime as dt
import decimal
import math

import duckdb

from ledgerlens.sources.tables import TABLES


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v, digits=6):
    if v is None:
        return None
    if isinstance(v, bool):
        return int(v)
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, digits)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x, digits) for x in v)
    return v


def _key(row):
    return tuple((x is None, str(type(x)), x if x is not None else 0) for x in row)


def compare(spark_df, con, sql: str, digits: int = 6) -> dict:
    pdf_cols = sorted(spark_df.columns)
    s_rows = [tuple(_norm(r[c], digits) for c in pdf_cols) for r in spark_df.collect()]
    res = con.execute(sql)
    o_cols_raw = [d[0] for d in res.description]
    o_data = res.fetchall()
    o_cols = sorted(o_cols_raw)
    idx = [o_cols_raw.index(c) for c in o_cols]
    o_rows = [tuple(_norm(r[i], digits) for i in idx) for r in o_data]
    out = {
        "spark_rows": len(s_rows),
        "oracle_rows": len(o_rows),
        "cols_match": pdf_cols == o_cols,
        "spark_cols": pdf_cols,
        "oracle_cols": o_cols,
    }
    s_sorted = sorted(s_rows, key=_key)
    o_sorted = sorted(o_rows, key=_key)
    out["values_match"] = out["cols_match"] and s_sorted == o_sorted
    if not out["values_match"] and out["cols_match"]:
        diffs = []
        for a, b in zip(s_sorted, o_sorted):
            if a != b:
                diffs.append((a, b))
                if len(diffs) >= 3:
                    break
        out["first_diffs"] = diffs
    return out
