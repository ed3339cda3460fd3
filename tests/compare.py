"""Side-by-side check of a registered Spark query against its DuckDB SQL.

Mirrors the correctness gate: column names, row count and an
order-insensitive comparison of the values.
"""
from __future__ import annotations

import math
from typing import Any

from urlsight.sources.tables import TABLES


def duckdb_run(sql: str, sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con.execute(sql).fetch_df()


def _norm(v: Any, digits: int) -> Any:
    if v is None:
        return None
    try:
        import pandas as pd
        if v is pd.NaT or (not isinstance(v, (str, bytes, list, tuple, dict)) and pd.isna(v)):
            return None
    except (TypeError, ValueError):
        pass
    if hasattr(v, "item") and not isinstance(v, (str, bytes)):
        try:
            v = v.item()
        except (ValueError, AttributeError):
            pass
    if isinstance(v, bool):
        return int(v)
    if isinstance(v, float):
        if math.isnan(v):
            return None
        if v.is_integer() and abs(v) < 2**53:
            return int(v)
        return round(v, digits)
    if hasattr(v, "isoformat"):
        return str(v)[:19]
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x, digits) for x in v)
    return v


def rows_of(pdf, digits: int = 6):
    cols = sorted(pdf.columns)
    rows = [tuple(_norm(r[c], digits) for c in cols) for r in pdf[cols].to_dict("records")]
    return cols, sorted(rows, key=repr)


def compare(spark_df, sql: str, sf_dir: str, digits: int = 6) -> dict:
    spdf = spark_df.toPandas()
    ddf = duckdb_run(sql, sf_dir)
    sc, sr = rows_of(spdf, digits)
    dc, dr = rows_of(ddf, digits)
    res = {"spark_rows": len(sr), "oracle_rows": len(dr), "columns_match": sc == dc,
           "spark_columns": sc, "oracle_columns": dc}
    mism = [(a, b) for a, b in zip(sr, dr) if a != b]
    res["value_mismatches"] = len(mism) + abs(len(sr) - len(dr))
    res["examples"] = mism[:3]
    res["ok"] = res["columns_match"] and len(sr) == len(dr) and not mism
    return res
