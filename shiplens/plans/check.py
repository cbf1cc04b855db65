"""Local cross-check of a registered query against its DuckDB oracle SQL.

Mirrors the driver's gate: row count, column names, and an
order-insensitive comparison of the values (columns sorted by name).
"""

from __future__ import annotations

import datetime as _dt
import math
from collections import Counter

from shiplens.sources.tables import TABLES


def _norm(v):
    if v is None:
        return None
    if hasattr(v, "item") and not isinstance(v, (str, bytes)):
        try:
            v = v.item()
        except Exception:
            pass
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return float(v)
    if isinstance(v, _dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, _dt.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return [tuple(_norm(r[i]) for i in order) for r in rows], sorted(cols)


def duck_connect(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def compare(spark, name: str, sf_dir: str, con=None) -> dict:
    from shiplens.plans.registry import ORACLE, QUERIES
    df = QUERIES[name](spark, sf_dir)
    srows = [tuple(r) for r in df.collect()]
    s_vals, s_cols = _rows(df.columns, srows)
    out = {"name": name, "spark_rows": len(srows)}
    if name not in ORACLE:
        out["status"] = "rows-only"
        return out
    con = con or duck_connect(sf_dir)
    res = con.execute(ORACLE[name])
    dcols = [d[0] for d in res.description]
    d_vals, d_cols = _rows(dcols, res.fetchall())
    out["duck_rows"] = len(d_vals)
    out["cols_match"] = s_cols == d_cols
    if not out["cols_match"]:
        out["spark_cols"], out["duck_cols"] = s_cols, d_cols
    cs, cd = Counter(s_vals), Counter(d_vals)
    out["values_match"] = cs == cd
    if not out["values_match"]:
        out["only_spark"] = list((cs - cd).elements())[:3]
        out["only_duck"] = list((cd - cs).elements())[:3]
    out["status"] = "ok" if (out["cols_match"] and out["values_match"]) else "MISMATCH"
    return out
