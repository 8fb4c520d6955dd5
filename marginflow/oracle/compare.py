"""Order-insensitive comparison of a Spark result with a DuckDB oracle.

Mirrors the driver's gate: same row count, same column names, same multiset
of rows (columns sorted by name, doubles rounded to a fixed precision).
"""

from __future__ import annotations

import datetime as _dt
import decimal
import hashlib
import math
import os

from pyspark.sql import DataFrame

from marginflow.sources.tables import DRIVER_TABLES

FLOAT_DIGITS = 6


def duckdb_connection(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in DRIVER_TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE OR REPLACE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        r = round(v, FLOAT_DIGITS)
        return 0.0 if r == 0 else r
    if isinstance(v, decimal.Decimal):
        return _norm(float(v))
    if isinstance(v, _dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, (_dt.date, _dt.time)):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    if hasattr(v, "asDict"):
        return _norm(v.asDict())
    if hasattr(v, "item"):  # numpy scalar
        return _norm(v.item())
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    out.sort(key=lambda t: repr(t))
    return [cols[i] for i in order], out


def compare(spark_df: DataFrame, sql: str, con, show: int = 3) -> dict:
    s_cols = spark_df.columns
    s_rows = [tuple(r) for r in spark_df.collect()]
    rel = con.sql(sql)
    d_cols = list(rel.columns)
    d_rows = rel.fetchall()
    sc, sr = _rows(s_cols, s_rows)
    dc, dr = _rows(d_cols, d_rows)
    res = {
        "rows_spark": len(sr), "rows_oracle": len(dr),
        "rows_match": len(sr) == len(dr),
        "schema_match": sc == dc,
        "values_match": sr == dr,
    }
    res["hash_spark"] = hashlib.sha1(repr(sr).encode()).hexdigest()[:12]
    res["hash_oracle"] = hashlib.sha1(repr(dr).encode()).hexdigest()[:12]
    if not res["schema_match"]:
        res["cols_spark"], res["cols_oracle"] = sc, dc
    if res["schema_match"] and not res["values_match"]:
        a, b = set(sr), set(dr)
        res["only_spark"] = [x for x in sr if x not in b][:show]
        res["only_oracle"] = [x for x in dr if x not in a][:show]
    res["ok"] = res["rows_match"] and res["schema_match"] and res["values_match"]
    return res
