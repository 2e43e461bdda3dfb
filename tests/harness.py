"""Local stand-in for the driver's check: run a Spark query and its DuckDB oracle on the
same parquet tables, compare schema (names), row count and an order-insensitive hash."""

from __future__ import annotations

import hashlib
import math

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        if v == int(v) and abs(v) < 2**53:
            return int(v)
        return round(v, 6)
    if hasattr(v, "item"):
        return _norm(v.item())
    if isinstance(v, (bytes, bytearray)):
        return bytes(v).hex()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def rows_of_spark(df):
    cols = sorted(df.columns)
    return cols, [tuple(_norm(r[c]) for c in cols) for r in df.select(*cols).collect()]


def rows_of_duck(con, sql):
    rel = con.sql(sql)
    names = rel.columns
    cols = sorted(names)
    idx = [names.index(c) for c in cols]
    return cols, [tuple(_norm(r[i]) for i in idx) for r in rel.fetchall()]


def digest(rows) -> str:
    h = hashlib.sha256()
    for r in sorted(repr(x) for x in rows):
        h.update(r.encode())
    return h.hexdigest()


def compare(spark_df, con, sql):
    sc, sr = rows_of_spark(spark_df)
    dc, dr = rows_of_duck(con, sql)
    out = {"schema": sc == dc, "rows": (len(sr), len(dr)), "hash": digest(sr) == digest(dr)}
    out["ok"] = out["schema"] and len(sr) == len(dr) and out["hash"]
    if not out["ok"]:
        out["spark_cols"], out["duck_cols"] = sc, dc
        a, b = set(map(repr, sr)), set(map(repr, dr))
        out["only_spark"] = sorted(a - b)[:3]
        out["only_duck"] = sorted(b - a)[:3]
    return out
