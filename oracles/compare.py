"""Order-insensitive comparison of a Spark result with a DuckDB result."""

from __future__ import annotations

import datetime as dt
import math
from collections import Counter

import duckdb

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations")


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        if math.isnan(v):
            return "NULL"
        return f"{v:.9g}"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat(sep=" ")
    if isinstance(v, dt.date):
        return v.isoformat()
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return str(v)


def spark_rows(df):
    return [tuple(norm(x) for x in r) for r in df.collect()], df.columns


def duck_rows(con, sql):
    cur = con.execute(sql)
    cols = [d[0] for d in cur.description]
    return [tuple(norm(x) for x in r) for r in cur.fetchall()], cols


def compare(df, con, sql) -> dict:
    srows, scols = spark_rows(df)
    drows, dcols = duck_rows(con, sql)
    out = {"spark_rows": len(srows), "oracle_rows": len(drows), "spark_cols": scols, "oracle_cols": dcols,
           "cols_match": scols == dcols}
    if sorted(scols) == sorted(dcols) and scols != dcols:
        idx = [dcols.index(c) for c in scols]
        drows = [tuple(r[i] for i in idx) for r in drows]
    cs, cd = Counter(srows), Counter(drows)
    out["match"] = out["cols_match"] and cs == cd
    if cs != cd:
        out["only_spark"] = list((cs - cd).elements())[:5]
        out["only_oracle"] = list((cd - cs).elements())[:5]
    return out
