"""Run a registered Spark query and its DuckDB oracle side by side and compare them:
column names, row count, and the order-insensitive multiset of rows (columns sorted by
name; doubles compared after rounding to 9 decimals)."""

from __future__ import annotations

import datetime as dt
import decimal
import math

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return (0, "")
    if isinstance(v, bool):
        return (1, int(v))
    if isinstance(v, float):
        if math.isnan(v):
            return (2, "nan")
        return (2, round(v, 9))
    if isinstance(v, decimal.Decimal):
        return (2, round(float(v), 9))
    if isinstance(v, int):
        return (2, v)
    if isinstance(v, dt.datetime):
        return (3, v.replace(tzinfo=None).isoformat())
    if isinstance(v, dt.date):
        return (3, v.isoformat())
    return (4, str(v))


def _canon(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i].lower())
    return [n.lower() for n in sorted(names, key=str.lower)], sorted(tuple(_norm(r[i]) for i in order) for r in rows)


SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
                 "timestamp_ntz": "TIMESTAMP", "date": "DATE", "boolean": "BOOLEAN", "smallint": "SMALLINT"}


def _duck_type(spark_type: str) -> str:
    if spark_type.startswith("decimal"):
        return spark_type.upper().replace(" ", "")
    return SPARK_TO_DUCK.get(spark_type, spark_type.upper())


def compare(spark, con, key: str, fn, sql: str, sf_dir: str) -> dict:
    sdf = fn(spark, sf_dir)
    s_names = sdf.columns
    s_types = {f.name.lower(): _duck_type(f.dataType.simpleString()) for f in sdf.schema.fields}
    s_rows = [tuple(r) for r in sdf.collect()]
    d_types = {c[0].lower(): str(c[1]).upper().replace(" ", "")
               for c in con.execute(f"DESCRIBE {sql}").fetchall()} if sql else {}
    cur = con.execute(sql)
    d_names = [c[0] for c in cur.description]
    d_rows = cur.fetchall()
    sn, sr = _canon(s_names, s_rows)
    dn, dr = _canon(d_names, d_rows)
    out = {"key": key, "spark_rows": len(sr), "oracle_rows": len(dr), "names_match": sn == dn,
           "values_match": sr == dr}
    if sn != dn:
        out["spark_cols"], out["oracle_cols"] = sn, dn
    elif sr != dr:
        ds, ss = set(dr), set(sr)
        only_s = [r for r in sr if r not in ds][:3]
        only_d = [r for r in dr if r not in ss][:3]
        out["only_spark"], out["only_oracle"] = only_s, only_d
    type_diff = {k: (s_types[k], d_types.get(k)) for k in s_types if d_types.get(k) != s_types[k]}
    out["types_match"] = not type_diff
    if type_diff:
        out["type_diff"] = type_diff
    out["ok"] = out["names_match"] and out["values_match"] and out["types_match"]
    return out
