"""Spark result vs DuckDB oracle: row count, column names, order-insensitive values."""

from __future__ import annotations

import datetime as dt
import decimal
import math
from collections import Counter

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 4)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 4)
    if isinstance(v, int):
        return v
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    return v


SPARK_TO_DUCK = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR",
                 "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP", "float": "FLOAT"}


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_norm(r[i]) for i in order) for r in rows)


def compare(spark, fn, sql: str | None, sf_dir: str, con=None) -> dict:
    df = fn(spark, sf_dir)
    s_names = df.columns
    s_rows = [tuple(r) for r in df.collect()]
    out = {"spark_rows": len(s_rows), "columns": sorted(s_names)}
    if sql is None:
        return out
    con = con or duck(sf_dir)
    rel = con.sql(sql)
    d_names = list(rel.columns)
    d_types = {n: str(t) for n, t in zip(rel.columns, rel.types)}
    d_rows = rel.fetchall()
    s_types = {f.name: SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString())
               for f in df.schema.fields}
    out["types_match"] = all(s_types.get(n) == d_types.get(n) for n in d_names)
    if not out["types_match"]:
        out["type_diff"] = [(n, s_types.get(n), d_types.get(n)) for n in d_names
                            if s_types.get(n) != d_types.get(n)]
    out["oracle_rows"] = len(d_rows)
    out["names_match"] = sorted(s_names) == sorted(d_names)
    a, b = rows_of(s_names, s_rows), rows_of(d_names, d_rows)
    out["values_match"] = out["names_match"] and a == b
    if not out["values_match"] and out["names_match"]:
        out["only_spark"] = list((a - b).items())[:3]
        out["only_oracle"] = list((b - a).items())[:3]
    if not out["names_match"]:
        out["oracle_columns"] = sorted(d_names)
    return out
