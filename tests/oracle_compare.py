"""Run a named query on Spark and its SQL on DuckDB, compare like the
driver does: column names, row count, order-insensitive values."""

from __future__ import annotations

import math
import os

import duckdb

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations")

_SPARK_TO_DUCK = {
    "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
    "float": "FLOAT", "smallint": "SMALLINT", "tinyint": "TINYINT",
}


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(sf_dir, t + '.parquet')}')")
    return con


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        if v == 0:
            return 0.0
        return round(v, 6)
    return v


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=repr)


def compare(spark, con, name, fn, sql, sf_dir):
    sdf = fn(spark, sf_dir)
    s_names = sdf.columns
    s_types = [f.dataType.simpleString() for f in sdf.schema.fields]
    s_rows = [tuple(r) for r in sdf.collect()]
    cur = con.execute(sql)
    d_names = [d[0] for d in cur.description]
    d_types = [str(d[1]) for d in cur.description]
    d_rows = cur.fetchall()
    problems = []
    if sorted(s_names) != sorted(d_names):
        problems.append(f"columns differ: spark={sorted(s_names)} duck={sorted(d_names)}")
        return problems
    st = {n: _SPARK_TO_DUCK.get(t, t) for n, t in zip(s_names, s_types)}
    dt = dict(zip(d_names, d_types))
    for n in s_names:
        if st[n] != dt[n]:
            problems.append(f"type {n}: spark={st[n]} duck={dt[n]}")
    if len(s_rows) != len(d_rows):
        problems.append(f"rows: spark={len(s_rows)} duck={len(d_rows)}")
    a, b = _rows(s_names, s_rows), _rows(d_names, d_rows)
    if a != b:
        diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
        problems.append(f"values differ (first): {diff}")
    return problems
