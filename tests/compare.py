"""Runs a registered query in Spark and its SQL counterpart in DuckDB and compares both."""

from __future__ import annotations

import os

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
SAME = {
    "INTEGER": "int", "BIGINT": "bigint", "SMALLINT": "smallint", "TINYINT": "tinyint", "DOUBLE": "double",
    "VARCHAR": "string", "DATE": "date", "BOOLEAN": "boolean", "TIMESTAMP": "timestamp_ntz",
}


def connect(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        path = f"{sf_dir}/{name}.parquet"
        if os.path.exists(path):
            con.execute(f"create view {name} as select * from '{path}'")
    return con


def _key(row):
    return tuple((v is not None, str(v)) for v in row)


def _norm(v):
    if isinstance(v, float):
        return 0.0 if v == 0 else v
    if hasattr(v, "tzinfo") and v.tzinfo is not None:
        return v.replace(tzinfo=None)
    return v


def difference(spark_df, con, sql: str) -> str | None:
    """None when schema and rows agree, else a short description."""
    names = sorted(spark_df.columns)
    left = [tuple(_norm(r[n]) for n in names) for r in spark_df.collect()]
    rel = con.sql(sql)
    if sorted(rel.columns) != names:
        return f"columns {names} vs {sorted(rel.columns)}"
    kinds = dict(zip(rel.columns, [str(t) for t in rel.types]))
    mine = dict(spark_df.dtypes)
    wrong = {n: (mine[n], kinds[n]) for n in names if SAME.get(kinds[n]) != mine[n] and not (mine[n] == "timestamp" and kinds[n] == "TIMESTAMP")}
    order = [rel.columns.index(n) for n in names]
    right = [tuple(_norm(row[i]) for i in order) for row in rel.fetchall()]
    if len(left) != len(right):
        return f"rows {len(left)} vs {len(right)} types {wrong}"
    left.sort(key=_key)
    right.sort(key=_key)
    bad = [(a, b) for a, b in zip(left, right) if a != b]
    if bad or wrong:
        return f"types {wrong} values {len(bad)} of {len(left)} differ: {names} {bad[:2]}"
    if not left:
        return "no rows"
    return None
