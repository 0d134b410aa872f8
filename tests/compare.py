"""Run queries next to their SQL in DuckDB and compare whole results."""

from __future__ import annotations

import math
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def _value(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 9)
    return v


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _bag(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_value(row[i]) for i in order) for row in rows)


KINDS = {
    "string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE",
    "boolean": "BOOLEAN", "date": "DATE", "timestamp": "TIMESTAMP",
}


def difference(df, con, sql: str) -> str:
    """Empty if the frame and the SQL agree in columns, types and rows."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    types = dict(zip(names, (str(t) for t in con.sql(sql).types)))
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} vs {sorted(names)}"
    kinds = {c: KINDS.get(t, t) for c, t in df.dtypes}
    odd = {c: (kinds[c], types[c]) for c in names if kinds[c] != types[c]}
    if odd:
        return f"types {odd}"
    ours, theirs = _bag(df.columns, df.collect()), _bag(names, result.fetchall())
    if ours != theirs:
        return (
            f"{sum(ours.values())} vs {sum(theirs.values())} rows; only ours "
            f"{list((ours - theirs).items())[:3]}; only theirs {list((theirs - ours).items())[:3]}"
        )
    return ""
