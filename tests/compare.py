"""Run a query in Spark and its SQL in DuckDB and compare the rows as a multiset."""

from __future__ import annotations

import datetime as dt
import decimal
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.sql(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return repr(value)
    if isinstance(value, decimal.Decimal):
        return str(value)
    if isinstance(value, (dt.datetime, dt.date)):
        return value.isoformat()
    return value


def rows_of(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(r[i]) for i in order) for r in rows)


_TYPES = {
    "int": "INTEGER", "bigint": "BIGINT", "string": "VARCHAR", "boolean": "BOOLEAN",
    "date": "DATE", "timestamp_ntz": "TIMESTAMP", "double": "DOUBLE",
}


def difference(df, con, sql: str) -> str | None:
    """None if equal, else a short account of what differs."""
    relation = con.sql(sql)
    spark_types = {n: _TYPES.get(t, t.upper()) for n, t in df.dtypes}
    duck_types = {n: str(t).upper() for n, t in zip(relation.columns, relation.types)}
    if spark_types != duck_types:
        differing = {
            n: (spark_types.get(n), duck_types.get(n))
            for n in spark_types.keys() | duck_types.keys()
            if spark_types.get(n) != duck_types.get(n)
        }
        return f"types differ: {differing}"
    ours = rows_of(df.columns, [tuple(r) for r in df.collect()])
    theirs = rows_of(relation.columns, relation.fetchall())
    if ours != theirs:
        return (
            f"{ours.total()} rows against {theirs.total()}; "
            f"only ours {list((ours - theirs).items())[:2]}; only theirs {list((theirs - ours).items())[:2]}"
        )
    return None
