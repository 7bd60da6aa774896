"""Comparison of a Spark result with DuckDB's, whatever the order of rows."""

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events"
    " documents embeddings pages benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, bool):
        return value
    if isinstance(value, (int, float)):
        return float(value) + 0.0
    if hasattr(value, "isoformat"):
        return value.isoformat()
    return value


def same_rows(df, con, sql: str) -> None:
    columns = sorted(df.columns)
    spark_rows = [tuple(map(plain, r)) for r in df.select(*columns).collect()]
    cursor = con.execute(sql)
    names = [c[0] for c in cursor.description]
    assert sorted(names) == columns
    places = [names.index(c) for c in columns]
    duck_rows = [tuple(plain(r[i]) for i in places) for r in cursor.fetchall()]
    assert sorted(spark_rows, key=repr) == sorted(duck_rows, key=repr)
