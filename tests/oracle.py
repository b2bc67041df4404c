"""Compare a query with its SQL twin: columns by name, rows as a bag."""

from __future__ import annotations

from collections import Counter
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{Path(sf_dir) / name}.parquet'")
    return con


def bag(columns, rows) -> tuple[list[str], Counter]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], Counter(tuple(r[i] for i in order) for r in rows)


def spark_bag(df):
    return bag(df.columns, [tuple(r) for r in df.collect()])


def sql_bag(con, sql):
    cursor = con.execute(sql)
    return bag([d[0] for d in cursor.description], cursor.fetchall())


def differences(df, con, sql) -> list[str]:
    (found_cols, found), (want_cols, want) = spark_bag(df), sql_bag(con, sql)
    if found_cols != want_cols:
        return [f"columns {found_cols} != {want_cols}"]
    extra, absent = list((found - want).items())[:3], list((want - found).items())[:3]
    return [f"only in Spark: {extra}", f"only in SQL: {absent}"] if extra or absent else []
