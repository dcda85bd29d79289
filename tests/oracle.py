"""Runs one query in Spark and its SQL in DuckDB and compares the rows, whatever their order."""

from __future__ import annotations

import math

import duckdb
from pyspark.sql import DataFrame

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    return str(value)


def rows_of(columns: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_plain(row[i]) for i in order) for row in rows)


def spark_rows(df: DataFrame) -> list[tuple]:
    return rows_of(df.columns, [tuple(row) for row in df.collect()])


def duckdb_rows(con: duckdb.DuckDBPyConnection, sql: str) -> list[tuple]:
    cursor = con.execute(sql)
    return rows_of([d[0] for d in cursor.description], cursor.fetchall())


def duckdb_columns(con: duckdb.DuckDBPyConnection, sql: str) -> dict[str, str]:
    return {row[0]: row[1] for row in con.execute(f"DESCRIBE {sql}").fetchall()}
