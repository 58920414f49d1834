"""Run a catalogue query in Spark and its oracle in DuckDB, and compare the rows."""

from __future__ import annotations

import math
from collections import Counter
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        if Path(f"{sf_dir}/{name}.parquet").exists():
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float) and not math.isnan(value):
        return round(value, 9)
    return value


def rows_of(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(r[i]) for i in order) for r in rows)


def spark_rows(df) -> Counter:
    return rows_of(df.columns, [tuple(r) for r in df.collect()])


def oracle_rows(con, sql: str) -> tuple[list[str], Counter]:
    result = con.sql(sql)
    return result.columns, rows_of(result.columns, result.fetchall())
