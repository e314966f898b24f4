"""Compare a Spark result with SQL on the same Parquet tables."""

from __future__ import annotations

import math
from collections import Counter
from decimal import Decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return connection


def _plain(value):
    if isinstance(value, Decimal):
        return float(value)
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else float(repr(value + 0.0))
    if isinstance(value, (list, tuple)):
        return tuple(_plain(v) for v in value)
    return value


def spark_rows(df) -> tuple[list[str], Counter]:
    names = sorted(df.columns)
    return names, Counter(tuple(_plain(r[n]) for n in names) for r in df.collect())


def sql_rows(connection, sql: str) -> tuple[list[str], Counter]:
    cursor = connection.execute(sql)
    columns = [d[0] for d in cursor.description]
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    rows = cursor.fetchall()
    return [columns[i] for i in order], Counter(tuple(_plain(r[i]) for i in order) for r in rows)


def sql_types(connection, sql: str) -> dict[str, str]:
    return {r[0]: r[1] for r in connection.execute(f"DESCRIBE {sql}").fetchall()}
