"""Run a query and its SQL counterpart over the same folder and compare the rows."""

from __future__ import annotations

import math
from datetime import date, datetime
from decimal import Decimal
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame

TABLES = "region nation customer supplier part orders lineitem events".split()


TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE",
         "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN"}


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        if Path(f"{folder}/{name}.parquet").exists():
            connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return connection


def plain(value):
    if isinstance(value, datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, date):
        return value.isoformat()
    if isinstance(value, Decimal):
        return float(value)
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    return float(value) if isinstance(value, (int, float)) and not isinstance(value, bool) else value


def rows_of(names: list[str], rows) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(plain(row[i]) for i in order) for row in rows), key=repr)


def difference(df: DataFrame, connection: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None if names, types and rows agree, otherwise what differs."""
    wanted = {row[0]: row[1] for row in connection.execute(f"DESCRIBE {sql}").fetchall()}
    have = {name: TYPES[kind] for name, kind in df.dtypes}
    if have != wanted:
        return f"columns {sorted(have.items())} against {sorted(wanted.items())}"
    result = connection.execute(sql)
    names = [column[0] for column in result.description]
    expected = rows_of(names, result.fetchall())
    found = rows_of(df.columns, df.collect())
    if found == expected:
        return None
    extra = [row for row in found if row not in expected][:3]
    missing = [row for row in expected if row not in found][:3]
    return f"{len(found)} against {len(expected)} rows; {sorted(names)}; extra {extra}; missing {missing}"
