"""Runs a query and its oracle and compares the rows, whatever their order."""

from __future__ import annotations

import datetime
import decimal
from collections import Counter

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]


def connect(sf_dir: str):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def _plain(value):
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        return f"{value:.6f}"
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    return repr(value)


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], Counter(tuple(_plain(r[i]) for i in order) for r in rows)


def spark_rows(df):
    return _rows(df.columns, df.collect())


def oracle_rows(connection, sql):
    result = connection.execute(sql)
    return _rows([d[0] for d in result.description], result.fetchall())


def differences(df, connection, sql) -> str | None:
    """None when equal, else a short description."""
    names, rows = spark_rows(df)
    other_names, other = oracle_rows(connection, sql)
    if names != other_names:
        return f"columns {names} != {other_names}"
    if rows != other:
        return (f"{sum(rows.values())} rows, oracle {sum(other.values())}; "
                f"only here {list((rows - other).items())[:3]}; only oracle {list((other - rows).items())[:3]}")
    return None
