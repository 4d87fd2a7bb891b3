"""Runs a registered query and its SQL and compares the rows, in any order."""

from __future__ import annotations

import datetime
import decimal
from collections import Counter

import duckdb
from pyspark.sql import DataFrame

from checks.tables import NAMES


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for name in NAMES:
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return db


def plain(value):
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None)
    return value


def rows_of(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(plain(row[i]) for i in order) for row in rows)


SPARK_KIND = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN",
              "timestamp_ntz": "TIMESTAMP", "array<bigint>": "BIGINT[]"}


def differences(df: DataFrame, db: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """What differs between a frame and a SQL text; empty where names, types and rows agree."""
    found = db.execute(sql)
    names = [column[0] for column in found.description]
    kinds = {column[0]: str(column[1]) for column in found.description}
    expected = found.fetchall()
    problems = []
    if sorted(df.columns) != sorted(names):
        return [f"columns {sorted(df.columns)} against {sorted(names)}"]
    for name, kind in df.dtypes:
        if SPARK_KIND.get(kind, kind.upper() if kind.startswith("decimal") else kind) != kinds[name]:
            problems.append(f"type of {name}: {kind} against {kinds[name]}")
    ours, theirs = rows_of(df.columns, df.collect()), rows_of(names, expected)
    if ours != theirs:
        problems.append(f"{ours.total()} rows against {theirs.total()}")
        problems += [f"only in Spark: {row}" for row in list((ours - theirs))[:2]]
        problems += [f"only in SQL: {row}" for row in list((theirs - ours))[:2]]
    return problems
