"""Run a query on Spark and its SQL twin, and compare every value."""

from __future__ import annotations

import math
import os

import duckdb

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")
DATA = os.environ.get("MARTWRIGHT_TESTDATA", "/root/testdata")


def twin_connection(folder: str):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"create view {table} as select * from read_parquet('{folder}/{table}.parquet')")
    return connection


def _normal(value):
    if isinstance(value, float) and math.isnan(value):
        return None
    return value


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_normal(r[i]) for i in order) for r in rows), key=repr)


def spark_rows(df):
    return sorted(df.columns), _rows(df.columns, [tuple(r) for r in df.collect()])


def twin_rows(connection, sql):
    result = connection.execute(sql)
    columns = [d[0] for d in result.description]
    return sorted(columns), _rows(columns, result.fetchall())


def first_difference(mine, theirs):
    """None if equal, else a short description."""
    if mine[0] != theirs[0]:
        return f"columns {mine[0]} != {theirs[0]}"
    if len(mine[1]) != len(theirs[1]):
        return f"{len(mine[1])} rows != {len(theirs[1])} rows"
    for a, b in zip(mine[1], theirs[1]):
        if a != b or [type(x) for x in a] != [type(x) for x in b]:
            return f"{mine[0]}\n{a}\n{b}"
    return None
