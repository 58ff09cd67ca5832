"""Run a registered query and its SQL check and compare them value by value."""

from __future__ import annotations

import datetime
import decimal
import math
import pathlib

import duckdb

from tidyspark.queries import ORACLES, QUERIES


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in pathlib.Path(sf_dir).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def plain(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, float):
        return None if math.isnan(value) else value
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, dict):
        return tuple(plain(v) for v in value.values())
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    return value


def kind(spark_type: str) -> str:
    names = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}
    names["timestamp_ntz"] = "TIMESTAMP"
    return names.get(spark_type, spark_type)


def normal(rows, order) -> list[str]:
    return sorted(repr([plain(row[i]) for i in order]) for row in rows)


def differences(spark, sf_dir: str, name: str, connection) -> list[str]:
    got = QUERIES[name](spark, sf_dir)
    rows = got.collect()
    if name not in ORACLES:
        return [] if rows else ["no rows"]
    want = connection.execute(ORACLES[name])
    columns = [d[0] for d in want.description]
    types = {d[0]: str(d[1]) for d in want.description}
    expected = want.fetchall()
    found = []
    if sorted(columns) != sorted(got.columns):
        return [f"columns {sorted(got.columns)} != {sorted(columns)}"]
    for column, spark_type in got.dtypes:
        if kind(spark_type) in ("BIGINT", "INTEGER", "DOUBLE", "VARCHAR", "BOOLEAN") and kind(spark_type) != types[column]:
            found.append(f"type of {column}: {spark_type} != {types[column]}")
    if len(rows) != len(expected):
        found.append(f"rows {len(rows)} != {len(expected)}")
    names = sorted(columns)
    left = normal(rows, [got.columns.index(c) for c in names])
    right = normal(expected, [columns.index(c) for c in names])
    if left != right:
        only_left, only_right = sorted(set(left) - set(right)), sorted(set(right) - set(left))
        found.append(f"{len(only_left)} / {len(only_right)} rows differ in {names}: {only_left[:2]} vs {only_right[:2]}")
    return found
