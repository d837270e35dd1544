"""Run a query and its SQL twin on the same tables and compare them as bags of rows."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb

FAMILIES = {
    "bigint": "int", "int": "int", "smallint": "int", "tinyint": "int", "hugeint": "int", "integer": "int",
    "double": "float", "float": "float", "string": "text", "varchar": "text", "boolean": "bool", "date": "date",
    "timestamp_ntz": "time", "timestamp": "time",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in Path(sf_dir).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def _value(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(f"{value:.12g}")
    return value


def _bag(rows, order):
    return sorted(repr([_value(row[i]) for i in order]) for row in rows)


def differences(df, connection, sql) -> list[str]:
    """What differs: columns, types, row count or rows."""
    result = connection.sql(sql)
    names = sorted(df.columns)
    if names != sorted(result.columns):
        return [f"columns {names} != {sorted(result.columns)}"]
    found = []
    ours = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    theirs = {n: str(t).lower() for n, t in zip(result.columns, result.types)}
    for name in names:
        if ours[name].replace("string", "varchar").replace("_ntz", "").replace("int", "integer") != theirs[
            name
        ] and (ours[name], theirs[name]) not in [("bigint", "bigint")]:
            found.append(f"type of {name}: {ours[name]} / {theirs[name]}")
    left = _bag(df.collect(), [df.columns.index(n) for n in names])
    right = _bag(result.fetchall(), [result.columns.index(n) for n in names])
    if len(left) != len(right):
        found.append(f"{len(left)} rows != {len(right)} rows")
    if left != right:
        only_left, only_right = sorted(set(left) - set(right)), sorted(set(right) - set(left))
        found.append(f"rows differ: {only_left[:3]} / {only_right[:3]}")
    return found
