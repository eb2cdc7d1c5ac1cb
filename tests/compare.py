"""Runs a registered query and its DuckDB text and compares schema and rows."""

from __future__ import annotations

import datetime
import math
from decimal import Decimal
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

KINDS = {
    "TINYINT": "int", "SMALLINT": "int", "INTEGER": "int", "BIGINT": "bigint",
    "HUGEINT": "hugeint", "DOUBLE": "double", "FLOAT": "float", "VARCHAR": "string",
    "BOOLEAN": "boolean", "DATE": "date",
}


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        path = Path(folder) / f"{name}.parquet"
        if path.exists():
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def kind_of(duck_type: str) -> str:
    text = str(duck_type)
    return text.lower().replace(" ", "") if text.startswith("DECIMAL") else KINDS.get(text, text)


def plain(value):
    """A value in a form both engines share."""
    if isinstance(value, Decimal):
        return str(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(f"{value:.9g}") + 0.0
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return value


def sorted_rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(
        (tuple(plain(row[i]) for i in order) for row in rows), key=lambda r: tuple(map(repr, r))
    )


def differences(df, con, sql: str) -> list[str]:
    """What differs between the frame and the SQL result; empty when nothing does."""
    result = con.execute(sql)
    duck = {d[0]: kind_of(d[1]) for d in result.description}
    duck_rows = result.fetchall()
    spark_kinds = {f.name: f.dataType.simpleString() for f in df.schema}
    found = [
        f"column {n}: spark {spark_kinds.get(n)}, duckdb {duck.get(n)}"
        for n in sorted(set(duck) | set(spark_kinds))
        if spark_kinds.get(n) != duck.get(n)
    ]
    if set(duck) != set(spark_kinds):
        return found
    left = sorted_rows(df.columns, [tuple(r) for r in df.collect()])
    right = sorted_rows(list(duck), duck_rows)
    if len(left) != len(right):
        found.append(f"rows: spark {len(left)}, duckdb {len(right)}")
    wrong = [(a, b) for a, b in zip(left, right) if a != b]
    if wrong:
        found.append(f"{len(wrong)} rows differ, first: {wrong[0]}")
    return found
