"""Compare a Spark result with its SQL twin: names, row count and every value."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def duckdb_over(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        if Path(f"{folder}/{name}.parquet").exists():
            connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return connection


def _plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return "~"
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, (int, float)) or type(value).__name__ == "Decimal":
        return repr(float(value) + 0.0)
    return str(value)


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda position: columns[position])
    return sorted(tuple(_plain(row[position]) for position in order) for row in rows)


def differences(spark_df, connection, sql: str) -> list[str]:
    """Human-readable differences, empty when both sides agree."""
    cursor = connection.execute(sql)
    wanted_columns = [column[0] for column in cursor.description]
    wanted = cursor.fetchall()
    if sorted(spark_df.columns) != sorted(wanted_columns):
        return [f"columns {sorted(spark_df.columns)} != {sorted(wanted_columns)}"]
    got = spark_df.collect()
    if len(got) != len(wanted):
        return [f"row count {len(got)} != {len(wanted)}"]
    pairs = zip(_rows(spark_df.columns, got), _rows(wanted_columns, wanted))
    return [f"{left} != {right}" for left, right in pairs if left != right][:5]
