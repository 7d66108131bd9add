"""Run a registered query and its SQL on the same tables and compare the rows."""

from __future__ import annotations

import duckdb

from tideferry.queries.stand_ins import ALL

# Spark type names and the DuckDB names they must come back as.
TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "string": "VARCHAR",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
    "date": "DATE",
}


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in ALL:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return connection


def _sorted(rows) -> list[tuple]:
    return sorted(rows, key=lambda row: tuple((value is not None, str(value)) for value in row))


def difference(frame, connection: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """What differs between a DataFrame and a SQL result, or None."""
    cursor = connection.execute(sql)
    expected_types = {column[0]: str(column[1]) for column in cursor.description}
    expected_rows = cursor.fetchall()
    found_types = {field.name: field.dataType.simpleString() for field in frame.schema}
    if sorted(found_types) != sorted(expected_types):
        return f"columns {sorted(found_types)} against {sorted(expected_types)}"
    for name, kind in found_types.items():
        if TYPES.get(kind) != expected_types[name]:
            return f"type of {name}: {kind} against {expected_types[name]}"
    names = sorted(found_types)
    order = [list(expected_types).index(name) for name in names]
    expected = _sorted(tuple(row[i] for i in order) for row in expected_rows)
    found = _sorted(tuple(row) for row in frame.select(*names).collect())
    if len(found) != len(expected):
        return f"{len(found)} rows against {len(expected)}"
    for left, right in zip(found, expected):
        if left != right:
            return f"{left} against {right}"
    return None if expected else "both empty"
