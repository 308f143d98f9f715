"""Comparing a Spark result with the result of its SQL in DuckDB, and a command line for it."""

from __future__ import annotations

import math
import sys
import time
from datetime import date, datetime
from decimal import Decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return connection


def _plain(value):
    """One form per value and kind, so that 1, 1.0 and Decimal('1.0') stay apart."""
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return ("null", "")
    if isinstance(value, bool):
        return ("bool", str(value))
    if isinstance(value, int):
        return ("int", str(value))
    if isinstance(value, float):
        return ("float", repr(value + 0.0))
    if isinstance(value, Decimal):
        return ("decimal", str(value))
    if isinstance(value, (date, datetime)):
        return ("time", value.isoformat())
    return ("text", str(value))


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda place: columns[place])
    return [columns[place] for place in order], sorted(tuple(_plain(row[place]) for place in order) for row in rows)


def difference(df, connection, sql: str) -> str | None:
    """What differs between a frame and a SQL result; None when nothing does."""
    made = df.collect()
    relation = connection.execute(sql)
    want_columns = [entry[0] for entry in relation.description]
    columns, got = rows_of(df.columns, made)
    expected_columns, expected = rows_of(want_columns, relation.fetchall())
    if columns != expected_columns:
        return f"columns {columns} instead of {expected_columns}"
    if len(got) != len(expected):
        return f"{len(got)} rows instead of {len(expected)}"
    for one, other in zip(got, expected):
        if one != other:
            differing = [(c, a, b) for c, a, b in zip(columns, one, other) if a != b]
            return f"(column, found, expected): {differing[:4]}"
    return None


def main() -> int:
    """compare.py FOLDER [NAME ...]: compare all or the named queries."""
    sys.path.insert(0, ".")
    import __spark_entry__ as entry
    from tidemark.session import local_session

    folder, names = sys.argv[1], sys.argv[2:]
    spark = local_session()
    connection = connect(folder)
    oracles, failed = entry.oracle_sql(), 0
    for name, run in entry.queries().items():
        if names and name not in names:
            continue
        begun = time.monotonic()
        try:
            df = run(spark, folder)
            found = difference(df, connection, oracles[name])
            rows = df.count()
        except Exception as problem:  # noqa: BLE001
            found, rows = f"{type(problem).__name__}: {str(problem)[:600]}", -1
        failed += found is not None
        print(f"{'ok  ' if found is None else 'FAIL'} {name} {rows} rows {time.monotonic() - begun:.1f}s {found or ''}", flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(min(main(), 1))
