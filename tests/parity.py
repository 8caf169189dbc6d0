"""Compare a registered query with its oracle SQL, as exact rows."""

from __future__ import annotations

from decimal import Decimal

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels " \
         "conversations".split()


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{folder}/{table}.parquet')")
    return connection


def _plain(value):
    if isinstance(value, Decimal):
        return float(value)
    return value


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return [names[i] for i in order], sorted(plain, key=repr)


def compare(spark_df, connection, sql):
    """None when equal, else a short description."""
    got_names, got = _rows(spark_df.columns, [tuple(row) for row in spark_df.collect()])
    cursor = connection.execute(sql)
    want_names, want = _rows([column[0] for column in cursor.description], cursor.fetchall())
    if got_names != want_names:
        return f"columns {got_names} != {want_names}"
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)}"
    different = [(a, b) for a, b in zip(got, want) if a != b]
    if different:
        return f"{len(different)} of {len(got)} rows differ, first {different[0]}"
    return None if got else "no rows"
