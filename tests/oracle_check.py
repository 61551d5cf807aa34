"""Compare registered queries with their SQL on the tables of one folder."""

from __future__ import annotations

from collections import Counter
from pathlib import Path

import duckdb


def open_oracle(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return connection


def differences(spark_rows, oracle_rows, columns: list[str], oracle_columns: list[str]) -> list:
    """Rows that only one side has, with columns ordered by name."""
    if sorted(columns) != sorted(oracle_columns):
        return [("columns", sorted(columns), sorted(oracle_columns))]
    order = [columns.index(name) for name in sorted(columns)]
    oracle_order = [oracle_columns.index(name) for name in sorted(columns)]
    ours = Counter(tuple(row[i] for i in order) for row in spark_rows)
    theirs = Counter(tuple(row[i] for i in oracle_order) for row in oracle_rows)
    return [*((ours - theirs).items()), *((theirs - ours).items())]
