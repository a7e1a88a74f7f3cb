"""Run registered queries against their DuckDB oracles and compare the rows."""

from __future__ import annotations

import math
import time
from pathlib import Path

import duckdb


def oracle_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return connection


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else f"{value:.9g}"
    if isinstance(value, bool) or value is None:
        return str(value)
    return str(value)


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_cell(row[i]) for i in order) for row in rows)


def mismatch(spark, connection, name, query, sql, sf_dir) -> str | None:
    """A description of the difference, None when the results agree."""
    frame = query(spark, sf_dir)
    found = _rows(frame.columns, [tuple(r) for r in frame.collect()])
    cursor = connection.execute(sql)
    names = [d[0] for d in cursor.description]
    wanted = _rows(names, cursor.fetchall())
    if sorted(names) != sorted(frame.columns):
        return f"{name}: columns {sorted(frame.columns)} vs {sorted(names)}"
    if len(found) != len(wanted):
        return f"{name}: {len(found)} rows vs {len(wanted)}"
    different = [(a, b) for a, b in zip(found, wanted) if a != b]
    if different:
        return f"{name}: {len(different)} of {len(found)} rows differ, first {different[0]} ({sorted(names)})"
    return None


def timed_check(spark, connection, name, query, sql, sf_dir):
    start = time.time()
    try:
        problem = mismatch(spark, connection, name, query, sql, sf_dir)
    except Exception as error:  # noqa: BLE001 - reported per query
        problem = f"{name}: {type(error).__name__}: {str(error)[:600]}"
    return problem, time.time() - start
