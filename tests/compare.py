"""Runs a registered query and its SQL twin and compares rows, columns and types."""

from __future__ import annotations

import argparse
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from vocabweave.plans.all_queries import ORACLES, QUERIES  # noqa: E402
from vocabweave.plans.catalog import TABLES  # noqa: E402

DATA = "/root/testdata/sf0.01"


def duck(folder: str = DATA) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return connection


def _key(row: tuple) -> tuple:
    return tuple((value is None, str(value)) for value in row)


def _sorted(columns: list[str], rows: list[tuple]) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted((tuple(row[i] for i in order) for row in rows), key=_key)


KINDS = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN"}


def compare(spark, connection, name: str, folder: str = DATA) -> str:
    """Empty when both agree, else what differs."""
    frame = QUERIES[name](spark, folder)
    columns, rows = _sorted(frame.columns, [tuple(row) for row in frame.collect()])
    if name not in ORACLES:
        return "" if rows else "no rows"
    result = connection.execute(ORACLES[name])
    kinds = {d[0]: str(d[1]) for d in result.description}
    other_columns, other = _sorted([d[0] for d in result.description], result.fetchall())
    if columns != other_columns:
        return f"columns {columns} and {other_columns}"
    wrong = {c: (k, kinds[c]) for c, k in frame.dtypes if KINDS.get(k, k) not in (kinds[c], {"NUMBER": "BIGINT", "STRING": "VARCHAR"}.get(kinds[c]))}
    if len(rows) != len(other):
        return f"{len(rows)} and {len(other)} rows; first {rows[:2]} {other[:2]}; kinds {wrong}"
    bad = [(a, b) for a, b in zip(rows, other) if a != b]
    if bad:
        return f"{len(bad)} of {len(rows)} rows differ, such as {bad[0]}; kinds {wrong}"
    if not rows:
        return "no rows"
    return f"kinds {wrong}" if wrong else ""


if __name__ == "__main__":
    from vocabweave.session import local_session

    parser = argparse.ArgumentParser()
    parser.add_argument("names", nargs="*")
    parser.add_argument("--folder", default=DATA)
    options = parser.parse_args()
    session, con = local_session("8"), duck(options.folder)
    for query_name in options.names or list(QUERIES):
        start = time.time()
        try:
            problem = compare(session, con, query_name, options.folder)
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:300]}"
        print(f"{query_name:28s} {time.time() - start:6.1f}s {problem or 'ok'}", flush=True)
