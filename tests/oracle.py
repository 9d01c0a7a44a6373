"""Compare registered queries with their SQL twins in DuckDB.

    python -m tests.oracle [sf_dir] [name ...]
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

from reviewlake.schemas import TABLES


def connect(base: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        path = Path(base) / f"{name}.parquet"
        if path.exists():
            connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return connection


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(f"{value:.9g}") + 0.0
    if isinstance(value, (list, tuple)):
        return tuple(_plain(item) for item in value)
    if isinstance(value, dict):
        return tuple((key, _plain(item)) for key, item in value.items())
    return value


def _rows(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda at: columns[at])
    return sorted((tuple(_plain(row[at]) for at in order) for row in rows), key=repr)


def compare(spark, connection, base: str, query, sql: str) -> str | None:
    """None when equal, else what differs."""
    df = query(spark, base)
    got_columns = df.columns
    got = _rows(got_columns, [tuple(row) for row in df.collect()])
    cursor = connection.execute(sql)
    want_columns = [column[0] for column in cursor.description]
    want = _rows(want_columns, cursor.fetchall())
    if sorted(got_columns) != sorted(want_columns):
        return f"columns {sorted(got_columns)} != {sorted(want_columns)}"
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)} rows; {got[:2]} vs {want[:2]}"
    bad = [(a, b) for a, b in zip(got, want) if a != b]
    if bad:
        return f"{len(bad)} of {len(got)} rows differ ({sorted(got_columns)}):\n   {bad[0][0]}\n   {bad[0][1]}"
    types = {name: type(value).__name__ for row in got[:1] for name, value in zip(sorted(got_columns), row)}
    wanted = {name: type(value).__name__ for row in want[:1] for name, value in zip(sorted(want_columns), row)}
    return None if types == wanted else f"types {types} != {wanted}"


def main() -> int:
    import __spark_entry__ as entry
    from reviewlake import build_session
    args = sys.argv[1:]
    base = args[0] if args else "/root/testdata/sf0.01"
    spark = build_session("oracle", "local[8]", spark__sql__shuffle__partitions=8,
                          spark__ui__showConsoleProgress="false")
    spark.sparkContext.setLogLevel("ERROR")
    queries, sql = entry.queries(), entry.oracle_sql()
    names = [name for name in queries if not args[1:] or any(name.startswith(part) for part in args[1:])]
    connection = connect(base)
    failed = 0
    for name in names:
        started = time.monotonic()
        try:
            if name in sql:
                problem = compare(spark, connection, base, queries[name], sql[name])
            else:
                rows = queries[name](spark, base).collect()
                problem = None if rows else "no rows"
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        failed += problem is not None
        kind = "sql " if name in sql else "rows"
        print(f"{'ok  ' if problem is None else 'FAIL'} {kind} {time.monotonic() - started:6.2f}s {name}"
              + (f"\n   {problem}" if problem else ""), flush=True)
    print(f"{len(names) - failed} of {len(names)} equal")
    return failed


if __name__ == "__main__":
    sys.exit(bool(main()))
