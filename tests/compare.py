"""Compares registered queries with their SQL on the same tables.

Run ``python -m tests.compare FOLDER [name ...]`` for a report with timings.
"""

from __future__ import annotations

import math
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


def _normal(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6) + 0.0
    return value


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_normal(r[i]) for i in order) for r in rows]
    return sorted(columns), sorted(out, key=lambda r: tuple((v is None, str(type(v)), str(v)) for v in r))


def differences(df, con, sql: str, limit: int = 3) -> list[str]:
    """Empty when columns, types of values and values agree."""
    left_columns, left = _rows(df.columns, [tuple(r) for r in df.collect()])
    result = con.execute(sql)
    right_columns, right = _rows([d[0] for d in result.description], result.fetchall())
    if left_columns != right_columns:
        return [f"columns {left_columns} / {right_columns}"]
    if len(left) != len(right):
        return [f"rows {len(left)} / {len(right)}"]
    found = []
    for a, b in zip(left, right):
        for name, x, y in zip(left_columns, a, b):
            same = x == y and type(x) is type(y)
            if not same:
                found.append(f"{name}: {x!r} / {y!r} in {a} / {b}")
                break
    return found[:limit] + ([f"{len(found)} rows differ"] if found else [])


def main() -> int:
    from ebbtide.queries import registry
    from ebbtide.session import build_session

    folder, names = sys.argv[1], sys.argv[2:]
    spark = build_session("compare", "local[8]", 8, {"spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("OFF")
    queries, sql = registry()
    con = connect(folder)
    failed = 0
    for name in names or queries:
        start = time.time()
        try:
            df = queries[name](spark, folder)
            if name in sql:
                found = differences(df, con, sql[name])
                state = "equal" if not found else "DIFFERENT"
            else:
                found, state = [], f"rows only ({df.count()})"
        except Exception as error:  # report and go on with the next query
            found, state = [str(error)[:1500]], "ERROR"
        failed += bool(found)
        print(f"{name:28s} {state} {time.time() - start:.1f}s", flush=True)
        for line in found:
            print("    " + line[:600])
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
