"""Runs a registered query and its SQL on the same files and compares the rows."""

from __future__ import annotations

import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def _key(row):
    return tuple((value is None, str(type(value)), str(value)) for value in row)


def rows_of_spark(frame):
    names = sorted(frame.columns)
    return names, sorted((tuple(r[n] for n in names) for r in frame.collect()), key=_key)


def rows_of_sql(con, sql):
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    names = sorted(columns)
    places = [columns.index(n) for n in names]
    return names, sorted((tuple(r[i] for i in places) for r in result.fetchall()), key=_key)


def difference(spark_rows, sql_rows) -> str | None:
    names, left = spark_rows
    other, right = sql_rows
    if names != other:
        return f"columns {set(names) ^ set(other)}"
    if len(left) != len(right):
        return f"{len(left)} rows against {len(right)}; {left[:1]} {right[:1]}"
    bad = [(a, b) for a, b in zip(left, right) if a != b]
    if bad:
        a, b = bad[0]
        cells = [(n, x, y) for n, x, y in zip(names, a, b) if x != y]
        return f"{len(bad)} of {len(left)} rows differ, first in {cells}"
    return None


def main() -> None:
    from conftest import make_session

    sys.path.insert(0, ".")
    from __spark_entry__ import oracle_sql, queries

    folder, wanted = sys.argv[1], sys.argv[2:]
    spark = make_session()
    con = connect(folder)
    oracles = oracle_sql()
    failures = 0
    for name, run in queries().items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            found = rows_of_spark(run(spark, folder))
            took = time.time() - start
            problem = None
            if name in oracles:
                problem = difference(found, rows_of_sql(con, oracles[name]))
            note = problem or ("ok" if name in oracles else "ok (no SQL)")
        except Exception as error:  # noqa: BLE001 - report and go on
            took, note, problem = time.time() - start, f"{type(error).__name__}: {error}"[:1500], "x"
            found = ([], [])
        failures += problem is not None
        print(f"{name}: {len(found[1])} rows, {took:.2f}s, sql {time.time() - start - took:.2f}s, {note}", flush=True)
    print("failures", failures)


if __name__ == "__main__":
    main()
