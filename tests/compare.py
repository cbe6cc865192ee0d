"""Run a query and its SQL on the same tables and compare rows without regard to order."""

from __future__ import annotations

import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def oracle(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"create view {name} as select * from '{folder}/{name}.parquet'")
    return connection


def difference(df, connection, sql: str) -> str | None:
    """None when both agree, else what differs first."""
    result = connection.execute(sql)
    names = [column[0] for column in result.description]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    wanted = sorted((repr(tuple(row[names.index(c)] for c in sorted(names))) for row in result.fetchall()))
    found = sorted(repr(tuple(row[c] for c in sorted(names))) for row in df.collect())
    if len(found) != len(wanted):
        return f"{len(found)} rows != {len(wanted)}"
    for a, b in zip(found, wanted):
        if a != b:
            return f"{a}\n  != {b}"
    return None if found or wanted else "no rows"


if __name__ == "__main__":
    from folioflow.catalog import ORACLE, QUERIES
    from folioflow.session import local_session

    folder, only = sys.argv[1], [a for a in sys.argv[2:] if not a.startswith("-")]
    session, connection = local_session("8"), oracle(folder)
    for name in only or QUERIES:
        started = time.time()
        if name in ORACLE and "--time" in sys.argv:
            try:
                connection.execute(ORACLE[name]).fetchall()
                print(f"{'  sql':32s} {time.time() - started:6.1f}s")
            except Exception as error:  # noqa: BLE001
                print(str(error)[:500])
            started = time.time()
            QUERIES[name](session, folder).write.format("noop").mode("overwrite").save()
            print(f"{'  spark':32s} {time.time() - started:6.1f}s")
            started = time.time()
        try:
            problem = difference(QUERIES[name](session, folder), connection, ORACLE[name]) if name in ORACLE else "no SQL"
        except Exception as error:  # noqa: BLE001 - a report of all queries
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        print(f"{name:32s} {time.time() - started:6.1f}s {problem or 'ok'}", flush=True)
