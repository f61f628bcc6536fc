"""Compare every registered query with its SQL twin, run by DuckDB.

    python tests/oracle_check.py [--exact] [folder] [query ...]

With ``--exact`` values and types must be identical.
"""

from __future__ import annotations

import datetime
import decimal
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def duck(folder: str):
    import duckdb

    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{folder}/{table}.parquet')")
    return con


EXACT = "--exact" in sys.argv


def plain(value):
    """A comparable form: floats to 9 significant digits, times as text."""
    if EXACT:
        return repr(value)
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, (int, float)):
        return "nan" if math.isnan(value) else float(f"{value:.9g}")
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat(sep=" ")
    return str(value)


def rows_of(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(row[i]) for i in order) for row in rows), key=repr)


def difference(name: str, spark_frame, con, sql: str) -> str | None:
    """None when both sides agree, else what differs."""
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    expected = rows_of(names, cursor.fetchall())
    if sorted(names) != sorted(spark_frame.columns):
        return f"columns {sorted(spark_frame.columns)} != {sorted(names)}"
    got = rows_of(spark_frame.columns, [tuple(r) for r in spark_frame.collect()])
    if len(got) != len(expected):
        return f"{len(got)} rows, expected {len(expected)}"
    for mine, other in zip(got, expected):
        if mine != other:
            return f"{mine} != {other}"
    return None


def main() -> None:
    import __spark_entry__ as entry
    from campanile.session import build_session

    args = [a for a in sys.argv[1:] if a != "--exact"]
    folder = args[0] if args else "/root/testdata/sf0.01"
    spark = build_session(master="local[8]", spark__ui__enabled="false", spark__sql__shuffle__partitions="8",
                          spark__ui__showConsoleProgress="false", spark__driver__memory="8g")
    spark.sparkContext.setLogLevel("ERROR")
    con, queries, sql = duck(folder), entry.queries(), entry.oracle_sql()
    failed = 0
    for name in args[1:] or queries:
        start = time.time()
        try:
            found = difference(name, queries[name](spark, folder), con, sql[name]) if name in sql else "no SQL"
        except Exception as error:  # keep going, report all
            found = f"error {str(error)[:500]}"
        failed += found is not None
        print(f"{name:36s} {time.time() - start:6.2f}s {'ok' if found is None else found}", flush=True)
    print(f"{failed} of {len(queries)} differ; without SQL: {sorted(set(queries) - set(sql))}")


if __name__ == "__main__":
    main()
