"""Compare every named query with its SQL, the way the driver does: names, rows, values."""

from __future__ import annotations

import datetime
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float) and value == int(value):
        return value
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None)
    return value


def normal_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(
        (tuple(_plain(r[i]) for i in order) for r in rows), key=lambda r: tuple(map(repr, r))
    )


def compare(spark, con, folder: str, name: str, function, sql: str) -> str | None:
    """None when equal, else a description of the first difference."""
    df = function(spark, folder)
    got = normal_rows(df.columns, [tuple(r) for r in df.collect()])
    result = con.execute(sql)
    expected = normal_rows([d[0] for d in result.description], result.fetchall())
    if got[0] != expected[0]:
        return f"columns {got[0]} != {expected[0]}"
    if len(got[1]) != len(expected[1]):
        return f"{len(got[1])} rows != {len(expected[1])}"
    for g, e in zip(got[1], expected[1]):
        if g != e or [type(x) for x in g] != [type(x) for x in e]:
            return f"spark {str(g)[:400]}\n  sql   {str(e)[:400]}"
    return None


if __name__ == "__main__":
    sys.path.insert(0, ".")
    from promptmill.queries import ORACLE, QUERIES
    from promptmill.session import local_session

    folder = f"/root/testdata/sf{sys.argv[1]}"
    spark = local_session(8)
    con = connect(folder)
    for name in sys.argv[2:] or QUERIES:
        start = time.time()
        try:
            difference = compare(spark, con, folder, name, QUERIES[name], ORACLE[name])
        except Exception as error:  # report and go on with the next query
            difference = f"{type(error).__name__}: {str(error)[:600]}"
        print(f"{'ok  ' if difference is None else 'DIFF'} {name} {time.time() - start:.1f}s", flush=True)
        if difference:
            print("  " + difference, flush=True)
