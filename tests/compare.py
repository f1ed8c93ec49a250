"""Compare registered queries with their SQL on one scale; also runnable by hand.

    python -m tests.compare /root/testdata/sf0.01 [key ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import glob
import os
import sys
import time
from collections import Counter

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(glob.glob(f"{sf_dir}/*.parquet")):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"create view {name} as select * from '{path}'")
    return con


def plain(value):
    if isinstance(value, decimal.Decimal):
        return str(value)
    if isinstance(value, dt.datetime):
        return value.isoformat()
    return value


def rows_of(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(plain(row[i]) for i in order) for row in rows)


def difference(spark, con, name, build, sql, sf_dir, ordered=False) -> str | None:
    frame = build(spark, sf_dir)
    cursor = con.execute(sql)
    expected_columns = [d[0] for d in cursor.description]
    fetched = cursor.fetchall()
    expected = rows_of(expected_columns, fetched)
    if sorted(frame.columns) != sorted(expected_columns):
        return f"{name}: columns {sorted(frame.columns)} != {sorted(expected_columns)}"
    collected = frame.collect()
    actual = rows_of(frame.columns, collected)
    if actual != expected:
        extra, missing = actual - expected, expected - actual
        return (
            f"{name}: {sum(actual.values())} rows != {sum(expected.values())}; "
            f"only Spark {list(extra.items())[:2]}; only SQL {list(missing.items())[:2]}"
        )
    if ordered:
        own = [[plain(r[frame.columns.index(c)]) for c in expected_columns] for r in collected]
        if own != [[plain(x) for x in r] for r in fetched]:
            return f"{name}: rows in another order"
    return None if expected else f"{name}: no rows"


def main() -> int:
    from __spark_entry__ import oracle_sql, queries
    from amendry.session import local_session

    sf_dir, wanted = sys.argv[1], sys.argv[2:]
    spark, con = local_session("compare"), connect(sf_dir)
    spark.sparkContext.setLogLevel("ERROR")
    statements, failures = oracle_sql(), 0
    for name, build in queries().items():
        if name not in statements or wanted and name not in wanted:
            continue
        start = time.time()
        try:
            problem = difference(spark, con, name, build, statements[name], sf_dir)
        except Exception as error:  # keep going, report all
            problem = f"{name}: {type(error).__name__} {str(error)[:600]}"
        failures += problem is not None
        print(f"{time.time() - start:6.2f}s {'FAIL ' + problem if problem else 'ok   ' + name}", flush=True)
    print(f"{failures} failures")
    return failures


if __name__ == "__main__":
    sys.exit(bool(main()))
