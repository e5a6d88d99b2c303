"""Run registered queries and their SQL side by side and compare all values.

``python tests/oracle_check.py [data directory] [query ...]``
"""

from __future__ import annotations

import math
import sys
import time
from datetime import date, datetime
from decimal import Decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(directory: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    connection.execute("set timezone = 'UTC'")
    for name in TABLES:
        connection.execute(f"create view {name} as select * from '{directory}/{name}.parquet'")
    return connection


def _value(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, float):
        return "nan" if math.isnan(v) else v + 0.0
    if isinstance(v, Decimal):
        return float(v)
    if isinstance(v, datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, date):
        return v.isoformat()
    return v


def normalized(columns: list[str], rows: list) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_value(row[i]) for i in order) for row in rows), key=lambda r: tuple((x is None, str(type(x)), x if x is not None else 0) for x in r))


def compare(spark, run, sql: str, connection, directory: str) -> str | None:
    """None when equal, else what differs."""
    frame = run(spark, directory)
    mine = normalized(frame.columns, frame.collect())
    cursor = connection.execute(sql)
    names = [c[0] for c in cursor.description]
    theirs = normalized(names, cursor.fetchall())
    if sorted(frame.columns) != sorted(names):
        return f"columns {sorted(frame.columns)} against {sorted(names)}"
    if len(mine) != len(theirs):
        return f"rows {len(mine)} against {len(theirs)}"
    different = [(a, b) for a, b in zip(mine, theirs) if a != b]
    if different:
        return f"{len(different)} of {len(mine)} rows differ, such as {different[0][0]} against {different[0][1]}"
    if not mine:
        return "no rows"
    return None


def main() -> int:
    sys.path.insert(0, __file__.rsplit("/", 2)[0])
    from __spark_entry__ import oracle_sql, queries
    from sediment.session import build_session, release_scratch

    directory = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    spark = build_session("check", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "12g"})
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(directory)
    oracle, failed = oracle_sql(), 0
    for name, run in queries().items():
        if wanted and name not in wanted:
            continue
        started = time.time()
        try:
            if name in oracle:
                problem = compare(spark, run, oracle[name], connection, directory)
            else:
                problem = None if run(spark, directory).count() else "no rows"
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        release_scratch(spark)
        failed += problem is not None
        print(f"{'FAIL' if problem else 'ok  '} {time.time() - started:6.1f}s {name} {problem or ''}", flush=True)
    print(f"{failed} failed")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
