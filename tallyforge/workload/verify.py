"""Compare registered queries with their SQL: python -m tallyforge.workload.verify FOLDER [NAME ...]"""

from __future__ import annotations

import math
import sys
import time

from tallyforge.session import scratch
from tallyforge.workload import load_queries
from tallyforge.workload.registry import Query
from tallyforge.workload.standins import BASE_TABLES

# Types that hold the same values in both engines.
SAME_TYPE = {
    "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN",
    "date": "DATE", "float": "FLOAT", "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP",
}


def connect(folder: str):
    import duckdb

    connection = duckdb.connect()
    for table in BASE_TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return connection


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    return str(value)


def differences(spark, connection, folder: str, query: Query) -> list[str]:
    """What differs between a query and its SQL; empty when they agree."""
    with scratch(spark):
        df = query.run(spark, folder)
        rows = df.collect()
    if query.sql is None:
        return [] if rows else ["no rows"]
    cursor = connection.execute(query.sql)
    theirs = {d[0]: str(d[1]) for d in cursor.description}
    their_rows = cursor.fetchall()
    problems = []
    ours = dict(df.dtypes)
    if sorted(ours) != sorted(theirs):
        return [f"columns {sorted(ours)} != {sorted(theirs)}"]
    for name, kind in ours.items():
        if SAME_TYPE.get(kind) != theirs[name]:
            problems.append(f"type of {name}: {kind} != {theirs[name]}")
    names = sorted(ours)
    positions = [list(theirs).index(n) for n in names]
    left = sorted(tuple(_plain(row[n]) for n in names) for row in rows)
    right = sorted(tuple(_plain(row[p]) for p in positions) for row in their_rows)
    if left != right:
        missing = sorted(set(right) - set(left))[:2]
        extra = sorted(set(left) - set(right))[:2]
        problems.append(f"{len(left)} rows != {len(right)} rows or values; only ours {extra}; only SQL {missing}")
    if not left:
        problems.append("no rows")
    return problems


def main(folder: str, *names: str) -> int:
    from tallyforge.session import build_session

    spark = build_session("verify", cores=8)
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(folder)
    failed = 0
    for name, query in load_queries().items():
        if names and not any(name.startswith(n) for n in names):
            continue
        started = time.time()
        try:
            problems = differences(spark, connection, folder, query)
        except Exception as error:  # report and go on with the next query
            problems = [f"{type(error).__name__}: {str(error)[:600]}"]
        failed += bool(problems)
        verdict = "FAIL" if problems else ("ok" if query.sql else "ok (rows only)")
        print(f"{verdict:15} {name:40} {time.time() - started:6.2f}s", *problems, sep="  ", flush=True)
    print("failed:", failed)
    return failed


if __name__ == "__main__":
    sys.exit(1 if main(*sys.argv[1:]) else 0)
