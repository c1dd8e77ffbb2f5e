"""Run registered queries next to their SQL twins and report differences.

    python tests/check_queries.py [folder] [name …]
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as entry  # noqa: E402
from rankflow.session import local_session  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return connection


def canonical(rows, names):
    """Rows as sorted tuples in column-name order, doubles at 12 digits."""
    order = sorted(range(len(names)), key=lambda i: names[i])

    def cell(value):
        if isinstance(value, float):
            return "nan" if math.isnan(value) else f"{value + 0.0:.12g}"
        return str(value)

    return sorted(names), sorted(tuple(cell(row[i]) for i in order) for row in rows)


def compare(spark, connection, folder: str, name: str) -> str:
    frame = entry.queries()[name](spark, folder)
    ours = canonical([tuple(r) for r in frame.collect()], frame.columns)
    sql = entry.oracle_sql().get(name)
    if sql is None:
        return f"rows-only {len(ours[1])}"
    cursor = connection.execute(sql)
    names = [column[0] for column in cursor.description]
    theirs = canonical(cursor.fetchall(), names)
    if ours == theirs:
        return f"ok {len(ours[1])} rows"
    if ours[0] != theirs[0]:
        return f"DIFF columns {ours[0]} {theirs[0]}"
    left = [r for r in ours[1] if r not in set(theirs[1])][:2]
    right = [r for r in theirs[1] if r not in set(ours[1])][:2]
    return f"DIFF rows {len(ours[1])} {len(theirs[1])} spark {left} sql {right}"


def main() -> None:
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(entry.queries())
    spark = local_session("check", os.environ.get("TEST_CPUS", "8"))
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(folder)
    bad = 0
    for name in names:
        start = time.time()
        try:
            verdict = compare(spark, connection, folder, name)
        except Exception as problem:  # noqa: BLE001 - report and go on
            verdict = f"FAIL {type(problem).__name__}: {str(problem)[:600]}"
        bad += not verdict.startswith(("ok", "rows-only"))
        print(f"{name:32s} {time.time() - start:6.2f}s  {verdict}", flush=True)
    print(f"{len(names) - bad} of {len(names)} fine")
    spark.stop()


if __name__ == "__main__":
    main()
