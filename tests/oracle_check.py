"""Run queries and their SQL side by side: ``python tests/oracle_check.py [sf_dir] [name ...]``."""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as contract  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return connection


# Spark type name -> DuckDB type name
TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "date": "DATE",
}


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    return str(value)


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_plain(row[i]) for i in order) for row in rows)


def compare(spark, connection, name: str, sf_dir: str) -> str | None:
    """None if both sides agree in columns, row count and values, else what differs."""
    frame = contract.queries()[name](spark, sf_dir)
    got = [tuple(row) for row in frame.collect()]
    sql = contract.oracle_sql().get(name)
    if sql is None:
        return None if got else "no rows"
    cursor = connection.execute(sql)
    columns = [d[0] for d in cursor.description]
    want = cursor.fetchall()
    if sorted(columns) != sorted(frame.columns):
        return f"columns {sorted(frame.columns)} != {sorted(columns)}"
    expected = {d[0]: str(d[1]) for d in cursor.description}
    other = [(c, t, expected[c]) for c, t in frame.dtypes if TYPES.get(t) != expected[c]]
    if other:
        return f"types {other}"
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)}"
    left, right = _rows(frame.columns, got), _rows(columns, want)
    if left != right:
        pairs = [(a, b) for a, b in zip(left, right) if a != b]
        return f"{len(pairs)} of {len(left)} rows differ, first {pairs[0]}"
    return None if got else "no rows"


def main() -> int:
    from epigauge.session import build_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(contract.queries())
    spark = build_session(
        "oracle-check",
        **{"spark.master": "local[8]", "spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(sf_dir)
    failed = 0
    for name in names:
        start = time.time()
        try:
            problem = compare(spark, connection, name, sf_dir)
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        failed += problem is not None
        kind = "sql " if name in contract.oracle_sql() else "rows"
        print(f"{'ok  ' if problem is None else 'FAIL'} {kind} {time.time() - start:6.2f}s {name} {problem or ''}", flush=True)
    print(f"{len(names) - failed} of {len(names)} agree")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
