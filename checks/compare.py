"""Run registered queries and compare each with its SQL, as sorted rows.

    python -m checks.compare [sf_dir] [query ...]
"""

import datetime
import math
import sys
import time

import duckdb
from pyspark.sql import SparkSession

from checks.oracle import ORACLE
from checks.queries import QUERIES
from flowatlas.session import local_session

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return value


def _sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    picked = [tuple(_plain(row[i]) for i in order) for row in rows]
    return sorted(columns), sorted(picked, key=lambda r: [(v is not None, str(v)) for v in r])


def expected(sf_dir: str, name: str):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(
            f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')"
        )
    result = connection.execute(ORACLE[name])
    return _sorted_rows([c[0] for c in result.description], result.fetchall())


def actual(spark: SparkSession, sf_dir: str, name: str):
    df = QUERIES[name](spark, sf_dir)
    return _sorted_rows(df.columns, [tuple(row) for row in df.collect()])


def difference(spark: SparkSession, sf_dir: str, name: str) -> str | None:
    """None when the rows agree, else a description of the first difference."""
    columns, rows = actual(spark, sf_dir, name)
    want_columns, want_rows = expected(sf_dir, name)
    if columns != want_columns:
        return f"columns {columns}, expected {want_columns}"
    if len(rows) != len(want_rows):
        return f"{len(rows)} rows, expected {len(want_rows)}"
    for row, want in zip(rows, want_rows):
        if row != want:
            return f"row {row}, expected {want}"
    return None if rows else "no rows"


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    failed = 0
    for name in names:
        start = time.time()
        try:
            problem = difference(spark, sf_dir, name)
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        failed += problem is not None
        print(f"{name:32} {time.time() - start:6.1f}s  {problem or 'ok'}", flush=True)
    return failed


if __name__ == "__main__":
    sys.exit(main())
