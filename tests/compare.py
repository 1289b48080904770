"""Run registered queries and their DuckDB statements side by side.

``python tests/compare.py [scale] [query ...]`` prints one line per query.
"""

from __future__ import annotations

import math
import os
import sys
import time
from collections import Counter

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def duckdb_connection(sf_dir: str):
    import duckdb

    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return connection


def _normal(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(f"{value:.9g}")
    return value


def rows_of(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_normal(row[i]) for i in order) for row in rows)


def difference(spark_df, connection, sql: str) -> str:
    """Empty when both results agree as bags of rows with the same column names."""
    result = connection.execute(sql)
    names = [d[0] for d in result.description]
    expected = rows_of(names, result.fetchall())
    if sorted(names) != sorted(spark_df.columns):
        return f"columns {sorted(spark_df.columns)} != {sorted(names)}"
    found = rows_of(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    if found == expected:
        return ""
    only_spark, only_duckdb = found - expected, expected - found
    return (
        f"{sum(only_spark.values())} rows only in Spark, e.g. {next(iter(only_spark), None)}; "
        f"{sum(only_duckdb.values())} only in DuckDB, e.g. {next(iter(only_duckdb), None)}"
    )


def main() -> int:
    import __spark_entry__ as driver
    from tests.conftest import make_session

    scale, names = (sys.argv[1] if len(sys.argv) > 1 else "sf0.01"), sys.argv[2:]
    sf_dir = f"/root/testdata/{scale}"
    spark, connection = make_session(), duckdb_connection(sf_dir)
    queries, statements = driver.queries(), driver.oracle_sql()
    failed = 0
    for name in names or queries:
        started = time.time()
        try:
            df = queries[name](spark, sf_dir)
            text = difference(df, connection, statements[name]) if name in statements else f"rows {df.count()}"
        except Exception as error:
            text = f"ERROR {str(error)[:800]}"
        failed += bool(text) and name in statements
        print(f"{name:28s} {time.time() - started:6.1f}s  {text or 'equal'}", flush=True)
    return failed


if __name__ == "__main__":
    sys.exit(main())
