"""Run queries in Spark and their SQL in DuckDB and compare the results value by value.

    python tests/compare.py [scale folder name] [query ...]
"""

from __future__ import annotations

import math
import sys
import time
from collections import Counter
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TESTDATA = "/root/testdata"
SF = f"{TESTDATA}/sf0.001"  # the scale of the tests
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        if math.isnan(value):
            return "NaN"
        return value + 0.0
    return value


def normal(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def compare(spark_df, con, sql: str) -> str | None:
    """None if equal, otherwise what differs."""
    cursor = con.execute(sql)
    expected_columns = [d[0] for d in cursor.description]
    expected = cursor.fetchall()
    if sorted(spark_df.columns) != sorted(expected_columns):
        return f"columns {sorted(spark_df.columns)} != {sorted(expected_columns)}"
    got = [tuple(r) for r in spark_df.collect()]
    left, right = normal(spark_df.columns, got), normal(expected_columns, expected)
    if left == right:
        # equal values may still differ in type: 1 == 1.0 == True
        kinds_left = {tuple(type(v).__name__ for v in row) for row in left}
        kinds_right = {tuple(type(v).__name__ for v in row) for row in right}
        return None if kinds_left == kinds_right else f"types {kinds_left ^ kinds_right}"
    only_left, only_right = left - right, right - left
    return (
        f"{len(got)} vs {len(expected)} rows; {sum(only_left.values())} only in Spark, e.g. "
        f"{list(only_left)[:2]}; {sum(only_right.values())} only in SQL, e.g. {list(only_right)[:2]}"
    )


def main() -> int:
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    sf = sys.argv[1] if len(sys.argv) > 1 else "sf0.01"
    wanted = sys.argv[2:]
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(f"{TESTDATA}/{sf}")
    sqls = entry.oracle_sql()
    failures = 0
    for name, query in entry.queries().items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            df = query(spark, f"{TESTDATA}/{sf}")
            problem = compare(df, con, sqls[name]) if name in sqls else None
            if name not in sqls:
                print(f"      {name} has no SQL, {df.count()} rows")
        except Exception as e:  # report and go on with the next query
            problem = f"{type(e).__name__}: {str(e)[:1500]}"
        failures += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} {time.time() - start:.1f}s {problem or ''}", flush=True)
    print(f"{failures} failures")
    return failures


if __name__ == "__main__":
    sys.exit(main() > 0)
