"""Run registered queries next to their SQL and compare rows: python -m checks.compare [dir] [name ...]"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str):
    import duckdb

    connection = duckdb.connect()
    for name in TABLES:
        path = f"{sf_dir}/{name}.parquet"
        if Path(path).exists():
            connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    return repr(value)


def rows_of(columns, rows) -> list[tuple[str, ...]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(row[i]) for i in order) for row in rows)


def difference(df, connection, sql: str) -> str | None:
    """None when the rows agree, otherwise a short description."""
    cursor = connection.execute(sql)
    names = [d[0] for d in cursor.description]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    expected = rows_of(names, cursor.fetchall())
    found = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if expected == found:
        return None
    off = [(a, b) for a, b in zip(found, expected) if a != b][:2]
    return f"rows {len(found)} / {len(expected)}; first differences {off}"


def main(sf_dir: str, names: list[str]) -> int:
    from pyspark.sql import SparkSession

    from checks.oracle import ORACLE
    from checks.queries import QUERIES

    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection, bad = connect(sf_dir), 0
    for name in names or QUERIES:
        start = time.time()
        if name not in ORACLE:
            print(f"rows  {name} {QUERIES[name](spark, sf_dir).count()}")
            continue
        try:
            problem = difference(QUERIES[name](spark, sf_dir), connection, ORACLE[name])
        except Exception as error:
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        bad += problem is not None
        print(f"{'BAD ' if problem else 'ok  '}  {name} {time.time() - start:.2f}s {problem or ''}", flush=True)
    print(f"{bad} differ")
    return bad


if __name__ == "__main__":
    arguments = sys.argv[1:]
    directory = arguments[0] if arguments else "/root/testdata/sf0.01"
    sys.exit(min(main(directory, arguments[1:]), 1))
