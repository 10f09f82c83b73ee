"""Partitioned Parquet tables and raw JSON landings."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import as_date, partition_value
from ..sources import read_table


def write_table(
    df: DataFrame,
    path: str,
    run_date: dt.date | str | int,
    column: str = "run_date",
    rebalance: bool = False,
) -> None:
    """Replace the partition of one run date, or year; the others stay.

    File sizes follow the tasks of the plan. `rebalance` adds a shuffle that evens them
    out, for plans that end in many small tasks.
    """
    dated = df.withColumn(column, F.lit(partition_value(run_date)))
    if rebalance:
        dated = dated.hint("rebalance")
    (
        dated.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(column)
        .parquet(path)
    )


def write_raw_json(
    df: DataFrame, path: str, run_date: dt.date | str, column: str = "date"
) -> None:
    """Land records as UTF-8 JSON lines, replacing what was landed for the date."""
    day = as_date(run_date).isoformat()
    df.write.mode("overwrite").option("encoding", "UTF-8").json(f"{path}/{column}={day}")


def audit(
    spark: SparkSession,
    path: str,
    expected: int,
    run_date: dt.date | str | int | None = None,
    column: str = "run_date",
) -> int:
    """Count what was written, from the Parquet footers, and fail on a difference."""
    found = read_table(spark, path, run_date, column).count()
    if found != expected:
        raise ValueError(f"{path}: expected {expected} rows, found {found}")
    return found
