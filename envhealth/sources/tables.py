"""Parquet tables of the lake and the published documents."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..functions import partition_value
from ..schemas import DOCUMENT, JSON_OPTIONS


def partition_path(path: str, value: dt.date | str | int, column: str = "run_date") -> str:
    return f"{path}/{column}={partition_value(value)}"


def read_table(
    spark: SparkSession,
    path: str,
    run_date: dt.date | str | int | None = None,
    column: str = "run_date",
    up_to: bool = False,
) -> DataFrame:
    """A partitioned table: all of it, one run date or year, or every run `up_to` it.

    One partition is read by its path, so a long history is not even listed; that it does
    not exist is an error. `up_to` is a predicate on the partition column, so files of
    later partitions are listed but not read.
    """
    if run_date is None:
        return spark.read.parquet(path)
    if up_to:
        return spark.read.parquet(path).where(F.col(column) <= F.lit(partition_value(run_date)))
    one = partition_path(path, run_date, column)
    return spark.read.option("basePath", path).parquet(one)


def read_positioned(spark: SparkSession, path: str, position: str = "_position") -> DataFrame:
    """A Parquet table with the position of each row: files in path order, rows in file order.

    No row is shuffled: the position is the row index that the scan knows plus the number
    of rows in earlier files. Those offsets are broadcast as 16 bytes per file, far less
    than the file listing that the driver holds for the scan anyway; paths are named by
    their hash, and two paths of one hash fail the read.
    """
    rows = spark.read.parquet(path)
    file = F.col("_metadata.file_path").alias("_file")
    name = F.xxhash64("_metadata.file_path").alias("_name")
    located = rows.select("*", name, F.col("_metadata.row_index").alias("_row"))
    sizes = rows.select(file).groupBy("_file").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
    offset = F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_offset")
    offsets = sizes.select(F.xxhash64("_file").alias("_name"), offset).groupBy("_name")
    clash = F.raise_error(F.lit("two files share a hash")).cast("bigint")
    offsets = offsets.agg(F.when(F.count(F.lit(1)) > 1, clash).otherwise(F.min("_offset")).alias("_offset"))
    return located.join(F.broadcast(offsets), "_name").select(
        *[F.col(f"`{c}`") for c in rows.columns],
        (F.col("_offset") + F.col("_row")).alias(position),
    )


def read_documents(
    spark: SparkSession, path: str, form: str = "parquet", extra: StructType | None = None
) -> DataFrame:
    """The published documents; JSON lines are read under the document schema plus `extra`."""
    if form == "parquet":
        return spark.read.parquet(path)
    if form != "json":
        raise ValueError(f"unknown document form: {form!r}")
    fields = [StructField("_id", StringType()), *DOCUMENT.fields, *(extra or StructType()).fields]
    return spark.read.schema(StructType(fields)).options(**JSON_OPTIONS).json(path)
