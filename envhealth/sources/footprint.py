"""Presence and size of inputs, from the file listing; file contents are not opened."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def footprint(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Number of files with content and their bytes, as one row; scans skip empty files."""
    listing = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    # A scan plans one task per large file; without contents many files fit in one.
    tasks = spark.sparkContext.defaultParallelism
    return listing.select("length").coalesce(tasks).agg(
        F.count(F.lit(1)).alias("files"),
        F.coalesce(F.sum("length"), F.lit(0)).alias("bytes"),
    )


def require_input(spark: SparkSession, path: str | list[str]) -> int:
    """Bytes of an input; a missing path or an input without bytes is an error."""
    try:
        row = footprint(spark, path).first()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        raise FileNotFoundError(f"input not found: {path}") from error
    if not row["bytes"]:
        raise ValueError(f"input is empty: {path}")
    return row["bytes"]
