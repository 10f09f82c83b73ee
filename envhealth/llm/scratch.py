"""Intermediate tables in the shared folder, so that lost executors cost only their own tasks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..checkpoints import scratch_path

BATCH_BYTES = 4 << 20


def saved(df: DataFrame, name: str) -> DataFrame:
    """`df` written as Parquet to the shared folder and read back: computed once, lineage cut."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_batches(spark: SparkSession, size: int = BATCH_BYTES) -> None:
    """From now on rows come to Python in batches of about `size` bytes, however long texts are."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(size))


def shuffle_tasks(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def free_name(df: DataFrame, name: str) -> str:
    """`name`, with underscores added until `df` has no column of that name."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name
