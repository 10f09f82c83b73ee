"""Key sets, coverage and previews."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..constants import YEAR


def distinct_keys(df: DataFrame, key: str = YEAR) -> DataFrame:
    return df.select(key).where(F.col(key).isNotNull()).distinct()


def common_keys(left: DataFrame, right: DataFrame, key: str = YEAR) -> DataFrame:
    """Keys present on both sides. Each side is made distinct first: `intersect` alone
    would shuffle every row of both sides on the key."""
    return distinct_keys(left, key).intersect(distinct_keys(right, key))


def coverage(df: DataFrame, key: str = YEAR) -> DataFrame:
    """Range, row count and number of distinct keys, through one row per key."""
    per_key = df.groupBy(key).agg(F.count(key).alias("_rows"))
    return per_key.agg(
        F.min(key).alias(f"min_{key}"),
        F.max(key).alias(f"max_{key}"),
        F.coalesce(F.sum("_rows"), F.lit(0)).alias(f"{key}_count"),
        F.count(key).alias(f"distinct_{key}s"),
    )


def metric_stats(df: DataFrame, metric: str) -> DataFrame:
    return df.agg(
        F.avg(metric).alias("overall_avg"),
        F.min(metric).alias("overall_min"),
        F.max(metric).alias("overall_max"),
    )


def sorted_preview(df: DataFrame, *keys: str, n: int = 10) -> DataFrame:
    """First n rows by `keys`; the other columns break ties, so the rows are fixed."""
    return df.orderBy(*keys, *[c for c in df.columns if c not in keys]).limit(n)
