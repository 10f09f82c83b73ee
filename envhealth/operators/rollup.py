"""Roll-up of daily statistics to years, and the join of years with indicators."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..constants import MIN_YEAR, YEAR, YEARS_AHEAD
from ..functions import as_date, year_of
from ..schemas import YEARLY

# A broadcast side may have at most this many rows; wider year windows join by shuffle.
MAX_BROADCAST_YEARS = 10_000


def yearly_stats(daily: DataFrame, drop_nan: bool = False) -> DataFrame:
    """Yearly figures of the daily rows.

    Every day weighs the same: the mean is a mean of daily means, minimum and maximum
    are those of daily means, and `pm25_measurements_count` counts days.
    """
    days = daily.withColumn(YEAR, year_of("date")).where(
        F.col(YEAR).isNotNull() & (F.col("pm25") >= 0)
    )
    if drop_nan:
        days = days.where(~F.isnan("pm25"))
    return days.groupBy(YEAR).agg(
        F.round(F.avg("pm25"), 2).alias("pm25_avg_yearly"),
        F.min("pm25").alias("pm25_min_yearly"),
        F.max("pm25").alias("pm25_max_yearly"),
        F.count("pm25").alias("pm25_measurements_count"),
        F.avg("measurements_count").alias("daily_measurements_avg"),
    )


def year_bounds(run_date: dt.date | str, min_year: int = MIN_YEAR) -> tuple[int, int]:
    return min_year, as_date(run_date).year + YEARS_AHEAD


def year_window(
    df: DataFrame, run_date: dt.date | str, min_year: int = MIN_YEAR
) -> DataFrame:
    return df.where(F.col(YEAR).between(*year_bounds(run_date, min_year)))


def combine(
    daily: DataFrame, indicators: DataFrame, run_date: dt.date | str, min_year: int = MIN_YEAR
) -> DataFrame:
    """Inner join of the yearly figures with every indicator row of the same year.

    The year window bounds the yearly side too: it cannot have more rows than the window
    has years, so the broadcast size is known before the job starts. The indicator side,
    however large or skewed to one year, is never shuffled.
    """
    return combine_years(yearly_stats(daily), indicators, run_date, min_year)


def combine_years(
    yearly: DataFrame, indicators: DataFrame, run_date: dt.date | str, min_year: int = MIN_YEAR
) -> DataFrame:
    """`combine` for yearly figures that are there already, one row a year."""
    first, last = year_bounds(run_date, min_year)
    yearly = year_window(yearly, run_date, min_year)
    if last - first + 1 <= MAX_BROADCAST_YEARS:
        yearly = F.broadcast(yearly)
    right = year_window(indicators, run_date, min_year)
    extra = [c for c in right.columns if c != YEAR]
    return yearly.join(right, YEAR, "inner").select(*YEARLY.names, *extra)
