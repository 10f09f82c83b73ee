"""Figures over all runs from what each run stored, without reading the earlier runs' rows."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..constants import YEAR
from ..functions import year_of
from ..operators import merge_daily, merge_moments, moments, moments_corr, moments_profile, yearly_stats
from ..schemas import YEARLY
from ..sinks import write_table
from ..sources import read_table

RUN, DAY = "run_date", "day"


def day_moments(daily: DataFrame, *by: str) -> DataFrame:
    """Moments by year of the days that count in the yearly figures, and of their day numbers."""
    days = daily.withColumn(YEAR, year_of("date")).where(F.col(YEAR).isNotNull() & (F.col("pm25") >= 0))
    return moments(days.withColumn(DAY, F.unix_date("date")).drop("date"), YEAR, *by, anchor=None)


def store_days(spark: SparkSession, daily: str, stored: str, run_date: dt.date | str) -> None:
    """Store the moments of the daily rows that the run of a date wrote, in place of its earlier ones."""
    write_table(day_moments(read_table(spark, daily, run_date).drop(RUN)), stored, run_date)


def store_rows(spark: SparkSession, table: str, stored: str, run_date: dt.date | str) -> None:
    """Store the moments of the rows that the run of a date wrote to any dated table."""
    write_table(moments(read_table(spark, table, run_date).drop(RUN)), stored, run_date)


def crossing_years(parts: DataFrame) -> list[int]:
    """Years in which the days of two runs may be the same: their ranges of days meet."""
    days = parts.where(F.col("column_name") == DAY)
    earlier = Window.partitionBy(YEAR).orderBy("low", RUN).rowsBetween(Window.unboundedPreceding, -1)
    met = days.withColumn("_high", F.max("high").over(earlier)).where(F.col("low") <= F.col("_high"))
    return sorted(r[YEAR] for r in met.select(YEAR).distinct().collect())


def history_years(
    spark: SparkSession, daily: str, stored: str, run_date: dt.date | str | None = None
) -> DataFrame:
    """The yearly figures of all daily rows up to a run date, from stored moments.

    Only years in which two runs may have written the same day, which must be merged by day
    first, are rolled up from their daily rows.
    """
    parts = read_table(spark, stored, run_date, up_to=True)
    crossing = crossing_years(parts)
    merged = merge_moments(parts.where(~F.col(YEAR).isin(crossing)), YEAR, order=RUN)

    def figure(column: str, field: str):
        return F.max(F.when(F.col("column_name") == column, F.col(field)))

    years = merged.groupBy(YEAR).agg(
        F.round(figure("pm25", "mean"), 2).alias("pm25_avg_yearly"),
        figure("pm25", "low").alias("pm25_min_yearly"),
        figure("pm25", "high").alias("pm25_max_yearly"),
        figure("pm25", "n").alias("pm25_measurements_count"),
        figure("measurements_count", "mean").alias("daily_measurements_avg"),
    )
    if crossing:
        rows = read_table(spark, daily, run_date, up_to=True)
        inside = rows.where(year_of("date").isin(crossing))
        years = years.unionByName(yearly_stats(merge_daily(inside.drop(RUN))))
    return years.select(*YEARLY.names)


def history_profile(spark: SparkSession, stored: str, run_date: dt.date | str | None = None) -> DataFrame:
    """Count, mean, deviation, minimum and maximum of each numeric column over all runs."""
    return moments_profile(merge_moments(read_table(spark, stored, run_date, up_to=True), order=RUN))


def history_corr(spark: SparkSession, stored: str, run_date: dt.date | str | None = None) -> DataFrame:
    """Correlation of the anchor with the other numeric columns over all runs."""
    return moments_corr(merge_moments(read_table(spark, stored, run_date, up_to=True), order=RUN))
