"""Air-quality readings: envelope -> reading -> cleaned reading -> daily statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ..constants import ACCEPTED_STATUS, CORRUPT, PM25_HIGH, PM25_LOW
from ..functions import clean_text, once, to_day, to_double
from .quality import REASON, tag_rejects


def accept_status(envelopes: DataFrame, status: str = ACCEPTED_STATUS) -> DataFrame:
    return envelopes.where(F.col("status") == status)


def extract_readings(envelopes: DataFrame) -> DataFrame:
    """Pull the three used fields out of the nested envelope; missing ones are NULL."""
    return envelopes.select(
        F.col("data.time.s").alias("utc_datetime"),
        F.col("data.city.name").alias("city"),
        F.col("data.iaqi.pm25.v").alias("pm25_raw"),
    )


def normalize_readings(extracted: DataFrame) -> DataFrame:
    """Clean texts, numeric value and date; what does not parse is NULL.

    Texts are parsed once per row. A value that is a number already stays an ordinary
    column, so that its bounds can reach the scan.
    """
    value, date = to_double("pm25_raw"), to_day("utc_datetime")
    parse_value = isinstance(extracted.schema["pm25_raw"].dataType, StringType)
    return extracted.select(
        clean_text("utc_datetime").alias("utc_datetime"),
        clean_text("city").alias("city"),
        *([once(pm25=value, date=date)] if parse_value else [value.alias("pm25"), once(date=date)]),
    )


def filter_readings(
    readings: DataFrame, low: float = PM25_LOW, high: float = PM25_HIGH
) -> DataFrame:
    """Keep readings with a date, which implies a time, and a value in [low, high].

    A comparison with NULL is not true, and NaN is above every bound.
    """
    return readings.where(F.col("pm25").between(low, high) & F.col("date").isNotNull())


def clean_readings(extracted: DataFrame) -> DataFrame:
    return filter_readings(normalize_readings(extracted))


def judge_readings(
    envelopes: DataFrame, low: float = PM25_LOW, high: float = PM25_HIGH
) -> DataFrame:
    """Every landed envelope with its reading and, in `reject_reason`, why it is not valid.

    A row without a reason is a valid reading, whatever else in its record did not parse:
    the same rows that `clean_readings` keeps. A record that did not parse and gave no
    valid reading is `malformed`; the other reasons are `status`, `value`, `date` and `bounds`.
    """
    value, date = to_double("data.iaqi.pm25.v"), to_day("data.time.s")
    landed = [F.col(c) for c in envelopes.columns]
    rows = envelopes.select(*landed, once(_value=value, _date=date))
    accepted = F.col("status").eqNullSafe(ACCEPTED_STATUS)
    valid = accepted & F.col("_value").between(low, high) & F.col("_date").isNotNull()
    usable = F.coalesce(valid, F.lit(False))
    return tag_rejects(
        rows,
        {
            "status": accepted | F.col("status").isNull(),
            "malformed": usable | F.col(CORRUPT).isNull(),
            "none": accepted,
            "value": F.col("_value").isNotNull(),
            "date": F.col("_date").isNotNull(),
            "bounds": F.col("_value").between(low, high),
        },
    ).withColumnsRenamed({"_value": "pm25", "_date": "date"}).replace("none", "status", REASON)


def daily_stats(readings: DataFrame) -> DataFrame:
    """One row per date. The shuffle carries one partial row per task and date."""
    return readings.groupBy("date").agg(
        F.avg("pm25").alias("pm25"),
        F.count("pm25").alias("measurements_count"),
        F.min("pm25").alias("pm25_min"),
        F.max("pm25").alias("pm25_max"),
    )


def merge_daily(daily: DataFrame) -> DataFrame:
    """One row per date out of daily rows from several landings, weighted by their counts."""
    weight = F.col("measurements_count")
    return daily.groupBy("date").agg(
        F.try_divide(F.sum(F.col("pm25") * weight), F.sum(weight)).alias("pm25"),
        F.sum(weight).alias("measurements_count"),
        F.min("pm25_min").alias("pm25_min"),
        F.max("pm25_max").alias("pm25_max"),
    )
