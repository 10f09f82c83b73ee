from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from .columns import as_column
from .text import clean_text


def as_date(value: dt.date | str) -> dt.date:
    if isinstance(value, dt.datetime):
        return value.date()
    return value if isinstance(value, dt.date) else dt.date.fromisoformat(value)


def partition_value(value: dt.date | str | int) -> dt.date | int:
    """Value of a partition column: a date, or a year as a number."""
    return value if isinstance(value, int) else as_date(value)


def to_day(column: Column | str) -> Column:
    """Date of an ISO date or date-time text; NULL for any other text.

    The date is that of the cleaned text. Text that needs no cleaning, nearly all of it,
    is read as it is.
    """
    c = as_column(column)
    return F.coalesce(c.try_cast("date"), clean_text(c).try_cast("date"))


def year_of(column: Column | str) -> Column:
    return F.year(column)


def on_day(column: Column | str, day: dt.date | str) -> Column:
    """Rows of one calendar day, as a half-open range so that it reaches the scan."""
    day = as_date(day)
    c = as_column(column)
    return (c >= F.lit(day)) & (c < F.lit(day + dt.timedelta(days=1)))
