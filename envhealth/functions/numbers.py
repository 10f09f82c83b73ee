from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..constants import RATE_PATTERN
from .columns import as_column

NUMBER = (
    r"^\s*[+-]?(?:[0-9]+\.?[0-9]*(?:[eE][+-]?[0-9]+)?|\.[0-9]+(?:[eE][+-]?[0-9]+)?"
    r"|(?i:inf|infinity|nan))\s*$"
)


def to_int(column: Column | str) -> Column:
    """Text to int; decimals are cut off ("2020.0" is 2020) and anything else is NULL."""
    c = as_column(column)
    whole = F.regexp_extract(c.cast("string"), r"^\s*([+-]?[0-9]+)\.[0-9]*\s*$", 1)
    return F.coalesce(c.try_cast("int"), whole.try_cast("int"))


def to_double(column: Column | str) -> Column:
    return as_column(column).try_cast("double")


def coerce_double(column: Column | str) -> Column:
    """Text to double, NULL for anything that is not a decimal number, infinity or NaN.

    The pattern keeps out what only Java reads as a number ("5d", "0x1p3"). It is also
    much cheaper than a failed cast, so use this where most of the text is not numeric.
    """
    c = as_column(column).cast("string")
    return F.when(c.rlike(NUMBER), c.try_cast("double"))


def parse_rate(column: Column | str) -> Column:
    """Double of a plain unsigned decimal; every other text is NULL. Apply before trimming."""
    c = as_column(column).cast("string")
    return F.when(c.rlike(RATE_PATTERN), c.try_cast("double"))


def nan_to_null(column: Column | str) -> Column:
    c = as_column(column)
    return F.when(~F.isnan(c), c)
