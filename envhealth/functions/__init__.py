"""Column -> Column expressions. All of them are built-in JVM expressions, no UDFs."""

from .dates import as_date, on_day, partition_value, to_day, year_of
from .evaluate import once
from .numbers import coerce_double, nan_to_null, parse_rate, to_double, to_int
from .payload import has_elements, has_field, is_json, is_object_with, is_record_list
from .text import clean_text

__all__ = [
    "as_date",
    "clean_text",
    "coerce_double",
    "has_elements",
    "has_field",
    "is_json",
    "is_object_with",
    "is_record_list",
    "nan_to_null",
    "on_day",
    "once",
    "parse_rate",
    "partition_value",
    "to_day",
    "to_double",
    "to_int",
    "year_of",
]
