from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def is_json(column: Column | str) -> Column:
    """True when the text is one JSON value of any size; false for broken or missing text.

    A key may occur twice. The text is read as the only element of an array and as the
    only field of an object, without building it: what follows a first value could only
    continue one of the two.
    """
    text = F.col(column) if isinstance(column, str) else column
    element = F.json_array_length(F.concat(F.lit("["), text, F.lit("]")))
    field = F.json_object_keys(F.concat(F.lit('{"":'), text, F.lit("}")))
    return F.coalesce((element == 1) & field.isNotNull(), F.lit(False))


def has_field(column: Column | str, field: str) -> Column:
    """Whether a JSON object has `field`, even when its value is null; else false."""
    return F.coalesce(F.array_contains(F.json_object_keys(column), field), F.lit(False))


def has_elements(column: Column | str) -> Column:
    """Whether a JSON array has an element; else false."""
    return F.coalesce(F.json_array_length(column) > 0, F.lit(False))


def is_object_with(column: Column | str, field: str) -> Column:
    """True for a well-formed JSON object that has `field`, even when its value is null."""
    return is_json(column) & has_field(column, field)


def is_record_list(column: Column | str) -> Column:
    """True for a well-formed JSON array with at least one element."""
    return is_json(column) & has_elements(column)
