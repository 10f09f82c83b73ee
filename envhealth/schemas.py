"""Explicit schemas of every table; nothing in this package infers a schema."""

from __future__ import annotations

from pyspark.sql.types import (
    DataType,
    DateType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

TEXT, INT, LONG, FLOAT, DOUBLE, DATE = (
    StringType(),
    IntegerType(),
    LongType(),
    FloatType(),
    DoubleType(),
    DateType(),
)


def struct(**fields: DataType) -> StructType:
    return StructType([StructField(name, kind) for name, kind in fields.items()])


# `v` stays text: numbers arrive as their source text and "-" must not cost the whole row.
ENVELOPE = struct(
    status=TEXT,
    data=struct(
        time=struct(s=TEXT),
        city=struct(name=TEXT),
        iaqi=struct(pm25=struct(v=TEXT)),
    ),
)

INDICATOR_RAW = struct(
    year=TEXT,
    percentage=TEXT,
    confidence_interval=TEXT,
    description=TEXT,
    group=TEXT,
    outcome_or_indicator=TEXT,
)

LANDING = struct(year=TEXT, location_name=TEXT, value=TEXT, unit=TEXT, data_value_type=TEXT)

READING = struct(utc_datetime=TEXT, city=TEXT, pm25=DOUBLE, date=DATE)

DAILY = struct(date=DATE, pm25=DOUBLE, measurements_count=LONG, pm25_min=DOUBLE, pm25_max=DOUBLE)

INDICATOR = struct(
    year=INT, percentage=TEXT, group=TEXT, outcome_or_indicator=TEXT, confidence_interval=TEXT
)

YEARLY = struct(
    year=INT,
    pm25_avg_yearly=DOUBLE,
    pm25_min_yearly=DOUBLE,
    pm25_max_yearly=DOUBLE,
    pm25_measurements_count=LONG,
    daily_measurements_avg=DOUBLE,
)

COMBINED = StructType(YEARLY.fields + [f for f in INDICATOR.fields if f.name != "year"])

# The published document: metrics narrow to 32 bits here and only here.
DOCUMENT = struct(
    year=INT,
    pm25_avg_yearly=FLOAT,
    pm25_min_yearly=FLOAT,
    pm25_max_yearly=FLOAT,
    pm25_measurements_count=INT,
    daily_measurements_avg=FLOAT,
    percentage=TEXT,
    group=TEXT,
    outcome_or_indicator=TEXT,
    confidence_interval=TEXT,
    indexed_at=TimestampNTZType(),
    data_source=TEXT,
    processing_date=DATE,
)

# How documents are written as JSON: NULL fields stay, times keep microseconds.
JSON_OPTIONS = {
    "ignoreNullFields": "false",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
    "dateFormat": "yyyy-MM-dd",
}
