"""Raw landing files: JSON envelopes, JSON record arrays, CSV drops."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..constants import ACCEPTED_STATUS, CORRUPT, LANDING_LIMIT, LANDING_YEARS
from ..functions import as_date
from ..schemas import ENVELOPE, INDICATOR_RAW, LANDING


def _read_json(
    spark: SparkSession,
    path: str | list[str],
    schema: StructType,
    multi_line: bool,
    strict: bool,
    files: str | None,
) -> DataFrame:
    reader = spark.read.option("multiLine", multi_line)
    if files:
        reader = reader.option("pathGlobFilter", files)
    if strict:
        return reader.option("mode", "FAILFAST").schema(schema).json(path)
    with_corrupt = StructType([*schema.fields]).add(CORRUPT, StringType())
    reader = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
    return reader.schema(with_corrupt).json(path)


def read_envelopes(
    spark: SparkSession,
    path: str | list[str],
    multi_line: bool = False,
    strict: bool = False,
    files: str | None = None,
) -> DataFrame:
    """Air-quality envelopes, one object per line, or one per file with `multi_line`.

    A record that does not parse is kept as text in `_corrupt_record`; with `strict` it
    fails the job instead. `files` is a pattern of file names to read.
    """
    return _read_json(spark, path, ENVELOPE, multi_line, strict, files)


def read_records(
    spark: SparkSession,
    path: str | list[str],
    schema: StructType = INDICATOR_RAW,
    multi_line: bool = False,
    strict: bool = False,
    files: str | None = None,
) -> DataFrame:
    """Flat records, one record or array per line. With `multi_line` a file is one record
    or one array over several lines; such a file is not split, so that one task reads it."""
    return _read_json(spark, path, schema, multi_line, strict, files)


def read_csv_drop(
    spark: SparkSession,
    path: str | list[str],
    schema: StructType = INDICATOR_RAW,
    multi_line: bool = False,
) -> DataFrame:
    """CSV with a header line. Columns are matched by name, all as text; those of the
    schema that the file lacks are NULL. Files whose headers differ fail the read. A line
    with too few or too many fields is kept as text in `_corrupt_record`."""
    reader = (
        spark.read.option("header", True)
        .option("enforceSchema", False)
        .option("escape", '"')
        .option("multiLine", multi_line)
    )
    present = reader.csv(path).columns
    as_text = StructType([StructField(c, StringType()) for c in [*present, CORRUPT]])
    # Without pruning every line's fields are counted, whatever columns are used.
    rows = (
        reader.option("columnNameOfCorruptRecord", CORRUPT)
        .option("columnPruning", False)
        .schema(as_text)
        .csv(path)
    )
    columns = [
        (F.col(f"`{f.name}`") if f.name in present else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in schema.fields
    ]
    return rows.select(*columns, CORRUPT)


def split_corrupt(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows that parsed, without the corrupt-record column, and the rows that did not."""
    good = rows.where(F.col(CORRUPT).isNull()).drop(CORRUPT)
    return good, rows.where(F.col(CORRUPT).isNotNull())


def landing_report(envelopes: DataFrame) -> DataFrame:
    """Landed records, those that did not parse, those with data, and those accepted.

    Only columns that a query uses are parsed, so a record counts as corrupt for a wrong
    `data` only because `data` is counted here too.
    """
    return envelopes.agg(
        F.count(F.lit(1)).alias("records"),
        F.count_if(F.col(CORRUPT).isNotNull()).alias("corrupt"),
        F.count("data").alias("with_data"),
        F.count_if(F.col("status") == ACCEPTED_STATUS).alias("accepted"),
    )


def landing_query(
    records: DataFrame,
    location: str,
    run_date: dt.date | str,
    years: int = LANDING_YEARS,
    limit: int = LANDING_LIMIT,
) -> DataFrame:
    """The newest `limit` records of one location since `run_date` minus `years`.

    `year` is compared as text, as it is stored. The other columns break ties, so only
    equal rows can stand in for each other at the limit.
    """
    since = str(as_date(run_date).year - years)
    return (
        records.where((F.col("location_name") == location) & (F.col("year") >= since))
        .select(*LANDING.names)
        .orderBy(F.desc("year"), *[F.asc(c) for c in LANDING.names if c != "year"])
        .limit(limit)
    )
