"""Validators of the lake tables: each returns rows (check_name, passed, value)."""

from __future__ import annotations

import datetime as dt

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..constants import YEAR
from ..functions import as_date, coerce_double
from ..operators import validate, year_bounds
from ..sinks.versions import current
from ..sources import footprint, read_documents, read_table
from .daily_run import Lake

CHECK = "check_name STRING, passed BOOLEAN, value BIGINT"


def _exists(spark: SparkSession, found: bool) -> DataFrame:
    return spark.createDataFrame([("exists", found, int(found))], CHECK)


def _checks(df: DataFrame, **values) -> DataFrame:
    """One row per named figure, all from one pass: `name=(figure, passes)`."""
    row = df.agg(*[figure.cast("bigint").alias(name) for name, (figure, _) in values.items()])
    cells = [
        F.struct(
            F.lit(name).alias("check_name"),
            F.coalesce(passes(F.col(name)), F.lit(False)).alias("passed"),
            F.col(name).alias("value"),
        )
        for name, (_, passes) in values.items()
    ]
    return row.select(F.inline(F.array(*cells)))


def _some(value):
    return value > 0


def _missing(error: AnalysisException) -> bool:
    return error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


def validate_daily(spark: SparkSession, lake: Lake, run_date: dt.date | str) -> DataFrame:
    """Days that the run of a date has written."""
    try:
        table = read_table(spark, lake.daily, run_date)
    except AnalysisException as error:
        if not _missing(error):
            raise
        return _exists(spark, False)
    return _exists(spark, True).union(_checks(table, days=(F.count(F.lit(1)), _some)))


def validate_indicators(spark: SparkSession, lake: Lake, year: int) -> DataFrame:
    """Indicator rows of an ingest year, and how many of them have a numeric rate."""
    try:
        table = read_table(spark, lake.indicators, year, "ingest_year")
    except AnalysisException as error:
        if not _missing(error):
            raise
        return _exists(spark, False)
    numeric = F.count_if(coerce_double("percentage").isNotNull())
    return _exists(spark, True).union(
        _checks(table, rows=(F.count(F.lit(1)), _some), numeric_rates=(numeric, _some))
    )


def validate_combined(spark: SparkSession, lake: Lake, run_date: dt.date | str) -> DataFrame:
    """Rows, missing years, year range and NULLs per column of the combined rows of a date."""
    try:
        table = read_table(spark, lake.combined, run_date)
    except AnalysisException as error:
        if not _missing(error):
            raise
        return _exists(spark, False)
    watched = [c for c in table.columns if c not in ("run_date", YEAR)]
    return _exists(spark, True).union(validate(table, *year_bounds(run_date), watched=watched))


def validate_published(
    spark: SparkSession, lake: Lake, run_date: dt.date | str
) -> DataFrame:
    """Documents in all and by year, their bytes, and those that come from another run date."""
    now = current(spark, lake.documents)
    if now is None:
        return _exists(spark, False)
    folder = f"{lake.documents}/{now['folder']}"
    table = read_documents(spark, folder, now["form"])
    foreign = F.count_if(~F.col("processing_date").eqNullSafe(F.lit(as_date(run_date))))
    size = footprint(spark, folder).select(
        F.lit("bytes").alias("check_name"),
        (F.col("bytes") > 0).alias("passed"),
        F.col("bytes").alias("value"),
    )
    # Counts by year are taken first; the totals come from those few rows.
    years = table.groupBy(YEAR).agg(F.count(F.lit(1)).alias("n"), foreign.alias("others"))
    per_year = years.select(
        F.concat(F.lit("documents_"), F.coalesce(F.col(YEAR).cast("string"), F.lit("none"))),
        F.col("n") > 0,
        "n",
    )
    totals = _checks(
        years,
        documents=(F.coalesce(F.sum("n"), F.lit(0)), _some),
        other_dates=(F.coalesce(F.sum("others"), F.lit(0)), lambda value: value == 0),
    )
    return _exists(spark, True).union(totals).union(size).union(per_year)
