"""Reports of the lake tables: every check and figure of a table from one pass, next to the last ones."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..constants import ANCHOR, YEAR
from ..functions import as_date, coerce_double
from ..operators import numeric_columns, year_bounds
from ..sinks import write_table
from ..sinks.versions import current
from ..sources import read_documents, read_table
from .daily_run import Lake

REPORT = "check_name STRING, passed BOOLEAN, figure DOUBLE"
#: A figure, and when it passes; without a condition it is only reported.
Check = tuple[Column, Callable[[Column], Column] | None]


def _present(spark: SparkSession, found: bool) -> DataFrame:
    return spark.createDataFrame([("exists", found, float(found))], REPORT)


def _read(read: Callable[[], DataFrame]) -> DataFrame | None:
    """The table, or None when it is not there."""
    try:
        return read()
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None


def report_of(df: DataFrame, checks: dict[str, Check]) -> DataFrame:
    """`(check_name, passed, figure)` of aggregates over `df`, all from one pass.

    A figure that is NULL fails its condition.
    """
    row = df.agg(*[figure.cast("double").alias(name) for name, (figure, _) in checks.items()])
    cells = []
    for name, (_, passes) in checks.items():
        passed = F.coalesce(passes(F.col(f"`{name}`")), F.lit(False)) if passes else F.lit(True)
        cells.append(F.struct(F.lit(name).alias("check_name"), passed.alias("passed"), F.col(f"`{name}`").alias("figure")))
    return row.select(F.inline(F.array(*cells)))


def _some(figure: Column) -> Column:
    return figure > 0


def _none(figure: Column) -> Column:
    return figure == 0


def describe_checks(df: DataFrame, skip: tuple[str, ...] = (YEAR,)) -> dict[str, Check]:
    """Count, mean, sample deviation, minimum and maximum of each numeric column, to be reported."""
    checks: dict[str, Check] = {}
    for name in numeric_columns(df):
        if name not in skip:
            c = F.col(f"`{name}`").cast("double")
            figures = {"count": F.count(c), "mean": F.avg(c), "stddev": F.stddev_samp(c), "min": F.min(c), "max": F.max(c)}
            checks |= {f"{figure}_{name}": (value, None) for figure, value in figures.items()}
    return checks


def null_checks(df: DataFrame, critical: tuple[str, ...] = (YEAR,)) -> dict[str, Check]:
    return {f"nulls_{c}": (F.count_if(F.col(f"`{c}`").isNull()), _none if c in critical else None) for c in df.columns}


def report_daily(spark: SparkSession, lake: Lake, run_date: dt.date | str) -> DataFrame:
    """Days that the run of a date has written, and the figures of their columns."""
    table = _read(lambda: read_table(spark, lake.daily, run_date).drop("run_date"))
    if table is None:
        return _present(spark, False)
    checks = {"rows": (F.count(F.lit(1)), _some), **null_checks(table, ("date",)), **describe_checks(table)}
    return _present(spark, True).union(report_of(table, checks))


def report_indicators(spark: SparkSession, lake: Lake, year: int) -> DataFrame:
    """Rows of an ingest year, their years, and the rates that are numeric, with their figures."""
    table = _read(lambda: read_table(spark, lake.indicators, year, "ingest_year").drop("ingest_year"))
    if table is None:
        return _present(spark, False)
    rate = coerce_double("percentage")
    checks: dict[str, Check] = {
        "rows": (F.count(F.lit(1)), _some),
        **null_checks(table),
        "numeric_rates": (F.count(rate), _some),
        "rate_min": (F.min(rate), lambda low: low >= 0),
        "rate_max": (F.max(rate), None),
        "rate_avg": (F.avg(rate), None),
        "min_year": (F.min(YEAR), None),
        "max_year": (F.max(YEAR), None),
    }
    return _present(spark, True).union(report_of(table, checks))


def report_combined(spark: SparkSession, lake: Lake, run_date: dt.date | str) -> DataFrame:
    """Rows, NULLs, year range and the figures of every numeric column of a run's combined rows."""
    table = _read(lambda: read_table(spark, lake.combined, run_date).drop("run_date"))
    if table is None:
        return _present(spark, False)
    first, last = year_bounds(run_date)
    checks: dict[str, Check] = {
        "rows": (F.count(F.lit(1)), _some),
        **null_checks(table),
        "min_year": (F.min(YEAR), lambda year: year >= first),
        "max_year": (F.max(YEAR), lambda year: year <= last),
        **describe_checks(table),
    }
    return _present(spark, True).union(report_of(table, checks))


def report_published(spark: SparkSession, lake: Lake, run_date: dt.date | str) -> DataFrame:
    """Documents in all and by year, the mean of the metric, and documents of another run date.

    The documents are read once, to one row per year; the totals come from those.
    """
    now = current(spark, lake.documents)
    if now is None:
        return _present(spark, False)
    table = read_documents(spark, f"{lake.documents}/{now['folder']}", now["form"])
    metric = F.col(ANCHOR).cast("double")
    foreign = F.count_if(~F.col("processing_date").eqNullSafe(F.lit(as_date(run_date))))
    years = table.groupBy(YEAR).agg(
        F.count(F.lit(1)).alias("n"), foreign.alias("others"), F.sum(metric).alias("total"), F.count(metric).alias("values")
    )
    totals: dict[str, Check] = {
        "documents": (F.coalesce(F.sum("n"), F.lit(0)), _some),
        "documents_noted": (F.coalesce(F.sum("n"), F.lit(0)), lambda n: n == F.lit(float(now["documents"]))),
        "other_dates": (F.coalesce(F.sum("others"), F.lit(0)), _none),
        f"mean_{ANCHOR}": (F.try_divide(F.sum("total"), F.sum("values")), None),
    }
    name = F.concat(F.lit("documents_"), F.coalesce(F.col(YEAR).cast("string"), F.lit("none")))
    per_year = years.select(name, F.col("n") > 0, F.col("n").cast("double"))
    return _present(spark, True).union(report_of(years, totals)).union(per_year)


def store_report(report: DataFrame, path: str, run_date: dt.date | str) -> None:
    """Keep the figures of a date, for the reports of later ones; those of the date are replaced."""
    write_table(report.coalesce(1), path, run_date)


def drift(
    report: DataFrame, path: str, run_date: dt.date | str, tolerance: float = 0.5
) -> DataFrame:
    """`report` with the figure of the last stored date before, and whether it stayed near it.

    A figure passes when it passes by itself and differs by at most `tolerance` times the size of
    the one before; without one before, or when either is NULL, only by itself.
    """
    spark = report.sparkSession
    stored = _read(lambda: read_table(spark, path))
    if stored is None:
        stored = spark.createDataFrame([], f"{REPORT}, run_date DATE")
    earlier = stored.where(F.col("run_date") < F.lit(as_date(run_date)))
    last = earlier.groupBy("check_name").agg(F.max_by("figure", "run_date").alias("before"))
    near = F.abs(F.col("figure") - F.col("before")) <= tolerance * F.abs("before")
    joined = report.join(last, "check_name", "left")
    return joined.select("check_name", (F.col("passed") & F.coalesce(near, F.lit(True))).alias("passed"), "figure", "before")
