"""The daily run: readings and indicators in parallel, then combine, then publish.

Every job takes an explicit run date and replaces exactly what it wrote for that date,
so any of them can be run again. Each writes its table in one action, counts rows while
they pass by, and compares the rows of the last step with what the table then holds.
Counts taken before a shuffle are for the report only: a task that has to run again
after a lost executor can be counted twice there, but not in the step that writes.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..constants import REQUIRED_INDICATOR_COLUMNS
from ..functions import as_date
from ..operators import (
    accept_status,
    clean_indicators,
    clean_readings,
    combine_years,
    daily_stats,
    extract_readings,
    figures,
    judge_indicators,
    judge_readings,
    merge_daily,
    observed,
    require_columns,
    require_rows,
    to_documents,
    yearly_stats,
)
from ..operators.quality import REASON
from ..schemas import INDICATOR
from ..sinks import audit, refresh, write_table
from ..sources import (
    partition_path,
    read_envelopes,
    read_positioned,
    read_records,
    read_table,
    require_input,
)

from .history import history_years, store_days, store_rows
from .ledger import ATTEMPTS, Ledger, run_stages

@dataclass(frozen=True)
class Lake:
    """Where the tables live. The raw folders are patterns over `{day}` and `{year}`."""

    root: str
    readings_folder: str = "raw/air_quality/date={day}"
    indicators_folder: str = "raw/hospitalizations/year={year}"
    files: str = "*.json*"

    def raw_readings(self, day: dt.date) -> str:
        return f"{self.root}/{self.readings_folder.format(day=day.isoformat())}"

    def raw_indicators(self, year: int) -> str:
        return f"{self.root}/{self.indicators_folder.format(year=year)}"

    @property
    def daily(self) -> str:
        return f"{self.root}/formatted/air_quality"

    @property
    def indicators(self) -> str:
        return f"{self.root}/formatted/hospitalizations"

    @property
    def combined(self) -> str:
        return f"{self.root}/final/combined"

    @property
    def day_moments(self) -> str:
        return f"{self.root}/final/day_moments"

    @property
    def moments(self) -> str:
        return f"{self.root}/final/combined_moments"

    @property
    def ledger(self) -> str:
        return f"{self.root}/ledger"

    @property
    def documents(self) -> str:
        return f"{self.root}/published/air_asthma"

    @property
    def rejects(self) -> str:
        return f"{self.root}/rejects/air_quality"

    @property
    def indicator_rejects(self) -> str:
        return f"{self.root}/rejects/hospitalizations"


def readings_job(
    spark: SparkSession,
    lake: Lake,
    run_date: dt.date | str,
    multi_line: bool = False,
    keep_moments: bool = False,
) -> dict[str, int]:
    """Clean the readings landed the day before and write their daily statistics.

    Every landed record is a valid reading or a reject with a reason; rejects are written
    first, so that a day without a valid reading leaves them too. `keep_moments` stores what
    `combine_job(scope="history")` needs of the run.
    """
    run_date = as_date(run_date)
    path = lake.raw_readings(run_date - dt.timedelta(days=1))
    require_input(spark, path)
    envelopes = read_envelopes(spark, path, multi_line, files=lake.files)
    judged, seen = observed(
        judge_readings(envelopes),
        f"readings landed {run_date}",
        rejected=F.count_if(F.col(REASON).isNotNull()),
    )
    _write_rejects(judged, partition_path(lake.rejects, run_date))
    daily, written = observed(
        daily_stats(clean_readings(extract_readings(accept_status(envelopes)))), f"days {run_date}"
    )
    landed = figures(seen)
    if landed["rows"] == landed["rejected"]:
        raise ValueError(f"daily statistics of {path}: no rows")
    write_table(daily, lake.daily, run_date)
    audit(spark, lake.daily, require_rows(written, f"daily statistics of {path}"), run_date)
    if keep_moments:
        store_days(spark, lake.daily, lake.day_moments, run_date)
    return {
        "readings": landed["rows"],
        "rejected_readings": landed["rejected"],
        "valid_readings": landed["rows"] - landed["rejected"],
        "days": figures(written)["rows"],
    }


def _write_rejects(judged: DataFrame, path: str) -> None:
    """Replace the rejects of one landing."""
    judged.where(F.col(REASON).isNotNull()).write.mode("overwrite").parquet(path)


def indicators_job(
    spark: SparkSession,
    lake: Lake,
    run_date: dt.date | str,
    multi_line: bool = False,
    keep_rate: bool = False,
) -> dict[str, int]:
    """Clean the indicator records landed in the year of the run.

    Every landed record is a valid indicator or a reject with a reason; rejects are written
    first. A required column that no record has is an error of its own.
    """
    run_date = as_date(run_date)
    path = lake.raw_indicators(run_date.year)
    require_input(spark, path)
    records = read_records(spark, path, multi_line=multi_line, files=lake.files)
    judged, seen = observed(
        judge_indicators(records),
        f"indicators landed {run_date}",
        malformed=F.count_if(F.col(REASON).eqNullSafe("malformed")),
        rejected=F.count_if(F.col(REASON).isNotNull()),
        **{c: F.count(c) for c in REQUIRED_INDICATOR_COLUMNS},
    )
    _write_rejects(judged, partition_path(lake.indicator_rejects, run_date.year, "ingest_year"))
    landed = figures(seen)
    missing = [c for c in REQUIRED_INDICATOR_COLUMNS if not landed[c]]
    if landed["rows"] > landed["malformed"] and missing:
        raise ValueError(f"missing columns: {missing} of {path}")
    if landed["rows"] == landed["rejected"]:
        raise ValueError(f"valid indicators of {path}: no rows")
    cleaned, written = observed(
        clean_indicators(records, keep_rate=keep_rate), f"indicators {run_date}"
    )
    write_table(cleaned, lake.indicators, run_date.year, "ingest_year")
    rows = require_rows(written, f"valid indicators of {path}")
    audit(spark, lake.indicators, rows, run_date.year, "ingest_year")
    return {
        "indicators": landed["rows"],
        "corrupt_indicators": landed["malformed"],
        "rejected_indicators": landed["rejected"],
        "valid_indicators": rows,
    }


def combine_job(
    spark: SparkSession, lake: Lake, run_date: dt.date | str, scope: str = "all"
) -> dict[str, int]:
    """Join the yearly figures with the indicators landed in the year of the run.

    `scope="all"` rolls up every daily row known at the run date; `scope="day"` only
    those written by this run. `scope="history"` gives the figures of "all" from the moments
    that every run has stored, and stores those of the combined rows.
    """
    if scope not in ("all", "day", "history"):
        raise ValueError(f"unknown scope: {scope!r}")
    run_date = as_date(run_date)
    if scope == "history":
        daily = None
        yearly = history_years(spark, lake.daily, lake.day_moments, run_date)
    else:
        daily = read_table(spark, lake.daily, run_date, up_to=scope == "all").drop("run_date")
        if scope == "all":
            daily = merge_daily(daily)
        yearly = yearly_stats(daily)
    indicators = read_table(spark, lake.indicators, run_date.year, "ingest_year").drop("ingest_year")
    combined, written = observed(
        combine_years(yearly, require_columns(indicators, INDICATOR.names), run_date),
        f"combined {run_date}",
        first_year=F.min("year").cast("bigint"),
        last_year=F.max("year").cast("bigint"),
    )
    write_table(combined, lake.combined, run_date)
    rows = figures(written)["rows"]
    if not rows:
        source = yearly if daily is None else daily
        for what, table in (("daily readings", source), ("indicators", indicators)):
            if table.isEmpty():
                raise ValueError(f"no rows: {what}")
        raise ValueError("no common year: combined")
    audit(spark, lake.combined, rows, run_date)
    if scope == "history":
        store_rows(spark, lake.combined, lake.moments, run_date)
    seen = figures(written)
    return {"combined": rows, "first_year": seen["first_year"], "last_year": seen["last_year"]}


def publish_job(
    spark: SparkSession,
    lake: Lake,
    run_date: dt.date | str,
    indexed_at: dt.datetime | str | None = None,
    form: str = "parquet",
) -> dict[str, int]:
    """Replace the published documents by those of the run date.

    Readers get the old set, by `sinks.read_current`, until the new one is complete and counted.
    """
    run_date = as_date(run_date)
    indexed_at = indexed_at or f"{run_date.isoformat()} 00:00:00"
    source = partition_path(lake.combined, run_date)
    require_input(spark, source)
    rows, seen = observed(read_positioned(spark, source), f"documents read {run_date}")
    documents, written = observed(
        to_documents(rows, run_date, indexed_at, position="_position"), f"documents {run_date}"
    )
    report = refresh(documents, lake.documents, form, expected=lambda: require_rows(written, "documents"))
    return report | {"dropped": figures(seen)["rows"] - report["documents"]}


def run_daily(
    spark: SparkSession,
    lake: Lake | str,
    run_date: dt.date | str,
    indexed_at: dt.datetime | str | None = None,
    scope: str = "all",
    multi_line: bool = False,
    resume: bool = False,
    attempts: int = ATTEMPTS,
) -> dict[str, int]:
    """All jobs of one date in dependency order; returns the row counts of every stage.

    A job that fails is tried once more. The ledger of the lake notes every attempt; with
    `resume` the jobs that it has as finished are not run again, and their counts are those of
    then. Another run of the same date meanwhile is refused.
    """
    lake = Lake(lake) if isinstance(lake, str) else lake
    keep = scope == "history"
    stages = {
        "readings": ((), lambda: readings_job(spark, lake, run_date, multi_line, keep)),
        "indicators": ((), lambda: indicators_job(spark, lake, run_date, multi_line)),
        "combine": (("readings", "indicators"), lambda: combine_job(spark, lake, run_date, scope)),
        "publish": (("combine",), lambda: publish_job(spark, lake, run_date, indexed_at)),
    }
    return run_stages(Ledger(spark, lake.ledger, run_date), stages, attempts, again=not resume)
