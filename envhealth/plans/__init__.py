"""End-to-end jobs: compositions of sources, operators and sinks."""

from .daily_run import (
    Lake,
    combine_job,
    indicators_job,
    publish_job,
    readings_job,
    run_daily,
)
from .history import crossing_years, history_corr, history_profile, history_years, store_days, store_rows
from .ledger import Busy, Ledger, run_stages
from .reports import drift, report_combined, report_daily, report_indicators, report_published, store_report
from .validators import (
    validate_combined,
    validate_daily,
    validate_indicators,
    validate_published,
)

__all__ = [
    "Busy",
    "Lake",
    "Ledger",
    "combine_job",
    "crossing_years",
    "history_corr",
    "history_profile",
    "history_years",
    "indicators_job",
    "drift",
    "publish_job",
    "readings_job",
    "report_combined",
    "report_daily",
    "report_indicators",
    "report_published",
    "run_daily",
    "run_stages",
    "store_days",
    "store_report",
    "store_rows",
    "validate_combined",
    "validate_daily",
    "validate_indicators",
    "validate_published",
]
