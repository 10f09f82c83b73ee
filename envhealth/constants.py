"""They must equal the published formats for results to match."""

# Cleaning rules.
RATE_PATTERN = r"^[0-9]+\.?[0-9]*$"
LINE_BREAKS = "\r\n\t"
PM25_LOW = 0
PM25_HIGH = 1000
MIN_YEAR = 2000
YEARS_AHEAD = 1

# Landing rules.
ACCEPTED_STATUS = "ok"
LANDING_LIMIT = 1000
LANDING_YEARS = 5

# Search defaults.
SEARCH_SIZE = 10
TERMS_SIZE = 10
BULK_DOCS = 100
BULK_BYTES = 10 * 1024 * 1024

# Column names.
YEAR = "year"
ANCHOR = "pm25_avg_yearly"
CORRUPT = "_corrupt_record"
REQUIRED_INDICATOR_COLUMNS = ("year", "percentage")
NUMERIC_TYPES = ("double", "float", "int", "bigint")
METRIC_COLUMNS = (
    "pm25_avg_yearly",
    "pm25_min_yearly",
    "pm25_max_yearly",
    "pm25_measurements_count",
    "daily_measurements_avg",
)
INDICATOR_TEXT_COLUMNS = ("group", "outcome_or_indicator", "percentage")
