"""Public-health indicator records: projection, rate parsing, cleaning, summary."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ..constants import CORRUPT, INDICATOR_TEXT_COLUMNS, MIN_YEAR
from ..functions import clean_text, coerce_double, once, parse_rate, to_int
from ..schemas import INDICATOR
from .quality import tag_rejects


def normalize_columns(df: DataFrame, columns: list[str] | tuple[str, ...]) -> DataFrame:
    """Clean the listed text columns that exist, in a single projection."""
    present = set(df.columns)
    return df.withColumns({c: clean_text(F.col(f"`{c}`")) for c in columns if c in present})


def project_indicators(raw: DataFrame) -> DataFrame:
    return raw.select(
        to_int("year").alias("year"),
        "confidence_interval",
        "description",
        "group",
        "percentage",
        "outcome_or_indicator",
    )


def clean_indicators(
    raw: DataFrame, min_year: int = MIN_YEAR, keep_rate: bool = False
) -> DataFrame:
    """Valid indicator rows; `keep_rate` adds the parsed rate as the last column.

    The rate is parsed from the untrimmed text: " 5" is not a rate, although the
    published `percentage` is trimmed afterwards. A year that is a number already stays an
    ordinary column, so that the bound on it can reach the scan.
    """
    texts = [c for c in INDICATOR.names if c != "year"]
    rate = parse_rate("percentage")
    if isinstance(raw.schema["year"].dataType, StringType):
        parsed = raw.select(*texts, once(year=to_int("year"), asthma_rate=rate))
    else:
        parsed = raw.select(*texts, F.col("year").try_cast("int"), once(asthma_rate=rate))
    valid = normalize_columns(parsed, INDICATOR_TEXT_COLUMNS).where(
        (F.col("year") >= min_year) & (F.col("asthma_rate") >= 0)
    )
    return valid.select(*INDICATOR.names, *(["asthma_rate"] if keep_rate else []))


def judge_indicators(raw: DataFrame, min_year: int = MIN_YEAR) -> DataFrame:
    """Every landed record and, in `reject_reason`, why `clean_indicators` does not keep it.

    A record that did not parse and is not valid is `malformed`; the other reasons are
    `year` and `rate`.
    """
    landed = [F.col(f"`{c}`") for c in raw.columns]
    rows = raw.select(*landed, once(_year=to_int("year"), _rate=parse_rate("percentage")))
    year, rate = F.col("_year") >= min_year, F.col("_rate") >= 0
    usable = F.coalesce(year & rate, F.lit(False))
    checks = {"malformed": usable | F.col(CORRUPT).isNull(), "year": year, "rate": rate}
    return tag_rejects(rows, checks).drop("_year", "_rate")


def rate_summary(df: DataFrame, column: str = "percentage") -> DataFrame:
    """Numeric minimum, maximum and mean of a rate kept as text."""
    rate = coerce_double(column)
    return df.agg(
        F.count(rate).alias("rates"),
        F.min(rate).alias("min_rate"),
        F.max(rate).alias("max_rate"),
        F.avg(rate).alias("avg_rate"),
    )
