"""Data-quality operators: schema gates, attrition, rejects, observed counts, validators."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..constants import YEAR
from ..functions import has_elements, has_field, is_json, once

REASON = "reject_reason"


def missing_columns(df: DataFrame, required: Iterable[str]) -> list[str]:
    present = set(df.columns)
    return [c for c in required if c not in present]


def require_columns(df: DataFrame, required: Iterable[str]) -> DataFrame:
    missing = missing_columns(df, required)
    if missing:
        raise ValueError(f"missing columns: {missing}")
    return df


def required_fields(df: DataFrame, payload: str, fields: Iterable[str]) -> DataFrame:
    """How many JSON payloads lack each required top-level field, each parsed once.

    A field whose value is null is there; what is not an object lacks every field.
    """
    fields = list(fields)
    names = [f"_{i}" for i in range(len(fields))]
    keys = df.select(once(_keys=F.json_object_keys(payload)))
    has = [F.coalesce(F.array_contains("_keys", f), F.lit(False)) for f in fields]
    counted = keys.agg(
        F.count(F.lit(1)).alias("_rows"), *[F.count_if(~h).alias(n) for h, n in zip(has, names)]
    )
    cells = [
        F.struct(
            F.lit(f).alias("field"), F.col("_rows").alias("records"), F.col(n).alias("missing")
        )
        for f, n in zip(fields, names)
    ]
    return counted.select(F.inline(F.array(*cells)))


def payload_report(df: DataFrame, payload: str, *by: str, field: str = "data") -> DataFrame:
    """Payloads that fail to parse, that are objects with `field`, that are record lists."""
    judged = df.select(*by, once(_payload=F.col(payload), _json=is_json(payload)))
    envelope = has_field("_payload", field)
    return judged.groupBy(*by).agg(
        F.count(F.lit(1)).alias("payloads"),
        F.count_if(~F.col("_json")).alias("malformed"),
        F.count_if(F.col("_json") & envelope).alias("envelopes"),
        F.count_if(F.col("_json") & has_elements("_payload")).alias("record_lists"),
    )


def drop_critical_nulls(df: DataFrame, columns: Iterable[str] = (YEAR,)) -> DataFrame:
    return df.na.drop(subset=list(columns))


def attrition(df: DataFrame, keep: Column) -> DataFrame:
    """Rows in, kept and removed by a predicate; an unknown outcome removes the row."""
    return df.agg(
        F.count(F.lit(1)).alias("rows_in"),
        F.count_if(keep).alias("rows_kept"),
        (F.count(F.lit(1)) - F.count_if(keep)).alias("rows_removed"),
    )


def tag_rejects(df: DataFrame, checks: Mapping[str, Column]) -> DataFrame:
    """Add the name of the first failed check, NULL for a good row."""
    failed = [
        F.when(~F.coalesce(passes, F.lit(False)), F.lit(name)) for name, passes in checks.items()
    ]
    return df.withColumn(REASON, F.coalesce(*failed))


def split_rejects(
    df: DataFrame, checks: Mapping[str, Column]
) -> tuple[DataFrame, DataFrame]:
    """Good rows, and rejected rows with their reason; together they are the input."""
    tagged = tag_rejects(df, checks)
    good = tagged.where(F.col(REASON).isNull()).drop(REASON)
    return good, tagged.where(F.col(REASON).isNotNull())


def observed(df: DataFrame, name: str, **more: Column) -> tuple[DataFrame, Observation]:
    """Count rows while they pass by: the figures are ready after the one action on `df`."""
    observation = Observation(name)
    named = [figure.alias(alias) for alias, figure in more.items()]
    return df.observe(observation, F.count(F.lit(1)).alias("rows"), *named), observation


class NoFigures(dict):
    """Figures of an observation that saw nothing: every one is 0."""

    def __missing__(self, name: str) -> int:
        return 0


def figures(observation: Observation) -> dict[str, int]:
    """The observed figures after the action; none at all when nothing passed by.

    Spark drops the observation of a plan that turns out to be empty while it runs. Any
    other failure is passed on.
    """
    try:
        return observation.get
    except Py4JJavaError as error:
        if "NoSuchElementException" not in str(error.java_exception):
            raise
        return NoFigures(rows=0)


def require_rows(observation: Observation, what: str) -> int:
    rows = figures(observation)["rows"]
    if not rows:
        raise ValueError(f"{what}: no rows")
    return rows


def stage_counts(readings: DataFrame, valid: Column, date: str = "date") -> DataFrame:
    """Rows in, valid rows, days and years after each stage, through one row per date."""
    per_day = readings.groupBy(date).agg(
        F.count(F.lit(1)).alias("_in"), F.count_if(valid).alias("_valid")
    )
    kept = F.col("_valid") > 0
    per_year = per_day.groupBy(F.year(date).alias("_year")).agg(
        F.sum("_in").alias("_in"),
        F.sum("_valid").alias("_valid"),
        F.count_if(kept).alias("_days"),
    )
    return per_year.agg(
        F.coalesce(F.sum("_in"), F.lit(0)).alias("readings"),
        F.coalesce(F.sum("_valid"), F.lit(0)).alias("valid_readings"),
        F.coalesce(F.sum("_days"), F.lit(0)).alias("days"),
        F.count_if(F.col("_days") > 0).alias("years"),
    )


def validate(
    df: DataFrame,
    first_year: int,
    last_year: int,
    critical: Iterable[str] = (YEAR,),
    watched: Iterable[str] = (),
) -> DataFrame:
    """Table checks as (check_name, passed, value), in one pass: rows, NULLs, year range.

    NULLs fail the check of a critical column; those of watched columns are only reported.
    """
    critical, watched = list(critical), list(watched)
    nulls = [
        F.count_if(F.col(f"`{c}`").isNull()).alias(f"_{i}")
        for i, c in enumerate(critical + watched)
    ]
    row = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        F.min(YEAR).cast("bigint").alias("_min"),
        F.max(YEAR).cast("bigint").alias("_max"),
        *nulls,
    )

    def check(name: str, passed: Column, value: Column) -> Column:
        return F.struct(
            F.lit(name).alias("check_name"),
            F.coalesce(passed, F.lit(False)).alias("passed"),
            value.alias("value"),
        )

    checks = [
        check("rows", F.col("_rows") > 0, F.col("_rows")),
        *[
            check(f"nulls_{c}", F.lit(c in watched) | (F.col(f"_{i}") == 0), F.col(f"_{i}"))
            for i, c in enumerate(critical + watched)
        ],
        check("min_year", F.col("_min") >= first_year, F.col("_min")),
        check("max_year", F.col("_max") <= last_year, F.col("_max")),
    ]
    return row.select(F.inline(F.array(*checks)))
