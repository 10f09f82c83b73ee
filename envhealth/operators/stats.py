"""Profiles and correlations, each in a single aggregation pass over the data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import ANCHOR, NUMERIC_TYPES, YEAR
from ..functions import coerce_double


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if f.dataType.simpleString() in NUMERIC_TYPES]


def _long(row: DataFrame, columns: list[str], figures: list[str]) -> DataFrame:
    """One aggregated row with cells `<i>_<figure>` -> one row per column."""
    cells = [
        F.struct(
            F.lit(name).alias("column_name"),
            *[F.col(f"{i}_{figure}").alias(figure) for figure in figures],
        )
        for i, name in enumerate(columns)
    ]
    return row.select(F.inline(F.array(*cells)))


def profile(df: DataFrame) -> DataFrame:
    """Count, mean, sample deviation, minimum and maximum of numeric and text columns.

    Minimum and maximum are text, as in `describe`; for text columns they are
    lexicographic, and the mean and deviation use the values that parse as numbers.
    """
    fields = [
        f
        for f in df.schema.fields
        if f.dataType.simpleString() in (*NUMERIC_TYPES, "smallint", "tinyint", "string")
        or f.dataType.simpleString().startswith("decimal")
    ]
    figures = ["count", "mean", "stddev", "min", "max"]
    aggs: list[Column] = []
    for i, field in enumerate(fields):
        c = F.col(f"`{field.name}`")
        is_text = field.dataType.simpleString() == "string"
        number = coerce_double(c) if is_text else c.cast("double")
        values = [
            F.count(c),
            F.avg(number),
            F.stddev_samp(number),
            F.min(c).cast("string"),
            F.max(c).cast("string"),
        ]
        aggs += [v.alias(f"{i}_{figure}") for figure, v in zip(figures, values)]
    return _long(df.agg(*aggs), [f.name for f in fields], figures)


def null_profile(df: DataFrame, nan_is_null: bool = False) -> DataFrame:
    """Rows and NULLs per column; `nan_is_null` counts NaN as missing too."""
    aggs: list[Column] = []
    for i, field in enumerate(df.schema.fields):
        c = F.col(f"`{field.name}`")
        missing = c.isNull()
        if nan_is_null and field.dataType.simpleString() in ("float", "double"):
            missing = missing | F.isnan(c)
        aggs += [F.count(F.lit(1)).alias(f"{i}_rows"), F.count_if(missing).alias(f"{i}_nulls")]
    return _long(df.agg(*aggs), df.columns, ["rows", "nulls"])


def pearson(left: Column, right: Column) -> Column:
    """Correlation over the rows where both sides are present; NULL when undefined."""
    both = left.isNotNull() & right.isNotNull()
    a, b = F.when(both, left), F.when(both, right)
    spread = F.sqrt(F.var_pop(a)) * F.sqrt(F.var_pop(b))
    return F.try_divide(F.covar_pop(a, b), spread)


def corr_vs_anchor(
    df: DataFrame, anchor: str = ANCHOR, skip: tuple[str, ...] = (YEAR,)
) -> DataFrame:
    """Correlation of `anchor` with every other numeric column, as (column_name, pairs, corr)."""
    others = [c for c in numeric_columns(df) if c != anchor and c not in skip]
    if not others:
        return df.sparkSession.createDataFrame([], "column_name STRING, pairs BIGINT, corr DOUBLE")
    left = F.col(f"`{anchor}`").cast("double")
    aggs: list[Column] = []
    for i, name in enumerate(others):
        right = F.col(f"`{name}`").cast("double")
        aggs += [
            F.count_if(left.isNotNull() & right.isNotNull()).alias(f"{i}_pairs"),
            pearson(left, right).alias(f"{i}_corr"),
        ]
    return _long(df.agg(*aggs), others, ["pairs", "corr"])
