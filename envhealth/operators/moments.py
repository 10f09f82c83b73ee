"""Mergeable moments: profiles and correlations of a history from one small row set a day.

The moments of a table are counts, means, sums of squared deviations, extremes and, against an
anchor, the sums of products of deviations. Those of two tables give those of both together by
Chan's formulas, without a difference of large sums, so a day is read once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import ANCHOR, NUMERIC_TYPES

#: One row per column; the `pair_` figures are over rows where the anchor is present too.
FIELDS = ["n", "mean", "m2", "low", "high"]
PAIR_FIELDS = ["pair_n", "pair_mean", "pair_m2", "pair_anchor_mean", "pair_anchor_m2", "pair_c"]


def _numeric(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if f.dataType.simpleString() in NUMERIC_TYPES]


def _squares(values: Column) -> Column:
    """Sum of squared deviations of the values that are not NULL; 0 for none."""
    return F.coalesce(F.var_pop(values) * F.count(values), F.lit(0.0))


def moments(df: DataFrame, *by: str, anchor: str | None = ANCHOR) -> DataFrame:
    """`(by..., column_name, n, mean, m2, low, high, pair_...)` of every numeric column, in one pass.

    Without a value the mean and the extremes are NULL and the sums 0. Without an anchor the
    pairs are empty.
    """
    names = [c for c in _numeric(df) if c not in by]
    aggs: list[Column] = []
    left = F.col(f"`{anchor}`").cast("double") if anchor else F.lit(None).cast("double")
    for i, name in enumerate(names):
        c = F.col(f"`{name}`").cast("double")
        both = c.isNotNull() & left.isNotNull()
        x, a = F.when(both, c), F.when(both, left)
        values = [
            F.count(c), F.avg(c), _squares(c), F.min(c), F.max(c),
            F.count(x), F.avg(x), _squares(x), F.avg(a), _squares(a),
            F.coalesce(F.covar_pop(x, a) * F.count(x), F.lit(0.0)),
        ]
        aggs += [v.alias(f"_{i}_{f}") for f, v in zip(FIELDS + PAIR_FIELDS, values)]
    row = df.groupBy(*by).agg(*aggs)
    cells = [
        F.struct(
            F.lit(name).alias("column_name"),
            *[F.col(f"_{i}_{f}").alias(f) for f in FIELDS + PAIR_FIELDS],
        )
        for i, name in enumerate(names)
    ]
    return row.select(*by, F.inline(F.array(*cells)))


def _joined(n: Column, mean: Column, other_n: Column, other_mean: Column) -> tuple[Column, Column]:
    """Mean of two sets, and the factor of the product of their mean differences."""
    total = n + other_n
    share = F.try_divide(other_n.cast("double"), total)
    away = F.coalesce(other_mean - mean, F.lit(0.0))
    merged = F.coalesce(mean + away * share, mean, other_mean)
    return merged, F.coalesce(n * share, F.lit(0.0))


def _merged(a: Column, b: Column) -> Column:
    """Moments of two sets together; a NULL mean is that of an empty set."""
    mean, factor = _joined(a["n"], a["mean"], b["n"], b["mean"])
    x, pairs = _joined(a["pair_n"], a["pair_mean"], b["pair_n"], b["pair_mean"])
    y, _ = _joined(a["pair_n"], a["pair_anchor_mean"], b["pair_n"], b["pair_anchor_mean"])

    def away(field: str) -> Column:
        return F.coalesce(b[field] - a[field], F.lit(0.0))

    return F.struct(
        (a["n"] + b["n"]).alias("n"),
        mean.alias("mean"),
        (a["m2"] + b["m2"] + away("mean") ** 2 * factor).alias("m2"),
        F.least(a["low"], b["low"]).alias("low"),
        F.greatest(a["high"], b["high"]).alias("high"),
        (a["pair_n"] + b["pair_n"]).alias("pair_n"),
        x.alias("pair_mean"),
        (a["pair_m2"] + b["pair_m2"] + away("pair_mean") ** 2 * pairs).alias("pair_m2"),
        y.alias("pair_anchor_mean"),
        (a["pair_anchor_m2"] + b["pair_anchor_m2"] + away("pair_anchor_mean") ** 2 * pairs).alias("pair_anchor_m2"),
        (a["pair_c"] + b["pair_c"] + away("pair_mean") * away("pair_anchor_mean") * pairs).alias("pair_c"),
    )


def merge_moments(parts: DataFrame, *by: str, order: str) -> DataFrame:
    """Moments of all parts together, merged in the order of `order`, one row per column (and `by`).

    What is gathered per column is one row per part, of eleven numbers.
    """
    empty = F.struct(
        *[
            F.lit(0).cast("long").alias(f)
            if f in ("n", "pair_n")
            else (F.lit(None).cast("double") if f in ("mean", "low", "high", "pair_mean", "pair_anchor_mean") else F.lit(0.0)).alias(f)
            for f in FIELDS + PAIR_FIELDS
        ]
    )
    part = F.struct(F.col(order).cast("string").alias("_order"), *FIELDS, *PAIR_FIELDS)
    gathered = parts.groupBy(*by, "column_name").agg(F.array_sort(F.collect_list(part)).alias("_parts"))
    return gathered.select(*by, "column_name", F.aggregate("_parts", empty, _merged).alias("_all")).select(
        *by, "column_name", "_all.*"
    )


def moments_profile(merged: DataFrame) -> DataFrame:
    """Count, mean, sample deviation, minimum and maximum of each column, as numbers."""
    deviation = F.when(F.col("n") > 1, F.sqrt(F.col("m2") / (F.col("n") - 1)))
    return merged.select(
        *[c for c in merged.columns if c not in (*FIELDS, *PAIR_FIELDS)],
        F.col("n").alias("count"), "mean", deviation.alias("stddev"), F.col("low").alias("min"), F.col("high").alias("max"),
    )


def moments_corr(merged: DataFrame, anchor: str = ANCHOR, skip: tuple[str, ...] = ("year",)) -> DataFrame:
    """Correlation of the anchor with every other column, as (column_name, pairs, corr)."""
    spread = F.sqrt("pair_m2") * F.sqrt("pair_anchor_m2")
    others = merged.where(~F.col("column_name").isin(anchor, *skip))
    return others.select(
        *[c for c in merged.columns if c not in (*FIELDS, *PAIR_FIELDS)],
        F.col("pair_n").alias("pairs"), F.try_divide("pair_c", spread).alias("corr"),
    )
