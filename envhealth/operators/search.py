"""Search over the document table: hits, totals, top terms and facets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import ANCHOR, SEARCH_SIZE, TERMS_SIZE, YEAR
from .documents import ID


def _hits(df: DataFrame, where: Column | None) -> DataFrame:
    return df if where is None else df.where(where)


def search(
    df: DataFrame,
    where: Column | None = None,
    size: int = SEARCH_SIZE,
    order: list[Column] | None = None,
) -> DataFrame:
    """The first `size` hits, newest year first; `_id` breaks ties."""
    order = order or [F.desc_nulls_last(YEAR), F.asc(ID)]
    return _hits(df, where).orderBy(*order).limit(size)


def search_total(df: DataFrame, where: Column | None = None) -> DataFrame:
    return _hits(df, where).agg(F.count(F.lit(1)).alias("total"))


def terms_topk(df: DataFrame, field: str = YEAR, size: int = TERMS_SIZE) -> DataFrame:
    """Most frequent values of a field; equal counts are ordered by value."""
    counts = df.where(F.col(field).isNotNull()).groupBy(field)
    return (
        counts.agg(F.count(F.lit(1)).alias("doc_count"))
        .orderBy(F.desc("doc_count"), F.asc(field))
        .limit(size)
    )


def search_facets(
    df: DataFrame,
    field: str = YEAR,
    metric: str = ANCHOR,
    where: Column | None = None,
    size: int = TERMS_SIZE,
) -> DataFrame:
    """Total hits with the mean of `metric`, and the top terms of `field`, from one pass.

    The rows (facet, term, doc_count, avg_metric) are 'all' once, also without a hit, and
    'term' up to `size` times. Totals are taken from one row per term, not from the hits.
    """
    per_term = (
        _hits(df, where)
        .groupBy(field)
        .agg(
            F.count(F.lit(1)).alias("_n"),
            F.sum(metric).alias("_sum"),
            F.count(metric).alias("_count"),
        )
    )
    total = per_term.agg(
        F.lit("all").alias("facet"),
        F.lit(None).cast("string").alias("term"),
        F.coalesce(F.sum("_n"), F.lit(0)).alias("doc_count"),
        F.try_divide(F.sum("_sum"), F.sum("_count")).alias("avg_metric"),
    )
    top = (
        per_term.where(F.col(field).isNotNull())
        .orderBy(F.desc("_n"), F.asc(field))
        .limit(size)
        .select(
            F.lit("term").alias("facet"),
            F.col(field).cast("string").alias("term"),
            F.col("_n").alias("doc_count"),
            F.lit(None).cast("double").alias("avg_metric"),
        )
    )
    return total.unionByName(top)
