"""Versioned document sets, and pages of hits with their total."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from envhealth import operators as op
from envhealth import sinks


def documents(spark, n, first=0):
    year = (F.lit(2000) + F.col("id") % 20).cast("int").alias("year")
    return spark.range(first, first + n).select(F.format_string("d_%03d", "id").alias("_id"), year)


def ids(df):
    return sorted(r["_id"] for r in df.collect())


@pytest.mark.parametrize("form", ["parquet", "json"])
def test_a_refresh_replaces_the_set(spark, tmp_path, form):
    path = str(tmp_path)
    with pytest.raises(ValueError, match="nothing is published"):
        sinks.read_current(spark, path)
    assert sinks.refresh(documents(spark, 20), path, form) == {"replaced": 0, "documents": 20}
    opened = sinks.read_current(spark, path)
    assert sinks.refresh(documents(spark, 7, 50), path, form) == {"replaced": 20, "documents": 7}
    assert ids(sinks.read_current(spark, path)) == [f"d_{i:03d}" for i in range(50, 57)]
    assert len(ids(opened)) == 20  # a reader of the set before goes on


def test_a_failed_refresh_leaves_the_old_set(spark, tmp_path):
    path = str(tmp_path)
    sinks.refresh(documents(spark, 5), path)
    bad = documents(spark, 5).withColumn("year", F.raise_error(F.lit("lost")).cast("int"))
    with pytest.raises(Exception, match="lost"):
        sinks.refresh(bad, path)
    assert len(ids(sinks.read_current(spark, path))) == 5
    assert sinks.refresh(documents(spark, 6), path) == {"replaced": 5, "documents": 6}


def test_old_versions_are_removed_later(spark, tmp_path):
    path = str(tmp_path)
    for n in (1, 2, 3, 4):
        sinks.refresh(documents(spark, n), path)
    with pytest.raises(ValueError):
        sinks.remove_old(spark, path, keep=0)
    removed = sinks.remove_old(spark, path, keep=2)
    assert len(removed) == 2 and not any((tmp_path / f).exists() for f in removed)
    assert len(ids(sinks.read_current(spark, path))) == 4
    assert sinks.remove_old(spark, path, keep=2) == []


SCHEMA = "_id string, year int, value double, day date"


def rows_of(n, seed):
    draw = random.Random(seed)
    values = [None, float("nan"), 1.5, -2.0, 0.0]
    return [
        (f"é{i:04d}", draw.choice([None, 2020, 2021, 2022]), draw.choice(values), draw.choice([None, dt.date(2020, 1, draw.randrange(1, 5))]))
        for i in range(n)
    ]


def page(df, **options):
    found = op.search_page(df, **options).orderBy("rank").collect()
    return found[0]["total"], [r["hit"]["_id"] for r in found if r["hit"] is not None], [r["rank"] for r in found]


@pytest.mark.parametrize("tasks", [1, 7])
@pytest.mark.parametrize("size", [0, 1, 10, 500])
def test_pages_equal_hits_and_total(spark, tasks, size):
    df = spark.createDataFrame(rows_of(200, 1), SCHEMA).repartition(tasks)
    where = F.col("year") >= 2021
    total, hits, ranks = page(df, where=where, size=size)
    assert total == op.search_total(df, where).first()["total"]
    assert hits == [r["_id"] for r in op.search(df, where, size).collect()]
    assert ranks == (list(range(1, len(hits) + 1)) or [None])
    order = [("value", True), ("day", False), ("_id", True)]
    columns = [F.desc_nulls_last("value"), F.asc_nulls_last("day"), F.desc("_id")]
    assert page(df, size=size, order=order)[1] == [r["_id"] for r in op.search(df, None, size, columns).collect()]


def test_pages_without_a_hit(spark):
    df = spark.createDataFrame(rows_of(5, 2), SCHEMA)
    assert page(df, where=F.lit(False)) == (0, [], [None])
    assert page(df.limit(0)) == (0, [], [None])


def test_a_page_scans_once(spark, tmp_path):
    documents(spark, 100).write.parquet(str(tmp_path / "d"))
    plan = op.search_page(spark.read.parquet(str(tmp_path / "d")), F.col("year") == 2003)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("FileScan") == 1 and "PushedFilters: [IsNotNull(year), EqualTo(year,2003)]" in text
