"""Stored moments against the same figures of all rows."""

from __future__ import annotations

import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from envhealth import operators as op
from envhealth import sinks, sources
from envhealth.plans import history


def close(a, b):
    if a is None or b is None:
        return a is b
    return a == b or (isinstance(a, float) and (math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-9) or (math.isnan(a) and math.isnan(b))))


def same(left, right):
    assert len(left) == len(right)
    for a, b in zip(left, right):
        assert len(a) == len(b) and all(close(x, y) for x, y in zip(a, b)), (a, b)


def table(spark, path, days, seed=0):
    """Rows of several runs with a large offset, NULLs, and columns without a value."""
    draw = random.Random(seed)
    for day in days:
        rows = [
            (1e4 + draw.random(), draw.choice([None, draw.gauss(3, 1)]), draw.randrange(5), None, "t")
            for _ in range(draw.randrange(0, 40))
        ]
        schema = "pm25_avg_yearly double, x double, k int, empty double, name string"
        df = spark.createDataFrame(rows, schema)
        if rows:
            sinks.write_table(df, path, day)


def test_merged_moments_equal_those_of_all_rows(spark, tmp_path, rows):
    path, stored = str(tmp_path / "t"), str(tmp_path / "m")
    days = [f"2024-01-{d:02d}" for d in range(1, 9)]
    table(spark, path, days)

    def check():
        all_rows = sources.read_table(spark, path).drop("run_date")
        found = history.history_profile(spark, stored).select("column_name", "count", "mean", "stddev", "min", "max")
        whole = op.profile(all_rows).where("column_name != 'name'")
        whole = whole.withColumns({c: F.col(c).cast("double") for c in ("min", "max")})
        same(rows(found), rows(whole))
        same(rows(history.history_corr(spark, stored).where("corr is not null")), rows(op.corr_vs_anchor(all_rows).where("corr is not null")))

    written = [d for d in days if (tmp_path / "t" / f"run_date={d}").exists()]
    for day in written:
        history.store_rows(spark, path, stored, day)
    check()
    table(spark, path, written[2:3], seed=9)  # a replaced day
    history.store_rows(spark, path, stored, written[2])
    check()


def test_moments_by_group_equal_aggregates(spark):
    draw = random.Random(2)
    data = [(draw.choice("ab"), draw.randrange(4), draw.choice([None, draw.random()]), draw.random()) for _ in range(300)]
    df = spark.createDataFrame(data, "g string, run int, x double, y double")
    parts = [op.moments(df.where(F.col("run") == i).drop("run"), "g", anchor="y").withColumn("run", F.lit(i)) for i in range(4)]
    union = parts[0].union(parts[1]).union(parts[2]).union(parts[3])
    merged = op.merge_moments(union, "g", order="run")
    corr = {(r["g"], r["column_name"]): r["corr"] for r in op.moments_corr(merged, anchor="y").collect()}
    for r in df.groupBy("g").agg(F.corr("x", "y").alias("c"), F.stddev_samp("x").alias("s")).collect():
        assert close(corr[(r["g"], "x")], r["c"])
        deviation = op.moments_profile(merged).where((F.col("g") == r["g"]) & (F.col("column_name") == "x")).first()
        assert close(deviation["stddev"], r["s"])


@pytest.mark.parametrize("crossing", [False, True])
def test_yearly_figures_from_stored_moments(spark, tmp_path, rows, crossing):
    daily, stored = str(tmp_path / "d"), str(tmp_path / "m")
    draw = random.Random(3)
    start = dt.date(2022, 12, 1)
    for run in range(5):
        first = start + dt.timedelta(days=30 * run - (3 if crossing and run == 2 else 0))
        days = [(first + dt.timedelta(days=i), draw.random() * 50, draw.randrange(1, 9)) for i in range(30)]
        frame = spark.createDataFrame([(d, v, n, v - 1, v + 1) for d, v, n in days], "date date, pm25 double, measurements_count long, pm25_min double, pm25_max double")
        sinks.write_table(frame, daily, f"2024-01-0{run + 1}")
        history.store_days(spark, daily, stored, f"2024-01-0{run + 1}")
    assert history.crossing_years(sources.read_table(spark, stored)) == ([2023] if crossing else [])
    whole = op.yearly_stats(op.merge_daily(sources.read_table(spark, daily).drop("run_date")))
    same(rows(history.history_years(spark, daily, stored)), rows(whole))
    early = sources.read_table(spark, daily, "2024-01-02", up_to=True)
    same(rows(history.history_years(spark, daily, stored, "2024-01-02")), rows(op.yearly_stats(op.merge_daily(early.drop("run_date")))))


def test_moments_of_nothing(spark):
    empty = spark.createDataFrame([], "pm25_avg_yearly double, x double")
    merged = op.merge_moments(op.moments(empty).withColumn("run", F.lit(1)), order="run")
    assert sorted((r["column_name"], r["count"], r["mean"], r["stddev"]) for r in op.moments_profile(merged).collect()) == [
        ("pm25_avg_yearly", 0, None, None), ("x", 0, None, None),
    ]
    assert [tuple(r) for r in op.moments_corr(merged).collect()] == [("x", 0, None)]
