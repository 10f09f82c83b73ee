from __future__ import annotations

import datetime as dt
import math
import random
import statistics

import pytest
from pyspark.sql import functions as F

from envhealth import operators as op
from envhealth import schemas
from envhealth.functions import parse_rate
from envhealth.operators import rollup

NAN = math.nan
RUN = dt.date(2024, 6, 1)


def readings(spark, values):
    data = [(f"2024-05-0{d} 10:00:00", "Town", v) for d, v in values]
    return spark.createDataFrame(data, "utc_datetime string, city string, pm25_raw double")


def daily(spark, data):
    rows = [(dt.date.fromisoformat(d) if d else None, v, n, v, v) for d, v, n in data]
    return spark.createDataFrame(rows, schemas.DAILY)


def indicators(spark, years):
    data = [(y, "5.5", "g", "o", str(i)) for i, y in enumerate(years)]
    return spark.createDataFrame(data, schemas.INDICATOR)


def test_reading_bounds(spark):
    df = readings(spark, [(1, v) for v in (-0.1, 0.0, 1000.0, 1000.1, NAN, None, 5.0)])
    kept = op.clean_readings(df)
    assert kept.schema == schemas.READING
    assert sorted(r["pm25"] for r in kept.collect()) == [0.0, 5.0, 1000.0]


def test_readings_without_time_are_dropped(spark):
    data = [("garbage", "a", 1.0), (None, "b", 1.0), (" 2024-05-01 10:00\n", "\tc\r\nd ", 1.0)]
    df = spark.createDataFrame(data, "utc_datetime string, city string, pm25_raw double")
    row = op.clean_readings(df).collect()
    assert [tuple(r) for r in row] == [("2024-05-01 10:00", "c  d", 1.0, dt.date(2024, 5, 1))]


def test_cleaning_is_idempotent(spark, rows):
    once = op.clean_readings(readings(spark, [(1, 5.0), (2, 2000.0), (3, 7.0)]))
    twice = op.clean_readings(once.withColumnRenamed("pm25", "pm25_raw"))
    assert rows(once) == rows(twice)


def test_daily_stats(spark, rows):
    df = op.daily_stats(op.clean_readings(readings(spark, [(1, 1.0), (1, 4.0), (2, 3.0)])))
    assert df.schema.simpleString() == schemas.DAILY.simpleString()
    assert rows(df) == [
        (dt.date(2024, 5, 1), 2.5, 2, 1.0, 4.0),
        (dt.date(2024, 5, 2), 3.0, 1, 3.0, 3.0),
    ]


def test_merge_daily_equals_stats_of_all_readings(spark, rows):
    a = op.clean_readings(readings(spark, [(1, 1.0), (1, 4.0), (2, 3.0)]))
    b = op.clean_readings(readings(spark, [(1, 10.0), (3, 2.0)]))
    merged = op.merge_daily(op.daily_stats(a).union(op.daily_stats(b)))
    assert rows(merged) == rows(op.daily_stats(a.union(b)))


def test_yearly_stats_weigh_days_equally(spark, rows):
    df = daily(
        spark,
        [("2023-01-01", 1.0, 100), ("2023-06-01", 2.005, 2), ("2024-01-01", 9.0, 1),
         (None, 5.0, 1), ("2024-01-02", None, 0), ("2024-01-03", -1.0, 1)],
    )
    yearly = op.yearly_stats(df)
    assert yearly.schema.simpleString() == schemas.YEARLY.simpleString()
    assert rows(yearly) == [(2023, 1.5, 1.0, 2.005, 2, 51.0), (2024, 9.0, 9.0, 9.0, 1, 1.0)]


def test_yearly_stats_nan(spark):
    df = daily(spark, [("2023-01-01", NAN, 1), ("2023-01-02", 4.0, 1)])
    assert op.yearly_stats(df).first()["pm25_measurements_count"] == 2
    assert op.yearly_stats(df, drop_nan=True).first()["pm25_measurements_count"] == 1


def test_clean_indicators(spark, rows):
    data = [
        ("1999", "5", "c", "d", "g", "o"),
        ("2000", "5.", "c", "d", "\tg\n", "o "),
        ("2001.0", "12.5\n", "c", "d", "g", "o"),
        ("2002", " 5", "c", "d", "g", "o"),
        ("abc", "5", "c", "d", "g", "o"),
        (None, "5", "c", "d", "g", "o"),
        ("2003", None, "c", "d", "g", "o"),
    ]
    raw = spark.createDataFrame(data, schemas.INDICATOR_RAW)
    df = op.clean_indicators(raw)
    assert df.schema == schemas.INDICATOR
    assert rows(df) == [(2000, "5.", "g", "o", "c"), (2001, "12.5", "g", "o", "c")]
    assert [r["asthma_rate"] for r in op.clean_indicators(raw, keep_rate=True).orderBy("year").collect()] == [5.0, 12.5]


def test_clean_indicators_with_numeric_years(spark, rows, tmp_path):
    data = [(1999, "5"), (2000, "5."), (2001, "x"), (None, "5")]
    raw = spark.createDataFrame(data, "year int, percentage string").withColumns(
        {c: F.lit("t") for c in ("confidence_interval", "description", "group", "outcome_or_indicator")}
    )
    raw.write.parquet(str(tmp_path / "raw"))
    df = op.clean_indicators(spark.read.parquet(str(tmp_path / "raw")))
    assert df.schema == schemas.INDICATOR
    assert rows(df) == [(2000, "5.", "t", "t", "t")]
    assert "GreaterThanOrEqual(year,2000)" in df._jdf.queryExecution().toString()


@pytest.mark.parametrize("limit", [10_000, 0])
def test_combine_fans_out_and_drops_unmatched_years(spark, monkeypatch, limit):
    monkeypatch.setattr(rollup, "MAX_BROADCAST_YEARS", limit)
    left = daily(spark, [("2021-01-01", 1.0, 1), ("2022-01-01", 2.0, 1), ("1998-01-01", 3.0, 1), (None, 4.0, 1)])
    right = indicators(spark, [2021, 2021, 2021, 2023, 1998, None])
    df = op.combine(left, right, RUN)
    assert df.schema.simpleString() == schemas.COMBINED.simpleString()
    assert [(r["year"], r["pm25_avg_yearly"]) for r in df.collect()] == [(2021, 1.0)] * 3


def test_combine_keeps_extra_indicator_columns(spark):
    left = daily(spark, [("2021-01-01", 1.0, 1)])
    right = indicators(spark, [2021]).withColumn("asthma_rate", F.lit(5.5))
    assert op.combine(left, right, RUN).columns[-1] == "asthma_rate"


def test_year_window_follows_the_run_date(spark):
    df = indicators(spark, [1999, 2000, 2025, 2026])
    assert sorted(r["year"] for r in op.year_window(df, RUN).collect()) == [2000, 2025]


def test_common_and_distinct_keys(spark, rows):
    a, b = indicators(spark, [2020, 2020, None, 2021]), indicators(spark, [2021, 2022, None])
    assert rows(op.distinct_keys(a)) == [(2020,), (2021,)]
    assert rows(op.common_keys(a, b)) == [(2021,)]
    assert op.common_keys(a, indicators(spark, [1990])).isEmpty()


def test_coverage(spark, rows):
    assert rows(op.coverage(indicators(spark, [2020, 2020, None, 2022]))) == [(2020, 2022, 3, 2)]
    assert rows(op.coverage(indicators(spark, [2020]).limit(0))) == [(None, None, 0, 0)]


def test_rate_summary_is_numeric(spark):
    df = spark.createDataFrame([("9",), ("10",), ("x",), (None,)], "percentage string")
    assert tuple(op.rate_summary(df).first()) == (2, 9.0, 10.0, 9.5)


def test_correlation_edges(spark):
    data = [(float(i), 2.0 * i, 3.0, float(i * i) if i % 2 else None, 2000 + i) for i in range(1, 8)]
    df = spark.createDataFrame(data, "a double, b double, flat double, holes double, year int")
    out = {r["column_name"]: r for r in op.corr_vs_anchor(df, "a").collect()}
    assert set(out) == {"b", "flat", "holes"}
    assert out["b"]["corr"] == pytest.approx(1.0)
    assert out["flat"]["corr"] is None
    odd = [1.0, 3.0, 5.0, 7.0]
    assert out["holes"]["pairs"] == 4
    assert out["holes"]["corr"] == pytest.approx(statistics.correlation(odd, [x * x for x in odd]))
    one = op.corr_vs_anchor(df.limit(1), "a").collect()
    assert [r["corr"] for r in one] == [None] * 3
    assert op.corr_vs_anchor(df.select("a", "year"), "a").isEmpty()


def test_correlation_is_symmetric_and_bounded(spark):
    rng = random.Random(3)
    data = [(rng.random(), rng.random() if rng.random() > 0.2 else None) for _ in range(300)]
    df = spark.createDataFrame(data, "x double, y double")
    xy = op.corr_vs_anchor(df, "x").first()["corr"]
    yx = op.corr_vs_anchor(df, "y").first()["corr"]
    assert xy == pytest.approx(yx) and -1 <= xy <= 1


def test_profile_agrees_with_describe(spark):
    data = [(1, 2.5, "3"), (4, None, "x"), (None, 0.5, None)]
    df = spark.createDataFrame(data, "i int, d double, s string").withColumn("t", F.lit(True))
    described = {r["summary"]: r for r in df.describe().collect()}
    for row in op.profile(df).collect():
        column = row["column_name"]
        assert column != "t"
        for figure in ("count", "mean", "stddev", "min", "max"):
            value = described[figure][column]
            assert (None if row[figure] is None else str(row[figure])) == value


def test_null_profile(spark, rows):
    df = spark.createDataFrame([(1, NAN), (None, 1.0), (3, None)], "i int, d double")
    assert rows(op.null_profile(df)) == [("d", 3, 1), ("i", 3, 1)]
    assert rows(op.null_profile(df, nan_is_null=True)) == [("d", 3, 2), ("i", 3, 1)]


def test_required_columns(spark):
    df = spark.createDataFrame([(1,)], "year int")
    assert op.missing_columns(df, ["year", "percentage"]) == ["percentage"]
    with pytest.raises(ValueError, match="percentage"):
        op.require_columns(df, ["percentage"])
    assert op.require_columns(df, ["year"]) is df


def test_rejects_and_good_rows_are_the_input(spark, rows):
    df = spark.createDataFrame([("1", 1), ("x", 1), ("2", None), (None, None)], "p string, k int")
    checks = {"rate": parse_rate("p").isNotNull(), "key": F.col("k") > 0}
    good, bad = op.split_rejects(df, checks)
    assert rows(good) == [("1", 1)]
    assert sorted(r["reject_reason"] for r in bad.collect()) == ["key", "rate", "rate"]
    assert rows(good.union(bad.drop("reject_reason"))) == rows(df)
    counts = op.attrition(df, checks["rate"] & checks["key"]).first()
    assert tuple(counts) == (4, good.count(), bad.count())


def test_observed_counts_need_no_extra_job(spark):
    df, seen = op.observed(spark.range(10), "ten", even=F.count_if(F.col("id") % 2 == 0))
    df.write.format("noop").mode("overwrite").save()
    assert seen.get == {"rows": 10, "even": 5}
    assert op.require_rows(seen, "ten") == 10
    empty, none = op.observed(spark.range(0), "none")
    empty.write.format("noop").mode("overwrite").save()
    with pytest.raises(ValueError, match="no rows"):
        op.require_rows(none, "none")


def test_validate(spark):
    checks = lambda years: {
        r["check_name"]: (r["passed"], r["value"])
        for r in op.validate(indicators(spark, years), 2000, 2025).collect()
    }
    assert checks([2000, 2025]) == {
        "rows": (True, 2), "nulls_year": (True, 0), "min_year": (True, 2000), "max_year": (True, 2025),
    }
    failed = checks([1999, None, 2026])
    assert [passed for passed, _ in failed.values()] == [True, False, False, False]
    empty = op.validate(indicators(spark, [2000]).limit(0), 2000, 2025).collect()
    assert [r["passed"] for r in empty] == [False, True, False, False]


def test_stage_counts(spark):
    df = op.normalize_readings(readings(spark, [(1, 1.0), (1, 5000.0), (2, 9000.0), (3, 2.0)]))
    assert tuple(op.stage_counts(df, F.col("pm25") <= 1000).first()) == (4, 2, 2, 1)


def test_sorted_preview_breaks_ties(spark):
    df = spark.createDataFrame([(2, "a"), (1, "z"), (1, "b"), (3, "c")], "year int, v string")
    assert [tuple(r) for r in op.sorted_preview(df, "year", n=3).collect()] == [(1, "b"), (1, "z"), (2, "a")]
