"""Reports of the lake tables."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from envhealth import sinks
from envhealth.plans import Lake, reports, run_daily

from test_daily_run import lake  # noqa: F401


def figures(df):
    return {r["check_name"]: r["figure"] for r in df.collect()}


def test_reports_of_a_run(spark, lake):  # noqa: F811
    paths = Lake(str(lake))
    calls = [
        lambda: reports.report_daily(spark, paths, "2024-06-01"),
        lambda: reports.report_indicators(spark, paths, 2024),
        lambda: reports.report_combined(spark, paths, "2024-06-01"),
        lambda: reports.report_published(spark, paths, "2024-06-01"),
    ]
    for call in calls:
        assert [tuple(r) for r in call().collect()] == [("exists", False, 0.0)]
    run_daily(spark, str(lake), "2024-06-01")
    daily, indicators, combined, published = (figures(call()) for call in calls)
    assert all(call().where("not passed").isEmpty() for call in calls)
    assert daily["rows"] == 1 and daily["mean_pm25"] == 15.0 and daily["stddev_pm25"] is None
    assert (indicators["numeric_rates"], indicators["rate_min"], indicators["rate_max"], indicators["rate_avg"]) == (3, 5.5, 5.5, 5.5)
    assert combined["rows"] == 2 and combined["nulls_group"] == 0 and combined["max_pm25_avg_yearly"] == 15.0
    assert published["documents"] == 2 and published["documents_2024"] == 2 and published["mean_pm25_avg_yearly"] == 15.0
    other = reports.report_published(spark, paths, "2024-07-07").where("not passed").collect()
    assert [(r["check_name"], r["figure"]) for r in other] == [("other_dates", 2.0)]


def test_failed_checks_and_one_scan(spark, tmp_path):
    paths = Lake(str(tmp_path))
    rows = [(1999, "7"), (None, "x"), (2001, "3.5")]
    sinks.write_table(spark.createDataFrame(rows, "year int, percentage string"), paths.combined, "2024-01-01")
    report = reports.report_combined(spark, paths, "2024-01-01")
    assert {r["check_name"] for r in report.where("not passed").collect()} == {"nulls_year", "min_year"}
    assert report._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1


@pytest.mark.parametrize("tolerance, passed", [(0.5, True), (0.1, False)])
def test_drift_against_the_last_stored_report(spark, tmp_path, tolerance, passed):
    path = str(tmp_path / "r")

    def report(value):
        return spark.createDataFrame([("rows", True, value), ("empty", True, None)], reports.REPORT)

    first = reports.drift(report(100.0), path, "2024-01-03", tolerance).collect()
    assert all(r["passed"] and r["before"] is None for r in first)
    reports.store_report(report(1.0), path, "2024-01-01")
    reports.store_report(report(100.0), path, "2024-01-02")
    reports.store_report(report(7.0), path, "2024-01-04")
    found = {r["check_name"]: r for r in reports.drift(report(130.0), path, "2024-01-03", tolerance).collect()}
    assert found["rows"]["passed"] is passed and found["rows"]["before"] == 100.0
    assert found["empty"]["passed"] and found["empty"]["before"] is None
    assert reports.drift(report(130.0), path, "2024-01-03").where(F.col("check_name") == "rows").count() == 1
