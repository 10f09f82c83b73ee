from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from envhealth import operators as op
from envhealth import sinks
from envhealth.plans import (
    Busy,
    Lake,
    Ledger,
    combine_job,
    daily_run,
    history_profile,
    indicators_job,
    readings_job,
    run_daily,
    validate_combined,
    validate_daily,
    validate_indicators,
    validate_published,
)


def land(root, day, values, time=None, name="waqi"):
    folder = root / "raw" / "air_quality" / f"date={day}"
    folder.mkdir(parents=True, exist_ok=True)
    for i, v in enumerate(values):
        body = {"status": "ok", "data": {"time": {"s": f"{time or day} 10:00:00"}, "city": {"name": "A"}, "iaqi": {"pm25": {"v": v}}}}
        text = v if isinstance(v, str) else json.dumps(body)
        (folder / f"{name}_{i}.json").write_text(text)


def land_indicators(root, year, years, percentage="5.5"):
    folder = root / "raw" / "hospitalizations" / f"year={year}"
    folder.mkdir(parents=True, exist_ok=True)
    records = [{"year": str(y), "percentage": percentage, "group": f"g{i}", "outcome_or_indicator": "o",
                "confidence_interval": "c", "description": "d"} for i, y in enumerate(years)]
    (folder / "asthma_rate.json").write_text("\n".join(map(json.dumps, records)))


@pytest.fixture
def lake(tmp_path):
    land(tmp_path, "2024-05-31", [10.0, 20.0])
    land(tmp_path, "2024-06-01", [40.0, '{"status": "error", "data": "x"}', '{"status"'])
    land_indicators(tmp_path, 2024, [2024, 2024, 2023])
    return tmp_path


def published(spark, root):
    return sinks.read_current(spark, Lake(str(root)).documents)


def test_two_dates_and_a_rerun(spark, lake, rows):
    root = str(lake)
    first = run_daily(spark, root, "2024-06-01", scope="day")
    assert first == {
        "readings": 2, "rejected_readings": 0, "valid_readings": 2, "days": 1, "indicators": 3, "corrupt_indicators": 0,
        "rejected_indicators": 0, "valid_indicators": 3, "combined": 2, "first_year": 2024, "last_year": 2024, "replaced": 0, "documents": 2, "dropped": 0,
    }
    assert {r["pm25_avg_yearly"] for r in published(spark, lake).collect()} == {15.0}

    second = run_daily(spark, root, "2024-06-02")
    assert second["rejected_readings"] == 2 and second["replaced"] == 2
    # Both days count once each: the mean of 15 and 40.
    after = published(spark, lake)
    assert {r["pm25_avg_yearly"] for r in after.collect()} == {27.5}
    assert sorted(r["_id"] for r in after.collect()) == ["2024-06-02_0", "2024-06-02_1"]
    combined = spark.read.parquet(Lake(root).combined)
    assert combined.groupBy("run_date").count().count() == 2
    rejects = spark.read.parquet(Lake(root).rejects)
    assert sorted(r["reject_reason"] for r in rejects.collect()) == ["malformed", "status"]

    (lake / "raw" / "air_quality" / "date=2024-06-01" / "waqi_2.json").unlink()
    (lake / "raw" / "air_quality" / "date=2024-06-01" / "waqi_1.json").unlink()
    second = {**second, "readings": 1, "rejected_readings": 0}
    before = rows(after)
    assert run_daily(spark, root, "2024-06-02") == {**second, "replaced": 2}
    assert rows(published(spark, lake)) == before
    assert spark.read.parquet(Lake(root).rejects).isEmpty()


def test_scope_day_uses_only_the_day_before(spark, lake):
    run_daily(spark, str(lake), "2024-06-01")
    run_daily(spark, str(lake), "2024-06-02", scope="day")
    assert {r["pm25_avg_yearly"] for r in published(spark, lake).collect()} == {40.0}
    with pytest.raises(ValueError, match="scope"):
        combine_job(spark, Lake(str(lake)), "2024-06-02", scope="week")


def test_late_readings_join_their_day(spark, lake):
    land(lake, "2024-06-02", [30.0], time="2024-05-31")
    for day in ("2024-06-01", "2024-06-02", "2024-06-03"):
        run_daily(spark, str(lake), day)
    # 2024-05-31 has 10, 20 and the late 30; 2024-06-01 has 40.
    row = published(spark, lake).first()
    assert row["pm25_measurements_count"] == 2 and row["pm25_avg_yearly"] == 30.0


def test_missing_and_empty_inputs(spark, lake):
    paths = Lake(str(lake))
    with pytest.raises(FileNotFoundError):
        readings_job(spark, paths, "2024-07-01")
    with pytest.raises(FileNotFoundError):
        indicators_job(spark, paths, "2030-01-01")
    land(lake, "2024-06-02", [5000.0])
    with pytest.raises(ValueError, match="no rows"):
        readings_job(spark, paths, "2024-06-03")
    land_indicators(lake, 2025, [2025], percentage="n/a")
    with pytest.raises(ValueError, match="no rows"):
        indicators_job(spark, paths, "2025-01-01")


def test_no_common_year(spark, lake):
    land_indicators(lake, 2024, [2019])
    with pytest.raises(ValueError, match="no common year"):
        run_daily(spark, str(lake), "2024-06-01")


def test_published_documents_can_be_searched(spark, lake):
    run_daily(spark, str(lake), "2024-06-01", "2024-06-01 09:00:00")
    docs = published(spark, lake)
    assert op.search(docs, F.col("group") == "g1").first()["data_source"] == "combined_2024-06-01"
    assert [tuple(r) for r in op.search_facets(docs).collect()] == [
        ("all", None, 2, 15.0),
        ("term", "2024", 2, None),
    ]
    checks = op.validate(docs, *op.year_bounds("2024-06-01")).collect()
    assert all(r["passed"] for r in checks)


def test_validators(spark, lake):
    paths = Lake(str(lake))
    calls = [
        lambda: validate_daily(spark, paths, "2024-06-01"),
        lambda: validate_indicators(spark, paths, 2024),
        lambda: validate_combined(spark, paths, "2024-06-01"),
        lambda: validate_published(spark, paths, "2024-06-01"),
    ]
    for call in calls:
        assert [tuple(r) for r in call().collect()] == [("exists", False, 0)]
    run_daily(spark, str(lake), "2024-06-01")
    reports = [{r["check_name"]: r["value"] for r in call().where("passed").collect()} for call in calls]
    assert reports[0] == {"exists": 1, "days": 1}
    assert reports[1] == {"exists": 1, "rows": 3, "numeric_rates": 3}
    assert reports[2]["rows"] == 2 and reports[2]["min_year"] == 2024 and reports[2]["nulls_group"] == 0
    assert reports[3]["documents"] == 2 and reports[3]["other_dates"] == 0 and reports[3]["bytes"] > 0
    other = validate_daily(spark, paths, "2024-07-07").collect()
    assert [(r["check_name"], r["passed"]) for r in other] == [("exists", False)]
    foreign = validate_published(spark, paths, "2024-07-07").where("not passed").collect()
    assert [(r["check_name"], r["value"]) for r in foreign] == [("other_dates", 2)]


def test_plain_folders_with_other_files(spark, tmp_path):
    land(tmp_path, "2024-05-31", [10.0])
    land_indicators(tmp_path, 2024, [2024])
    raw = tmp_path / "raw"
    (raw / "air_quality" / "date=2024-05-31").rename(raw / "air_quality" / "2024-05-31")
    (raw / "hospitalizations" / "year=2024").rename(raw / "hospitalizations" / "2024")
    (raw / "hospitalizations" / "2024" / "asthma_data.csv").write_text("year,percentage\n2024,7\n")
    plain = Lake(str(tmp_path), "raw/air_quality/{day}", "raw/hospitalizations/{year}")
    report = run_daily(spark, plain, "2024-06-01")
    assert report["indicators"] == 1 and report["corrupt_indicators"] == 0
    assert report["documents"] == 1


def test_broken_indicator_file_does_not_stop_the_run(spark, lake):
    folder = lake / "raw" / "hospitalizations" / "year=2024"
    (folder / "broken.json").write_text('[{"year": "2024"')
    report = run_daily(spark, str(lake), "2024-06-01")
    assert report["corrupt_indicators"] == 1 and report["valid_indicators"] == 3


REJECTS = [
    '{"status": "ok", "data": "text"}',
    '{"status": "ok", "data": {"time": {"s": "2024-05-31 10:00:00"}, "city": "text", "iaqi": {"pm25": {"v": 5}}}}',
    '{"status": "error", "data": "x"}',
    '{"status": "ok", "data": {"time": {"s": "2024-05-31',
    '{"status": "ok", "data": {"time": {"s": "never"}, "iaqi": {"pm25": {"v": 5}}}}',
    '{"status": "ok", "data": {"time": {"s": "2024-05-31 10:00:00"}, "iaqi": {"pm25": {"v": "-"}}}}',
    '{"status": "ok", "data": {"time": {"s": "2024-05-31 10:00:00"}, "iaqi": {"pm25": {"v": 1000.5}}}}',
]


@pytest.mark.parametrize("good", [0, 1])
def test_every_landed_reading_is_valid_or_rejected(spark, tmp_path, good):
    land(tmp_path, "2024-05-31", [10.0] * good + [r for r in REJECTS if good or '"city": "text"' not in r])
    lake = Lake(str(tmp_path))
    if good:
        report = readings_job(spark, lake, "2024-06-01")
        # The bad city costs nothing that is used.
        assert (report["readings"], report["valid_readings"], report["rejected_readings"]) == (8, 2, 6)
    else:
        with pytest.raises(ValueError, match="no rows"):
            readings_job(spark, lake, "2024-06-01")
    rejects = spark.read.parquet(lake.rejects).groupBy("reject_reason").count().collect()
    assert dict(map(tuple, rejects)) == {"malformed": 2, "status": 1, "date": 1, "value": 1, "bounds": 1}


def test_every_landed_indicator_is_valid_or_rejected(spark, tmp_path):
    land_indicators(tmp_path, 2024, [2024, 2023, 1999, "soon"])
    folder = tmp_path / "raw" / "hospitalizations" / "year=2024"
    (folder / "more.json").write_text('{"year": "2024", "percentage": "5%"}\n{"year": "2024"\n{"year": "2024"}')
    lake = Lake(str(tmp_path))
    report = indicators_job(spark, lake, "2024-06-01")
    assert (report["indicators"], report["valid_indicators"], report["rejected_indicators"]) == (7, 2, 5)
    rejects = spark.read.parquet(lake.indicator_rejects).groupBy("reject_reason").count().collect()
    assert dict(map(tuple, rejects)) == {"malformed": 1, "year": 2, "rate": 2}


def test_required_columns_that_no_record_has(spark, tmp_path):
    folder = tmp_path / "raw" / "hospitalizations" / "year=2024"
    folder.mkdir(parents=True)
    (folder / "asthma_rate.json").write_text('{"year": "2024", "rate": "5"}\n{"year": "2023"}')
    with pytest.raises(ValueError, match="missing columns: .'percentage'"):
        indicators_job(spark, Lake(str(tmp_path)), "2024-06-01")


def test_empty_tables_are_told_apart(spark, lake):
    run_daily(spark, str(lake), "2024-06-01")
    paths = Lake(str(lake))
    for table, what in ((paths.daily, "daily readings"), (paths.indicators, "indicators")):
        part = "run_date=2024-06-01" if what == "daily readings" else "ingest_year=2024"
        full = spark.read.parquet(f"{table}/{part}")
        full.where("false").write.mode("overwrite").parquet(f"{table}/{part}")
        with pytest.raises(ValueError, match=f"no rows: {what}"):
            combine_job(spark, paths, "2024-06-01", scope="day")
        run_daily(spark, str(lake), "2024-06-01")


def test_history_gives_the_figures_of_all_rows(spark, lake, rows):
    land(lake, "2024-06-02", [30.0], time="2024-05-31")
    land(lake, "2024-06-03", [7.0], time="2023-05-31")
    root = str(lake)
    for day in ("2024-06-01", "2024-06-02", "2024-06-03", "2024-06-04"):
        run_daily(spark, root, day, scope="history")
    found = rows(published(spark, lake))
    assert len(found) == 3
    run_daily(spark, root, "2024-06-04", scope="all")
    assert rows(published(spark, lake)) == found
    combined = spark.read.parquet(Lake(root).combined).drop("run_date")
    profile = {r["column_name"]: r["count"] for r in history_profile(spark, Lake(root).moments).collect()}
    assert profile["pm25_avg_yearly"] == combined.count()


def test_a_crashed_run_is_resumed(spark, lake, monkeypatch):
    calls = []
    real = daily_run.publish_job

    def lost(*args):
        calls.append("publish")
        if len(calls) < 3:
            raise RuntimeError("lost")
        return real(*args)

    monkeypatch.setattr(daily_run, "publish_job", lost)
    with pytest.raises(RuntimeError, match="lost"):
        run_daily(spark, str(lake), "2024-06-01")
    monkeypatch.setattr(daily_run, "readings_job", lambda *args: calls.append("readings"))
    report = run_daily(spark, str(lake), "2024-06-01", resume=True)
    assert calls == ["publish"] * 3 and report["readings"] == 2 and report["documents"] == 2
    ledger = Ledger(spark, Lake(str(lake)).ledger, "2024-06-01")
    assert ledger.holder() is None and set(ledger.finished()) == {"readings", "indicators", "combine", "publish"}
    other = Ledger(spark, Lake(str(lake)).ledger, "2024-06-01")
    other.claim()
    with pytest.raises(Busy):
        run_daily(spark, str(lake), "2024-06-01")


def test_counts_of_a_job_whose_task_died_once(lake):
    """In a session whose tasks may fail: the report counts every record once."""
    import subprocess
    import sys
    from pathlib import Path

    code = f"""
import os, sys
sys.path.insert(0, {str(Path(__file__).parent.parent)!r})
os.environ["PYTHONPATH"] = sys.path[0]
from pyspark.sql import SparkSession
from envhealth.plans import Lake, daily_run
spark = SparkSession.builder.master("local[2,3]").config("spark.ui.enabled", "false").getOrCreate()
real = daily_run.judge_readings

def dying(envelopes):
    judged = real(envelopes)
    def run(batches):
        for batch in batches:
            yield batch
        try:
            os.close(os.open({str(lake)!r} + "/died", os.O_CREAT | os.O_EXCL))
        except FileExistsError:
            return
        os._exit(1)
    return judged.mapInArrow(run, judged.schema)

daily_run.judge_readings = dying
print(daily_run.readings_job(spark, Lake({str(lake)!r}), "2024-06-02"))
"""
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=180)
    expected = {"readings": 3, "rejected_readings": 2, "valid_readings": 1, "days": 1}
    assert done.stdout.strip() == str(expected), done.stderr[-2000:]
    assert (lake / "died").exists()
