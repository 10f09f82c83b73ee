from __future__ import annotations

import json

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from envhealth import operators as op
from envhealth import sources


def envelope(v=None, time="2024-05-01 10:00:00", city="Town A", status="ok"):
    iaqi = {} if v is None else {"pm25": {"v": v}}
    return {"status": status, "data": {"time": {"s": time}, "city": {"name": city}, "iaqi": iaqi}}


@pytest.fixture
def landing(tmp_path):
    files = {
        "good.json": json.dumps(envelope(42), indent=2),
        "text_number.json": json.dumps(envelope("17.5")),
        "missing.json": json.dumps(envelope()),
        "dash.json": json.dumps(envelope("-")),
        "error.json": json.dumps({"status": "error", "data": "no such station"}),
        "broken.json": '{"status": "ok", "data": {',
    }
    for name, text in files.items():
        (tmp_path / name).write_text(text)
    return str(tmp_path)


def test_envelopes_one_object_per_file(spark, landing, rows):
    landed = sources.read_envelopes(spark, landing, multi_line=True)
    assert landed.count() == 6
    readings = op.extract_readings(op.accept_status(landed))
    assert sorted(str(r["pm25_raw"]) for r in readings.collect()) == ["-", "17.5", "42", "None"]
    cleaned = op.clean_readings(readings)
    assert sorted(r["pm25"] for r in cleaned.collect()) == [17.5, 42.0]


def test_landing_report(spark, landing):
    row = sources.landing_report(sources.read_envelopes(spark, landing, multi_line=True)).first()
    assert row.asDict() == {"records": 6, "corrupt": 2, "with_data": 4, "accepted": 4}


def test_strict_read_fails_on_broken_file(spark, landing):
    with pytest.raises(Exception, match="MALFORMED|FAILFAST|Malformed"):
        sources.read_envelopes(spark, landing, multi_line=True, strict=True).collect()


def test_record_array(spark, tmp_path, rows):
    (tmp_path / "a.json").write_text('[{"year": 2019, "percentage": 5.50}, {"year": "2020"}]')
    (tmp_path / "b.json").write_text('[{"year":"2019"')
    good, corrupt = sources.split_corrupt(sources.read_records(spark, str(tmp_path)))
    assert rows(good.select("year", "percentage")) == [("2019", "5.50"), ("2020", None)]
    assert [r["_corrupt_record"] for r in corrupt.select("_corrupt_record", "year").collect()] == [
        '[{"year":"2019"'
    ]


def test_csv_columns_by_name(spark, tmp_path, rows):
    (tmp_path / "drop.csv").write_text(
        'group,year,percentage,other\n"Total, all",2020,5.5,x\n"say ""hi""",2021,,y\n'
    )
    df = sources.read_csv_drop(spark, str(tmp_path))
    assert df.columns[:2] == ["year", "percentage"]
    assert rows(df.select("year", "percentage", "group", "description")) == [
        ("2020", "5.5", "Total, all", None),
        ("2021", None, 'say "hi"', None),
    ]


def test_csv_lines_with_other_numbers_of_fields(spark, tmp_path, rows):
    lines = ["year,percentage,group", "2020,5.5,a", "2020,5.5,b,EXTRA", "2021", "", "2022,,c"]
    (tmp_path / "drop.csv").write_text("\n".join(lines))
    good, bad = sources.split_corrupt(sources.read_csv_drop(spark, str(tmp_path)))
    assert rows(good.select("year", "group")) == [("2020", "a"), ("2022", "c")]
    assert sorted(r["_corrupt_record"] for r in bad.select("year", "_corrupt_record").collect()) == ["2020,5.5,b,EXTRA", "2021"]
    assert len(good.collect()) + len(bad.collect()) == 4


def test_a_cluster_needs_a_shared_folder():
    from types import SimpleNamespace

    from envhealth.checkpoints import shared_dir

    def session(master, named=None):
        context = SimpleNamespace(master=master, getCheckpointDir=lambda: None, setCheckpointDir=lambda _: None)
        return SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda *_: named))

    for master in ("yarn", "spark://host:7077", "local-cluster[2,1,1024]"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            shared_dir(session(master))
        assert shared_dir(session(master, "hdfs:///shared")) == "hdfs:///shared"
    assert shared_dir(session("local[8]")) and shared_dir(session("local"))


def test_csv_files_with_other_headers_fail(spark, tmp_path):
    (tmp_path / "a.csv").write_text("year,percentage\n2020,5.5\n")
    (tmp_path / "b.csv").write_text("percentage,year\n6.5,2021\n")
    with pytest.raises(Exception, match="header|HEADER"):
        sources.read_csv_drop(spark, str(tmp_path)).collect()


def test_footprint_and_gate(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a.json").write_bytes(b"12345")
    (folder / "b.json").write_bytes(b"")
    row = sources.footprint(spark, str(folder)).first().asDict()
    assert row == {"files": 1, "bytes": 5}
    assert sources.require_input(spark, str(folder)) == 5
    with pytest.raises(FileNotFoundError):
        sources.require_input(spark, str(tmp_path / "absent"))
    (folder / "a.json").write_bytes(b"")
    with pytest.raises(ValueError, match="empty"):
        sources.require_input(spark, str(folder))


def test_read_table_prunes_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(6).withColumn("run_date", F.expr("date_add(date'2024-01-01', cast(id % 3 as int))"))
    df.write.partitionBy("run_date").parquet(path)
    day = sources.read_table(spark, path, "2024-01-02")
    assert sorted(r["id"] for r in day.collect()) == [1, 4]
    assert day.schema == spark.read.parquet(path).schema
    assert {f.split("/")[-2] for f in day.inputFiles()} == {"run_date=2024-01-02"}
    before = sources.read_table(spark, path, "2024-01-02", up_to=True)
    assert "PartitionFilters: [isnotnull(run_date" in before._jdf.queryExecution().toString()
    assert before.count() == 4
    assert sources.read_table(spark, path).count() == 6
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        sources.read_table(spark, path, "2024-01-09")


def test_landing_query_text_comparison_and_limit(spark):
    schema = "year string, location_name string, value string, unit string, data_value_type string"
    data = [("2019", "New York", "1", "u", "a"), ("2024", "New York", "2", "u", "a"),
            ("2024", "Utah", "3", "u", "a"), ("2018", "New York", "4", "u", "a"),
            ("2023", "New York", "5", "u", "a"), (None, "New York", "6", "u", "a")]
    df = spark.createDataFrame(data, schema)
    found = sources.landing_query(df, "New York", "2024-06-01")
    assert [r["value"] for r in found.collect()] == ["2", "5", "1"]
    assert [r["value"] for r in sources.landing_query(df, "New York", "2024-06-01", limit=1).collect()] == ["2"]


def test_positions_follow_files_and_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(0, 1000, 1, 7).write.parquet(path)
    df = sources.read_positioned(spark, path)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    found = {r["_position"]: r["id"] for r in df.collect()}
    assert sorted(found) == list(range(1000))
    # Files of a range are in order, so positions are the values themselves.
    assert all(position == value for position, value in found.items())
