from __future__ import annotations

import json

from envhealth import operators as op
from envhealth import sources
from envhealth.streaming import clean_landing


def land(folder, name, value, status="ok"):
    body = {"status": status, "data": {"time": {"s": "2024-05-01 10:00:00"}, "city": {"name": "A"}, "iaqi": {"pm25": {"v": value}}}}
    (folder / f"{name}.json").write_text(json.dumps(body))


def test_each_file_is_cleaned_once(spark, tmp_path, rows):
    landing, table, state = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "state")
    landing.mkdir()

    def run():
        query = clean_landing(spark, str(landing), table, state, files_per_batch=2)
        assert query.awaitTermination(60)
        return sorted(r["pm25"] for r in spark.read.parquet(table).collect())

    for i, value in enumerate([10, "-", 5000, 20, 30]):
        land(landing, f"a{i}", value)
    land(landing, "e", 7, status="error")
    assert run() == [10.0, 20.0, 30.0]
    land(landing, "later", 40)
    assert run() == [10.0, 20.0, 30.0, 40.0]
    assert run() == [10.0, 20.0, 30.0, 40.0]

    batch = op.clean_readings(op.extract_readings(op.accept_status(sources.read_envelopes(spark, str(landing)))))
    assert rows(batch) == rows(spark.read.parquet(table))
