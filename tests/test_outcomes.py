"""The stream that keeps rejects, and deliveries with an outcome for every document."""

from __future__ import annotations

import json

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from envhealth import operators as op
from envhealth import sinks, sources
from envhealth.streaming import land_readings, landed_readings, landed_rejects, outcomes


def envelope(value, status="ok", day="2024-05-01 10:00:00", city="A"):
    body = {"time": {"s": day}, "city": {"name": city}, "iaqi": {"pm25": {"v": value}}}
    return json.dumps({"status": status, "data": body})


LANDED = [envelope(10), '{"status": "ok", "data":', envelope(5000), envelope(7, "error"), envelope(8, day="soon"), envelope("-")]
REASONS = ["bounds", "date", "malformed", "status", "value"]


def state(spark, table):
    good = sorted(r["pm25"] for r in landed_readings(spark, table).collect())
    return good, sorted((r["reject_reason"], r["record"]) for r in landed_rejects(spark, table).collect())


def test_every_landed_record_is_a_reading_or_a_reject(spark, tmp_path, rows):
    landing, table = tmp_path / "in", str(tmp_path / "out")
    landing.mkdir()
    (landing / "a.json").write_text("\n".join(LANDED))

    def run():
        assert land_readings(spark, str(landing), table, str(tmp_path / "state")).awaitTermination(60)
        return state(spark, table)

    good, rejects = run()
    assert good == [10.0] and [r for r, _ in rejects] == REASONS
    assert dict(rejects)["malformed"] == LANDED[1]
    assert json.loads(dict(rejects)["bounds"])["data"]["iaqi"]["pm25"]["v"] == "5000"
    assert run() == (good, rejects)
    (landing / "b.json").write_text("\n".join(LANDED[:2]))
    good, rejects = run()
    assert len(good) == 2 and len(rejects) == 6
    batch = op.clean_readings(op.extract_readings(op.accept_status(sources.read_envelopes(spark, str(landing)))))
    assert rows(batch) == rows(landed_readings(spark, table))


@pytest.mark.parametrize("when", ["before", "after"])
def test_a_batch_that_failed_is_written_once(spark, tmp_path, monkeypatch, when):
    landing, table, checkpoint = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "state")
    landing.mkdir()
    for i in range(4):
        (landing / f"{i}.json").write_text("\n".join(LANDED))
    real, failed = outcomes.write_batch, []

    def fails_once(path):
        write = real(path)

        def wrapped(envelopes, batch_id):
            if batch_id == 1 and not failed:
                failed.append(batch_id)
                if when == "after":
                    write(envelopes, batch_id)
                raise RuntimeError("lost")
            write(envelopes, batch_id)

        return wrapped

    monkeypatch.setattr(outcomes, "write_batch", fails_once)

    def run():
        query = land_readings(spark, str(landing), table, checkpoint, files_per_batch=1)
        query.awaitTermination(120)

    with pytest.raises(StreamingQueryException):
        run()
    run()
    good, rejects = state(spark, table)
    assert failed == [1] and good == [10.0] * 4 and len(rejects) == 4 * len(REASONS)


def documents(spark, n):
    year = (F.lit(2000) + F.col("id") % 20).cast("int").alias("year")
    return spark.range(0, n, 1, 3).select(F.format_string("d_%03d", "id").alias("_id"), year)


@pytest.mark.parametrize("max_bytes", [10_000, 250, 1])
def test_every_document_has_an_outcome(spark, tmp_path, max_bytes):
    path = str(tmp_path / "outcomes")

    def send(texts):
        return ['"year":2007' not in t for t in texts]

    counts = sinks.deliver(documents(spark, 100), "air", send, path, "2024-01-01", max_docs=10, max_bytes=max_bytes)
    assert counts == {"indexed": 95, "failed": 5}
    dead = sinks.dead_letters(spark, path, "2024-01-01").collect()
    assert sorted(r["_id"] for r in dead) == [f"d_{i:03d}" for i in range(7, 100, 20)]
    assert all(json.loads(r["value"].split("\n")[1])["year"] == 2007 for r in dead)
    assert sinks.read_outcomes(spark, path, "2024-01-01").select("_id").distinct().count() == 100
    assert sinks.deliver(documents(spark, 4), "air", send, path, "2024-01-02") == {"indexed": 4, "failed": 0}
    assert sinks.deliver(documents(spark, 3), "air", send, path, "2024-01-01") == {"indexed": 3, "failed": 0}
    assert sinks.dead_letters(spark, path, "2024-01-01").count() == 0


def test_a_sender_that_fails_refuses_its_chunk(spark, tmp_path):
    path = str(tmp_path / "outcomes")

    def send(texts):
        if any("d_005" in t for t in texts):
            raise ConnectionError("gone")
        return [True] * len(texts)

    counts = sinks.deliver(documents(spark, 12).coalesce(1), "air", send, path, "2024-01-01", max_docs=4)
    assert counts == {"indexed": 8, "failed": 4}
    assert {r["error"] for r in sinks.dead_letters(spark, path, "2024-01-01").collect()} == {"ConnectionError: gone"}


def test_a_failed_task_is_counted_once(tmp_path):
    """In a session whose tasks may fail: the first attempt sends, dies, and leaves no outcome."""
    import subprocess
    import sys

    code = f"""
from pyspark.sql import SparkSession, functions as F
from envhealth import sinks
import os
spark = SparkSession.builder.master("local[2,3]").config("spark.ui.enabled", "false").getOrCreate()
folder = {str(tmp_path)!r}
docs = spark.range(0, 40, 1, 2).select(F.format_string("d_%03d", "id").alias("_id"), F.col("id").alias("year"))
def send(texts):
    name = folder + "/sent-" + str(sum(len(t) for t in texts)) + texts[0][-12:-1].replace('"', "").replace(":", "")
    if any('"year":15' in t for t in texts) and not os.path.exists(folder + "/died"):
        open(folder + "/died", "w").close()
        os._exit(1)
    return ['"year":3' not in t for t in texts]
print(sinks.deliver(docs, "air", send, folder + "/outcomes", "2024-01-01", max_docs=5))
print(sinks.read_outcomes(spark, folder + "/outcomes", "2024-01-01").count())
"""
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=180)
    assert done.stdout.split("\n")[:2] == ["{'indexed': 29, 'failed': 11}", "40"], done.stderr[-2000:]
    assert (tmp_path / "died").exists()
