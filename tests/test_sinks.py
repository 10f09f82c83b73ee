from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from envhealth import operators as op
from envhealth import sinks, sources


def documents(spark, n):
    return spark.range(n).select(F.format_string("d_%03d", "id").alias("_id"), (F.lit(2000) + F.col("id") % 20).cast("int").alias("year"))


def test_partition_overwrite_keeps_other_dates(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.write_table(spark.range(5), path, "2024-01-01")
    sinks.write_table(spark.range(7), path, "2024-01-02")
    sinks.write_table(spark.range(3), path, "2024-01-02", rebalance=True)
    assert sources.read_table(spark, path).count() == 8
    assert sinks.audit(spark, path, 3, "2024-01-02") == 3
    with pytest.raises(ValueError, match="expected 4 rows, found 5"):
        sinks.audit(spark, path, 4, "2024-01-01")


def test_write_is_parallel(spark, tmp_path):
    path = tmp_path / "t"
    sinks.write_table(spark.range(0, 100, 1, 4), str(path), "2024-01-01")
    assert len(list(path.glob("run_date=2024-01-01/*.parquet"))) == 4


def test_raw_json_landing(spark, tmp_path):
    path = str(tmp_path / "raw")
    df = spark.createDataFrame([("é", None), ("b", "x")], "group string, percentage string")
    sinks.write_raw_json(df, path, "2024-01-01")
    sinks.write_raw_json(df.limit(1), path, "2024-01-01")
    back = sources.read_records(spark, f"{path}/date=2024-01-01", multi_line=False)
    assert [r["group"] for r in back.collect()] == ["é"]


@pytest.mark.parametrize("form", ["parquet", "json"])
def test_published_documents_are_replaced(spark, tmp_path, form):
    path = str(tmp_path / "docs")
    assert sinks.published_count(spark, path, form) == 0
    sinks.write_documents(documents(spark, 20), path, form)
    assert sinks.published_count(spark, path, form) == 20
    sinks.write_documents(documents(spark, 7), path, form)
    assert sinks.published_count(spark, path, form) == 7
    back = sources.read_documents(spark, path, form)
    assert sorted(r["_id"] for r in back.collect()) == [f"d_{i:03d}" for i in range(7)]
    assert back.where(F.col("year").isNull()).count() == 0


def test_unknown_form(spark, tmp_path):
    with pytest.raises(ValueError, match="form"):
        sinks.write_documents(documents(spark, 1), str(tmp_path / "d"), "xml")
    with pytest.raises(ValueError, match="form"):
        sources.read_documents(spark, str(tmp_path / "d"), "xml")


def test_bulk_files_hold_few_documents(spark, tmp_path):
    path = tmp_path / "bulk"
    sinks.write_bulk(documents(spark, 25).coalesce(1), str(path), "air", max_docs=10)
    sizes = sorted(len(f.read_text().splitlines()) for f in path.glob("part-*"))
    assert sizes == [10, 20, 20]


@pytest.mark.parametrize("max_bytes", [10_000, 250])
def test_publish_counts_accepted_and_failed(spark, tmp_path, max_bytes):
    folder = str(tmp_path)

    def send(texts):
        import uuid

        with open(f"{folder}/{uuid.uuid4().hex}", "w") as out:
            out.write("\n".join(texts))
        return sum('"year":2007' not in t for t in texts)

    df = documents(spark, 100).repartition(3)
    counts = sinks.publish(df, "air", send, max_docs=10, max_bytes=max_bytes)
    assert counts == {"indexed": 95, "failed": 5}
    chunks = [f.read_text() for f in tmp_path.iterdir()]
    assert all(len(c.splitlines()) <= 20 and len(c) <= max_bytes for c in chunks)
    actions = [json.loads(line) for c in chunks for line in c.splitlines()[::2]]
    assert len({a["index"]["_id"] for a in actions}) == 100


def test_publish_nothing(spark):
    assert sinks.publish(documents(spark, 0), "air", len) == {"indexed": 0, "failed": 0}


def test_publish_sends_a_document_larger_than_the_limit(spark):
    assert sinks.publish(documents(spark, 3), "air", len, max_bytes=1) == {"indexed": 3, "failed": 0}


def test_positions_of_a_written_table_match_its_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.write_table(spark.range(0, 50, 1, 3), path, "2024-01-01")
    rows = sources.read_positioned(spark, f"{path}/run_date=2024-01-01")
    ids = [r["_id"] for r in op.position_ids(rows, "2024-01-01").collect()]
    assert sorted(ids) == sorted(f"2024-01-01_{i}" for i in range(50))
