from __future__ import annotations

import datetime as dt
import json
import math
import random

import pytest
from pyspark.sql import functions as F

from envhealth import operators as op
from envhealth import schemas
from envhealth.operators import documents

RUN, AT = "2024-06-01", "2024-06-01 07:08:09.5"


def combined(spark, data):
    return spark.createDataFrame(data, schemas.COMBINED)


ROW = (2021, 1.5, 1.0, 2.0, 10, 3.5, "5.5", "g", "o", "c")


def test_conform_casts_and_keeps_extra(spark):
    df = spark.createDataFrame([("2020.0", "1.5", 7, "x"), ("n/a", "bad", 2**40, "y")],
                               "year string, pm25_avg_yearly string, pm25_measurements_count bigint, more string")
    out = op.conform(df)
    assert out.schema.names == [*schemas.DOCUMENT.names, "more"]
    assert out.select(*schemas.DOCUMENT.names).schema == schemas.DOCUMENT
    a, b = out.orderBy("more").collect()
    assert (a["year"], a["pm25_avg_yearly"], a["pm25_measurements_count"]) == (2020, 1.5, 7)
    assert (b["year"], b["pm25_avg_yearly"], b["pm25_measurements_count"]) == (None, None, None)
    assert a["group"] is None and a["more"] == "x"
    assert op.conform(df, keep_extra=False).columns == schemas.DOCUMENT.names


def test_documents_drop_missing_years_and_keep_position_gaps(spark):
    rows = [(*ROW, 0), (None, *ROW[1:], 1), (2022, *ROW[1:], 2)]
    df = spark.createDataFrame(rows, combined(spark, [ROW]).schema.add("_position", "integer"))
    docs = op.to_documents(df, RUN, AT, position="_position").orderBy("_id").collect()
    assert [d["_id"] for d in docs] == ["2024-06-01_0", "2024-06-01_2"]
    assert docs[0]["data_source"] == "combined_2024-06-01"
    assert docs[0]["processing_date"] == dt.date(2024, 6, 1)
    assert docs[0]["indexed_at"] == dt.datetime(2024, 6, 1, 7, 8, 9, 500000)


def test_document_lines_write_nulls(spark):
    docs = op.to_documents(combined(spark, [(2021, math.nan, None, *ROW[3:9], None)]), RUN, AT)
    line = json.loads(op.to_ndjson(docs).first()["value"])
    assert set(line) == {"_id", *schemas.DOCUMENT.names}
    assert line["pm25_avg_yearly"] is None and line["confidence_interval"] is None
    assert line["pm25_max_yearly"] == 2.0 and line["year"] == 2021
    assert line["indexed_at"] == "2024-06-01T07:08:09.500000"
    assert line["processing_date"] == "2024-06-01"


def test_document_lines_round_trip(spark, rows):
    docs = op.to_documents(combined(spark, [ROW, ROW, (2022, *ROW[1:])]), RUN, AT)
    assert rows(op.from_ndjson(op.to_ndjson(docs), docs.schema)) == rows(docs)


def test_bulk_lines(spark):
    docs = op.to_documents(combined(spark, [ROW]), RUN, AT)
    action, source = op.to_bulk(docs, "air").first()["value"].split("\n")
    identifier = docs.first()["_id"]
    assert json.loads(action) == {"index": {"_index": "air", "_id": identifier}}
    assert "_id" not in json.loads(source) and json.loads(source)["year"] == 2021


def test_coerce_numeric_leaves_numbers(spark):
    df = spark.createDataFrame([("1.5", 2, "t"), ("x", 3, "u")], "pm25_avg_yearly string, pm25_measurements_count bigint, group string")
    out = op.coerce_numeric(df)
    assert [f.dataType.simpleString() for f in out.schema.fields] == ["double", "bigint", "string"]
    assert [r["pm25_avg_yearly"] for r in out.orderBy("group").collect()] == [1.5, None]


def test_nulls_and_texts_hash_differently(spark):
    df = spark.createDataFrame([(None, "a"), ("a", None), ("null", "a"), ("", "a")], "x string, y string")
    assert df.select(op.content_hash(["x", "y"])).distinct().count() == 4


def skewed(spark, copies=3000):
    rng = random.Random(5)
    data = [("hot", 1)] * copies + [(rng.choice("abc"), rng.randrange(3)) for _ in range(500)]
    rng.shuffle(data)
    data += [(None, None), (None, None)]
    return spark.createDataFrame(data, "k string, v int").repartition(5)


@pytest.mark.parametrize("per_task", [1 << 20, 64])
def test_copies_are_numbered_without_loss(spark, rows, monkeypatch, per_task):
    monkeypatch.setattr(documents, "COPIES_PER_TASK", per_task)
    df = skewed(spark)
    numbered = op.number_copies(df)
    assert rows(numbered.select("k", "v")) == rows(df)
    groups = numbered.groupBy("k", "v").agg(F.count("*").alias("n"), F.min("_copy").alias("lo"),
                                            F.max("_copy").alias("hi"), F.countDistinct("_copy").alias("d"))
    assert all(r["lo"] == 0 and r["hi"] == r["n"] - 1 and r["d"] == r["n"] for r in groups.collect())


def test_hot_copies_are_spread_over_tasks(spark, monkeypatch):
    monkeypatch.setattr(documents, "COPIES_PER_TASK", 64)
    numbered = op.number_copies(skewed(spark)).where(F.col("k") == "hot")
    per_task = numbered.groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert max(r["count"] for r in per_task) < 3000 / 2


def test_hash_ids_are_unique_and_stable(spark):
    df = skewed(spark)
    first = {r["_id"] for r in op.hash_ids(df, RUN).collect()}
    again = {r["_id"] for r in op.hash_ids(df.repartition(3).orderBy(F.rand(1)), RUN).collect()}
    assert len(first) == df.count() and first == again
    assert all(i.startswith("2024-06-01_") for i in first)


def test_ordered_positions(spark, rows):
    df = skewed(spark).where(F.col("k").isNotNull())
    out = op.ordered_positions(df, "k").orderBy("_position").collect()
    assert [r["_position"] for r in out] == list(range(df.count()))
    assert [r["k"] for r in out] == sorted(r["k"] for r in out)
    assert rows(op.ordered_positions(df, "k").drop("_position")) == rows(df)


def test_ordered_positions_split_a_hot_key(spark):
    placed = op.ordered_positions(skewed(spark, 20_000), "k")
    hot = placed.where(F.col("k") == "hot").groupBy(F.spark_partition_id().alias("p")).count()
    assert max(r["count"] for r in hot.collect()) < 20_000 / 2
