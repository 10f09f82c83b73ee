from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from envhealth import operators as op


@pytest.fixture
def docs(spark):
    data = [("1", 2020, "a", 1.0), ("2", 2021, "a", 2.0), ("3", 2021, "b", None),
            ("4", None, "b", 4.0), ("5", 2022, "b", 6.0)]
    return spark.createDataFrame(data, "_id string, year int, group string, pm25_avg_yearly double")


def ids(df):
    return [r["_id"] for r in df.collect()]


def test_search_defaults(docs):
    assert ids(op.search(docs)) == ["5", "2", "3", "1", "4"]
    assert ids(op.search(docs, size=2)) == ["5", "2"]


def test_search_predicates(docs):
    assert ids(op.search(docs, F.col("group") == "a")) == ["2", "1"]
    assert ids(op.search(docs, F.col("year").isin(2020, 2022))) == ["5", "1"]
    assert ids(op.search(docs, F.col("year").between(2021, 2022), order=[F.asc("_id")])) == ["2", "3", "5"]
    assert ids(op.search(docs, F.col("pm25_avg_yearly").isNotNull(), size=1)) == ["5"]
    assert op.search_total(docs, F.col("group") == "b").first()["total"] == 3
    assert op.search_total(docs).first()["total"] == 5


def test_terms(docs):
    assert [tuple(r) for r in op.terms_topk(docs).collect()] == [(2021, 2), (2020, 1), (2022, 1)]
    assert [tuple(r) for r in op.terms_topk(docs, size=1).collect()] == [(2021, 2)]


def test_facets(docs):
    assert [tuple(r) for r in op.search_facets(docs, size=2).collect()] == [
        ("all", None, 5, 3.25),
        ("term", "2021", 2, None),
        ("term", "2020", 1, None),
    ]
    only_b = op.search_facets(docs, where=F.col("group") == "b").collect()
    assert tuple(only_b[0]) == ("all", None, 3, 5.0)
