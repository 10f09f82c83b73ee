from __future__ import annotations

import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from envhealth import functions as fn


def apply(spark, function, values, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    out = df.select("i", function("v").alias("out")).collect()
    return [r["out"] for r in sorted(out)]


@pytest.mark.parametrize(
    ("text", "rate"),
    [
        ("12.5", 12.5),
        ("5.", 5.0),
        ("007", 7.0),
        ("12.5\n", 12.5),
        (" 5", None),
        ("5 ", None),
        (".5", None),
        ("-1", None),
        ("1e3", None),
        ("", None),
        ("N/A", None),
        ("5%", None),
        (None, None),
    ],
)
def test_parse_rate(spark, text, rate):
    assert apply(spark, fn.parse_rate, [text]) == [rate]


def test_to_int(spark):
    values = ["2021", " 2021 ", "2020.0", "2020.9", "-3.7", "abc", "2e3", "", None, "99999999999"]
    assert apply(spark, fn.to_int, values) == [
        2021, 2021, 2020, 2020, -3, None, None, None, None, None,
    ]


def test_coerce_double(spark):
    values = ["1.5", " 2 ", "1e3", ".5", "-7.", "5d", "5f", "0x1p3", "1_0", "abc", "", None]
    assert apply(spark, fn.coerce_double, values) == [
        1.5, 2.0, 1000.0, 0.5, -7.0, None, None, None, None, None, None, None,
    ]
    inf, nan = apply(spark, fn.coerce_double, ["inf", "NaN"])
    assert inf == math.inf and math.isnan(nan)


def test_nan_to_null(spark):
    assert apply(spark, fn.nan_to_null, [1.0, math.nan, None], "double") == [1.0, None, None]


def test_clean_text(spark):
    values = ["\t a\r\nb  \n", "plain", "  ", None, " x "]
    assert apply(spark, fn.clean_text, values) == ["a  b", "plain", "", None, " x "]


def test_clean_text_is_idempotent(spark):
    rng = random.Random(7)
    values = ["".join(rng.choice("ab \t\r\n") for _ in range(rng.randrange(12))) for _ in range(200)]
    once = apply(spark, fn.clean_text, values)
    assert apply(spark, fn.clean_text, once) == once
    assert once == [
        "".join(" " if c in "\r\n\t" else c for c in v).strip(" ") for v in values
    ]


def test_to_day(spark):
    day = dt.date(2024, 5, 1)
    values = ["2024-05-01 10:00:00", "\t2024-05-01\n", "2024-05-01\n10:00", "garbage", "", None]
    assert apply(spark, fn.to_day, values) == [day, day, day, None, None, None]
    cleaned = lambda c: fn.clean_text(c).try_cast("date")
    assert apply(spark, fn.to_day, values) == apply(spark, cleaned, values)


def test_on_day(spark):
    df = spark.sql(
        "SELECT * FROM VALUES (timestamp_ntz'2024-01-14 23:59:59'), (timestamp_ntz'2024-01-15 00:00:00'),"
        " (timestamp_ntz'2024-01-15 23:59:59.9'), (timestamp_ntz'2024-01-16 00:00:00') AS t(ts)"
    )
    assert df.where(fn.on_day("ts", "2024-01-15")).count() == 2


def test_as_date():
    assert fn.as_date("2024-02-03") == dt.date(2024, 2, 3)
    assert fn.as_date(dt.datetime(2024, 2, 3, 4)) == dt.date(2024, 2, 3)


def test_payload_predicates(spark):
    texts = ['{"data": 1}', '{"data": null}', '{"x": 1}', "[1]", "[]", '{"data"', None, "3"]
    assert apply(spark, fn.is_json, texts) == [True, True, True, True, True, False, False, True]
    has = lambda c: fn.is_object_with(c, "data")
    assert apply(spark, has, texts) == [True, True] + [False] * 6
    assert apply(spark, fn.is_record_list, texts) == [False] * 3 + [True] + [False] * 4


def test_once_computes_a_value_for_every_row(spark):
    df = spark.range(3).select("id", fn.once(double=F.col("id") * 2, text=F.lit("x")))
    assert [tuple(r) for r in df.collect()] == [(0, 0, "x"), (1, 2, "x"), (2, 4, "x")]
