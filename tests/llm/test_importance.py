"""Importance resampling against a plain version of the contract."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from envhealth.llm import importance, ranks

from .conftest import ODD, documents, prose

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def features(text):
    lowered = "".join(c.lower() if c.isascii() else c for c in text or "")
    words = WORD.findall(lowered)
    return words, words + [f"{a} {b}" for a, b in zip(words, words[1:])]


def plain(rows, target, percent=25, least=20, buckets=10_000):
    """`(doc_id, n_features, weight, score, rank)` of every row; null ids last among equal scores."""

    def counted(texts):
        return Counter(zlib.crc32(f.encode()) % buckets for t in texts for f in features(t)[1])

    s, t = counted(r[1] for r in rows), counted(target)
    ss, tt = sum(s.values()), sum(t.values())

    def gain(b):
        return math.floor(1000 * math.log((t[b] + 1) * (ss + buckets) / ((s[b] + 1) * (tt + buckets))))

    out, able = [], []
    for i, (doc_id, text, *_) in enumerate(rows):
        words, found = features(text)
        gains = [gain(zlib.crc32(f.encode()) % buckets) for f in found]
        weight = sum(gains) // len(gains) if gains else 0
        h = int(hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32)))
        out.append([doc_id, len(found), weight, score, None])
        if len(words) >= least:
            able.append(i)
    able.sort(key=lambda i: (-out[i][3], out[i][0] is None, out[i][0] or 0, out[i][1]))
    for rank, i in enumerate(able[: percent * len(able) // 100], 1):
        out[i][4] = rank
    return sorted(map(repr, map(tuple, out)))


def found(docs, target, **options):
    return sorted(repr(tuple(r)) for r in importance.resample(docs, target, **options).collect())


@pytest.fixture(scope="module")
def target(spark):
    texts = [prose(1, 300), "the Silver house, of light 9", None, ""]
    return spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "item_id long, text string, score string"), texts


@pytest.mark.parametrize("percent", [0, 1, 25, 100])
def test_resampling_equals_the_plain_form(spark, target, percent):
    rng = random.Random(percent)
    rows = [(i, prose(i, rng.randrange(0, 60)) + rng.choice(["", " Été", " x-1"]), "en", "s") for i in range(400)]
    assert found(documents(spark, rows), target[0], percent=percent) == plain(rows, target[1], percent)


def test_resampling_of_odd_rows(odd, none, spark, target):
    assert found(odd, target[0], percent=50) == plain(ODD, target[1], 50)
    assert importance.resample(none, target[0]).count() == 0
    empty = target[0].where("false")
    assert found(odd, empty, percent=50) == plain(ODD, [], 50)


def test_one_id_in_a_third_of_all_rows(spark, target):
    rows = [(7 if i % 3 == 0 else i, prose(i % 5 if i % 3 == 0 else i, 25), "en", "s") for i in range(900)]
    got = importance.resample(documents(spark, rows), target[0]).collect()
    assert sorted(r.rank for r in got if r.rank) == list(range(1, 226))
    plainly = plain(rows, target[1])
    # Rows of one id and length differ in nothing that orders them, so only the rest is told apart.
    assert sorted(repr(tuple(r)[:4]) for r in got) == sorted(repr(tuple(eval(p))[:4]) for p in plainly)
    order = [(-r.score, r.doc_id, r.n_features) for r in sorted((r for r in got if r.rank), key=lambda r: r.rank)]
    assert order == sorted(order)


@pytest.mark.parametrize("error", [1e-9, 1e-3, 0.5])
def test_brackets_hold_the_cutoff_whatever_the_sketch_says(spark, error):
    values = [random.Random(4).randrange(-50, 50) for _ in range(3000)]
    rows = spark.createDataFrame([(v,) for v in values], "score long")
    for wanted in (1, 2, 750, 2999, 3000):
        low, high, above = importance.bracket(rows, "score", wanted, len(values), error=error)
        assert low <= sorted(values, reverse=True)[wanted - 1] <= high and above == sum(v > high for v in values) < wanted


def test_a_wrong_bracket_is_widened(spark, monkeypatch):
    rows = spark.range(1000).select(F.col("id").alias("score"))
    asked = []
    real = type(rows).approxQuantile

    def wrong(self, column, at, error):
        asked.append(at)
        return [0.0, 1.0] if len(asked) == 1 else real(self, column, at, error)

    monkeypatch.setattr(type(rows), "approxQuantile", wrong)
    low, high, above = importance.bracket(rows, "score", 10, 1000)
    assert low <= 990 <= high and above == 999 - high and len(asked) == 2


def test_crc_of_words_of_any_length():
    words = ["", "a", "é" * 31, "b" * 64, "c" * 65, "d" * 5000]
    text = " ".join(words[1:])
    data = np.frombuffer("".join(words).encode(), np.uint8)
    ends = np.cumsum([len(w.encode()) for w in words])
    starts = np.concatenate([[0], ends[:-1]])
    assert importance.crc_of_ranges(data, starts, ends).tolist() == [zlib.crc32(w.encode()) for w in words]
    (_, buckets, _), = importance.feature_buckets(pa.array([text]))
    assert buckets.tolist() == [zlib.crc32(f.encode()) % 10_000 for f in features(text)[1]]


def test_prefix_sums_over_ranges(spark):
    values = [(i % 7, (i * 37) % 101, i) for i in range(500)]
    df = spark.createDataFrame(values, "a long, b long, before_ long").repartition(5)
    got = ranks.prefix_sums(df, [F.col("a"), F.desc("b"), F.col("before_")], x=F.col("b"), y=F.lit(1)).collect()
    total, expected = 0, {}
    for n, v in enumerate(sorted(values, key=lambda v: (v[0], -v[1], v[2]))):
        expected[v] = (total, n)
        total += v[1]
    assert {tuple(r)[:3]: tuple(r)[3:] for r in got} == expected
    assert ranks.prefix_sums(df.where("false"), [F.col("a")], x=F.col("b")).count() == 0
