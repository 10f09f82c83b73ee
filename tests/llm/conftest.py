from __future__ import annotations

import random

import pytest

#: Names that operators use for their own columns.
CLASHING = "size string, key string, fp string, row string, block string, n_words string, copies string, band string, _key string, _copies string, _spans string, _empty string"
NAMES = [part.split()[0] for part in CLASHING.split(", ")]
SCHEMA = f"doc_id long, text string, lang string, source string, n_chars long, {CLASHING}"
WORDS = "the of and house river stone green light water tree road silver cloud winter music paper glass".split()


def prose(seed: int, n: int, words: list[str] = WORDS) -> str:
    draw = random.Random(seed)
    return " ".join(draw.choice(words) + draw.choice(["", "", "s", "ing"]) for _ in range(n))


def documents(spark, rows):
    """Documents from (doc_id, text, lang, source), with extra columns whose names clash."""
    full = [(*r, len(r[1] or ""), *("x" for _ in NAMES)) for r in rows]
    return spark.createDataFrame(full, SCHEMA)


ODD = [
    (1, None, "en", "b"),
    (2, "", "en", "a"),
    (3, " \t\n ", None, "a"),
    (4, "one", "en", None),
    (None, prose(1, 120), "en", "a"),
    (5, prose(2, 300), "en", "b"),
    (5, prose(2, 300), "en", "b"),
    (6, prose(2, 300), "en", "b"),
    (7, prose(3, 40_000), "de", "c"),
    (8, "word " * 400, "de", "c"),
    (9, "Ünïcödé ñandú \U0001f600 日本語 123 -- ..", "es", "é"),
]


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty and long texts, repeated rows and clashing names."""
    return documents(spark, ODD).cache()


@pytest.fixture(scope="session")
def none(spark):
    return documents(spark, [])
