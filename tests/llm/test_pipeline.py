"""The stages, each on its own input, and the queries that the driver gets."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from envhealth.llm.queries import ORACLE, QUERIES
from envhealth.llm.scratch import saved

from .conftest import NAMES, ODD, documents, prose
from .test_operators import contaminated, repeats, split


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Documents of two sources with bad, copied, repeating and contaminated ones among them."""
    rng = random.Random(2)
    rows, labels = list(ODD), []
    passage, item = prose(70, 90).split(), prose(71, 40).split()
    for d in range(100, 400):
        w = prose(d, rng.randrange(80, 160)).split()
        kind = d % 10
        if kind == 0:
            w[10:10] = ["vile", "nasty"]
        elif kind == 1:
            w[20:20] = passage
        elif kind == 2:
            w[30:30] = item
        elif kind == 3:
            w = prose(d - 3 + 4 * (d % 20 == 3), 130).split()
            w[50] = "changed"
        rows.append((d, " ".join(w), "en", f"s{d % 2}"))
        labels.append((d, int(kind != 0), int(kind == 0)))
    path = str(tmp_path_factory.mktemp("tables"))
    documents(spark, rows).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([(1, " ".join(item))], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def test_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = [docs]
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        kept.append(saved(stage(spark, kept[-1], folder), f"stage{i}"))
    before, quality, single, cut, clean, mixed = ([tuple(r[:2]) for r in k.collect()] for k in kept)
    assert all(k.schema == docs.schema for k in kept[1:5])
    ids = [{r[0] for r in rows} for rows in (before, quality, single, cut, clean, mixed)]
    # 1: toxic texts go, the others stay.
    assert not {d for d in ids[1] if d and d >= 100 and d % 10 == 0}
    assert {d for d in ids[0] if d and d >= 100 and d % 10} <= ids[1]
    # 2: one of each group of like texts stays; the rest are not much like each other.
    assert len(single) == len(ids[2]) and len({tuple(split(t)) for _, t in single}) == len(single)
    # 3: repeats are cut, nothing else.
    again = repeats(single)
    expected = {d: [w for i, w in enumerate(split(t)) if i not in again.get(d, ())] for d, t in single}
    assert again and {d: split(t) for d, t in cut} == {d: w for d, w in expected.items() if w or not again.get(d)}
    assert all(r.n_chars == len(r.text) for r in kept[3].collect() if r.text is not None)
    # 4: exactly the contaminated ones go.
    items = [tuple(r) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    assert sorted(map(str, clean)) == sorted(str(r) for r in cut if not contaminated(r[1], items)[4])
    assert len(clean) < len(cut)
    # 5: both sources are taken towards their targets.
    assert ids[5] <= ids[4] and {"copy"} == set(kept[5].columns) - set(docs.columns)
    words = kept[5].groupBy("source").agg(F.sum(F.size(F.split("text", r"\s+"))).alias("n"))
    assert words.count() >= 2
    assert set(NAMES) <= set(kept[5].columns)


def test_stages_of_no_documents(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").where("false")
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        docs = saved(stage(spark, docs, folder), f"none{i}")
    assert docs.count() == 0


@pytest.mark.parametrize("name", ["op5_language", "op12_toxicity"])
def test_a_null_id_is_not_held_out(spark, folder, name):
    rows = QUERIES[name](spark, folder).collect()
    assert {r.held_out for r in rows if r.doc_id is None} == {False}
    assert {r.held_out for r in rows} == {True, False}


def test_everything_is_registered():
    names = set(entry.queries())
    assert set(QUERIES) | {"pipeline"} <= names
    assert {name.split("_")[0] for name in QUERIES} == {f"op{n}" for n in range(1, 14)}
    assert set(ORACLE) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_sql_agrees(spark, sf_dir, name):
    duckdb = pytest.importorskip("duckdb")
    base = duckdb.connect()
    for table in ("documents", "benchmark"):
        base.sql(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    found = QUERIES[name](spark, sf_dir)
    expected = base.sql(ORACLE[name])
    at = [expected.columns.index(c) for c in found.columns]
    assert sorted(map(tuple, found.collect())) == sorted(tuple(r[i] for i in at) for r in expected.fetchall())
