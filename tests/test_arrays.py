"""Arrays that are read in splits, against the parse of the whole file."""

from __future__ import annotations

import json
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from envhealth import sources
from envhealth.schemas import INDICATOR_RAW
from envhealth.sources import arrays

TEXTS = ["plain", "}", "{", "]},{", "a\\", '"', '\\"}', "é}ü", "", " [ ", "\\\\", "x" * 300, None]


def records(n, seed=0):
    draw = random.Random(seed)
    return [{name: draw.choice(TEXTS) for name in INDICATOR_RAW.names} | {"year": str(i)} for i in range(n)]


@pytest.fixture
def small_splits(spark):
    names = ["spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes", "spark.sql.files.minPartitionNum"]
    for name, value in zip(names, ["1000", "1", "1"]):
        spark.conf.set(name, value)
    yield
    for name in names:
        spark.conf.unset(name)


def found(df):
    return sorted((tuple(r) for r in df.select(*INDICATOR_RAW.names).collect()), key=lambda r: (len(r[0]), r[0]))


def expected(rows):
    return [tuple(r[name] for name in INDICATOR_RAW.names) for r in rows]


@pytest.mark.parametrize("indent", [None, 2])
@pytest.mark.parametrize("n", [0, 1, 2, 200])
def test_arrays_equal_the_whole_parse(spark, tmp_path, small_splits, indent, n):
    rows = records(n, n)
    (tmp_path / "a.json").write_text(json.dumps(rows, indent=indent, ensure_ascii=False) + "\n", encoding="utf-8")
    assert found(sources.read_array_records(spark, str(tmp_path))) == expected(rows)


def test_one_file_is_read_by_many_tasks(spark, tmp_path, small_splits):
    (tmp_path / "a.json").write_text(json.dumps(records(200), indent=1))
    texts = sources.read_array_texts(spark, str(tmp_path))
    scan = spark.read.option("lineSep", "}").text(str(tmp_path))
    assert scan.rdd.getNumPartitions() > 10
    got = [(r["element"], r["value"]) for r in texts.collect()]
    assert sorted(e for e, _ in got) == list(range(200))


def test_elements_longer_than_splits(spark, tmp_path, small_splits):
    rows = records(5)
    rows[2]["description"] = "}{,[" * 3000
    rows[4]["group"] = '\\"' * 2000
    (tmp_path / "a.json").write_text(json.dumps(rows))
    (tmp_path / "b.json").write_text(json.dumps([{**r, "year": "1" + r["year"]} for r in rows], indent=3))
    got = found(sources.read_array_records(spark, str(tmp_path)))
    assert got == expected(rows + [{**r, "year": "1" + r["year"]} for r in rows])


@pytest.mark.parametrize(
    "text, elements",
    [
        ("[]", []), (" \n", []), ("[ 1, [2, 3], \"a,b\" ]", ["1", "[2, 3]", '"a,b"']), ('{"a": 1, "b": [2]}', ['{"a": 1, "b": [2]}']),
        ('{\n"a": {"b": 1}\n}\n', ['{\n"a": {"b": 1}\n}']), ('[{"a": 1}, {"a": 2', ['{"a": 1}', '{"a": 2']), ('[{"a": 1}, {"a": 2}', ['{"a": 1}', '{"a": 2}']),
        ('[{"a": 1}] rest', ['{"a": 1}']), ("[{}, {}]", ["{}", "{}"]), ('﻿[{"a": 1}]', ['{"a": 1}']),
    ],
)
def test_odd_files(spark, tmp_path, text, elements):
    (tmp_path / "a.json").write_text(text, encoding="utf-8")
    got = sources.read_array_texts(spark, str(tmp_path)).orderBy("element").collect()
    assert [r["value"].strip() for r in got] == elements


def test_elements_that_do_not_parse_are_kept(spark, tmp_path):
    (tmp_path / "a.json").write_text('[{"year": "1"}, {"year": }, {"year": "3"}]')
    rows = sources.read_array_records(spark, str(tmp_path)).collect()
    assert sorted(r["year"] or "" for r in rows) == ["", "1", "3"]
    assert [r["_corrupt_record"].strip() for r in rows if r["_corrupt_record"]] == ['{"year": }']


@settings(max_examples=150, deadline=None)
@given(st.recursive(st.none() | st.integers() | st.text(alphabet='ab\\"{}[],'), lambda x: st.lists(x, max_size=4) | st.dictionaries(st.text(alphabet='a"\\}'), x, max_size=3), max_leaves=20))
def test_structure_sees_what_a_parser_sees(value):
    """Walking byte by byte gives the same brackets and commas, from any brace on."""
    data = json.dumps([value]).encode()
    inside, escape, depth, seen = False, False, 0, []
    states = {0: (False, 0)}
    for i, c in enumerate(data):
        if inside:
            inside, escape = (c != ord('"') or escape), (c == ord("\\") and not escape)
        elif c == ord('"'):
            inside, escape = True, False
        elif chr(c) in "[]{},":
            depth += {"[": 1, "{": 1, "]": -1, "}": -1}.get(chr(c), 0)
            seen.append((i, c, depth))
        if c == ord("}"):
            states[i + 1] = (inside, depth)
    for start, (inside, depth) in states.items():
        places, kinds, depths, _ = arrays.structure(data[start:], inside)
        got = list(zip((places + start).tolist(), kinds.tolist(), (depths + depth).tolist()))
        assert got == [s for s in seen if s[0] >= start]
    assert np.all(depths >= -len(data)) if len(depths) else True


def test_array_lines_are_landed_in_batches(spark, monkeypatch):
    """One batch from each batch of records, and one for the last line; before, one a record."""
    import json

    import pyarrow as pa

    from checks import bindings

    runs = []
    monkeypatch.setattr(type(spark.range(1)), "mapInArrow", lambda df, run, schema: runs.append(run))
    bindings.array_lines(spark.range(5), 1)
    batches = [pa.RecordBatch.from_pydict({"value": v}) for v in (["1", "2", "3"], [], ["4"], ["5", "6"])]
    found = list(runs[0](iter(batches)))
    assert len(found) == 4
    assert json.loads("".join(x for b in found for x in b.to_pydict()["value"])) == [1, 2, 3, 4, 5, 6]
    assert list(runs[0](iter([]))) == []


def test_files_of_one_envelope_are_written_by_all_tasks(spark, tmp_path):
    from checks import bindings

    path = str(tmp_path / "supplier.parquet")
    spark.createDataFrame([(i, f"s{i}", i % 3) for i in range(100)], "s_suppkey long, s_name string, s_nationkey int").coalesce(1).write.parquet(path)
    found = bindings.supplier_envelopes(spark, str(tmp_path))
    counts = found.rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect()
    assert sum(counts) == 100 and max(counts) < 30
