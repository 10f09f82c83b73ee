"""The manifest of landed files."""

from __future__ import annotations

import json

import pytest

from envhealth import operators as op
from envhealth import sources


def land(root, day, n, size=0):
    folder = root / f"date={day}"
    folder.mkdir(parents=True, exist_ok=True)
    for i in range(n):
        body = {"status": "ok", "data": {"time": {"s": f"{day} 10:00:00"}, "city": {"name": "A" * size}, "iaqi": {"pm25": {"v": i}}}}
        (folder / f"f{i}.json").write_text(json.dumps(body, indent=1))
    (folder / "notes.txt").write_text("no envelope")


def test_a_second_run_lists_only_what_is_new(spark, tmp_path, monkeypatch):
    landing, manifest = tmp_path / "raw", str(tmp_path / "manifest")
    land(landing, "2024-01-01", 3)
    land(landing, "2024-01-02", 2)
    folders = ["date=2024-01-01", "date=2024-01-02", "date=2024-01-03"]
    assert sources.extend_manifest(spark, str(landing), folders, manifest) == folders[:2]
    assert sources.extend_manifest(spark, str(landing), folders, manifest) == []
    land(landing, "2024-01-03", 1)
    assert sources.extend_manifest(spark, str(landing), folders, manifest) == folders[2:]
    table = sources.read_manifest(spark, manifest)
    assert table.count() == 6 and all(r["length"] > 0 and r["path"].endswith(".json") for r in table.collect())
    land(landing, "2024-01-02", 5)
    assert sources.extend_manifest(spark, str(landing), folders, manifest, again=folders[1:2]) == folders[1:2]
    assert sources.read_manifest(spark, manifest).count() == 9


@pytest.mark.parametrize("read_files", [2, 100])
def test_listed_files_are_read(spark, tmp_path, rows, read_files):
    landing, manifest = tmp_path / "raw", str(tmp_path / "manifest")
    assert sources.read_listed(spark, sources.read_manifest(spark, manifest)).count() == 0
    land(landing, "2024-01-01", 3)
    land(landing, "2024-01-02", 2)
    sources.extend_manifest(spark, str(landing), ["date=2024-01-01", "date=2024-01-02"], manifest)
    listed = sources.read_listed(spark, sources.read_manifest(spark, manifest), read_files=read_files)
    whole = sources.read_envelopes(spark, [f"{landing}/date=2024-01-01", f"{landing}/date=2024-01-02"], True, files="*.json")
    assert rows(op.extract_readings(listed)) == rows(op.extract_readings(whole))


def test_packs_are_bounded(spark):
    data = [(f"p{i:03d}", 10 if i % 7 else 5000, None, f"f{i % 2}") for i in range(200)]
    table = spark.createDataFrame(data, sources.manifest.MANIFEST)
    packs = {}
    for r in sources.packed(table, pack_bytes=1000, open_bytes=10).collect():
        packs.setdefault((r["folder"], r["pack"]), []).append((r["path"], r["length"] + 10))
    assert sum(map(len, packs.values())) == 200 and len(packs) > 10
    for files in packs.values():
        files.sort()
        assert sum(cost for _, cost in files[:-1]) < 1000  # all but the last file begin within the pack
