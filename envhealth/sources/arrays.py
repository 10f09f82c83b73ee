"""Large JSON arrays of records, each read by many tasks.

Spark splits a text file at any separator, so a file is read as the pieces between closing
braces. Whether a split starts inside a text, and how deep, depends on all before it: the
first pass sums every split up for both cases, a scan over the splits of each file tells
which case holds, and the second pass cuts the splits into elements. Elements that run over
splits are put together from their parts; no others are moved.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from ..constants import CORRUPT
from ..schemas import INDICATOR_RAW

BRACE = b"}"
QUOTE, BACKSLASH, COMMA, OPEN, CLOSE = b'"\\,[]'
SUMMARY = (
    "file string, start long, size long, bytes long, pieces long, array boolean, "
    "case boolean, inside boolean, depth long, commas map<long,long>"
)
STATE = "file string, start long, inside boolean, depth long, element long, whole boolean, last boolean"
PARTS = "file string, element long, start long, complete boolean, text binary"

_DELTA = np.zeros(256, np.int64)
_DELTA[[ord("["), ord("{")]] = 1
_DELTA[[ord("]"), ord("}")]] = -1
_STRUCTURAL = np.zeros(256, bool)
_STRUCTURAL[list(b"[]{},")] = True


def structure(data: bytes, inside: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, bool]:
    """Brackets, braces and commas outside texts: place, byte, depth after; and whether a text is open.

    `data` starts after a brace, which no escape reaches over; depth counts from 0.
    """
    raw = np.frombuffer(data, np.uint8)
    quotes = np.flatnonzero(raw == QUOTE)
    plain = np.flatnonzero(raw != BACKSLASH)
    # A quote after an odd run of backslashes is escaped.
    before = np.searchsorted(plain, quotes)
    last_plain = np.where(before > 0, plain[np.maximum(before - 1, 0)] if len(plain) else -1, -1)
    quotes = quotes[(quotes - 1 - last_plain) % 2 == 0]
    places = np.flatnonzero(_STRUCTURAL[raw])
    outside = (np.searchsorted(quotes, places) + inside) % 2 == 0
    places = places[outside]
    kinds = raw[places]
    return places, kinds, np.cumsum(_DELTA[kinds]), bool((len(quotes) + inside) % 2)


def _splits(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[str, int, int], bytes, int]]:
    """`(file, start, size)`, bytes and number of pieces, for runs of the pieces of one split."""
    for batch in batches:
        if not batch.num_rows:
            continue
        values, files = batch.column("value").to_pylist(), batch.column("file").to_pylist()
        starts, sizes = batch.column("start").to_pylist(), batch.column("size").to_pylist()
        i = 0
        while i < len(values):
            j = i
            while j < len(values) and files[j] == files[i] and starts[j] == starts[i]:
                j += 1
            yield (files[i], starts[i], sizes[i]), BRACE.join(values[i:j]) + BRACE, j - i
            i = j


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What every split does to the state, for a start outside and inside of a text."""
    key, totals = None, None

    def rows():
        columns = [
            [key[0]] * 2, [key[1]] * 2, [key[2]] * 2, [totals["bytes"]] * 2, [totals["pieces"]] * 2, [totals["array"]] * 2,
            [False, True], [totals[c][0] for c in (False, True)], [totals[c][1] for c in (False, True)],
            [list(totals[c][2].items()) for c in (False, True)],
        ]
        types = [
            pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.bool_(),
            pa.bool_(), pa.bool_(), pa.int64(), pa.map_(pa.int64(), pa.int64()),
        ]
        names = ["file", "start", "size", "bytes", "pieces", "array", "case", "inside", "depth", "commas"]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)

    for now, data, pieces in _splits(batches):
        if now != key:
            if key:
                yield rows()
            key = now
            totals = {"bytes": 0, "pieces": 0, "array": None}
            totals |= {case: (case, 0, Counter()) for case in (False, True)}
        if totals["array"] is None and (head := data.lstrip(b"\xef\xbb\xbf \t\r\n")):
            totals["array"] = head[:1] == b"["
        totals["bytes"] += len(data)
        totals["pieces"] += pieces
        for case in (False, True):
            inside, depth, commas = totals[case]
            _, kinds, depths, after = structure(data, inside)
            commas.update((depths[kinds == COMMA] + depth).tolist())
            totals[case] = (after, depth + (int(depths[-1]) if len(depths) else 0), commas)
    if key:
        yield rows()


def _scanned(table: pa.Table) -> pa.Table:
    """The state at the start of each split of one file, from the sums of all splits."""
    rows = sorted(table.to_pylist(), key=lambda r: (r["start"], r["case"]))
    by_start: dict[int, dict] = {}
    for row in rows:
        by_start.setdefault(row["start"], {})[row["case"]] = row
    first = next(iter(by_start.values()))[False]
    array = next((r[False]["array"] for r in by_start.values() if r[False]["array"] is not None), False)
    # Every piece but perhaps the last was followed by a brace; the file's length tells.
    surplus = sum(r[False]["bytes"] for r in by_start.values()) > first["size"]
    inside, depth, element = False, 0, 0
    out = []
    for n, (start, cases) in enumerate(by_start.items()):
        last = n == len(by_start) - 1
        out.append((first["file"], start, inside, depth, element, not array, last and surplus))
        row = cases[inside]
        element += dict(row["commas"]).get(1 - depth, 0)
        inside, depth = row["inside"], depth + row["depth"]
    types = [pa.string(), pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.bool_(), pa.bool_()]
    names = ["file", "start", "inside", "depth", "element", "whole", "last"]
    return pa.table([pa.array(c, t) for c, t in zip(zip(*out), types)], names=names)


def _cut(batches: Iterator[pa.RecordBatch], states) -> Iterator[pa.RecordBatch]:
    """Elements, and parts of those that other splits have parts of too."""
    key, held, opened = None, None, False
    out: list[list] = [[], [], [], []]

    def emit(element: int, complete: bool, text: bytes) -> None:
        for column, value in zip(out, (element, key[1], complete, text)):
            column.append(value)

    def flush() -> pa.RecordBatch:
        types = [pa.int64(), pa.int64(), pa.bool_(), pa.binary()]
        columns = [pa.array([key[0]] * len(out[0]), pa.string()), *(pa.array(c, t) for c, t in zip(out, types))]
        for column in out:
            column.clear()
        return pa.RecordBatch.from_arrays(columns, names=["file", "element", "start", "complete", "text"])

    def close() -> None:
        """The end of a split leaves its last element open."""
        data = bytes(held["data"])
        if held["last"] and data.endswith(BRACE):
            data = data[:-1]
        if data and (held["whole"] or held["depth"] > 0):
            emit(held["element"], False, data)

    for now, data, _ in _splits(batches):
        if now != key:
            if key:
                close()
                yield flush()
            key = now
            inside, depth, element, whole, last = states.value[now[:2]]
            held = {"data": bytearray(), "inside": inside, "depth": depth, "element": element, "whole": whole, "last": last}
            opened = False  # whether the running element began in this split
        if held["whole"]:
            held["data"] += data
            continue
        places, kinds, depths, held["inside"] = structure(data, held["inside"])
        depths = depths + held["depth"]
        begin = 0
        edges = ((kinds == COMMA) & (depths == 1)) | ((kinds == OPEN) & (depths == 1)) | ((kinds == CLOSE) & (depths == 0))
        for place, kind in zip(places[edges].tolist(), kinds[edges].tolist()):
            if kind != OPEN:
                emit(held["element"], opened, bytes(held["data"]) + data[begin:place])
            held["data"], begin, opened = bytearray(), place + 1, True
            held["element"] += kind == COMMA
        held["data"] += data[begin:]
        held["depth"] = int(depths[-1]) if len(depths) else held["depth"]
        if len(out[0]):
            yield flush()
    if key:
        close()
        yield flush()


def read_array_texts(spark: SparkSession, path: str | list[str], files: str | None = None) -> DataFrame:
    """`(file, element, value)`: the elements of each file's array as texts, counted from 0.

    A file whose first character opens no array is one element. What stands after the end of
    an array is left out; an array that is not closed ends with the rest of the file as its
    last element. The state that tasks are given has one row per split of the files.
    """
    reader = spark.read.option("lineSep", BRACE.decode())
    if files:
        reader = reader.option("pathGlobFilter", files)
    pieces = reader.text(path if isinstance(path, list) else [path]).select(
        F.col("value").cast("binary").alias("value"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
        F.col("_metadata.file_size").alias("size"),
    )
    summed = pieces.mapInArrow(_summed, SUMMARY)
    scanned = summed.groupBy("file").applyInArrow(_scanned, STATE).collect()
    states = spark.sparkContext.broadcast({(r["file"], r["start"]): tuple(r)[2:] for r in scanned})
    parts = pieces.mapInArrow(partial(_cut, states=states), PARTS)
    text = F.col("text").cast("string")
    complete = parts.where("complete").select("file", "element", text.alias("value"))
    ordered = F.array_sort(F.collect_list(F.struct("start", "text")))
    joined = F.aggregate(ordered, F.lit(b""), lambda all_, part: F.concat(all_, part["text"]))
    open_ = parts.where("not complete").groupBy("file", "element").agg(joined.cast("string").alias("value"))
    elements = complete.union(open_).select("file", "element", F.trim(F.col("value")).alias("value"))
    return elements.where(F.regexp_replace("value", r"\s", "") != "")


def read_array_records(
    spark: SparkSession,
    path: str | list[str],
    schema: StructType = INDICATOR_RAW,
    files: str | None = None,
) -> DataFrame:
    """Records of arrays over any number of lines, however large one file is.

    Rows are those of `read_records(..., multi_line=True)`: an element that does not parse is
    kept as text in `_corrupt_record`. The tasks follow the splits of the files.
    """
    with_corrupt = StructType([*schema.fields]).add(CORRUPT, StringType())
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    texts = read_array_texts(spark, path, files)
    return texts.select(F.from_json("value", with_corrupt, options).alias("_record")).select("_record.*")
