"""Passages that occur more than once, by sparse suffix arrays.

Suffixes are kept only at word grams that content selects: any MATCH consecutive words keep at
least one, the same one wherever they occur. Suffixes that begin with the same gram are sorted
by what follows it. In that order the longest match of a suffix with any other is with a
neighbour, so two comparisons bound how far its matches may extend right. Where that and the
words to the left reach MATCH words, matches are extended left and right: every window of MATCH
words around the gram within the bound is looked up among the others, and all but its first
occurrence, in the order of documents and positions, are repeats.

A task holds all suffixes of its grams, so what it finds is final. Grams that would fill a good part of
a task are dealt by ranges instead, and matches are bounded to the left too before, by neighbours in the order of what
precedes them: else every occurrence of a common line, with what stands before it, would have windows to compare
that no other has. Tasks hold ranges of that order and find the first occurrences among their own suffixes. Suffixes
with the same words before the gram are neighbours, so other tasks can only hold windows whose words before the
gram are those of the range's first or last suffix; these are then compared among all ranges.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .decontaminate import winnowed
from .hot_keys import hot_share, join_counted
from .scratch import free_name, saved, shuffle_tasks, small_batches
from .words import NOT_SPACE, find_words, mixed, pieces, powers

#: Words of the shortest repeat, and of the gram that a suffix begins with.
MATCH, GRAM = 50, 10
SIDE = MATCH - GRAM
#: Suffixes of one gram that are extended together; more are taken in turn.
CHUNK = 8_000

_LEFT, _RIGHT = np.uint64(0xA0761D6478BD642F), np.uint64(0xE7037ED1A0B428DB)


def row_key(*columns: str) -> Column:
    """Names a row by its content; rows that are alike are one document to this operator."""
    return F.xxhash64(*columns)


def _grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for texts in pieces(batch.column(1)):
            words = find_words(texts, NOT_SPACE)
            at, hashes = winnowed(words, MATCH, GRAM)
            owner = np.searchsorted(words.bounds, at, "right") - 1 + texts.first
            columns = [pa.array(hashes.view(np.int64)), batch.column(0).take(pa.array(owner))]
            yield pa.RecordBatch.from_arrays(columns, names=["gram", "key"])


SUFFIX = "gram long, key long, doc_id {}, pos int, left binary, right binary, left_words int, right_words int"


def _suffixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Suffixes at wanted grams, with SIDE words either side: left ones nearest first, zero-padded."""
    for batch in batches:
        wanted = batch.column(3)
        for texts in pieces(batch.column(2)):
            words = find_words(texts, NOT_SPACE)
            at, hashes = winnowed(words, MATCH, GRAM)
            owner = np.searchsorted(words.bounds, at, "right") - 1
            kept = []
            for i in range(len(texts.offsets) - 1):
                mine = slice(*np.searchsorted(owner, [i, i + 1]))
                grams = wanted[texts.first + i].values.to_numpy().view(np.uint64)
                kept.append(np.isin(hashes[mine], grams))
            keep = np.concatenate([np.zeros(0, bool), *kept])
            at, hashes, owner = at[keep], hashes[keep], owner[keep]
            short = words.hashes.astype(np.uint32)
            low, high = words.bounds[owner], words.bounds[owner + 1]
            sides = []
            for first, step, room in ((at - 1, -1, at - low), (at + GRAM, 1, high - at - GRAM)):
                n = np.minimum(room, SIDE)
                index = first[:, None] + step * np.arange(SIDE)
                inside = np.arange(SIDE) < n[:, None]
                side = np.where(inside, short[np.clip(index, 0, max(0, len(short) - 1))], 0).astype(np.uint32) if len(at) else np.zeros((0, SIDE), np.uint32)
                sides.append((pa.array([r.tobytes() for r in side], pa.binary()), pa.array(n.astype(np.int32))))
            rows = pa.array(owner + texts.first)
            columns = [
                pa.array(hashes.view(np.int64)), batch.column(0).take(rows), batch.column(1).take(rows),
                pa.array((at - low).astype(np.int32)), sides[0][0], sides[1][0], sides[0][1], sides[1][1],
            ]
            names = ["gram", "key", "doc_id", "pos", "left", "right", "left_words", "right_words"]
            yield pa.RecordBatch.from_arrays(columns, names=names)


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint32).reshape(-1, SIDE)


def _bounded(side: str, name: str, other: str, edges: bool = False):
    """Adds `name`: the longest match on `side` of each sorted suffix with a neighbour of its gram.

    The neighbours of a task's first and last suffix may be in other tasks, so they may match as
    far as their words go. Suffixes that do not reach SIDE words with `other`, the words that they may
    match on the other side, are left out. With `edges`, a column says which rows are not suffixes but copies of
    the task's first and last one.
    """

    def lengths(rows: pa.Table) -> np.ndarray:
        m = _matrix(rows.column(side))
        n = rows.column(f"{side}_words").to_numpy()
        gram = rows.column("gram").to_numpy()
        same = m[1:] == m[:-1]
        match = np.where(same.all(axis=1), SIDE, (~same).argmax(axis=1)) if len(same) else np.zeros(0, np.int64)
        match = np.minimum(match, np.minimum(n[1:], n[:-1]))
        return np.where(gram[1:] == gram[:-1], match, -1)

    def marked(rows: pa.Table, edge: bool) -> list[pa.RecordBatch]:
        rows = rows.append_column("edge", pa.array(np.full(len(rows), edge))) if edges else rows
        return rows.combine_chunks().to_batches()

    def reaching(rows: pa.Table) -> list[pa.RecordBatch]:
        n = rows.column(name).to_numpy()
        return marked(rows.filter(pa.array((n >= 0) & (n + rows.column(other).to_numpy() >= SIDE))), False)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, before = None, SIDE  # the last row so far, and its match with the row before it
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = pa.Table.from_batches([batch])
            if held is None and edges:
                yield from marked(rows.slice(0, 1).append_column(name, rows.column(f"{side}_words").slice(0, 1)), True)
            rows = rows if held is None else pa.concat_tables([held, rows])
            match = lengths(rows)
            both = np.maximum(np.concatenate([[before], match]), np.concatenate([match, [-1]]))
            both = np.minimum(both, rows.column(f"{side}_words").to_numpy())
            out = rows.append_column(name, pa.array(both.astype(np.int32)))
            # The last row waits for its next neighbour.
            yield from reaching(out.slice(0, rows.num_rows - 1))
            held, before = rows.slice(rows.num_rows - 1), int(match[-1]) if len(match) else before
        if held is not None:
            last = held.append_column(name, held.column(f"{side}_words"))
            yield from reaching(last)
            if edges:
                yield from marked(last, True)

    return run


#: Repeats of suffixes, those with one last window in one row. `window` is null where they are settled; else
#: it is still to be compared with other tasks. With `key` and `start`, the row is no repeat of its task
#: but the window's first occurrence there.
REPEATS = "array<struct<key:long,pos:int,lo:int,hi:int>>"
MATCHES = "gram long, window long, first_doc_id {}, key long, start int, repeats " + REPEATS


def _extended(batches: Iterator[pa.RecordBatch], chunk: int, split: bool) -> Iterator[pa.RecordBatch]:
    """MATCHES of suffixes sorted by gram, document, position, that may extend by `right_most` words and as far left.

    If grams are `split`, edges come first, and windows with the words before the gram that an edge has may be
    in other tasks. Their repeats wait for the comparison of first occurrences; all others are settled here.
    """
    left = "left_most" if split else "left_words"
    names = [c.split()[0] for c in MATCHES.split(", ")]
    id_type = None
    edges: list[tuple[int, np.ndarray]] = []  # their gram and the words before it
    tail = None  # the gram that the last chunk ended in
    seen: dict[str, np.ndarray] = {}  # first occurrences of the tail's windows

    def matches(gram, window, settled, doc, key, start, bounds, repeats) -> pa.RecordBatch:
        fields = [pa.array(x.astype(t)) for x, t in zip(repeats, (np.int64, np.int32, np.int32, np.int32), strict=True)]
        rows = pa.StructArray.from_arrays(fields, names=["key", "pos", "lo", "hi"])
        columns = [
            pa.array(gram), pa.array(window.view(np.int64), mask=settled), pa.array(doc.tolist(), id_type), key, start,
            pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), rows),
        ]
        return pa.RecordBatch.from_arrays(columns, names=names)

    def close(gram: int, first: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
        first = {name: x[first["open"]] for name, x in first.items()}
        for a in range(0, len(first.get("value", ())), chunk):
            f = {name: x[a : a + chunk] for name, x in first.items()}
            n, start = len(f["value"]), f["start"]
            own = (f["key"], f["pos"], start, start + MATCH)
            yield matches(np.full(n, gram), f["value"], ~f["open"], f["doc"], pa.array(f["key"]), pa.array(start.astype(np.int32)), np.arange(n + 1), own)

    def extend(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        nonlocal tail, seen
        gram, key, pos = (rows.column(c).to_numpy() for c in ("gram", "key", "pos"))
        if tail is not None and tail != gram[0]:
            yield from close(tail, seen)
            seen = {}
        docs = np.array(rows.column("doc_id").to_pylist(), object)
        left_most, right_most = (rows.column(c).to_numpy()[:, None] for c in (left, "right_most"))
        shared = np.full(len(gram), -1)  # words before the gram that an edge has too
        for edge, words in edges:
            same = _matrix(rows.column("left")) == words
            shared = np.where(gram == edge, np.maximum(shared, np.where(same.all(axis=1), SIDE, (~same).argmax(axis=1))), shared)
        sums = []
        for side, step in (("left", _LEFT), ("right", _RIGHT)):
            terms = _matrix(rows.column(side)).astype(np.uint64) * powers(step, SIDE)
            sums.append(np.concatenate([np.zeros((len(gram), 1), np.uint64), np.cumsum(terms, axis=1)], axis=1))
        n_left = np.arange(SIDE + 1)
        windows = mixed(sums[0] * np.uint64(3) + sums[1][:, ::-1] + n_left.astype(np.uint64) * _RIGHT)
        row, l = np.nonzero((n_left <= left_most) & (SIDE - n_left <= right_most))
        value = mixed(windows[row, l] ^ gram.view(np.uint64)[row])
        start = pos[row] - l
        one, at, back = np.unique(value, return_index=True, return_inverse=True)
        owner = row[at]
        first = {"value": one, "gram": gram[owner], "key": key[owner], "pos": pos[owner], "start": start[at], "doc": docs[owner], "open": l[at] <= shared[owner]}
        if seen:
            place = np.minimum(np.searchsorted(seen["value"], one), len(seen["value"]) - 1)
            old = seen["value"][place] == one
            first = {name: np.where(old, seen[name][place], x) for name, x in first.items()}
        hit = np.flatnonzero((first["key"][back] != key[row]) | (first["start"][back] != start))
        edge = np.flatnonzero(np.diff(row[hit], prepend=-1)) if len(hit) else np.zeros(0, np.int64)
        # All windows of a suffix hold its gram, so their union is one run of words.
        lo = np.minimum.reduceat(start[hit], edge) if len(hit) else hit
        hi = np.maximum.reduceat(start[hit], edge) + MATCH if len(hit) else hit
        # Windows of a row are in order of the words to their left, so its first is the rightmost.
        end = hit[edge]
        order = np.lexsort((back[end], gram[row[end]]))
        end, lo, hi = end[order], lo[order], hi[order]
        mine, window = row[end], back[end]
        group = np.flatnonzero(np.diff(window, prepend=-1))
        like = window[group]
        none = [pa.nulls(len(group), t) for t in (pa.int64(), pa.int32())]
        found_gram = gram[mine[group]]
        yield matches(found_gram, one[like], ~first["open"][like], first["doc"][like], *none, np.append(group, len(end)), (key[mine], pos[mine], lo, hi))
        if seen:
            more = ~np.isin(seen["value"], one)
            order = np.argsort(np.concatenate([one, seen["value"][more]]))
            first = {name: np.concatenate([x, seen[name][more]])[order] for name, x in first.items()}

        def of(g: int) -> dict[str, np.ndarray]:
            own = first["gram"] == g
            return {name: x[own] for name, x in first.items()} if own.any() else {}

        for g in np.unique(gram[gram != gram[-1]]):
            if any(g == edge for edge, _ in edges):
                yield from close(g, of(g))
        tail, seen = gram[-1], of(gram[-1])

    held: list[pa.Table] = []
    size = 0
    for batch in batches:
        if split and batch.num_rows:
            suffix = pa.array(~batch.column("edge").to_numpy(zero_copy_only=False))
            ends = batch.filter(pa.array(batch.column("edge").to_numpy(zero_copy_only=False)))
            edges += zip(ends.column("gram").to_pylist(), _matrix(ends.column("left")), strict=True)
            batch = batch.filter(suffix)
        if batch.num_rows:
            id_type = batch.schema.field("doc_id").type
            held.append(pa.Table.from_batches([batch]))
            size += batch.num_rows
            if size >= chunk:
                yield from extend(pa.concat_tables(held))
                held, size = [], 0
    if held:
        yield from extend(pa.concat_tables(held))
    if tail is not None:
        yield from close(tail, seen)


def _compared(matches: DataFrame) -> DataFrame:
    """`(first_doc_id, repeats)`: windows that several tasks may hold are compared among all of them."""
    open_ = matches.where("window is not null")
    here = F.when(F.col("key").isNotNull(), F.struct(F.col("first_doc_id").isNull().alias("none"), "first_doc_id", "key", "start"))
    # A window of one row is its own first occurrence, and nothing repeats it.
    firsts = open_.groupBy("window").agg(F.min(here).alias("least"), F.count("*").alias("n")).where("n > 1")
    compared = join_counted(open_, saved(firsts, "firsts"), "window", F.col("repeats")[0])
    # A task's own repeats remain repeats; its first occurrences are, unless they are the first of all.
    repeats = compared.where("key is null or key != least.key or start != least.start")
    columns = (F.col("least.first_doc_id").alias("first_doc_id"), "repeats")
    return matches.where("window is null").select("first_doc_id", "repeats").unionByName(repeats.select(*columns))


def _merged(batches: Iterator[pa.RecordBatch], id_type: pa.DataType) -> Iterator[pa.RecordBatch]:
    """Spans that meet as one, and for each suffix the first document of its last window."""
    for batch in batches:
        out, firsts = [], []
        for found in batch.column(1).to_pylist():
            last: dict[int, tuple] = {}
            runs: list[list[int]] = []
            for s in found:  # in order of `lo`
                if s["pos"] not in last or s["hi"] > last[s["pos"]][0]:
                    last[s["pos"]] = s["hi"], s["first_doc_id"]
                if runs and s["lo"] <= runs[-1][1]:
                    runs[-1][1] = max(runs[-1][1], s["hi"])
                else:
                    runs.append([s["lo"], s["hi"]])
            out.append([{"lo": a, "hi": b} for a, b in runs])
            firsts.append(sorted({d for _, d in last.values() if d is not None}))
        span = pa.list_(pa.struct([("lo", pa.int32()), ("hi", pa.int32())]))
        columns = [batch.column(0), pa.array(out, span), pa.array(firsts, pa.list_(id_type))]
        yield pa.RecordBatch.from_arrays(columns, names=["key", "spans", "first_doc_ids"])


def _matches(rows: DataFrame, grams: DataFrame, again: DataFrame, chunk: int, split: bool) -> DataFrame:
    """MATCHES of `rows(key, doc_id, text)` at the grams of `again`, each in one task or, if `split`, in several."""
    wanted = join_counted(grams, again, "gram", F.col("key")).groupBy("key").agg(F.collect_set("gram").alias("wanted"))
    id_type = rows.schema["doc_id"].dataType.simpleString()
    suffix = SUFFIX.format(id_type)
    found = rows.join(wanted, "key").select("key", "doc_id", "text", "wanted").mapInArrow(_suffixes, suffix)
    n, order = shuffle_tasks(rows.sparkSession), ["gram", F.col("doc_id").asc_nulls_last(), "key", "pos"]
    # Ranges split a gram by what follows it, and equal suffixes by their documents.
    dealt = found.repartitionByRange(n, "gram", "right", "key", "pos") if split else found.repartition(n, "gram")
    # The sorts spill; no task holds its suffixes as a whole.
    bounded, schema = _bounded("right", "right_most", "left_words"), f"{suffix}, right_most int"
    able = dealt.sortWithinPartitions("gram", "right").mapInArrow(bounded, schema)
    if split:
        bounded, schema = _bounded("left", "left_most", "right_most", True), f"{schema}, left_most int, edge boolean"
        dealt = able.repartitionByRange(n, "gram", "left", "key", "pos")
        able = dealt.sortWithinPartitions("gram", "left").mapInArrow(bounded, schema)
        order = [F.col("edge").desc(), *order]
    ordered = able.sortWithinPartitions(*order)
    run = partial(_extended, chunk=chunk, split=split)
    return ordered.mapInArrow(run, MATCHES.format(id_type))


def repeated_spans(docs: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """`(key, spans, first_doc_ids)` of the `docs(doc_id, text)` that hold repeats.

    `key` is `row_key("doc_id", "text")`. `spans` are ranges `lo <= word < hi` in order, apart from
    each other; words are runs without ASCII white space, A-Z in lower case. A word is in a span
    if some MATCH consecutive words around it occur earlier: in a smaller doc_id (null last), or
    before in the text; `first_doc_ids` are the documents of such first occurrences. Null, empty
    and shorter texts have no repeats. Rows that agree in doc_id and text are one document and
    do not repeat each other. Other columns are ignored; no rows, no result rows.

    Words are compared by 32 bits of their hashes and windows by 64. A task holds the windows of
    one gram, or of its own part of one; where there are ranges, Spark's sample for them, about 200 bytes for each of 100
    suffixes a task and a million at most, is on the driver.
    """
    spark = docs.sparkSession
    small_batches(spark)
    rows = docs.select(row_key("doc_id", "text").alias("key"), "doc_id", "text")
    grams = saved(rows.select("key", "text").mapInArrow(_grams, "gram long, key long"), "grams")
    again = saved(grams.groupBy("gram").agg(F.count("*").alias("n")).where("n > 1"), "again")
    # A gram of more rows would be a good part of a task.
    share = hot_share(again)
    hot, others = again.where(F.col("n") > share), again.where(F.col("n") <= share)
    matches = _matches(rows, grams, others, chunk, False)
    if not hot.isEmpty():
        matches = matches.unionByName(_matches(rows, grams, hot, chunk, True))
    matches = saved(matches, "matches")
    spans = _compared(matches).select("first_doc_id", F.explode("repeats").alias("r"))
    per_doc = spans.groupBy("r.key").agg(
        F.array_sort(F.collect_set(F.struct("r.lo", "r.hi", "r.pos", "first_doc_id"))).alias("found")
    )
    id_type = docs.schema["doc_id"].dataType.simpleString()
    schema = f"key long, spans array<struct<lo:int,hi:int>>, first_doc_ids array<{id_type}>"
    arrow_id = docs.select("doc_id").limit(0).toArrow().schema.field("doc_id").type
    return saved(per_doc.mapInArrow(partial(_merged, id_type=arrow_id), schema), "spans")


def _cut(batches: Iterator[pa.RecordBatch], text_at: int, keep_emptied: bool) -> Iterator[pa.RecordBatch]:
    """Texts without the words of their spans and the white space after each."""
    for batch in batches:
        stays = np.ones(batch.num_rows, bool)
        out = batch.column(text_at).to_pylist()
        spans = batch.column(batch.num_columns - 1).to_pylist()
        for texts in pieces(batch.column(text_at), lower=False):
            words = find_words(texts, NOT_SPACE, hashed=False)
            for i in range(len(texts.offsets) - 1):
                if not spans[texts.first + i]:
                    continue
                base, end = int(texts.offsets[i]), int(texts.offsets[i + 1])
                starts = words.starts[words.bounds[i] : words.bounds[i + 1]]
                kept, at = [], base
                for s in spans[texts.first + i]:
                    kept.append(texts.data[at : starts[s["lo"]]].tobytes())
                    at = int(starts[s["hi"]]) if s["hi"] < len(starts) else end
                kept.append(texts.data[at:end].tobytes())
                stays[texts.first + i] = keep_emptied or bool(b"".join(kept).strip())
                out[texts.first + i] = b"".join(kept).decode()
        columns = batch.columns[:-1]
        columns[text_at] = pa.array(out, batch.schema.field(text_at).type)
        cut = pa.RecordBatch.from_arrays(columns, names=batch.schema.names[:-1])
        yield cut if stays.all() else cut.filter(pa.array(stays))


def without_repeats(docs: DataFrame, keep_emptied: bool = True) -> DataFrame:
    """`docs` with repeats cut out of `text`; every other column, and texts without repeats, stay.

    A document that is one long repeat is left with an empty text, or goes without `keep_emptied`.
    See `repeated_spans`.
    """
    found, spans = repeated_spans(docs), free_name(docs, "spans")
    packed = docs.select(F.struct("*").alias("doc"), row_key("doc_id", "text").alias("key"))
    whole = packed.join(found.select("key", F.col("spans").alias("cuts")), "key", "left")
    text_at = docs.columns.index("text")
    run = partial(_cut, text_at=text_at, keep_emptied=keep_emptied)
    return whole.select("doc.*", F.col("cuts").alias(spans)).mapInArrow(run, docs.schema)
