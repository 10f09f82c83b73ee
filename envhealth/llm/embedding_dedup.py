"""Near-duplicate embeddings by cross-polytope hashing.

A vector is rotated by sign flips and fast Hadamard transforms; its hash is the axis it then lies
nearest to. A table joins a few such hashes to one bucket; next to its own bucket a vector also
looks into those of the second nearest axes. Pairs that meet are verified by their cosine in
double precision. Each pair is counted in the first table that it meets in, so counts of
links add up over tasks without pairs being written out.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import partial
from itertools import product
from math import ceil, log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import components, forest
from .scratch import saved, shuffle_tasks, small_batches

COSINE = 0.93
#: Simulated share of pairs at the threshold itself that meet; nearer ones meet more often.
RECALL, MOST_TABLES = 0.99, 40
#: Vectors of a label that share a bucket, about; decides how many hashes a table joins.
BUCKET = 256
#: Rows of a bucket that one task compares with each other; larger buckets are split into cells.
CELL = 8192
BLOCK = 1024


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of each row; the width is a power of two."""
    n, width = x.shape
    h = 1
    while h < width:
        x = x.reshape(n, width // (2 * h), 2, h)
        x = np.stack([x[:, :, 0] + x[:, :, 1], x[:, :, 0] - x[:, :, 1]], axis=2)
        h *= 2
    return x.reshape(n, width) / np.sqrt(width)


def axes(x: np.ndarray, table: int, which: int) -> np.ndarray:
    """Numbers of the nearest and the second nearest signed axis after a pseudo-random rotation."""
    width = x.shape[1]
    signs = np.random.default_rng([width, table, which]).choice([-1.0, 1.0], (3, width))
    for flip in signs:
        x = hadamard(x * flip)
    size = np.abs(x)
    rows = np.arange(len(x))
    first = size.argmax(axis=1)
    size[rows, first] = -1
    second = size.argmax(axis=1)
    return np.stack([2 * i + (x[rows, i] < 0) for i in (first, second)], axis=1)


def bucket_codes(vectors: np.ndarray, hashes: int, tables: Sequence[int]) -> np.ndarray:
    """`n x tables x 2**hashes` bucket codes; the first of each table is the vector's own."""
    width = 1 << max(1, ceil(log(max(2, vectors.shape[1]), 2)))
    x = np.zeros((len(vectors), width))
    x[:, : vectors.shape[1]] = vectors
    out = np.zeros((len(x), len(tables), 1 << hashes), np.int64)
    for t, table in enumerate(tables):
        near = [axes(x, table, k) for k in range(hashes)]
        for i, choice in enumerate(product((0, 1), repeat=hashes)):
            for k, c in enumerate(choice):
                out[:, t, i] = out[:, t, i] * (2 * width) + near[k][:, c]
    return out


def meets(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether pairs of code rows `n x tables x codes` meet in each table."""
    one = (a[:, :, :1] == b).any(axis=2)
    return one | (b[:, :, :1] == a).any(axis=2)


def tables_needed(width: int, hashes: int, cosine: float) -> int:
    """Tables with which simulated random pairs at the threshold meet often enough."""
    rng = np.random.default_rng(11)
    x, z = rng.normal(size=(2, 1500, width))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    z -= (z * x).sum(axis=1, keepdims=True) * x
    z /= np.maximum(np.linalg.norm(z, axis=1, keepdims=True), 1e-12)
    y = cosine * x + np.sqrt(1 - cosine**2) * z
    met = np.zeros(len(x), bool)
    for t in range(MOST_TABLES):
        met |= meets(bucket_codes(x, hashes, [t]), bucket_codes(y, hashes, [t]))[:, 0]
        if met.mean() >= RECALL:
            return t + 1
    return MOST_TABLES


def _coded(batches: Iterator[pa.RecordBatch], hashes: int, tables: dict[int, int]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sizes = batch.column("width").to_numpy()
        flat = batch.column("vector").flatten().to_numpy()
        at = np.concatenate([[0], np.cumsum(sizes)])
        codes: list = [None] * batch.num_rows
        for width in np.unique(sizes):
            rows = np.flatnonzero(sizes == width)
            vectors = flat[at[rows][:, None] + np.arange(width)].astype(np.float64)
            # By the largest component first: squares of huge or tiny ones do not overflow.
            vectors /= np.abs(vectors).max(axis=1, keepdims=True)
            vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
            for i, c in zip(rows, bucket_codes(vectors, hashes, range(tables[int(width)])), strict=True):
                codes[i] = c.reshape(-1)
        out = [*batch.columns, pa.array(codes, pa.list_(pa.int64()))]
        yield pa.RecordBatch.from_arrays(out, names=[*batch.schema.names, "codes"])


class _Bucket:
    """Rows of one cell: unit vectors, codes, roles."""

    def __init__(self, rows: pa.Table, probes: int):
        self.id, self.copies, self.part = (rows.column(c).to_numpy() for c in ("class_id", "copies", "part"))
        self.place = rows.column("place").to_numpy()
        width = rows.column("width")[0].as_py()
        vectors = rows.column("vector").combine_chunks().flatten().to_numpy().reshape(-1, width).astype(np.float64)
        vectors /= np.abs(vectors).max(axis=1, keepdims=True)
        self.unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
        self.codes = rows.column("codes").combine_chunks().flatten().to_numpy().reshape(len(rows), -1, probes)
        self.table = int(self.place[0] // probes)
        self.own = self.place % probes == 0

    def links(self, cosine: float, cell: tuple[int, int]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Verified pairs (place in rows) that are to be counted here, a block at a time."""
        base = np.flatnonzero(self.own & (self.part == cell[1]) | self.own & (self.part == cell[0]))
        every = np.arange(len(self.id))
        for i in range(0, len(base), BLOCK):
            for j in range(0, len(every), BLOCK):
                x, y = base[i : i + BLOCK], every[j : j + BLOCK]
                a, b = np.nonzero(self.unit[x] @ self.unit[y].T >= cosine)
                a, b = x[a], y[b]
                fits = self.id[a] != self.id[b]
                # Own buckets meet once, at the smaller id; across the parts of a cell only there.
                fits &= ~self.own[b] | (self.id[a] < self.id[b])
                if cell[0] != cell[1]:
                    fits &= self.part[a] != self.part[b]
                a, b = a[fits], b[fits]
                met = meets(self.codes[a, : self.table + 1], self.codes[b, : self.table + 1])
                first = ~met[:, :-1].any(axis=1)
                ca, cb = self.codes[a, self.table], self.codes[b, self.table]
                probing = ~self.own[b]
                # A probe meets a bucket's own vector: not if both are at home in one bucket, and
                # once if each looks into the other's.
                both_own = ca[:, 0] == cb[:, 0]
                mutual = (ca == cb[:, :1]).any(axis=1)
                first &= ~probing | (~both_own & (~mutual | (self.id[a] < self.id[b])))
                yield a[first], b[first]


def _counted(batches: Iterator[pa.RecordBatch], cosine: float, probes: int) -> Iterator[pa.RecordBatch]:
    """`(a, b, n_links)`: counts as (class, null, n) and enough links to connect a bucket as (a, b, 0)."""
    held: list[pa.Table] = []

    def out(a, b, n):
        columns = [pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(n, pa.int64())]
        return pa.RecordBatch.from_arrays(columns, names=["a", "b", "n_links"])

    def group(rows: pa.Table):
        if len(rows) < 2:
            return
        cell = (rows.column("low")[0].as_py(), rows.column("high")[0].as_py())
        bucket = _Bucket(rows, probes)
        counts = np.zeros(len(rows), np.int64)
        tops, others = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for a, b in bucket.links(cosine, cell):
            np.add.at(counts, a, bucket.copies[b])
            np.add.at(counts, b, bucket.copies[a])
            if len(a):
                tops, others = forest(np.append(tops, bucket.id[a]), np.append(others, bucket.id[b]))
        some = counts > 0
        if some.any():
            yield out(bucket.id[some], [None] * int(some.sum()), counts[some])
            yield out(tops, others, np.zeros(len(tops), np.int64))

    def groups(rows: pa.Table, whole: bool):
        key = np.stack([rows.column(c).to_numpy() for c in ("key", "low", "high")], axis=1)
        edge = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]).any(axis=1), [True]]))
        stop = len(edge) - 1 if whole else len(edge) - 2
        for i in range(stop):
            yield from group(rows.slice(edge[i], edge[i + 1] - edge[i]))
        held[:] = [] if whole else [rows.slice(edge[-2])]

    for batch in batches:
        if batch.num_rows:
            held.append(pa.Table.from_batches([batch]))
            yield from groups(pa.concat_tables(held), False)
    if held:
        yield from groups(pa.concat_tables(held), True)


def near_duplicates(vectors: DataFrame, cosine: float = COSINE) -> DataFrame:
    """`(vec_id, n_links, component_id, kept)`, one row per row of `vectors(vec_id, embedding, label)`.

    Vectors link if their labels are equal and not null, their lengths are equal, and their
    cosine is at least `cosine`; a vector that is null, empty, zero, or holds a null or
    non-finite component links with nothing. `n_links` counts other rows, equal vectors included.
    Equal vectors are one class until the end, of any number of rows. `component_id` is the
    smallest vec_id reachable; `kept` marks that row. A null vec_id keeps its row, counts as a
    link, is the component only of nulls, and is never kept. Other columns are ignored; no rows,
    no result rows.
    """
    spark = vectors.sparkSession
    small_batches(spark)
    good = F.size("embedding") > 0
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    nonzero = F.exists("embedding", lambda x: x != 0)
    able = F.coalesce(F.col("label").isNotNull() & good & finite & nonzero, F.lit(False))
    keys = [F.xxhash64("label", "embedding").alias("k1"), F.hash("embedding", "label").alias("k2")]
    rows = vectors.select("vec_id", "label", "embedding", able.alias("able"), *keys)
    classes = rows.where("able").groupBy("k1", "k2").agg(
        F.count(F.lit(1)).alias("copies"), F.min("vec_id").alias("least"),
        F.first("label").alias("label"), F.first("embedding").alias("vector"),
    )
    classes = classes.withColumn("class_id", F.monotonically_increasing_id()).withColumn("width", F.size("vector"))
    classes = saved(classes, "classes")
    # Only the number of vector lengths comes to the driver, and the largest label.
    widths = [r[0] for r in classes.select("width").distinct().collect()]
    largest = classes.groupBy("label").count().agg(F.max("count")).first()[0] or 1
    hashes = int(np.clip(ceil(log(max(1.0, largest / BUCKET)) / log(2 * max([2, *widths]))), 1, 3))
    tables = {w: tables_needed(w, hashes, cosine) for w in widths}
    probes = 1 << hashes
    coded = classes.select("class_id", "label", "copies", "width", "vector")
    schema = f"class_id long, label {classes.schema['label'].dataType.simpleString()}, copies long, width int, vector {classes.schema['vector'].dataType.simpleString()}, codes array<long>"
    coded = saved(coded.mapInArrow(partial(_coded, hashes=hashes, tables=tables), schema), "codes")
    placed = coded.select("*", F.posexplode("codes").alias("place", "code"))
    table = F.floor(F.col("place") / probes)
    placed = placed.withColumn("key", F.xxhash64("label", "width", table, "code")).drop("code", "label")
    large = placed.groupBy("key").count().where(F.col("count") > CELL)
    cells = F.ceil(F.coalesce("count", F.lit(1)) / CELL)
    dealt = placed.join(large, "key", "left").withColumn("cells", cells)
    dealt = dealt.withColumn("part", F.pmod(F.xxhash64("class_id"), F.col("cells")))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("cells") - 1)))
    dealt = dealt.withColumns({"low": F.least("part", "other"), "high": F.greatest("part", "other")})
    columns = ["key", "low", "high", "part", "place", "class_id", "copies", "width", "vector", "codes"]
    grouped = dealt.select(*columns).repartition(shuffle_tasks(spark), "key", "low", "high").sortWithinPartitions("key", "low", "high")
    found = saved(grouped.mapInArrow(partial(_counted, cosine=cosine, probes=probes), "a long, b long, n_links long"), "found")
    counts = found.where("b is null").groupBy("a").agg(F.sum("n_links").alias("n"))
    roots = components(found.where("b is not null").select("a", "b"))
    info = classes.select("k1", "k2", "class_id", "copies", "least")
    info = info.join(counts, info["class_id"] == counts["a"], "left").drop("a")
    info = info.join(roots, info["class_id"] == roots["node"], "left").withColumn("root", F.coalesce("root", "class_id"))
    info = saved(info.select("k1", "k2", "root", "least", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links")), "links")
    least = info.groupBy("root").agg(F.min("least").alias("component_id"))
    info = info.join(least, "root").select("k1", "k2", "n_links", "component_id", F.lit(True).alias("able"))
    joined = rows.select("vec_id", "able", "k1", "k2").join(info, ["k1", "k2", "able"], "left")
    component = F.when(F.col("able"), F.col("component_id")).otherwise(F.col("vec_id"))
    return joined.select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"),
    )
