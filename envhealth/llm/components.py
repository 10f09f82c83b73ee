"""Connected components of a graph that only exists as a distributed table of links."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import saved

SCHEMA = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For some links, each node that is not the smallest of its component, and that smallest."""
    nodes, flat = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = flat[: len(a)], flat[len(a) :]
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[x], root[y])
        new = root.copy()
        np.minimum.at(new, root[x], low)
        np.minimum.at(new, root[y], low)
        while not np.array_equal(new[new], new):
            new = new[new]
        if np.array_equal(new, root):
            break
        root = new
    moved = root != np.arange(len(nodes))
    return nodes[moved], nodes[root[moved]]


def _contracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each batch of links as a star forest over the same nodes, never more rows than came."""
    for batch in batches:
        if batch.num_rows:
            a, b = forest(batch.column(0).to_numpy(), batch.column(1).to_numpy())
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], schema=SCHEMA)


def components(links: DataFrame) -> DataFrame:
    """`(node, root)` for every node of `links(a, b)`; root is the component's smallest node.

    Links are first contracted batch by batch, then large-star and small-star rounds run until
    nothing changes: every round is joins and map-side aggregated minima, no component is
    ever gathered, and a hub's links may be split over tasks. Loops and repeated links are
    allowed; nodes without a link to another node are absent; no links, no rows.
    """
    edges = saved(links.select("a", "b").where("a <> b").mapInArrow(_contracted, "a long, b long"), "links")
    state = None
    while True:
        both = edges.union(edges.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b").distinct()
        small_least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(small_least, "a")
        moved = small.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = saved(moved.union(small_least.select("a", "m")).distinct(), "links")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots)
