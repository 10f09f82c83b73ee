"""A page of search hits and the number of all hits, from one scan."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import partial

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import SEARCH_SIZE, YEAR
from .documents import ID

#: Column, and whether its greatest value comes first. NULL comes last either way.
Order = tuple[str, bool]
NEWEST: tuple[Order, ...] = ((YEAR, True), (ID, False))


def _keys(df: DataFrame, order: Sequence[Order]) -> tuple[list[Column], list[tuple[str, str]]]:
    """Sort columns, with those before them that say where NULL and NaN come."""
    columns, ways = [], []
    for i, (name, down) in enumerate(order):
        c, kind = F.col(f"`{name}`"), df.schema[name].dataType.simpleString()
        way = "descending" if down else "ascending"
        columns.append(c.isNull().cast("int").alias(f"_null{i}"))
        ways.append((f"_null{i}", "ascending"))
        if kind in ("float", "double"):
            columns.append(F.coalesce(F.isnan(c), F.lit(False)).cast("int").alias(f"_nan{i}"))
            ways.append((f"_nan{i}", way))
            c = F.when(~F.isnan(c), c)
        columns.append(c.alias(f"_key{i}"))
        ways.append((f"_key{i}", way))
    return columns, ways


def _best(batches: Iterator[pa.RecordBatch], size: int, ways: list[tuple[str, str]]) -> Iterator[pa.RecordBatch]:
    """The first `size` rows of a task, and in every row the number of all, in `_hits`.

    Rows come as hits, or as what other tasks have kept: then `_hits` is theirs, on one row each.
    A task without rows says nothing; one whose rows are all counted keeps at least one.
    """
    held: pa.Table | None = None
    total = 0
    at = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        at = table.schema.get_field_index("_hits")
        total += pc.sum(table.column("_hits")).as_py()
        held = table if held is None else pa.concat_tables([held, table])
        if held.num_rows > size:
            held = held.take(pc.sort_indices(held, sort_keys=ways)[: max(1, size)])
    if held is not None:
        held = held.take(pc.sort_indices(held, sort_keys=ways)).combine_chunks()
        counts = pa.array([total] + [0] * (held.num_rows - 1), pa.int64())
        yield from held.set_column(at, "_hits", counts).to_batches()


def search_page(
    df: DataFrame, where: Column | None = None, size: int = SEARCH_SIZE, order: Sequence[Order] = NEWEST
) -> DataFrame:
    """`(total, rank, hit)`: the first `size` hits in order with their rank, and how many there are.

    Every task keeps its own first `size` rows next to a count, and one small task merges those. So
    the documents are read once for both. Without a hit there is one row, of total 0 and no hit;
    with `size` 0 it has the total. End `order` with a column that tells documents apart.
    """
    keys, ways = _keys(df, order)
    hits = df if where is None else df.where(where)
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("hit")
    sized = hits.select(row, *keys, F.lit(1).cast("long").alias("_hits"))
    best = partial(_best, size=size, ways=ways)
    merged = sized.mapInArrow(best, sized.schema).repartition(1).mapInArrow(best, sized.schema)
    # The merging task kept the order; it leaves `size` rows, or one of size 0 for the count.
    page = merged.agg(
        F.coalesce(F.sum("_hits"), F.lit(0)).alias("total"), F.slice(F.collect_list("hit"), 1, size).alias("hits")
    )
    return page.select("total", F.posexplode_outer("hits").alias("rank", "hit")).withColumn("rank", F.col("rank") + 1)
