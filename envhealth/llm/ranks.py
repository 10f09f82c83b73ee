"""Order and prefix sums of tables that no task holds whole."""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scratch import free_name, saved, shuffle_tasks


def _running(batches: Iterator[pa.RecordBatch], sums: list[str], part: str) -> Iterator[pa.RecordBatch]:
    """Replaces each weight by the sum of the weights before it in this partition."""
    number = TaskContext.get().partitionId()
    totals = dict.fromkeys(sums, 0)
    for batch in batches:
        names = batch.schema.names
        columns = list(batch.columns)
        for name in sums:
            weight = columns[names.index(name)].to_numpy(zero_copy_only=False).astype(np.int64)
            running = np.cumsum(weight) + totals[name]
            if len(running):
                totals[name] = int(running[-1])
            columns[names.index(name)] = pa.array(running - weight)
        columns[names.index(part)] = pa.array(np.full(batch.num_rows, number, np.int32))
        yield pa.RecordBatch.from_arrays(columns, names=names)


def prefix_sums(df: DataFrame, order: list[Column], **weights: Column) -> DataFrame:
    """`df` with, for each name in `weights`, the sum of that weight over all earlier rows of `order`.

    Rows are dealt by ranges of `order`, summed within each range as they stream by, and moved up
    by the sums of the ranges before, of which there is one per shuffle partition. Ranges split
    nothing that is equal in `order`, so let it end with something that tells hot rows apart. Rows
    that are equal in it come in any order. Weights are longs and not null.
    """
    spark = df.sparkSession
    part = free_name(df, "_part")
    names = list(weights)
    wide = df.withColumns({name: w.cast("long") for name, w in weights.items()}).withColumn(part, F.lit(0))
    dealt = wide.repartitionByRange(shuffle_tasks(spark), *order).sortWithinPartitions(*order)
    # The weights stay next to the sums until the totals of the ranges are known.
    kept = {name: free_name(df, f"_{name}") for name in names}
    dealt = dealt.withColumns({kept[name]: F.col(name) for name in names})
    summed = saved(dealt.mapInArrow(partial(_running, sums=names, part=part), dealt.schema), "ranges")
    tops = summed.groupBy(part).agg(*[F.max(F.col(name) + F.col(kept[name])).alias(name) for name in names])
    offsets, before = [], dict.fromkeys(names, 0)
    for row in sorted(tops.collect()):  # one row a range
        offsets.append((row[0], *before.values()))
        before = {name: before[name] + row[name] for name in names}
    moved = {name: free_name(summed, f"_before_{name}") for name in names}
    schema = ", ".join([f"`{part}` int", *[f"`{moved[name]}` long" for name in names]])
    table = spark.createDataFrame(offsets, schema)
    out = summed.join(F.broadcast(table), part)
    return out.select(
        *[F.col(f"`{c}`") for c in df.columns], *[(F.col(name) + F.col(moved[name])).alias(name) for name in names]
    )
