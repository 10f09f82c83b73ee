"""Mixing sources to target weights by dependent rounding of copy counts.

A source whose target is r times its size wants r copies of each of its documents. The whole
part is taken at once, and so is what the fractions of rows that are alike add up to in whole
copies. What is left is rounded by pivotal sampling: two fractions of a source meet, and mass moves at random from one to the other until one is 0 or 1. The one left over
meets the next. Small blocks of a source do this in parallel, and what each leaves over meets
again along a tree until one fraction per source remains.
"""

from __future__ import annotations

import random
from collections.abc import Iterator, Sequence
from math import ceil, log2

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.documents import ordered_positions
from .scratch import saved, shuffle_tasks

#: Words of a text: maximal runs that hold no ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (1.0, 2.0, 3.0)
MOST_COPIES = 3
#: Documents that meet in one block, on average at most, and blocks that meet in the next level.
BLOCK, FAN_IN = 1024, 32
#: Rows that are alike and written out again together.
RUN = 1 << 18
ROUND_OFF = 1e-9


def word_count(text: str | Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sized: DataFrame, weights: Sequence[float], most: float) -> DataFrame:
    """`(source, source_size, target)`: shares by weight, at most `most` times the size.

    The excess of sources at their limit goes to the others by weight, until none is above:
    target = least(level * weight, most * size), where the level rises until the targets add
    up to the total size. Every step is one aggregate over the table of sources.
    """
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = ordered_positions(totals.withColumn("_none", F.col("source").isNull()), "_none", "source", position="_rank")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("_rank") % len(weights) + 1).cast("int"))
    table = saved(ranked.select("source", "source_size", weight.alias("weight")), "sources")
    limit = F.col("source_size") * float(most)
    total, all_weights = table.agg(F.sum("source_size"), F.sum("weight")).first()
    level, before = (total or 0) / (all_weights or 1.0), -1.0
    while level > before:
        full = limit <= F.col("weight") * level
        fixed, open_weight = table.agg(F.sum(F.when(full, limit)), F.sum(F.when(~full, F.col("weight")))).first()
        if not open_weight:
            break
        before, level = level, (total - (fixed or 0.0)) / open_weight
    return table.select("source", "source_size", F.least(F.col("weight") * level, limit).alias("target"))


def pivot(sizes: list[int], chances: list[float], rand: random.Random) -> list[float]:
    """Chances after each has met the one left over so far: all are 0 or 1 but at most one.

    What moves between two documents is expected words, chance times size, so the sum over the
    block stays; the direction is drawn so that each chance keeps its expectation.
    """
    out = list(chances)
    carry = None
    for i in range(len(out)):
        if not ROUND_OFF < out[i] < 1 - ROUND_OFF:
            out[i] = float(round(out[i]))
            continue
        if carry is None:
            carry = i
            continue
        gain = min((1 - out[carry]) * sizes[carry], out[i] * sizes[i])
        loss = min(out[carry] * sizes[carry], (1 - out[i]) * sizes[i])
        moved = gain if rand.random() * (gain + loss) < loss else -loss
        out[carry] += moved / sizes[carry]
        out[i] -= moved / sizes[i]
        for j in (carry, i):
            if not ROUND_OFF < out[j] < 1 - ROUND_OFF:
                out[j] = float(round(out[j]))
        carry = next((j for j in (carry, i) if 0 < out[j] < 1), None)
    return out


def _level(seed: str):
    """Rounds sorted rows block by block. A block's chances only depend on its own rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None

        def rounded(table: pa.Table) -> pa.RecordBatch:
            keys = list(zip(table.column("source").to_pylist(), table.column("block").to_pylist(), strict=True))
            size, chance = table.column("size").to_pylist(), table.column("chance").to_pylist()
            out, i = [], 0
            while i < len(keys):
                j = i
                while j < len(keys) and keys[j] == keys[i]:
                    j += 1
                out += pivot(size[i:j], chance[i:j], random.Random(f"{seed}|{keys[i]!r}"))
                i = j
            at = table.schema.get_field_index("chance")
            table = table.set_column(at, "chance", pa.array(out, pa.float64()))
            return table.combine_chunks().to_batches()

        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            held = table if held is None else pa.concat_tables([held, table])
            source, block = held.column("source"), held.column("block")
            last = (source[-1].as_py(), block[-1].as_py())
            stop = held.num_rows - 1
            while stop > 0 and (source[stop - 1].as_py(), block[stop - 1].as_py()) == last:
                stop -= 1
            if stop:
                yield from rounded(held.slice(0, stop))
                held = held.slice(stop)
        if held is not None and held.num_rows:
            yield from rounded(held)

    return run


def _each_row(groups: DataFrame, run: int) -> DataFrame:
    """`n` rows for each group, numbered by `_i`; a large group is cut into runs over all tasks."""
    n, step, zero = F.col("n"), F.lit(run).cast("long"), F.lit(0).cast("long")
    few = groups.where(n <= step).withColumn("_first", zero)
    many = groups.where(n > step).withColumn("_first", F.explode(F.sequence(zero, n - 1, step)))
    many = many.repartition(shuffle_tasks(groups.sparkSession), "doc_id", "size", "_first")
    numbers = F.sequence("_first", F.least(F.col("_first") + step, n) - 1)
    return few.unionByName(many).withColumn("_i", F.explode(numbers)).drop("_first")


def mix(
    docs: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    most: int = MOST_COPIES,
    seed: int = 1,
    run: int = RUN,
) -> DataFrame:
    """`(doc_id, source, size, source_size, target, copies)`, one row per document.

    Sources by code point, null last, get the weights in turn and share the total size; a target
    stops at `most` times the source's size. `copies` is 0 to `most`; a source's taken words miss its
    target by at most half of one of its documents.
    The draw depends on `seed`, sources, sizes and ids only, so that reruns agree; of repeated
    rows that are alike it is not said which is taken; they cost what one row does until they are
    written out again, `run` rows at a time. A null or empty text has size 0 and is
    never taken; if all texts are empty every target is 0. A null doc_id is a value like any other.
    Other columns are ignored; no rows, no result rows.
    """
    spark = docs.sparkSession
    sized = docs.select("doc_id", "source", word_count("text").alias("size"))
    alike = saved(sized.groupBy("doc_id", "source", "size").agg(F.count("*").alias("n")), "sizes")
    targets = source_targets(alike.select("source", (F.col("size") * F.col("n")).alias("size")), weights, most)
    wants = F.when(F.col("size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    info = targets.withColumnRenamed("source", "_source")
    full = alike.join(info, alike["source"].eqNullSafe(info["_source"])).drop("_source")
    full = full.withColumn("_wants", wants).withColumn("whole", F.floor(F.col("_wants") + ROUND_OFF))
    full = full.withColumn("_mass", F.greatest(F.col("_wants") - F.col("whole"), F.lit(0.0)) * F.col("n"))
    # Of n alike rows `more` get one copy above `whole`; the rest of their mass is one row's chance.
    full = full.withColumn("more", F.floor(F.col("_mass") + ROUND_OFF))
    chance = F.greatest(F.col("_mass") - F.col("more"), F.lit(0.0))
    blocks = 1 << max(0, ceil(log2(max(1, alike.count() / BLOCK))))
    spread = F.pmod(F.xxhash64("doc_id", "size", F.lit(seed)), F.lit(blocks))
    columns = ["doc_id", "source", "size", "n", "source_size", "target", "whole", "more"]
    rows = saved(full.select(*columns, chance.alias("chance"), spread.alias("block")), "chances")
    is_open = (F.col("chance") > 0) & (F.col("chance") < 1)
    done, left, level = [rows.where(~is_open)], rows.where(is_open), 0
    while True:
        dealt = left.repartition(shuffle_tasks(spark), "source", "block")
        ordered = dealt.sortWithinPartitions("source", "block", F.desc("size"), "doc_id")
        met = saved(ordered.mapInArrow(_level(f"{seed}|{level}"), left.schema), "rounded")
        if blocks == 1:
            break
        done.append(met.where(~is_open))
        blocks, level = max(1, blocks // FAN_IN), level + 1
        left = met.where(is_open).withColumn("block", F.pmod("block", F.lit(blocks)))
    done.append(met.withColumn("chance", F.round("chance")))
    out = done[0]
    for part in done[1:]:
        out = out.unionByName(part)
    chosen = F.col("_i") < F.col("more") + F.col("chance")
    copies = (F.col("whole") + chosen.cast("int")).cast("int").alias("copies")
    return _each_row(out, run).select("doc_id", "source", "size", "source_size", "target", copies)
