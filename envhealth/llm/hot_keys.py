"""Joins with a table of counted keys, where one key may hold any share of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scratch import shuffle_tasks

#: A key with more than this part of a task's even share of rows is spread over several tasks.
SHARE = 4


def hot_share(counted: DataFrame) -> float:
    """Rows from which a key of `counted(n)` is spread: a SHAREth part of a task's even share."""
    total = counted.agg(F.sum("n")).first()[0] or 1
    return max(1.0, total / (SHARE * shuffle_tasks(counted.sparkSession)))


def join_counted(rows: DataFrame, counted: DataFrame, key: str, spread: Column) -> DataFrame:
    """`rows` inner-joined on `key` with `counted(key, n, ...)`, one row a key, which is read three times.

    `n` is the number of rows that hold the key. Keys with more than the SHAREth part of a task's
    rows are at most SHARE times as many as there are tasks, so their list is broadcast; their
    rows are dealt by `spread`, and their one row of `counted` is sent to each part. A null key joins nothing.
    """
    parts, part = f"_{key}_parts", f"_{key}_part"
    share = hot_share(counted)
    hot = F.broadcast(counted.where(F.col("n") > share).select(key, F.ceil(F.col("n") / share).cast("int").alias(parts)))
    one = F.coalesce(F.col(parts), F.lit(1))
    dealt = rows.join(hot, key, "left").withColumn(part, F.pmod(F.xxhash64(spread), one).cast("int")).drop(parts)
    each = counted.join(hot, key, "left").withColumn(part, F.explode(F.sequence(F.lit(0), one - 1))).drop(parts, "n")
    return dealt.join(each, [key, part]).drop(part)
