"""Typed documents: schema conformance, lineage, identifiers, JSON lines."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructType

from ..checkpoints import checkpointed
from ..constants import METRIC_COLUMNS
from ..functions import as_date, coerce_double, nan_to_null, to_int
from ..schemas import DOCUMENT, JSON_OPTIONS
from .quality import drop_critical_nulls

ID = "_id"
POSITION = "_position"
# A content with more copies than this is spread over several tasks to be numbered.
COPIES_PER_TASK = 1 << 18


def coerce_numeric(
    df: DataFrame, columns: list[str] | tuple[str, ...] = METRIC_COLUMNS
) -> DataFrame:
    """Text in the listed columns becomes a number or NULL; numeric columns stay as they are."""
    text = {f.name for f in df.schema.fields if isinstance(f.dataType, StringType)}
    return df.withColumns({c: coerce_double(F.col(f"`{c}`")) for c in columns if c in text})


def nulls_for_nan(df: DataFrame) -> DataFrame:
    """NULL instead of NaN in every floating-point column."""
    floating = [
        f.name for f in df.schema.fields if f.dataType.simpleString() in ("float", "double")
    ]
    return df.withColumns({c: nan_to_null(F.col(f"`{c}`")) for c in floating})


def add_lineage(
    df: DataFrame, run_date: dt.date | str, indexed_at: dt.datetime | str
) -> DataFrame:
    run_date = as_date(run_date)
    return df.withColumns(
        {
            "indexed_at": F.lit(str(indexed_at)).cast("timestamp_ntz"),
            "data_source": F.lit(f"combined_{run_date.isoformat()}"),
            "processing_date": F.lit(run_date),
        }
    )


def conform(df: DataFrame, schema: StructType = DOCUMENT, keep_extra: bool = True) -> DataFrame:
    """Cast to the schema by name; a value that does not fit is NULL, a missing column too.

    Columns outside the schema follow at the end, or are left out.
    """
    types = {f.name: f.dataType for f in df.schema.fields}

    def fitted(field) -> Column:
        if field.name not in types:
            return F.lit(None).cast(field.dataType)
        c = F.col(f"`{field.name}`")
        if types[field.name] == field.dataType:
            return c
        if isinstance(field.dataType, IntegerType) and isinstance(types[field.name], StringType):
            return to_int(c)
        return c.try_cast(field.dataType)

    known = set(schema.names)
    extra = [F.col(f"`{c}`") for c in df.columns if keep_extra and c not in known]
    return df.select(*[fitted(f).alias(f.name) for f in schema.fields], *extra)


def content_hash(columns: list[str]) -> Column:
    """Hash of the row as JSON with explicit nulls, so NULL and absent text differ."""
    row = F.struct(*[F.col(f"`{c}`") for c in columns])
    return F.sha2(F.to_json(row, JSON_OPTIONS), 256)


def number_copies(df: DataFrame, copy: str = "_copy", **derived: Column) -> DataFrame:
    """Number equal rows 0, 1, 2, ... without ever gathering them.

    Copies are counted (map-side first) instead of collected, and written out again
    from the count. A content with very many copies is first cut into runs that are
    spread over all tasks. `derived` columns are computed once per content.
    """
    columns = [F.col(f"`{c}`") for c in df.columns]
    counted = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("_copies")).withColumns(derived)
    copies, run = F.col("_copies"), F.lit(COPIES_PER_TASK).cast("bigint")
    zero = F.lit(0).cast("bigint")
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    few = counted.where(copies <= run).withColumn("_first", zero)
    many = (
        counted.where(copies > run)
        .withColumn("_first", F.explode(F.sequence(zero, copies - 1, run)))
        .repartition(tasks, "_first", *columns)
    )
    last = F.least(F.col("_first") + run, copies) - 1
    return few.unionByName(many).select(
        *columns, *derived, F.explode(F.sequence("_first", last)).alias(copy)
    )


def hash_ids(df: DataFrame, run_date: dt.date | str) -> DataFrame:
    """Identifier `<run_date>_<content hash>_<copy>`: unique, and the same on a re-run."""
    numbered = number_copies(df, _hash=content_hash(df.columns))
    parts = [F.lit(as_date(run_date).isoformat()), F.col("_hash"), F.col("_copy")]
    return numbered.select(
        F.concat_ws("_", *parts).alias(ID), *[F.col(f"`{c}`") for c in df.columns]
    )


def position_ids(
    df: DataFrame, run_date: dt.date | str, position: str = POSITION
) -> DataFrame:
    """Identifier `<run_date>_<position>` from a position column, which is dropped."""
    columns = [F.col(f"`{c}`") for c in df.columns if c != position]
    identifier = F.concat_ws("_", F.lit(as_date(run_date).isoformat()), F.col(position))
    return df.select(identifier.alias(ID), *columns)


def ordered_positions(df: DataFrame, *keys: str, position: str = POSITION) -> DataFrame:
    """Position 0, 1, 2, ... of every row in the order of `keys`.

    Ties are broken by content and copy number, which makes the order total: range
    partitions can split even a key that holds most rows. The sorted rows are
    checkpointed, then each row's place in its partition plus the size of the
    partitions before it is its position; the offsets have one row per partition.
    """
    columns = df.columns
    order = [F.col(f"`{k}`") for k in keys] + [F.col("_hash"), F.col("_copy")]
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = checkpointed(
        number_copies(df, _hash=content_hash(columns))
        .repartitionByRange(tasks, *order)
        .sortWithinPartitions(*order)
        .drop("_hash", "_copy")
    )
    # The id holds the partition number in its upper 31 bits and the row number in the rest.
    located = ranged.withColumn("_at", F.monotonically_increasing_id())
    part = F.shiftright("_at", 33)
    sizes = located.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    row = F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    return (
        located.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")
        .select(*[F.col(f"`{c}`") for c in columns], (F.col("_offset") + row).alias(position))
    )


def to_documents(
    df: DataFrame,
    run_date: dt.date | str,
    indexed_at: dt.datetime | str,
    position: str | None = None,
    keep_extra: bool = True,
) -> DataFrame:
    """Combined rows as documents: coerced numbers, no NaN, no missing year, `_id` first.

    With `position` the identifiers come from that column, which was numbered before
    rows without a year were dropped; otherwise they come from the content.
    """
    kept = drop_critical_nulls(nulls_for_nan(coerce_numeric(df)))
    named = position_ids(kept, run_date, position) if position else hash_ids(kept, run_date)
    schema = StructType([named.schema[ID], *DOCUMENT.fields])
    return conform(add_lineage(named, run_date, indexed_at), schema, keep_extra)


def to_ndjson(documents: DataFrame) -> DataFrame:
    """One JSON text per document in column `value`; NULL fields are written as null."""
    return documents.select(F.to_json(F.struct("*"), JSON_OPTIONS).alias("value"))


def from_ndjson(lines: DataFrame, schema: StructType) -> DataFrame:
    parsed = F.from_json("value", schema, JSON_OPTIONS)
    return lines.select(parsed.alias("_doc")).select("_doc.*")


def to_bulk(documents: DataFrame, index: str, keep_id: bool = False) -> DataFrame:
    """Bulk-load text in column `value`: an action line and a source line per document."""
    action = F.to_json(F.struct(F.struct(F.lit(index).alias("_index"), F.col(ID)).alias("index")))
    fields = F.struct(*[F.col(f"`{c}`") for c in documents.columns if c != ID])
    source = F.to_json(fields, JSON_OPTIONS)
    name = [F.col(ID).cast("string").alias(ID)] if keep_id else []
    return documents.select(*name, F.concat_ws("\n", action, source).alias("value"))
