"""A manifest of landed files, extended by listing new folders only."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..checkpoints import checkpointed
from ..schemas import ENVELOPE
from .landing import read_envelopes, read_records

MANIFEST = "path STRING, length BIGINT, modified TIMESTAMP, folder STRING"
#: Bytes of files that are read together, and what opening a file counts for.
PACK_BYTES, OPEN_BYTES = 64 << 20, 64 << 10
#: Files that one reader is given at a time; their paths are what the driver holds.
READ_FILES = 100_000


def read_manifest(spark: SparkSession, manifest: str) -> DataFrame:
    """The files known so far; none before the first listing."""
    try:
        return spark.read.schema(MANIFEST).parquet(manifest)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], MANIFEST)


def extend_manifest(
    spark: SparkSession, landing: str, folders: Iterable[str], manifest: str, files: str = "*.json*", again: Iterable[str] = ()
) -> list[str]:
    """List those of `folders` below `landing` that the manifest does not know; returns them.

    Only names, sizes and times are read, not the files, by all tasks at once. A folder is a name
    without a slash. It is listed once; one in `again`, which has changed, is listed anew. A folder
    that is not there, or is empty, stays unknown.
    """
    known = {r["folder"] for r in read_manifest(spark, manifest).select("folder").distinct().collect()}
    new = [f for f in dict.fromkeys(folders) if f not in known or f in set(again)]
    if not new:
        return []
    reader = spark.read.format("binaryFile").option("pathGlobFilter", files)
    try:
        # Of the names between the braces, those that are there.
        found = reader.load(f"{landing}/{{{','.join(new)}}}")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return []
    folder = F.element_at(F.split("path", "/"), -2).alias("folder")
    named = found.select("path", "length", F.col("modificationTime").alias("modified"), folder)
    part = checkpointed(named)
    writer = part.repartition("folder").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("folder").parquet(manifest)
    there = {r["folder"] for r in part.select("folder").distinct().collect()}
    return [f for f in new if f in there]


def packed(manifest: DataFrame, pack_bytes: int = PACK_BYTES, open_bytes: int = OPEN_BYTES) -> DataFrame:
    """`manifest` with `pack`: files of a folder that follow each other, about `pack_bytes` together.

    Opening a file counts like `open_bytes` more, so that a pack of tiny files is bounded too. A file
    that is larger is a pack of its own or the end of one. Folders are packed at the same time.
    """
    before = Window.partitionBy("folder").orderBy("path").rowsBetween(Window.unboundedPreceding, -1)
    cost = F.col("length") + F.lit(open_bytes)
    start = F.coalesce(F.sum(cost).over(before), F.lit(0))
    return manifest.withColumn("pack", F.floor(start / pack_bytes).cast("bigint"))


def read_listed(
    spark: SparkSession,
    manifest: DataFrame,
    schema: StructType = ENVELOPE,
    multi_line: bool = True,
    read_files: int = READ_FILES,
) -> DataFrame:
    """Records of the files in `manifest`, without listing their folders again.

    The driver holds the paths, as it does for any scan, and Spark packs small files into tasks by
    size and by the cost of opening one. Very many paths become several scans of `read_files` each.
    """
    paths = [r["path"] for r in manifest.select("path").orderBy("path").collect()]
    if not paths:
        empty = spark.createDataFrame([], schema)
        return empty.withColumn("_corrupt_record", F.lit(None).cast("string"))
    scans = []
    for i in range(0, len(paths), read_files):
        some = paths[i : i + read_files]
        scans.append(read_envelopes(spark, some, multi_line) if schema is ENVELOPE else read_records(spark, some, schema, multi_line))
    out = scans[0]
    for scan in scans[1:]:
        out = out.unionByName(scan)
    return out
