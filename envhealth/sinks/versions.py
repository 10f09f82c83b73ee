"""A published document set that readers never see half replaced.

Every refresh writes a folder of its own. A table of versions names those that are complete;
its newest row is the published set, so the swap is the one small file that is added last.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import read_documents
from .documents import write_documents

VERSION = "number BIGINT, folder STRING, form STRING, documents BIGINT, replaced BIGINT, at DOUBLE"


def versions(spark: SparkSession, path: str) -> DataFrame:
    """The complete versions below `path`, newest first."""
    try:
        table = spark.read.schema(VERSION).parquet(f"{path}/versions")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        table = spark.createDataFrame([], VERSION)
    return table.orderBy(F.desc("number"), F.desc("at"), F.asc("folder"))


def current(spark: SparkSession, path: str) -> dict | None:
    rows = versions(spark, path).limit(1).collect()
    return rows[0].asDict() if rows else None


def read_current(spark: SparkSession, path: str) -> DataFrame:
    """The published documents; an error when nothing was published."""
    now = current(spark, path)
    if now is None:
        raise ValueError(f"{path}: nothing is published")
    return read_documents(spark, f"{path}/{now['folder']}", now["form"])


def refresh(
    documents: DataFrame, path: str, form: str = "parquet", expected: Callable[[], int] | None = None
) -> dict[str, int]:
    """Publish `documents` in place of the set before; returns both numbers of documents.

    Until the last step readers get the old set, and a refresh that fails leaves it. Counts are
    those of the files that were written; `expected` is asked after the write, and a set of
    another size is not published.
    """
    spark = documents.sparkSession
    before = current(spark, path)
    number = before["number"] + 1 if before else 1
    folder = f"v{number:06d}-{uuid.uuid4().hex}"
    write_documents(documents, f"{path}/{folder}", form)
    count = read_documents(spark, f"{path}/{folder}", form).count()
    if expected is not None and count != (wanted := expected()):
        raise ValueError(f"{path}: expected {wanted} documents, found {count}")
    replaced = before["documents"] if before else 0
    row = [(number, folder, form, count, replaced, time.time())]
    spark.createDataFrame(row, VERSION).coalesce(1).write.parquet(f"{path}/versions/refresh={uuid.uuid4().hex}")
    return {"replaced": replaced, "documents": count}


def remove_old(spark: SparkSession, path: str, keep: int = 2) -> list[str]:
    """Remove the folders of all but the newest `keep` versions; returns their names.

    Readers that began before a refresh go on with the version that they opened, so keep as
    many as may be open. Folders of refreshes that failed have no version and are not touched.
    """
    if keep < 1:
        raise ValueError("the published version cannot be removed")
    old = [r["folder"] for r in versions(spark, path).collect()[keep:]]
    removed = []
    for folder in old:
        target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/{folder}")
        store = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        if store.delete(target, True):
            removed.append(folder)
    return removed
