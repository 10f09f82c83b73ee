"""Document sinks: Parquet or JSON lines, bulk-load files, delivery through a caller's sender."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..constants import BULK_BYTES, BULK_DOCS
from ..operators.documents import to_bulk, to_ndjson
from ..sources import read_documents


def published_count(spark: SparkSession, path: str, form: str = "parquet") -> int:
    """Documents published at a path; 0 when there are none yet. Parquet counts from footers."""
    try:
        return read_documents(spark, path, form).count()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return 0


def write_documents(documents: DataFrame, path: str, form: str = "parquet") -> None:
    """Publish documents; the published set is replaced as a whole.

    Parquet is the form to search: columns and predicates are pruned at the scan. JSON
    lines are the form to hand over.
    """
    if form == "parquet":
        documents.write.mode("overwrite").parquet(path)
    elif form == "json":
        to_ndjson(documents).write.mode("overwrite").text(path)
    else:
        raise ValueError(f"unknown document form: {form!r}")


def write_bulk(documents: DataFrame, path: str, index: str, max_docs: int = BULK_DOCS) -> None:
    """Files of bulk-load text with at most `max_docs` documents each."""
    writer = to_bulk(documents, index).write.mode("overwrite")
    writer.option("maxRecordsPerFile", max_docs).text(path)


def publish(
    documents: DataFrame,
    index: str,
    send: Callable[[list[str]], int],
    max_docs: int = BULK_DOCS,
    max_bytes: int = BULK_BYTES,
) -> dict[str, int]:
    """Hand bulk-load text to `send` on the executors; returns indexed and failed counts.

    `send` gets a chunk of texts within both limits and returns how many were accepted.
    A task that is run again sends its documents again, under the same identifiers.
    """

    def deliver(batches):
        indexed = failed = size = 0
        chunk: list[str] = []
        for batch in batches:
            for text in batch["value"]:
                length = len(text.encode("utf-8")) + 1
                if chunk and (len(chunk) == max_docs or size + length > max_bytes):
                    accepted = send(chunk)
                    indexed, failed = indexed + accepted, failed + len(chunk) - accepted
                    chunk, size = [], 0
                chunk.append(text)
                size += length
        if chunk:
            accepted = send(chunk)
            indexed, failed = indexed + accepted, failed + len(chunk) - accepted
        yield pd.DataFrame({"indexed": [indexed], "failed": [failed]})

    delivered = to_bulk(documents, index).mapInPandas(deliver, "indexed BIGINT, failed BIGINT")
    row = delivered.agg(F.sum("indexed").alias("indexed"), F.sum("failed").alias("failed")).first()
    return {"indexed": row["indexed"] or 0, "failed": row["failed"] or 0}
