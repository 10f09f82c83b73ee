"""Delivery of documents through a caller's sender, with an outcome for every document."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..constants import BULK_BYTES, BULK_DOCS
from ..functions import partition_value
from ..operators.documents import ID, to_bulk
from ..sources import partition_path

#: Gets the bulk-load texts of a chunk and returns, for each, whether it was accepted.
Sender = Callable[[list[str]], Sequence[bool]]
OUTCOME = f"`{ID}` string, accepted boolean, error string, value string"


def chunks(
    rows: Iterator[tuple[str, str]], max_docs: int, max_bytes: int
) -> Iterator[list[tuple[str, str]]]:
    """Documents in order, at most `max_docs` and `max_bytes` together; a larger one goes alone."""
    held: list[tuple[str, str]] = []
    size = 0
    for name, text in rows:
        length = len(text.encode("utf-8")) + 1
        if held and (len(held) == max_docs or size + length > max_bytes):
            yield held
            held, size = [], 0
        held.append((name, text))
        size += length
    if held:
        yield held


def _sent(send: Sender, texts: list[str]) -> tuple[Sequence[bool], str | None]:
    """The sender's answer; a sender that fails refuses the whole chunk, and says why."""
    try:
        accepted = send(texts)
    except Exception as error:  # noqa: BLE001 - whatever it is, the documents are not lost
        return [False] * len(texts), f"{type(error).__name__}: {error}"
    if len(accepted) != len(texts):
        raise ValueError(f"the sender answered for {len(accepted)} of {len(texts)} documents")
    return accepted, None


def deliver(
    documents: DataFrame,
    index: str,
    send: Sender,
    outcomes: str,
    run_date: dt.date | str,
    max_docs: int = BULK_DOCS,
    max_bytes: int = BULK_BYTES,
) -> dict[str, int]:
    """Send documents from the tasks and write what became of each; returns the counts.

    The outcome table at `outcomes` has a row per document and replaces that of the run date;
    refused documents keep their text there. It is written by the tasks that send, and Spark
    commits the rows of one attempt of each task, so a task that runs again sends its
    documents again, under the same identifiers, and is counted once. Counts come from the
    committed files. Nothing but them comes to the driver, however many are refused.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = ((n, t) for b in batches for n, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()))
        for chunk in chunks(rows, max_docs, max_bytes):
            accepted, error = _sent(send, [text for _, text in chunk])
            columns = [
                [name for name, _ in chunk],
                [bool(ok) for ok in accepted],
                [None if ok else error for ok in accepted],
                [None if ok else text for ok, (_, text) in zip(accepted, chunk)],
            ]
            types = [pa.string(), pa.bool_(), pa.string(), pa.string()]
            arrays = [pa.array(c, t) for c, t in zip(columns, types)]
            yield pa.RecordBatch.from_arrays(arrays, names=[ID, "accepted", "error", "value"])

    path = partition_path(outcomes, partition_value(run_date))
    made = to_bulk(documents, index, keep_id=True).mapInArrow(run, OUTCOME)
    made.write.mode("overwrite").partitionBy("accepted").parquet(path)
    return delivered(documents.sparkSession, outcomes, run_date)


def read_outcomes(spark: SparkSession, outcomes: str, run_date: dt.date | str) -> DataFrame:
    path = partition_path(outcomes, partition_value(run_date))
    return spark.read.schema(OUTCOME).parquet(path)


def delivered(spark: SparkSession, outcomes: str, run_date: dt.date | str) -> dict[str, int]:
    """Documents accepted and refused on a date, by the committed files."""
    counts = read_outcomes(spark, outcomes, run_date).groupBy("accepted").count().collect()
    found = {row["accepted"]: row["count"] for row in counts}
    return {"indexed": found.get(True, 0), "failed": found.get(False, 0)}


def dead_letters(spark: SparkSession, outcomes: str, run_date: dt.date | str) -> DataFrame:
    """Identifier, error and bulk-load text of each refused document; only their files are read."""
    refused = read_outcomes(spark, outcomes, run_date).where(~F.col("accepted"))
    return refused.select(ID, "error", "value")
