from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..operators import accept_status, clean_readings, extract_readings
from ..schemas import ENVELOPE


def clean_landing(
    spark: SparkSession,
    landing: str,
    table: str,
    checkpoint: str,
    multi_line: bool = False,
    files_per_batch: int = 10_000,
) -> StreamingQuery:
    """Append the cleaned readings of files not seen before to a Parquet table, then stop.

    The cleaning is that of the batch job. Which files were read is kept in `checkpoint`,
    which belongs in the same durable storage as the table; a failed run resumes there
    and writes each file's readings exactly once.
    """
    envelopes = (
        spark.readStream.schema(ENVELOPE)
        .option("multiLine", multi_line)
        .option("maxFilesPerTrigger", files_per_batch)
        .json(landing)
    )
    readings = clean_readings(extract_readings(accept_status(envelopes)))
    return (
        readings.writeStream.format("parquet")
        .option("path", table)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
