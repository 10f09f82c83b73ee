"""The readings landing as a stream that keeps every record: valid readings and rejects."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StringType, StructType

from ..constants import CORRUPT
from ..functions import clean_text
from ..operators import judge_readings
from ..operators.quality import REASON
from ..schemas import ENVELOPE, READING

#: Folder names of the two kinds of rows of a batch.
VALID, REJECTED = "valid", "rejected"
OUTCOMES = StructType([*READING.fields]).add(REASON, StringType()).add("record", StringType())


def judged_rows(envelopes: DataFrame) -> DataFrame:
    """One row per landed record: its reading, or why there is none and the record as text.

    Each record is parsed and judged once. A record that did not parse is kept as it was
    landed, any other as JSON of what was read of it.
    """
    judged = judge_readings(envelopes)
    parsed = F.to_json(F.struct("status", "data"), {"ignoreNullFields": "false"})
    rejected = F.col(REASON).isNotNull()
    return judged.select(
        clean_text("data.time.s").alias("utc_datetime"),
        clean_text("data.city.name").alias("city"),
        "pm25",
        "date",
        REASON,
        F.when(rejected, F.coalesce(CORRUPT, parsed)).alias("record"),
        F.when(rejected, REJECTED).otherwise(VALID).alias("outcome"),
    )


def write_batch(table: str):
    """A batch writer that may be called again for a batch: it replaces what that batch wrote.

    Readings and rejects are one write of one pass, so that a batch has both or neither.
    """

    def write(envelopes: DataFrame, batch_id: int) -> None:
        rows = judged_rows(envelopes)
        rows.write.mode("overwrite").partitionBy("outcome").parquet(f"{table}/batch_id={batch_id}")

    return write


def land_readings(
    spark: SparkSession,
    landing: str,
    table: str,
    checkpoint: str,
    multi_line: bool = False,
    files_per_batch: int = 10_000,
) -> StreamingQuery:
    """Judge the records of files not seen before and keep every one of them, then stop.

    Which files belong to which batch is kept in `checkpoint`, in the same durable storage as
    the table. A batch that failed, or whose end was not noted, is run again on the same files
    under the same number and replaces its own folder, so every record is there exactly once.
    """
    schema = StructType([*ENVELOPE.fields]).add(CORRUPT, StringType())
    envelopes = (
        spark.readStream.schema(schema)
        .option("multiLine", multi_line)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("maxFilesPerTrigger", files_per_batch)
        .json(landing)
    )
    return (
        envelopes.writeStream.foreachBatch(write_batch(table))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def _outcomes(spark: SparkSession, table: str, kind: str) -> DataFrame:
    schema = StructType([*OUTCOMES.fields]).add("outcome", StringType()).add("batch_id", LongType())
    return spark.read.schema(schema).parquet(table).where(F.col("outcome") == kind)


def landed_readings(spark: SparkSession, table: str) -> DataFrame:
    """The valid readings of all batches; the folders of rejects are not read."""
    return _outcomes(spark, table, VALID).select(*READING.names)


def landed_rejects(spark: SparkSession, table: str) -> DataFrame:
    """The records that are no valid reading, with the reason and the batch that met them."""
    return _outcomes(spark, table, REJECTED).select("batch_id", REASON, "record")
