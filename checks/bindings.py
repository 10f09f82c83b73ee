"""The given tables in the shape the operators expect. Only columns are renamed or nested."""

from __future__ import annotations

import datetime as dt

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from envhealth.operators import clean_indicators, clean_readings, combine, daily_stats

RUN_DATE = dt.date(2026, 1, 1)
INDEXED_AT = "2026-01-01 06:30:00"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def extracted_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_shipdate").cast("string").alias("utc_datetime"),
        F.col("l_returnflag").alias("city"),
        (F.col("l_extendedprice") / 100).alias("pm25_raw"),
    )


def envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings nested as they are landed; returned items stand for failed responses."""
    r = extracted_readings(spark, sf_dir)
    body = F.struct(
        F.struct(F.col("utc_datetime").alias("s")).alias("time"),
        F.struct(F.col("city").alias("name")).alias("city"),
        F.struct(F.struct(F.col("pm25_raw").cast("string").alias("v")).alias("pm25")).alias("iaqi"),
    )
    status = F.when(F.col("city") == "R", "error").otherwise("ok")
    return r.select(status.alias("status"), body.alias("data"))


def daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily_stats(clean_readings(extracted_readings(spark, sf_dir)))


def raw_indicators(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.year("o_orderdate").cast("string").alias("year"),
        F.col("o_totalprice").cast("string").alias("percentage"),
        F.col("o_orderkey").cast("string").alias("confidence_interval"),
        F.col("o_custkey").cast("string").alias("description"),
        F.col("o_orderpriority").alias("group"),
        F.col("o_orderstatus").alias("outcome_or_indicator"),
    )


def indicators(spark: SparkSession, sf_dir: str, keep_rate: bool = False) -> DataFrame:
    return clean_indicators(raw_indicators(spark, sf_dir), keep_rate=keep_rate)


def combined(spark: SparkSession, sf_dir: str, keep_rate: bool = False) -> DataFrame:
    return combine(daily(spark, sf_dir), indicators(spark, sf_dir, keep_rate), RUN_DATE)


def landing_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.year("o_orderdate").cast("string").alias("year"),
        F.col("o_orderpriority").alias("location_name"),
        F.col("o_totalprice").cast("string").alias("value"),
        F.col("o_orderstatus").alias("unit"),
        F.col("o_orderkey").cast("string").alias("data_value_type"),
    )


def dirty_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Balances as text, spelled differently in each market segment."""
    text = F.col("c_acctbal").cast("string")
    segment = F.col("c_mktsegment")
    spelled = (
        F.when(segment == "BUILDING", F.concat(F.lit(" "), text))
        .when(segment == "MACHINERY", F.concat(text, F.lit("%")))
        .when(segment == "FURNITURE", F.concat(F.split_part(text, F.lit("."), F.lit(1)), F.lit(".")))
        .otherwise(text)
    )
    return table(spark, sf_dir, "customer").select(
        "c_custkey", spelled.alias("percentage"), F.col("c_mktsegment").alias("group")
    )


def payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event properties as JSON objects, lists, envelopes and broken text by event type."""
    props, kind = F.col("props"), F.col("event_type")
    payload = (
        F.when(kind == "error", F.expr("left(props, length(props) - 1)"))
        .when(kind == "signup", F.concat(F.lit("["), props, F.lit("]")))
        .when(kind == "view", F.concat(F.lit('{"data": '), props, F.lit("}")))
        .otherwise(props)
    )
    return table(spark, sf_dir, "events").select("event_id", "event_type", payload.alias("payload"))


def envelope_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event values as landed envelope texts: errors carry a text instead of data, sign-ups
    have no value, views have a dash, and purchases break the city over two lines."""
    kind = F.col("event_type")
    city = F.when(kind == "purchase", F.lit("\\tport\\nside ")).otherwise(kind)
    iaqi = (
        F.when(kind == "signup", F.lit("{}"))
        .when(kind == "view", F.lit('{"pm25": {"v": "-"}}'))
        .otherwise(F.format_string('{"pm25": {"v": %s}}', F.col("value").cast("string")))
    )
    good = F.format_string(
        '{"status": "ok", "data": {"time": {"s": "%s"}, "city": {"name": "%s"}, "iaqi": %s}}',
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss"),
        city,
        iaqi,
    )
    text = F.when(kind == "error", F.lit('{"status": "error", "data": "no station"}')).otherwise(good)
    return table(spark, sf_dir, "events").select("event_id", text.alias("value"))


def landed_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Envelope texts of the events; those of clicks are cut off."""
    texts = envelope_texts(spark, sf_dir)
    cut = F.expr("left(value, length(value) - 2)")
    is_click = F.contains("value", F.lit('"name": "click"'))
    return texts.select("event_id", F.when(is_click, cut).otherwise(F.col("value")).alias("value"))


def supplier_envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An envelope over several lines for each supplier."""
    lines = [
        "{",
        '  "status": "ok",',
        '  "data": {',
        '    "city": {"name": "%s"},',
        '    "iaqi": {"pm25": {"v": %s}}',
        "  }",
        "}",
    ]
    text = F.format_string("\n".join(lines), F.col("s_name"), F.col("s_suppkey").cast("string"))
    envelopes = table(spark, sf_dir, "supplier").select(text.alias("value"), F.col("s_nationkey").alias("nation"))
    # Each becomes a file; the input's few splits would write them one after another.
    return envelopes.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")))


def array_lines(records: DataFrame, files: int) -> DataFrame:
    """Lines of `files` JSON arrays with a record a line, each array the rows of one task."""

    def run(batches):
        before = None
        for batch in batches:
            lines = batch.column(0).to_pylist()
            if lines:
                lines[0] = ("[" if before is None else "") + lines[0]
                ended = [] if before is None else [before + ","]
                ended += [line + "," for line in lines[:-1]]
                before = lines[-1]
                yield pa.RecordBatch.from_pydict({"value": pa.array(ended, pa.string())})
        if before is not None:
            yield pa.RecordBatch.from_pydict({"value": [before + "]"]})

    return records.select(F.to_json(F.struct("*")).alias("value")).repartition(files).mapInArrow(run, "value string")


def orders_by_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as rows of a yearly run each, with the price as the anchor."""
    orders = table(spark, sf_dir, "orders")
    run = F.make_date(F.year("o_orderdate"), F.lit(12), F.lit(31)).alias("run_date")
    price = F.col("o_totalprice").alias("pm25_avg_yearly")
    half = F.when(F.col("o_orderkey") % 2 == 0, F.col("o_custkey")).alias("half")
    return orders.select(run, price, "o_custkey", half, F.lit(None).cast("double").alias("absent"))
