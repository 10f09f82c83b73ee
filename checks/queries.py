"""Registered queries: one per operator, over whole tables.

Dates, and years that can be NULL, are returned as text. Averages keep the precision of a
32-bit float: engines add in different orders, and unlike decimal rounding this has no ties
near exact means.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from envhealth import functions as fn
from envhealth import operators as op
from envhealth import sinks, sources
from envhealth.checkpoints import scratch_path
from envhealth.plans import (
    Lake,
    Ledger,
    history_corr,
    history_profile,
    history_years,
    report_combined,
    report_daily,
    report_indicators,
    report_published,
    run_daily,
    run_stages,
)
from envhealth.plans.history import day_moments
from envhealth.schemas import DOCUMENT, ENVELOPE, READING
from envhealth.streaming import clean_landing, land_readings, landed_readings, landed_rejects

from . import bindings as b

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def _narrow(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("float").cast("double") for c in columns})


def _text(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("string") for c in columns})


def _widen(df: DataFrame) -> DataFrame:
    """32-bit columns as doubles, which print alike everywhere."""
    floats = [f.name for f in df.schema.fields if f.dataType.simpleString() == "float"]
    return df.withColumns({c: F.col(c).cast("double") for c in floats})


YEARLY_DOUBLES = ("pm25_avg_yearly", "pm25_min_yearly", "pm25_max_yearly", "daily_measurements_avg")


# Scans, landings, sinks


@query
def scan_parquet(spark, sf_dir):
    orders = sources.read_table(spark, f"{sf_dir}/orders.parquet")
    return orders.withColumn("o_orderdate", F.col("o_orderdate").cast("string"))


@query
def scan_run_date(spark, sf_dir):
    day = dt.date(2024, 1, 16) - dt.timedelta(days=1)
    events = sources.read_table(spark, f"{sf_dir}/events.parquet").where(fn.on_day("ts", day))
    return events.select("event_id", "user_id", "event_type", "value")


@query
def landing_query(spark, sf_dir):
    return sources.landing_query(b.landing_records(spark, sf_dir), "1-URGENT", dt.date(2001, 6, 1))


@query
def source_footprint(spark, sf_dir):
    """Bytes of the texts of all documents, landed as lines."""
    path = scratch_path(spark, "lines")
    b.table(spark, sf_dir, "documents").select("text").write.text(path)
    return sources.footprint(spark, path).select("bytes")


@query
def scan_json_envelopes(spark, sf_dir):
    path = scratch_path(spark, "envelopes")
    b.envelope_texts(spark, sf_dir).select("value").write.text(path)
    landed = sources.read_envelopes(spark, path, multi_line=False)
    return op.extract_readings(op.accept_status(landed))


@query
def scan_json_records(spark, sf_dir):
    path = scratch_path(spark, "records")
    sinks.write_raw_json(b.raw_indicators(spark, sf_dir), path, b.RUN_DATE)
    good, _ = sources.split_corrupt(sources.read_records(spark, path, multi_line=False))
    return op.project_indicators(good)


@query
def scan_csv_landing(spark, sf_dir):
    path = scratch_path(spark, "drop")
    b.raw_indicators(spark, sf_dir).write.option("header", True).csv(path)
    return op.project_indicators(sources.read_csv_drop(spark, path))


@query
def json_landing_report(spark, sf_dir):
    path = scratch_path(spark, "payloads")
    accepted = F.concat(F.lit('{"status": "ok", '), F.expr("substring(payload, 2)"))
    landed = F.when(F.col("event_type") == "purchase", accepted).otherwise(F.col("payload"))
    b.payloads(spark, sf_dir).select(landed.alias("value")).write.text(path)
    return sources.landing_report(sources.read_envelopes(spark, path, multi_line=False))


@query
def stream_clean_landing(spark, sf_dir):
    """The envelope landing cleaned as an available-now stream."""
    path, table = scratch_path(spark, "landing"), scratch_path(spark, "readings")
    b.envelope_texts(spark, sf_dir).select("value").write.text(path)
    stream = clean_landing(spark, path, table, scratch_path(spark, "state"), multi_line=False)
    stream.awaitTermination()
    return _text(spark.read.schema(READING).parquet(table), "date")


@query
def bulk_delivery(spark, sf_dir):
    """Every document handed to a sender that refuses those of one group."""
    documents = op.to_documents(b.combined(spark, sf_dir), b.RUN_DATE, b.INDEXED_AT)

    def send(texts):
        return sum('"group":"5-LOW"' not in text for text in texts)

    counts = sinks.publish(documents, "air", send)
    return spark.createDataFrame([counts], "indexed BIGINT, failed BIGINT")


@query
def roundtrip_parquet(spark, sf_dir):
    path = scratch_path(spark, "orders")
    orders = scan_parquet(spark, sf_dir)
    written, seen = op.observed(orders, "round trip")
    sinks.write_table(written, path, b.RUN_DATE)
    sinks.audit(spark, path, op.require_rows(seen, "round trip"), b.RUN_DATE)
    return sources.read_table(spark, path, b.RUN_DATE).drop("run_date")


# Rejects


def _reasons(judged):
    reason = F.coalesce("reject_reason", F.lit("valid")).alias("reason")
    return judged.groupBy(reason).agg(F.count(F.lit(1)).alias("records"))


@query
def readings_rejects(spark, sf_dir):
    """Landed envelopes by the reason that keeps them out; those without one are valid."""
    path = scratch_path(spark, "envelopes")
    b.envelope_texts(spark, sf_dir).select("value").write.text(path)
    return _reasons(op.judge_readings(sources.read_envelopes(spark, path)))


@query
def indicators_rejects(spark, sf_dir):
    path = scratch_path(spark, "records")
    sinks.write_raw_json(b.raw_indicators(spark, sf_dir), path, b.RUN_DATE)
    return _reasons(op.judge_indicators(sources.read_records(spark, path)))


# Payload checks


@query
def json_wellformed(spark, sf_dir):
    return op.payload_report(b.payloads(spark, sf_dir), "payload", "event_type")


@query
def required_fields(spark, sf_dir):
    return op.required_fields(b.payloads(spark, sf_dir), "payload", ["k", "data"])


@query
def extract_nested(spark, sf_dir):
    texts = b.envelope_texts(spark, sf_dir)
    parsed = texts.select("event_id", F.from_json("value", ENVELOPE).alias("e"))
    return op.extract_readings(parsed.select("e.*"))


@query
def status_gate(spark, sf_dir):
    return op.accept_status(b.envelopes(spark, sf_dir)).select(
        F.col("data.time.s").alias("utc_datetime"), F.col("data.city.name").alias("city")
    )


# Cleaning


@query
def project_cast(spark, sf_dir):
    return op.project_indicators(b.raw_indicators(spark, sf_dir))


@query
def filter_valid_readings(spark, sf_dir):
    return _text(op.clean_readings(b.extracted_readings(spark, sf_dir)), "date")


@query
def clean_envelopes(spark, sf_dir):
    parsed = b.envelope_texts(spark, sf_dir).select(F.from_json("value", ENVELOPE).alias("e"))
    return _text(op.clean_readings(op.extract_readings(parsed.select("e.*"))), "date")


@query
def parse_rate(spark, sf_dir):
    rates = b.dirty_rates(spark, sf_dir)
    return rates.select("c_custkey", "percentage", fn.parse_rate("percentage").alias("rate"))


@query
def normalize_text(spark, sf_dir):
    documents = b.table(spark, sf_dir, "documents").select("doc_id", "text")
    return op.normalize_columns(documents, ["text", "absent"])


@query
def coerce_numeric(spark, sf_dir):
    customers = b.table(spark, sf_dir, "customer")
    mixed = F.when(F.col("c_mktsegment") == "BUILDING", F.col("c_name")).otherwise(
        F.col("c_acctbal").cast("string")
    )
    df = customers.select("c_custkey", mixed.alias("pm25_avg_yearly"), "c_acctbal")
    return op.coerce_numeric(df, ["pm25_avg_yearly", "c_acctbal", "absent"])


@query
def nan_to_null(spark, sf_dir):
    value = F.when(F.col("event_type") == "error", float("nan")).otherwise(F.col("value"))
    events = b.table(spark, sf_dir, "events").select("event_id", value.alias("value"))
    return events.select("event_id", fn.nan_to_null("value").alias("value"))


@query
def drop_critical_nulls(spark, sf_dir):
    year = F.when(F.col("event_type") != "view", F.year("ts"))
    events = b.table(spark, sf_dir, "events").select("event_id", "event_type", year.alias("year"))
    return op.drop_critical_nulls(events)


@query
def to_date_year(spark, sf_dir):
    text = F.when(F.col("event_type") == "error", "garbage").otherwise(F.col("ts").cast("string"))
    events = b.table(spark, sf_dir, "events").select("event_id", fn.to_day(text).alias("date"))
    return _text(events.withColumn("year", fn.year_of("date")), "date", "year")


@query
def clean_indicators(spark, sf_dir):
    return b.indicators(spark, sf_dir)


@query
def clean_indicators_rate(spark, sf_dir):
    return b.indicators(spark, sf_dir, keep_rate=True)


@query
def filter_year_window(spark, sf_dir):
    projected = op.project_indicators(b.raw_indicators(spark, sf_dir))
    return op.year_window(projected, b.RUN_DATE).select("year", "confidence_interval")


@query
def quarantine_split(spark, sf_dir):
    checks = {
        "rate": fn.parse_rate("percentage").isNotNull(),
        "group": F.col("group") != "HOUSEHOLD",
    }
    return op.tag_rejects(b.dirty_rates(spark, sf_dir), checks)


@query
def attrition_report(spark, sf_dir):
    return op.attrition(b.dirty_rates(spark, sf_dir), fn.parse_rate("percentage").isNotNull())


# Aggregation and join


@query
def daily_stats(spark, sf_dir):
    rounded = _narrow(b.daily(spark, sf_dir), "pm25", "pm25_min", "pm25_max")
    return _text(rounded, "date")


@query
def job_daily_readings(spark, sf_dir):
    accepted = op.accept_status(b.envelopes(spark, sf_dir))
    stats = op.daily_stats(op.clean_readings(op.extract_readings(accepted)))
    return _text(_narrow(stats, "pm25", "pm25_min", "pm25_max"), "date")


@query
def yearly_stats(spark, sf_dir):
    return _narrow(op.yearly_stats(b.daily(spark, sf_dir)), *YEARLY_DOUBLES[1:])


@query
def combine_yearly(spark, sf_dir):
    return _narrow(b.combined(spark, sf_dir), *YEARLY_DOUBLES[1:])


@query
def distinct_years(spark, sf_dir):
    return op.distinct_keys(op.project_indicators(b.raw_indicators(spark, sf_dir)))


@query
def common_years(spark, sf_dir):
    yearly = op.year_window(op.yearly_stats(b.daily(spark, sf_dir)), b.RUN_DATE)
    return op.common_keys(yearly, b.indicators(spark, sf_dir))


@query
def year_coverage(spark, sf_dir):
    return op.coverage(b.combined(spark, sf_dir))


@query
def overall_metric_stats(spark, sf_dir):
    stats = op.metric_stats(b.combined(spark, sf_dir), "pm25_avg_yearly")
    return _narrow(stats, *stats.columns)


@query
def rate_summary(spark, sf_dir):
    return _narrow(op.rate_summary(b.dirty_rates(spark, sf_dir)), "avg_rate")


@query
def stage_counts(spark, sf_dir):
    readings = op.normalize_readings(b.extracted_readings(spark, sf_dir))
    return op.stage_counts(readings, F.col("pm25").between(0, 1000))


# Statistics and validation


@query
def describe_long(spark, sf_dir):
    df = b.table(spark, sf_dir, "lineitem")
    df = df.withColumn("l_discount", F.nullif("l_discount", F.lit(0.0)))
    long = _narrow(op.profile(df), "mean", "stddev")
    text = F.col("column_name").isin("l_returnflag", "l_linestatus")
    return long.select(
        "column_name",
        "count",
        "mean",
        "stddev",
        F.when(~text, F.col("min").try_cast("double")).alias("min_value"),
        F.when(~text, F.col("max").try_cast("double")).alias("max_value"),
        F.when(text, F.col("min")).alias("min_text"),
        F.when(text, F.col("max")).alias("max_text"),
    )


@query
def null_profile(spark, sf_dir):
    zero = {c: F.nullif(c, F.lit(0.0)) for c in ("l_discount", "l_tax")}
    flag = F.nullif("l_returnflag", F.lit("N"))
    df = b.table(spark, sf_dir, "lineitem").withColumns({**zero, "l_returnflag": flag})
    return op.null_profile(df)


@query
def corr_vs_anchor(spark, sf_dir):
    df = b.table(spark, sf_dir, "lineitem").select(
        "l_extendedprice",
        "l_quantity",
        "l_tax",
        "l_linenumber",
        F.nullif("l_discount", F.lit(0.0)).alias("discount"),
        F.nullif("l_linenumber", "l_linenumber").cast("double").alias("absent"),
        (F.col("l_linenumber") - F.col("l_linenumber")).alias("flat"),
    )
    return op.corr_vs_anchor(df, "l_extendedprice").withColumn("corr", F.round("corr", 6))


@query
def corr_combined(spark, sf_dir):
    long = op.corr_vs_anchor(b.combined(spark, sf_dir, keep_rate=True))
    return long.withColumn("corr", F.round("corr", 6))


@query
def validate_combined(spark, sf_dir):
    return op.validate(b.combined(spark, sf_dir), *op.year_bounds(b.RUN_DATE))


# Documents and search


@query
def lineage_columns(spark, sf_dir):
    events = b.table(spark, sf_dir, "events").select("event_id", "event_type")
    return _text(op.add_lineage(events, b.RUN_DATE, b.INDEXED_AT), "indexed_at", "processing_date")


@query
def conform_schema(spark, sf_dir):
    events = b.table(spark, sf_dir, "events").select(
        F.when(F.col("event_type") == "error", "n/a")
        .otherwise(F.year("ts").cast("string"))
        .alias("year"),
        F.col("value").alias("pm25_avg_yearly"),
        F.col("event_id").alias("pm25_measurements_count"),
        F.col("user_id").alias("percentage"),
        F.col("event_type").alias("group"),
        F.col("ts").cast("date").cast("string").alias("processing_date"),
        F.col("props").alias("extra"),
    )
    return _widen(_text(op.conform(events), "year", "indexed_at", "processing_date"))


@query
def document_ids(spark, sf_dir):
    orders = sources.read_positioned(spark, f"{sf_dir}/orders.parquet")
    return op.position_ids(orders, b.RUN_DATE).select("_id", "o_orderkey")


@query
def document_ids_hash(spark, sf_dir):
    return op.hash_ids(b.indicators(spark, sf_dir), b.RUN_DATE)


@query
def document_positions(spark, sf_dir):
    return op.ordered_positions(b.indicators(spark, sf_dir), "year", "group")


def _id_figures(documents):
    """Whole identifiers hold a hash of numbers that engines print in their own ways: their form, and
    how many of a document's there are."""
    forms = F.regexp_replace("_id", "[0-9a-f]{64}", "hash")
    same = F.count(F.lit(1)).over(Window.partitionBy("_id"))
    return documents.withColumns({"id_form": forms, "id_rows": same}).drop("_id")


@query
def document_ndjson(spark, sf_dir):
    documents = op.to_documents(b.combined(spark, sf_dir), b.RUN_DATE, b.INDEXED_AT)
    schema = StructType([StructField("_id", StringType()), *DOCUMENT.fields])
    back = op.from_ndjson(op.to_ndjson(documents), schema)
    return _id_figures(_widen(_text(back, "indexed_at", "processing_date")))


@query
def search_documents(spark, sf_dir):
    return op.search(
        _narrow(b.combined(spark, sf_dir), *YEARLY_DOUBLES[1:]),
        where=F.col("group").isin("1-URGENT", "2-HIGH") & F.col("year").between(2000, 2001),
        order=[F.desc("year"), F.asc("confidence_interval")],
    )


@query
def search_total(spark, sf_dir):
    return op.search_total(b.combined(spark, sf_dir), F.col("group") == "1-URGENT")


@query
def terms_topk(spark, sf_dir):
    return op.terms_topk(b.table(spark, sf_dir, "events"), "user_id")


@query
def search_facets(spark, sf_dir):
    facets = op.search_facets(b.combined(spark, sf_dir))
    return _narrow(facets, "avg_metric")


@query
def sorted_preview(spark, sf_dir):
    preview = op.sorted_preview(b.combined(spark, sf_dir), "year", n=10)
    return _narrow(preview, *YEARLY_DOUBLES[1:])


@query
def daily_run_documents(spark, sf_dir):
    """Lands raw files, runs every job of one date, and reads the published documents."""
    root = scratch_path(spark, "lake")
    lake = Lake(root)
    landed = lake.raw_readings(b.RUN_DATE - dt.timedelta(days=1))
    b.envelopes(spark, sf_dir).write.json(landed)
    b.raw_indicators(spark, sf_dir).write.json(lake.raw_indicators(b.RUN_DATE.year))
    run_daily(spark, root, b.RUN_DATE, b.INDEXED_AT, multi_line=False)
    documents = sinks.read_current(spark, lake.documents)
    shown = _widen(_text(documents, "indexed_at", "processing_date"))
    # Positions follow the files that the combine job wrote: 0 to the number of rows, each once.
    place = F.split_part("_id", F.lit("_"), F.lit(2)).cast("bigint")
    inside = place.between(0, documents.count() - 1).alias("id_inside")
    once = F.count(F.lit(1)).over(Window.partitionBy("_id")).alias("id_rows")
    date = F.split_part("_id", F.lit("_"), F.lit(1)).alias("id_date")
    return shown.select(date, inside, once, *[c for c in shown.columns if c != "_id"])


# Outcomes, arrays, history, refreshes, pages, runs


@query
def stream_landing_outcomes(spark, sf_dir):
    """Every landed record of a stream by what became of it, after a second run without new files."""
    path, table, state = (scratch_path(spark, name) for name in ("landing", "outcomes", "state"))
    b.landed_texts(spark, sf_dir).select("value").write.text(path)
    for _ in range(2):
        land_readings(spark, path, table, state, files_per_batch=2).awaitTermination()
    valid = landed_readings(spark, table).select(F.lit("valid").alias("reason"))
    rejected = landed_rejects(spark, table).select(F.col("reject_reason").alias("reason"))
    return valid.union(rejected).groupBy("reason").agg(F.count(F.lit(1)).alias("records"))


@query
def stream_landing_rejects(spark, sf_dir):
    """The texts of the records that did not parse, as they were landed."""
    path, table = scratch_path(spark, "landing"), scratch_path(spark, "outcomes")
    b.landed_texts(spark, sf_dir).select("value").write.text(path)
    land_readings(spark, path, table, scratch_path(spark, "state")).awaitTermination()
    return landed_rejects(spark, table).where("reject_reason = 'malformed'").select("record")


@query
def delivery_refused(spark, sf_dir):
    """Documents that a sender refused, by their whole identifiers, from the dead letters."""
    orders = sources.read_positioned(spark, f"{sf_dir}/orders.parquet")
    documents = op.position_ids(orders, b.RUN_DATE).select("_id", "o_orderkey", "o_orderpriority")

    def send(texts):
        return ['"o_orderpriority":"5-LOW"' not in text for text in texts]

    outcomes = scratch_path(spark, "outcomes")
    sinks.deliver(documents, "orders", send, outcomes, b.RUN_DATE)
    source = F.split_part("value", F.lit("\n"), F.lit(2))
    key = F.get_json_object(source, "$.o_orderkey").cast("bigint").alias("o_orderkey")
    return sinks.dead_letters(spark, outcomes, b.RUN_DATE).select("_id", key)


@query
def delivery_counts(spark, sf_dir):
    """Accepted and refused documents of a delivery that was run twice for its date."""
    documents = op.hash_ids(b.indicators(spark, sf_dir), b.RUN_DATE)
    outcomes = scratch_path(spark, "outcomes")

    def send(texts):
        return ['"group":"5-LOW"' not in text for text in texts]

    sinks.deliver(documents.where("year = 2000"), "air", send, outcomes, b.RUN_DATE)
    counts = sinks.deliver(documents, "air", send, outcomes, b.RUN_DATE)
    return spark.createDataFrame([counts], "indexed BIGINT, failed BIGINT")


@query
def scan_json_array(spark, sf_dir):
    """Records landed as two arrays over many lines, read in splits."""
    path = scratch_path(spark, "arrays")
    b.array_lines(b.raw_indicators(spark, sf_dir), 2).write.text(path)
    good, _ = sources.split_corrupt(sources.read_array_records(spark, path))
    return op.project_indicators(good)


@query
def scan_envelope_files(spark, sf_dir):
    """Envelopes landed as one object over several lines per file."""
    path = scratch_path(spark, "files")
    b.supplier_envelopes(spark, sf_dir).select("value").write.option("maxRecordsPerFile", 1).text(path)
    landed = sources.read_envelopes(spark, path, multi_line=True)
    return op.extract_readings(op.accept_status(landed))


@query
def landing_manifest(spark, sf_dir):
    """Files by folder of a landing that was listed twice, the second time for new folders only; and
    what the listed files hold."""
    path, manifest = scratch_path(spark, "files"), scratch_path(spark, "manifest")
    envelopes = b.supplier_envelopes(spark, sf_dir)
    envelopes.write.partitionBy("nation").option("maxRecordsPerFile", 1).text(path)
    folders = [f"nation={n}" for n in range(25)]
    sources.extend_manifest(spark, path, folders[:12], manifest, files="*.txt")
    sources.extend_manifest(spark, path, folders, manifest, files="*.txt")
    listed = sources.read_manifest(spark, manifest)
    readings = op.extract_readings(op.accept_status(sources.read_listed(spark, listed)))
    held = readings.agg(F.lit("readings").alias("what"), F.count("city").alias("figure"))
    total = readings.agg(F.lit("total").alias("what"), F.sum(F.col("pm25_raw").cast("bigint")).alias("figure"))
    files = listed.groupBy(F.col("folder").alias("what")).agg(F.count(F.lit(1)).alias("figure"))
    return files.union(held).union(total)


def _stored_moments(spark, parts):
    path = scratch_path(spark, "moments")
    parts.write.partitionBy("run_date").parquet(path)
    return path


@query
def history_describe(spark, sf_dir):
    """The profile of all runs, merged from the moments that each has stored."""
    stored = _stored_moments(spark, op.moments(b.orders_by_run(spark, sf_dir), "run_date"))
    found = _narrow(history_profile(spark, stored), "mean", "stddev")
    return found.withColumnsRenamed({"min": "min_value", "max": "max_value"})


@query
def history_correlation(spark, sf_dir):
    stored = _stored_moments(spark, op.moments(b.orders_by_run(spark, sf_dir), "run_date"))
    return history_corr(spark, stored).withColumn("corr", F.round("corr", 6))


@query
def history_yearly(spark, sf_dir):
    """Yearly figures from stored moments of runs of a quarter; in even years, two runs share the days
    of a quarter between them, so that these years are rolled up from their days."""
    days = b.daily(spark, sf_dir)
    quarter = F.last_day(F.add_months(F.date_trunc("quarter", "date"), 2))
    late = (F.year("date") % 2 == 0) & (F.dayofmonth("date") % 2 == 0)
    daily = scratch_path(spark, "daily")
    runs = days.withColumn("run_date", F.date_add(quarter, late.cast("int")))
    runs.repartition("run_date").write.partitionBy("run_date").parquet(daily)
    stored = _stored_moments(spark, day_moments(sources.read_table(spark, daily), "run_date"))
    return _narrow(history_years(spark, daily, stored), *YEARLY_DOUBLES[1:])


@query
def refresh_documents(spark, sf_dir):
    """Documents of the published set, after it replaced one of all years."""
    path = scratch_path(spark, "published")
    documents = op.hash_ids(b.indicators(spark, sf_dir), b.RUN_DATE)
    sinks.refresh(documents, path)
    report = sinks.refresh(documents.where("year = 2001"), path)
    found = sinks.read_current(spark, path).groupBy("year").agg(F.count(F.lit(1)).alias("documents"))
    return found.withColumn("replaced", F.lit(report["replaced"]).cast("bigint"))


@query
def search_page(spark, sf_dir):
    """Hits with their rank and the total of all hits, from one scan."""
    page = op.search_page(
        b.combined(spark, sf_dir),
        where=F.col("group").isin("1-URGENT", "2-HIGH") & F.col("year").between(2000, 2001),
        order=[("year", True), ("confidence_interval", False)],
    )
    fields = ["year", "group", "percentage", "confidence_interval"]
    return page.select("total", "rank", *[F.col(f"hit.{f}").alias(f) for f in fields])


@query
def run_ledger(spark, sf_dir):
    """Events of a run whose second stage failed once, and of one that resumed it."""
    path = scratch_path(spark, "ledger")
    lost = []

    def readings():
        return {"count": op.clean_readings(b.extracted_readings(spark, sf_dir)).count()}

    def indicators():
        if not lost:
            lost.append(True)
            raise RuntimeError("lost")
        return {"count": b.indicators(spark, sf_dir).count()}

    stages = {"readings": ((), readings), "indicators": (("readings",), indicators)}
    run_stages(Ledger(spark, path, b.RUN_DATE), stages)
    run_stages(Ledger(spark, path, b.RUN_DATE), stages)
    events = Ledger(spark, path, b.RUN_DATE).events().where("stage <> 'claim'")
    count = F.get_json_object(F.when(F.col("state") == "done", F.col("detail")), "$.count")
    return events.select("stage", "attempt", "state", count.cast("bigint").alias("count"))


def _lake(spark, sf_dir):
    """A lake with the indicators, combined rows and documents of a run, and no daily rows."""
    lake = Lake(scratch_path(spark, "lake"))
    sinks.write_table(b.indicators(spark, sf_dir), lake.indicators, b.RUN_DATE.year, "ingest_year")
    combined = b.combined(spark, sf_dir)
    sinks.write_table(combined, lake.combined, b.RUN_DATE)
    sinks.refresh(op.to_documents(combined, b.RUN_DATE, b.INDEXED_AT), lake.documents)
    return lake


@query
def report_lake(spark, sf_dir):
    """Checks and figures of the tables of a lake: an absent one, indicators, combined rows."""
    lake = _lake(spark, sf_dir)
    parts = {
        "daily": report_daily(spark, lake, b.RUN_DATE),
        "indicators": report_indicators(spark, lake, b.RUN_DATE.year),
        "combined": report_combined(spark, lake, b.RUN_DATE),
    }
    named = [part.select(F.lit(name).alias("table_name"), "*") for name, part in parts.items()]
    return _narrow(named[0].union(named[1]).union(named[2]), "figure")


@query
def report_documents(spark, sf_dir):
    """Checks and figures of the published documents, in all and by year."""
    lake = _lake(spark, sf_dir)
    return _narrow(report_published(spark, lake, b.RUN_DATE), "figure")
