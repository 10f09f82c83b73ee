"""The same results in ANSI SQL over the given tables, keyed like the queries."""

from __future__ import annotations



def _narrow(expr: str) -> str:
    return f"CAST(CAST({expr} AS FLOAT) AS DOUBLE)"


READINGS = """readings AS (
  SELECT CAST(l_shipdate AS VARCHAR) AS utc_datetime, l_returnflag AS city,
         l_extendedprice / 100 AS pm25, CAST(l_shipdate AS DATE) AS date
  FROM lineitem
  WHERE l_shipdate IS NOT NULL AND l_extendedprice / 100 BETWEEN 0 AND 1000)"""

DAILY = (
    READINGS
    + """,
daily AS (
  SELECT date, avg(pm25) AS pm25, count(pm25) AS measurements_count,
         min(pm25) AS pm25_min, max(pm25) AS pm25_max
  FROM readings GROUP BY date)"""
)

YEARLY = (
    DAILY
    + """,
yearly AS (
  SELECT CAST(year(date) AS INTEGER) AS year, round(avg(pm25), 2) AS pm25_avg_yearly,
         min(pm25) AS pm25_min_yearly, max(pm25) AS pm25_max_yearly,
         count(pm25) AS pm25_measurements_count,
         avg(measurements_count) AS daily_measurements_avg
  FROM daily GROUP BY 1)"""
)

RAW_INDICATORS = """raw_indicators AS (
  SELECT CAST(year(o_orderdate) AS INTEGER) AS year, CAST(o_totalprice AS VARCHAR) AS percentage,
         o_orderpriority AS "group", o_orderstatus AS outcome_or_indicator,
         CAST(o_orderkey AS VARCHAR) AS confidence_interval,
         CAST(o_custkey AS VARCHAR) AS description
  FROM orders)"""

INDICATORS = (
    RAW_INDICATORS
    + r""",
indicators AS (
  SELECT year, percentage, "group", outcome_or_indicator, confidence_interval,
         CAST(percentage AS DOUBLE) AS asthma_rate
  FROM raw_indicators
  WHERE year >= 2000 AND regexp_matches(percentage, '^[0-9]+\.?[0-9]*$'))"""
)

COMBINED = (
    f"WITH {YEARLY},\n{INDICATORS},\n"
    + """combined AS (
  SELECT y.*, i.percentage, i."group", i.outcome_or_indicator, i.confidence_interval,
         i.asthma_rate
  FROM yearly y JOIN indicators i ON y.year = i.year
  WHERE i.year BETWEEN 2000 AND 2027)
"""
)

YEARLY_COLUMNS = f"""year, pm25_avg_yearly, {_narrow("pm25_min_yearly")} AS pm25_min_yearly,
       {_narrow("pm25_max_yearly")} AS pm25_max_yearly, pm25_measurements_count,
       {_narrow("daily_measurements_avg")} AS daily_measurements_avg"""

COMBINED_COLUMNS = f"""{YEARLY_COLUMNS},
       percentage, "group", outcome_or_indicator, confidence_interval"""

DOCUMENT_COLUMNS = f"""year, {_narrow("pm25_avg_yearly")} AS pm25_avg_yearly,
       {_narrow("pm25_min_yearly")} AS pm25_min_yearly,
       {_narrow("pm25_max_yearly")} AS pm25_max_yearly,
       CAST(pm25_measurements_count AS INTEGER) AS pm25_measurements_count,
       {_narrow("daily_measurements_avg")} AS daily_measurements_avg,
       percentage, "group", outcome_or_indicator, confidence_interval,
       '2026-01-01 06:30:00' AS indexed_at, 'combined_2026-01-01' AS data_source,
       '2026-01-01' AS processing_date"""

DIRTY_RATES = """rates AS (
  SELECT c_custkey, c_mktsegment AS "group",
         CASE c_mktsegment
           WHEN 'BUILDING' THEN ' ' || CAST(c_acctbal AS VARCHAR)
           WHEN 'MACHINERY' THEN CAST(c_acctbal AS VARCHAR) || '%'
           WHEN 'FURNITURE' THEN split_part(CAST(c_acctbal AS VARCHAR), '.', 1) || '.'
           ELSE CAST(c_acctbal AS VARCHAR) END AS percentage
  FROM customer),
parsed AS (
  SELECT *, CASE WHEN regexp_matches(percentage, '^[0-9]+\\.?[0-9]*$')
                 THEN TRY_CAST(percentage AS DOUBLE) END AS rate
  FROM rates)""".replace("\\\\", "\\")

PAYLOADS = """payloads AS (
  SELECT event_id, event_type,
         CASE event_type
           WHEN 'error' THEN left(props, length(props) - 1)
           WHEN 'signup' THEN '[' || props || ']'
           WHEN 'view' THEN '{"data": ' || props || '}'
           ELSE props END AS payload
  FROM events)"""

# What the landed envelope texts of the events must parse to.
EVENT_READINGS = """parsed AS (
  SELECT CASE WHEN event_type <> 'error' THEN strftime(ts, '%Y-%m-%d %H:%M:%S') END AS utc_datetime,
         CASE event_type WHEN 'error' THEN NULL
                         WHEN 'purchase' THEN chr(9) || 'port' || chr(10) || 'side '
                         ELSE event_type END AS city,
         CASE event_type WHEN 'view' THEN '-'
                         WHEN 'signup' THEN NULL WHEN 'error' THEN NULL
                         ELSE CAST(value AS VARCHAR) END AS pm25_raw
  FROM events)"""

CLEAN_ENVELOPES = f"""WITH {EVENT_READINGS}
SELECT utc_datetime, trim(regexp_replace(city, '[\\r\\n\\t]', ' ', 'g')) AS city,
       TRY_CAST(pm25_raw AS DOUBLE) AS pm25, substr(utc_datetime, 1, 10) AS date
FROM parsed
WHERE utc_datetime IS NOT NULL AND TRY_CAST(pm25_raw AS DOUBLE) BETWEEN 0 AND 1000"""

DOCUMENT_HASH = """hashed AS (
  SELECT year, percentage, "group", outcome_or_indicator, confidence_interval,
         sha256('{"year":' || CAST(year AS VARCHAR) || ',"percentage":"' || percentage
                || '","group":"' || "group" || '","outcome_or_indicator":"' || outcome_or_indicator
                || '","confidence_interval":"' || confidence_interval || '"}') AS h
  FROM indicators)"""

PROJECTED = """year, confidence_interval, description, "group", percentage, outcome_or_indicator"""


LINEITEM_NUMBERS = (
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_tax",
)


def _describe(name: str, expr: str, text: bool = False) -> str:
    number = f"TRY_CAST({expr} AS DOUBLE)"
    value = ("NULL", "NULL") if text else (f"min({expr})", f"max({expr})")
    words = (f"min({expr})", f"max({expr})") if text else ("NULL", "NULL")
    return f"""SELECT '{name}' AS column_name, count({expr}) AS count,
       {_narrow(f"avg({number})")} AS mean, {_narrow(f"stddev_samp({number})")} AS stddev,
       CAST({value[0]} AS DOUBLE) AS min_value, CAST({value[1]} AS DOUBLE) AS max_value,
       CAST({words[0]} AS VARCHAR) AS min_text, CAST({words[1]} AS VARCHAR) AS max_text
FROM lineitem"""


def _nulls(name: str, expr: str) -> str:
    return f"""SELECT '{name}' AS column_name, count(*) AS rows,
       count(*) - count({expr}) AS nulls FROM lineitem"""


def _corr(name: str, anchor: str, expr: str, source: str) -> str:
    corr = f"corr({anchor}, {expr})"
    return f"""SELECT '{name}' AS column_name, count({expr}) AS pairs,
       CASE WHEN isnan({corr}) THEN NULL ELSE round({corr}, 6) END AS corr FROM {source}"""


def _union(parts: list[str]) -> str:
    return "\nUNION ALL\n".join(parts)


RUN_COLUMNS = [
    ("pm25_avg_yearly", "o_totalprice"),
    ("o_custkey", "o_custkey"),
    ("half", "CASE WHEN o_orderkey % 2 = 0 THEN o_custkey END"),
    ("absent", "CAST(NULL AS DOUBLE)"),
]


_RATE = "CAST(percentage AS DOUBLE)"
_INDICATOR_COLUMNS = ("year", "percentage", '"group"', "outcome_or_indicator", "confidence_interval")
_MEASURED = (
    "pm25_avg_yearly", "pm25_min_yearly", "pm25_max_yearly", "pm25_measurements_count", "daily_measurements_avg",
)
#: Table, check, whether it passes, figure.
REPORTED = [
    *[(t, "rows", "count(*) > 0", "count(*)") for t in ("indicators", "combined")],
    *[
        (t, "nulls_" + c.strip('"'), "true", f"count(*) - count({c})")
        for t, columns in (("indicators", ()), ("combined", _MEASURED))
        for c in (*_INDICATOR_COLUMNS, *columns)
    ],
    ("indicators", "numeric_rates", "true", f"count({_RATE})"),
    ("indicators", "rate_min", f"min({_RATE}) >= 0", f"min({_RATE})"),
    ("indicators", "rate_max", "true", f"max({_RATE})"),
    ("indicators", "rate_avg", "true", f"avg({_RATE})"),
    ("indicators", "min_year", "true", "min(year)"),
    ("indicators", "max_year", "true", "max(year)"),
    ("combined", "min_year", "min(year) >= 2000", "min(year)"),
    ("combined", "max_year", "max(year) <= 2027", "max(year)"),
    *[
        ("combined", f"{figure}_{c}", "true", f"{function}({c})")
        for c in _MEASURED
        for figure, function in (
            ("count", "count"), ("mean", "avg"), ("stddev", "stddev_samp"), ("min", "min"), ("max", "max"),
        )
    ],
]


ORACLE: dict[str, str] = {
    "scan_parquet": "SELECT * REPLACE (CAST(o_orderdate AS VARCHAR) AS o_orderdate) FROM orders",
    "source_footprint": "SELECT CAST(sum(strlen(text)) + count(*) AS BIGINT) AS bytes FROM documents",
    "scan_run_date": """SELECT event_id, user_id, event_type, value FROM events
WHERE CAST(ts AS DATE) = DATE '2024-01-16' - 1""",
    "landing_query": """SELECT CAST(year(o_orderdate) AS VARCHAR) AS year, o_orderpriority AS location_name,
       CAST(o_totalprice AS VARCHAR) AS value, o_orderstatus AS unit,
       CAST(o_orderkey AS VARCHAR) AS data_value_type
FROM orders
WHERE o_orderpriority = '1-URGENT' AND CAST(year(o_orderdate) AS VARCHAR) >= '1996'
ORDER BY 1 DESC, 2, 3, 4, 5 LIMIT 1000""",
    "scan_json_envelopes": f"""WITH {EVENT_READINGS}
SELECT utc_datetime, city, pm25_raw FROM parsed WHERE utc_datetime IS NOT NULL""",
    "scan_json_records": f"WITH {RAW_INDICATORS} SELECT {PROJECTED} FROM raw_indicators",
    "scan_csv_landing": f"WITH {RAW_INDICATORS} SELECT {PROJECTED} FROM raw_indicators",
    # A list element is a record of its own, so only the truncated payloads are broken.
    "json_landing_report": f"""WITH {PAYLOADS}
SELECT count(*) AS records, count(*) FILTER (WHERE NOT json_valid(payload)) AS corrupt,
       count(*) FILTER (WHERE event_type = 'view') AS with_data,
       count(*) FILTER (WHERE event_type = 'purchase') AS accepted
FROM payloads""",
    "roundtrip_parquet": "SELECT * REPLACE (CAST(o_orderdate AS VARCHAR) AS o_orderdate) FROM orders",
    "readings_rejects": """SELECT CASE WHEN event_type = 'error' THEN 'status'
            WHEN event_type IN ('signup', 'view') THEN 'value'
            WHEN value BETWEEN 0 AND 1000 THEN 'valid' ELSE 'bounds' END AS reason, count(*) AS records
FROM events GROUP BY 1""",
    "indicators_rejects": f"""WITH {RAW_INDICATORS}
SELECT CASE WHEN year < 2000 THEN 'year'
            WHEN NOT regexp_matches(percentage, '^[0-9]+\\.?[0-9]*$') THEN 'rate'
            ELSE 'valid' END AS reason, count(*) AS records
FROM raw_indicators GROUP BY 1""",
    "json_wellformed": f"""WITH {PAYLOADS},
typed AS (
  SELECT event_type, CASE WHEN json_valid(payload) THEN payload END AS p FROM payloads)
SELECT event_type, count(*) AS payloads, count(*) - count(p) AS malformed,
       count(*) FILTER (WHERE json_type(p) = 'OBJECT' AND json_exists(p, '$.data')) AS envelopes,
       count(*) FILTER (WHERE json_type(p) = 'ARRAY' AND json_array_length(p) > 0) AS record_lists
FROM typed GROUP BY event_type""",
    "required_fields": f"""WITH {PAYLOADS},
fields AS (
  SELECT CASE WHEN json_valid(payload) THEN json_extract(payload, '$.k') END AS k,
         CASE WHEN json_valid(payload) THEN json_extract(payload, '$.data') END AS data
  FROM payloads)
SELECT 'k' AS field, count(*) AS records, count(*) - count(k) AS missing FROM fields
UNION ALL
SELECT 'data' AS field, count(*) AS records, count(*) - count(data) AS missing FROM fields""",
    "extract_nested": f"WITH {EVENT_READINGS} SELECT utc_datetime, city, pm25_raw FROM parsed",
    "status_gate": """SELECT CAST(l_shipdate AS VARCHAR) AS utc_datetime, l_returnflag AS city
FROM lineitem WHERE l_returnflag <> 'R'""",
    "project_cast": f"WITH {RAW_INDICATORS} SELECT {PROJECTED} FROM raw_indicators",
    "filter_valid_readings": f"""WITH {READINGS}
SELECT utc_datetime, city, pm25, CAST(date AS VARCHAR) AS date FROM readings""",
    "clean_envelopes": CLEAN_ENVELOPES,
    "stream_clean_landing": CLEAN_ENVELOPES,
    "parse_rate": f"WITH {DIRTY_RATES} SELECT c_custkey, percentage, rate FROM parsed",
    "normalize_text": """SELECT doc_id, trim(regexp_replace(text, '[\\r\\n\\t]', ' ', 'g')) AS text
FROM documents""",
    "coerce_numeric": """SELECT c_custkey, c_acctbal,
       CASE WHEN c_mktsegment = 'BUILDING' THEN TRY_CAST(c_name AS DOUBLE)
            ELSE c_acctbal END AS pm25_avg_yearly
FROM customer""",
    "nan_to_null": """SELECT event_id, CASE WHEN event_type <> 'error' THEN value END AS value
FROM events""",
    "drop_critical_nulls": """SELECT event_id, event_type, CAST(year(ts) AS INTEGER) AS year
FROM events WHERE event_type <> 'view'""",
    "to_date_year": """SELECT event_id,
       CASE WHEN event_type <> 'error' THEN CAST(CAST(ts AS DATE) AS VARCHAR) END AS date,
       CASE WHEN event_type <> 'error' THEN CAST(year(ts) AS VARCHAR) END AS year
FROM events""",
    "clean_indicators": f"""WITH {INDICATORS}
SELECT year, percentage, "group", outcome_or_indicator, confidence_interval FROM indicators""",
    "clean_indicators_rate": f"""WITH {INDICATORS}
SELECT year, percentage, "group", outcome_or_indicator, confidence_interval, asthma_rate
FROM indicators""",
    "filter_year_window": f"""WITH {RAW_INDICATORS}
SELECT year, confidence_interval FROM raw_indicators WHERE year BETWEEN 2000 AND 2027""",
    "quarantine_split": f"""WITH {DIRTY_RATES}
SELECT c_custkey, percentage, "group",
       CASE WHEN rate IS NULL THEN 'rate'
            WHEN "group" = 'HOUSEHOLD' THEN 'group' END AS reject_reason
FROM parsed""",
    "attrition_report": f"""WITH {DIRTY_RATES}
SELECT count(*) AS rows_in, count(rate) AS rows_kept, count(*) - count(rate) AS rows_removed
FROM parsed""",
    "daily_stats": f"""WITH {DAILY}
SELECT CAST(date AS VARCHAR) AS date, {_narrow("pm25")} AS pm25, measurements_count,
       {_narrow("pm25_min")} AS pm25_min, {_narrow("pm25_max")} AS pm25_max FROM daily""",
    "job_daily_readings": f"""SELECT CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS date,
       {_narrow("avg(l_extendedprice / 100)")} AS pm25, count(*) AS measurements_count,
       {_narrow("min(l_extendedprice / 100)")} AS pm25_min,
       {_narrow("max(l_extendedprice / 100)")} AS pm25_max
FROM lineitem
WHERE l_returnflag <> 'R' AND l_extendedprice / 100 BETWEEN 0 AND 1000
GROUP BY 1""",
    "yearly_stats": f"""WITH {YEARLY}
SELECT {YEARLY_COLUMNS} FROM yearly""",
    "combine_yearly": f"{COMBINED}SELECT {COMBINED_COLUMNS} FROM combined",
    "distinct_years": f"WITH {RAW_INDICATORS} SELECT DISTINCT year FROM raw_indicators",
    "common_years": f"""WITH {YEARLY},
{INDICATORS}
SELECT year FROM yearly WHERE year BETWEEN 2000 AND 2027 INTERSECT SELECT year FROM indicators""",
    "year_coverage": f"""{COMBINED}SELECT min(year) AS min_year, max(year) AS max_year,
       count(year) AS year_count, count(DISTINCT year) AS distinct_years FROM combined""",
    "overall_metric_stats": f"""{COMBINED}SELECT {_narrow("avg(pm25_avg_yearly)")} AS overall_avg,
       {_narrow("min(pm25_avg_yearly)")} AS overall_min,
       {_narrow("max(pm25_avg_yearly)")} AS overall_max FROM combined""",
    # Surrounding spaces do not stop a numeric reading of the text; a percent sign does.
    "rate_summary": f"""WITH {DIRTY_RATES},
numbers AS (SELECT TRY_CAST(percentage AS DOUBLE) AS n FROM rates)
SELECT count(n) AS rates, min(n) AS min_rate, max(n) AS max_rate, {_narrow("avg(n)")} AS avg_rate
FROM numbers""",
    "stage_counts": """SELECT count(*) AS readings,
       count(*) FILTER (WHERE ok) AS valid_readings,
       count(DISTINCT CASE WHEN ok THEN date END) AS days,
       count(DISTINCT CASE WHEN ok THEN year(date) END) AS years
FROM (SELECT CAST(l_shipdate AS DATE) AS date, l_extendedprice / 100 BETWEEN 0 AND 1000 AS ok
      FROM lineitem)""",
    "describe_long": _union(
        [
            *[_describe(c, c) for c in LINEITEM_NUMBERS],
            _describe("l_discount", "nullif(l_discount, 0)"),
            *[_describe(c, c, text=True) for c in ("l_returnflag", "l_linestatus")],
        ]
    ),
    "null_profile": _union(
        [
            *[_nulls(c, c) for c in (*LINEITEM_NUMBERS[:-1], "l_linestatus", "l_shipdate")],
            _nulls("l_discount", "nullif(l_discount, 0)"),
            _nulls("l_tax", "nullif(l_tax, 0)"),
            _nulls("l_returnflag", "nullif(l_returnflag, 'N')"),
        ]
    ),
    "corr_vs_anchor": _union(
        [
            _corr("l_quantity", "l_extendedprice", "l_quantity", "lineitem"),
            _corr("l_tax", "l_extendedprice", "l_tax", "lineitem"),
            _corr("l_linenumber", "l_extendedprice", "l_linenumber", "lineitem"),
            _corr("discount", "l_extendedprice", "nullif(l_discount, 0)", "lineitem"),
            """SELECT 'absent' AS column_name, CAST(0 AS BIGINT) AS pairs, CAST(NULL AS DOUBLE) AS corr""",
            """SELECT 'flat' AS column_name, count(*) AS pairs, CAST(NULL AS DOUBLE) AS corr
FROM lineitem""",
        ]
    ),
    "corr_combined": COMBINED
    + _union(
        [
            _corr(c, "pm25_avg_yearly", c, "combined")
            for c in (
                "pm25_min_yearly",
                "pm25_max_yearly",
                "pm25_measurements_count",
                "daily_measurements_avg",
                "asthma_rate",
            )
        ]
    ),
    "validate_combined": f"""{COMBINED}SELECT 'rows' AS check_name, count(*) > 0 AS passed, count(*) AS value FROM combined
UNION ALL
SELECT 'nulls_year', count(*) = count(year), count(*) - count(year) FROM combined
UNION ALL
SELECT 'min_year', min(year) >= 2000, CAST(min(year) AS BIGINT) FROM combined
UNION ALL
SELECT 'max_year', max(year) <= 2027, CAST(max(year) AS BIGINT) FROM combined""",
    "lineage_columns": """SELECT event_id, event_type, '2026-01-01 06:30:00' AS indexed_at,
       'combined_2026-01-01' AS data_source, '2026-01-01' AS processing_date FROM events""",
    "conform_schema": f"""SELECT CASE WHEN event_type <> 'error' THEN CAST(year(ts) AS VARCHAR) END AS year,
       {_narrow("value")} AS pm25_avg_yearly, CAST(NULL AS DOUBLE) AS pm25_min_yearly,
       CAST(NULL AS DOUBLE) AS pm25_max_yearly, CAST(event_id AS INTEGER) AS pm25_measurements_count,
       CAST(NULL AS DOUBLE) AS daily_measurements_avg, CAST(user_id AS VARCHAR) AS percentage,
       event_type AS "group", CAST(NULL AS VARCHAR) AS outcome_or_indicator,
       CAST(NULL AS VARCHAR) AS confidence_interval, CAST(NULL AS VARCHAR) AS indexed_at,
       CAST(NULL AS VARCHAR) AS data_source, CAST(CAST(ts AS DATE) AS VARCHAR) AS processing_date,
       props AS extra
FROM events""",
    "document_ids": """SELECT '2026-01-01_' || CAST(row_number() OVER (ORDER BY o_orderkey) - 1 AS VARCHAR) AS _id,
       o_orderkey
FROM orders""",
    "document_ids_hash": f"""WITH {INDICATORS},
{DOCUMENT_HASH}
SELECT '2026-01-01_' || h || '_'
       || CAST(row_number() OVER (PARTITION BY h ORDER BY h) - 1 AS VARCHAR) AS _id,
       year, percentage, "group", outcome_or_indicator, confidence_interval
FROM hashed""",
    "document_positions": f"""WITH {INDICATORS},
{DOCUMENT_HASH}
SELECT year, percentage, "group", outcome_or_indicator, confidence_interval,
       row_number() OVER (ORDER BY year, "group", h) - 1 AS _position
FROM hashed""",
    # A document's copies are numbered in its identifier.
    "document_ndjson": f"""{COMBINED}SELECT '2026-01-01_hash_'
       || CAST(row_number() OVER (PARTITION BY year, percentage, "group", outcome_or_indicator, confidence_interval) - 1 AS VARCHAR)
       AS id_form, CAST(1 AS BIGINT) AS id_rows, {DOCUMENT_COLUMNS} FROM combined""",
    "bulk_delivery": f"""{COMBINED}SELECT count(*) FILTER (WHERE "group" <> '5-LOW') AS indexed,
       count(*) FILTER (WHERE "group" = '5-LOW') AS failed FROM combined""",
    "search_documents": f"""{COMBINED}SELECT {COMBINED_COLUMNS} FROM combined
WHERE "group" IN ('1-URGENT', '2-HIGH') AND year BETWEEN 2000 AND 2001
ORDER BY year DESC, confidence_interval LIMIT 10""",
    "search_total": f"""{COMBINED}SELECT count(*) AS total FROM combined WHERE "group" = '1-URGENT'""",
    "terms_topk": """SELECT user_id, count(*) AS doc_count FROM events
WHERE user_id IS NOT NULL GROUP BY user_id ORDER BY doc_count DESC, user_id LIMIT 10""",
    "search_facets": f"""{COMBINED}SELECT 'all' AS facet, CAST(NULL AS VARCHAR) AS term, count(*) AS doc_count,
       {_narrow("avg(pm25_avg_yearly)")} AS avg_metric FROM combined
UNION ALL
SELECT 'term', CAST(year AS VARCHAR), n, NULL FROM (
  SELECT year, count(*) AS n FROM combined GROUP BY year ORDER BY n DESC, year LIMIT 10)""",
    "sorted_preview": f"""{COMBINED}SELECT {COMBINED_COLUMNS} FROM combined
ORDER BY year, percentage, "group", outcome_or_indicator, confidence_interval LIMIT 10""",
    "daily_run_documents": COMBINED.replace(
        "WHERE l_shipdate IS NOT NULL AND", "WHERE l_returnflag <> 'R' AND"
    )
    + f"SELECT '2026-01-01' AS id_date, true AS id_inside, CAST(1 AS BIGINT) AS id_rows, {DOCUMENT_COLUMNS} FROM combined",
    "stream_landing_outcomes": """SELECT CASE WHEN event_type = 'error' THEN 'status'
            WHEN event_type = 'click' THEN 'malformed'
            WHEN event_type IN ('signup', 'view') THEN 'value'
            WHEN value BETWEEN 0 AND 1000 THEN 'valid' ELSE 'bounds' END AS reason, count(*) AS records
FROM events GROUP BY 1""",
    "stream_landing_rejects": """SELECT '{"status": "ok", "data": {"time": {"s": "' || strftime(ts, '%Y-%m-%d %H:%M:%S')
       || '"}, "city": {"name": "click"}, "iaqi": {"pm25": {"v": ' || CAST(value AS VARCHAR) || '}}' AS record
FROM events WHERE event_type = 'click'""",
    "delivery_refused": """SELECT _id, o_orderkey FROM (
  SELECT '2026-01-01_' || CAST(row_number() OVER (ORDER BY o_orderkey) - 1 AS VARCHAR) AS _id,
         o_orderkey, o_orderpriority
  FROM orders)
WHERE o_orderpriority = '5-LOW'""",
    "delivery_counts": f"""WITH {INDICATORS}
SELECT count(*) FILTER (WHERE "group" <> '5-LOW') AS indexed,
       count(*) FILTER (WHERE "group" = '5-LOW') AS failed FROM indicators""",
    "scan_json_array": f"WITH {RAW_INDICATORS} SELECT {PROJECTED} FROM raw_indicators",
    "scan_envelope_files": """SELECT CAST(NULL AS VARCHAR) AS utc_datetime, s_name AS city,
       CAST(s_suppkey AS VARCHAR) AS pm25_raw FROM supplier""",
    "history_describe": _union(
        [
            f"""SELECT '{name}' AS column_name, count({expr}) AS count, {_narrow(f"avg({expr})")} AS mean,
       {_narrow(f"stddev_samp({expr})")} AS stddev, CAST(min({expr}) AS DOUBLE) AS min_value,
       CAST(max({expr}) AS DOUBLE) AS max_value FROM orders"""
            for name, expr in RUN_COLUMNS
        ]
    ),
    "history_correlation": _union(
        [
            f"""SELECT '{name}' AS column_name, count({expr}) AS pairs,
       round(corr(o_totalprice, {expr}), 6) AS corr FROM orders"""
            for name, expr in RUN_COLUMNS[1:]
        ]
    ),
    "history_yearly": f"""WITH {YEARLY}
SELECT {YEARLY_COLUMNS} FROM yearly""",
    "refresh_documents": f"""WITH {INDICATORS}
SELECT year, count(*) AS documents, (SELECT count(*) FROM indicators) AS replaced
FROM indicators WHERE year = 2001 GROUP BY year""",
    "search_page": f"""{COMBINED}SELECT count(*) OVER () AS total,
       CAST(row_number() OVER (ORDER BY year DESC, confidence_interval) AS INTEGER) AS rank,
       year, "group", percentage, confidence_interval FROM combined
WHERE "group" IN ('1-URGENT', '2-HIGH') AND year BETWEEN 2000 AND 2001
ORDER BY rank LIMIT 10""",
    "run_ledger": f"""WITH {READINGS},
{INDICATORS}
SELECT 'readings' AS stage, CAST(1 AS INTEGER) AS attempt, 'done' AS state, count(*) AS count FROM readings
UNION ALL SELECT 'indicators', 1, 'failed', NULL
UNION ALL SELECT 'indicators', 2, 'done', count(*) FROM indicators""",
    "report_lake": f"""{COMBINED}SELECT 'daily' AS table_name, 'exists' AS check_name, false AS passed, CAST(0 AS DOUBLE) AS figure
UNION ALL SELECT 'indicators', 'exists', true, 1
UNION ALL SELECT 'combined', 'exists', true, 1
UNION ALL """
    + _union(
        [
            f"SELECT '{table}', '{name}', {passed}, {_narrow(figure)} FROM {table}"
            for table, name, passed, figure in REPORTED
        ]
    ),
    "report_documents": f"""{COMBINED}, floats AS (SELECT year, CAST(CAST(pm25_avg_yearly AS FLOAT) AS DOUBLE) AS v FROM combined)
SELECT 'exists' AS check_name, true AS passed, CAST(1 AS DOUBLE) AS figure
UNION ALL SELECT 'documents', count(*) > 0, count(*) FROM floats
UNION ALL SELECT 'documents_noted', true, count(*) FROM floats
UNION ALL SELECT 'other_dates', true, 0
UNION ALL SELECT 'mean_pm25_avg_yearly', true, {_narrow("avg(v)")} FROM floats
UNION ALL SELECT 'documents_' || year, true, count(*) FROM floats GROUP BY year""",
    "landing_manifest": """SELECT 'nation=' || s_nationkey AS what, count(*) AS figure FROM supplier GROUP BY 1
UNION ALL SELECT 'readings', count(*) FROM supplier
UNION ALL SELECT 'total', CAST(sum(s_suppkey) AS BIGINT) FROM supplier""",
}
