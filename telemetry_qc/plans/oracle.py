"""Oracle SQL (DuckDB dialect) for the registered queries.

The expected answers are derived from *how each record was generated*: the
typed values from the generator's formulas and the defect from
``event_id % 40``.  Nothing here parses JSON, so a parser bug cannot hide
in both sides.  QC limits are written out here as well, so that a wrong
default of the engine shows.
"""

from __future__ import annotations

from typing import NamedTuple, Sequence


class Rule(NamedTuple):
    column: str
    min: float | int | None = None
    max: float | int | None = None
    not_null: bool = True


DEFAULT_RULES = (
    Rule("trip_id"),
    Rule("car_id"),
    Rule("latitude", -90, 90),
    Rule("longitude", -180, 180),
    Rule("event_timestamp"),
    Rule("speed_kmph", 0, 200),
    Rule("fuel_level", 0, 100),
    Rule("engine_temp_c", None, 130),
    Rule("trip_start_time"),
    Rule("trip_start_latitude", -90, 90),
    Rule("trip_start_longitude", -180, 180),
)
NULL_RULES = tuple(Rule(r.column) for r in DEFAULT_RULES)
LINEITEM_RULES = (Rule("l_quantity", None, 45), Rule("l_discount", 0.01, None))
EVENTS_RULES = (Rule("value", None, 200),)
CUSTOMER_RULES = (Rule("c_acctbal", 0, 9000),)
PUBLISH_TOPIC = "telemetry-validated"
REPORT_DAY = "2024-01-15"

MALFORMED_CLASSES = "(0, 1, 2, 10)"

ENV_CTES = r"""
ev AS (
    SELECT event_id, ts, user_id, value, props,
           event_id % 40 AS cls,
           strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS ts_text
    FROM events
),
txt AS (
    SELECT *,
        '"trip_id":"T' || CAST(user_id AS VARCHAR) || '"' AS j_trip_id,
        '"car_id":"Car_' || CAST(user_id % 20 AS VARCHAR) || '"' AS j_car_id,
        '"latitude":' || CAST(event_id % 90 AS VARCHAR) || '.25' AS j_latitude,
        '"longitude":88.5' AS j_longitude,
        '"timestamp":"' || ts_text || '"' AS j_timestamp,
        '"speed_kmph":' || CAST(value AS VARCHAR) AS j_speed,
        '"fuel_level":' || CAST(event_id % 121 AS VARCHAR) || '.0' AS j_fuel,
        '"engine_temp_c":' || CAST(60 + event_id % 71 AS VARCHAR) || '.5' AS j_engine,
        '"trip_start_time":"' || substr(ts_text, 1, 10) || 'T00:00:00"' AS j_start_time,
        '"trip_start_latitude":22.5' AS j_start_lat,
        '"trip_start_longitude":88.25' AS j_start_lon
    FROM ev
),
env AS (
    SELECT *,
        'Car_' || CAST(user_id % 20 AS VARCHAR) AS message_key,
        'telemetry' AS topic_name,
        CAST(user_id % 5 AS INTEGER) AS kafka_partition,
        event_id AS kafka_offset,
        '{' || concat_ws(',', j_trip_id, j_car_id, j_latitude, j_longitude,
                         j_timestamp, j_speed, j_fuel, j_engine, j_start_time,
                         j_start_lat, j_start_lon) || '}' AS good
    FROM txt
),
env_text AS (
    SELECT *,
        CASE
            WHEN cls = 0 THEN substr(good, 1, 60)
            WHEN cls = 1 THEN 'hello'
            WHEN cls = 2 THEN NULL
            WHEN cls = 10 THEN '[' || good || ']'
            ELSE '{' || CASE WHEN cls = 4 THEN '"firmware":"v2",' ELSE '' END
                || concat_ws(',',
                    j_trip_id,
                    CASE WHEN cls = 7 THEN '"Car_ID":"Car_' || CAST(user_id % 20 AS VARCHAR) || '"'
                         ELSE j_car_id END,
                    CASE WHEN cls = 9 THEN '"latitude":95.0' ELSE j_latitude END,
                    j_longitude,
                    CASE WHEN cls = 6 THEN '"timestamp":"yesterday"' ELSE j_timestamp END,
                    CASE WHEN cls = 5 THEN '"speed_kmph":"fast"' ELSE j_speed END,
                    CASE WHEN cls = 3 THEN NULL
                         WHEN cls = 8 THEN '"fuel_level":null' ELSE j_fuel END,
                    j_engine, j_start_time, j_start_lat, j_start_lon)
                || '}'
        END AS value_str
    FROM env
),
rec AS (
    SELECT
        message_key, value_str, topic_name, kafka_partition, kafka_offset, cls,
        ts AS kafka_timestamp,
        CASE
            WHEN cls IN (0, 1, 2, 10) THEN 'Malformed JSON'
            WHEN cls = 3 THEN 'Missing column: fuel_level'
            WHEN cls = 4 THEN 'Unexpected column: firmware'
            WHEN cls = 5 THEN 'Type mismatch for column ''speed_kmph'''
            WHEN cls = 6 THEN 'Type mismatch for column ''timestamp'''
            WHEN cls = 7 THEN 'Missing column: car_id; Unexpected column: Car_ID'
        END AS error_reason,
        CASE WHEN cls IN (0, 1, 2, 10) THEN NULL
             ELSE 'T' || CAST(user_id AS VARCHAR) END AS trip_id,
        CASE WHEN cls IN (0, 1, 2, 10, 7) THEN NULL
             ELSE 'Car_' || CAST(user_id % 20 AS VARCHAR) END AS car_id,
        CASE WHEN cls IN (0, 1, 2, 10) THEN NULL
             WHEN cls = 9 THEN CAST(95.0 AS DOUBLE)
             ELSE CAST(event_id % 90 AS DOUBLE) + CAST(0.25 AS DOUBLE) END AS latitude,
        CASE WHEN cls IN (0, 1, 2, 10) THEN NULL ELSE CAST(88.5 AS DOUBLE) END AS longitude,
        CASE WHEN cls IN (0, 1, 2, 10, 6) THEN NULL ELSE ts END AS event_timestamp,
        CASE WHEN cls IN (0, 1, 2, 10, 5) THEN NULL ELSE value END AS speed_kmph,
        CASE WHEN cls IN (0, 1, 2, 10, 3, 8) THEN NULL
             ELSE CAST(event_id % 121 AS DOUBLE) END AS fuel_level,
        CASE WHEN cls IN (0, 1, 2, 10) THEN NULL
             ELSE CAST(60 + event_id % 71 AS DOUBLE) + CAST(0.5 AS DOUBLE) END AS engine_temp_c,
        CASE WHEN cls IN (0, 1, 2, 10) THEN NULL ELSE date_trunc('day', ts) END AS trip_start_time,
        CASE WHEN cls IN (0, 1, 2, 10) THEN NULL ELSE CAST(22.5 AS DOUBLE) END AS trip_start_latitude,
        CASE WHEN cls IN (0, 1, 2, 10) THEN NULL ELSE CAST(88.25 AS DOUBLE) END AS trip_start_longitude,
        CASE WHEN cls IN (0, 1, 2, 10) THEN NULL ELSE CAST(ts AS DATE) END AS trip_start_date
    FROM env_text
)"""

PAYLOAD_COLS = (
    "trip_id, car_id, latitude, longitude, event_timestamp, speed_kmph, fuel_level, "
    "engine_temp_c, trip_start_time, trip_start_latitude, trip_start_longitude"
)
PAYLOAD_COLS_TS = PAYLOAD_COLS.replace("event_timestamp", 'event_timestamp AS "timestamp"')


def _lit(v) -> str:
    return f"CAST({v!r} AS DOUBLE)" if isinstance(v, float) else str(v)


def rule_sql(rule: Rule) -> str:
    """CASE expression giving the rule's failure reason, or NULL."""
    c, branches = rule.column, []
    if rule.not_null:
        branches.append(f"WHEN {c} IS NULL THEN '{c} null'")
    if rule.min is not None or rule.max is not None:
        branches.append(f"WHEN isnan({c}) THEN '{c} NaN'")
    if rule.min is not None:
        branches.append(f"WHEN {c} < {_lit(rule.min)} THEN '{c} below {rule.min}'")
    if rule.max is not None:
        branches.append(f"WHEN {c} > {_lit(rule.max)} THEN '{c} above {rule.max}'")
    return "CASE " + " ".join(branches) + " END"


def summary_sql(rules: Sequence[Rule]) -> str:
    parts = ", ".join(rule_sql(r) for r in rules)
    return f"NULLIF(concat_ws('; ', {parts}), '')"


def with_records(body: str, rules: Sequence[Rule] = DEFAULT_RULES) -> str:
    """ENV CTEs + QC verdict + route, then ``body``."""
    return (
        "WITH "
        + ENV_CTES
        + f""",
checked AS (
    SELECT rec.*, {summary_sql(rules)} AS qc_summary FROM rec
),
routed AS (
    SELECT checked.*,
        CASE WHEN qc_summary IS NULL THEN 'success' ELSE 'fail' END AS qc_status,
        CASE WHEN error_reason IS NOT NULL THEN 'corrupt'
             WHEN qc_summary IS NULL THEN 'clean' ELSE 'failed' END AS route
    FROM checked
)
"""
        + body
    )


def _qc_over(table: str, keys: str, rules: Sequence[Rule]) -> str:
    return f"""
SELECT {keys},
       CASE WHEN s IS NULL THEN 'success' ELSE 'fail' END AS qc_status,
       s AS qc_summary
FROM (SELECT {keys}, {summary_sql(rules)} AS s FROM {table}) t"""


def _audit_sql() -> str:
    parts = [
        f"SELECT trip_id, '{r.column}' AS column_name, ({rule_sql(r)}) IS NULL AS passed, "
        f"{rule_sql(r)} AS fail_reason, kafka_partition, kafka_offset "
        f"FROM routed WHERE route <> 'corrupt'"
        for r in DEFAULT_RULES
    ]
    return "\nUNION ALL\n".join(parts)


def _json_sql() -> str:
    def s(c):
        return f"CASE WHEN {c} IS NULL THEN 'null' ELSE '\"' || {c} || '\"' END"

    def d(c):
        return f"COALESCE(CAST({c} AS VARCHAR), 'null')"

    def t(c):
        return f"COALESCE('\"' || strftime({c}, '%Y-%m-%dT%H:%M:%S.%f') || '\"', 'null')"

    fields = [
        ("trip_id", s("trip_id")),
        ("car_id", s("car_id")),
        ("latitude", d("latitude")),
        ("longitude", d("longitude")),
        ("timestamp", t("event_timestamp")),
        ("speed_kmph", d("speed_kmph")),
        ("fuel_level", d("fuel_level")),
        ("engine_temp_c", d("engine_temp_c")),
        ("trip_start_time", t("trip_start_time")),
        ("trip_start_latitude", d("trip_start_latitude")),
        ("trip_start_longitude", d("trip_start_longitude")),
    ]
    body = " || ',' || ".join(f"'\"{k}\":' || {v}" for k, v in fields)
    return f"'{{' || {body} || '}}'"


def cells_failed_sql() -> str:
    return " + ".join(f"CASE WHEN ({rule_sql(r)}) IS NULL THEN 0 ELSE 1 END" for r in DEFAULT_RULES)


def _observed_sql() -> str:
    """Key by key, how the texts were made."""
    keys = [
        ("trip_id", "STRING", "string"),
        ("car_id", "STRING", "string"),
        ("latitude", "DECIMAL", "double"),
        ("longitude", "DECIMAL", "double"),
        ("timestamp", "STRING", "timestamp"),
        ("speed_kmph", "DECIMAL", "double"),
        ("fuel_level", "DECIMAL", "double"),
        ("engine_temp_c", "DECIMAL", "double"),
        ("trip_start_time", "STRING", "timestamp"),
        ("trip_start_latitude", "DECIMAL", "double"),
        ("trip_start_longitude", "DECIMAL", "double"),
    ]
    absent = {"car_id": "cls = 7", "fuel_level": "cls = 3"}
    other = {"speed_kmph": ("cls = 5", "STRING", "type"), "fuel_level": ("cls = 8", "VOID", "ok")}
    out = []

    def add(where: str, key: str, kind: str, wanted: str, finding: str) -> None:
        out.append(
            f"SELECT kafka_partition, '{key}' AS key, {kind} AS observed_type, count(*) AS records, "
            f"{wanted} AS expected_type, '{finding}' AS finding FROM rec WHERE {where} GROUP BY kafka_partition"
        )

    none = "CAST(NULL AS VARCHAR)"
    for key, kind, wanted in keys:
        gone = absent.get(key, "false")
        special, special_kind, finding = other.get(key, ("false", kind, "ok"))
        add(f"cls NOT IN {MALFORMED_CLASSES} AND NOT ({gone}) AND NOT ({special})", key, f"'{kind}'", f"'{wanted}'", "ok")
        if special != "false":
            add(special, key, f"'{special_kind}'", f"'{wanted}'", finding)
        add(f"cls IN {MALFORMED_CLASSES} OR {gone}", key, none, f"'{wanted}'", "missing")
    add("cls = 4", "firmware", "'STRING'", none, "unexpected")
    add("cls = 7", "Car_ID", "'STRING'", none, "unexpected")
    return "\nUNION ALL\n".join(out)


DEVICE_COLS = f"{PAYLOAD_COLS}, trip_start_date, message_key, kafka_partition, kafka_offset"

ORACLE_SQL: dict[str, str] = {
    "q01_envelope_scan": with_records(
        "SELECT message_key, value_str, topic_name, kafka_partition, kafka_offset, "
        "kafka_timestamp FROM rec"
    ),
    "q02_json_props": (
        "SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS prop_k "
        "FROM events"
    ),
    "q03_parse_typed": with_records(f"SELECT kafka_offset, {PAYLOAD_COLS_TS} FROM rec"),
    "q04_trip_date": with_records("SELECT kafka_offset, trip_start_date FROM rec"),
    "q05_enriched": with_records(
        f"SELECT {PAYLOAD_COLS_TS}, trip_start_date, message_key, kafka_partition, "
        "kafka_offset, value_str FROM rec"
    ),
    "q06_contract_errors": with_records("SELECT kafka_offset, error_reason FROM rec"),
    "q07_corrupt_records": with_records(
        "SELECT message_key, kafka_partition, kafka_offset, value_str, error_reason, "
        "topic_name FROM rec WHERE error_reason IS NOT NULL"
    ),
    "q08_schema_valid": with_records(f"SELECT {DEVICE_COLS} FROM rec WHERE error_reason IS NULL"),
    "q09_schema_diff": """
SELECT v.ordinal, v.discrepancy, (SELECT count(*) FROM lineitem) AS batch_rows
FROM (VALUES
    (1, 'Type mismatch for column ''l_quantity'': expected IntegerType(), got DoubleType()'),
    (2, 'Missing column: l_comment'),
    (3, 'Unexpected column: l_tax')
) AS v(ordinal, discrepancy)""",
    "q10_batch_route_drift": (
        "SELECT *, 'corrupt' AS route, 'Type mismatch for column ''o_totalprice'': "
        "expected StringType(), got DoubleType()' AS error_reason FROM orders"
    ),
    "q11_batch_route_ok": (
        "SELECT *, 'clean' AS route, CAST(NULL AS VARCHAR) AS error_reason FROM orders"
    ),
    "q12_qc_nulls": with_records(
        f"SELECT kafka_offset, null_summary FROM (SELECT kafka_offset, "
        f"{summary_sql(NULL_RULES)} AS null_summary FROM routed WHERE route <> 'corrupt') t "
        "WHERE null_summary IS NOT NULL"
    ),
    "q13_qc_threshold": _qc_over("lineitem", "l_orderkey, l_linenumber", LINEITEM_RULES),
    "q13b_qc_threshold_events": _qc_over("events", "event_id", EVENTS_RULES),
    "q14_qc_bounds": _qc_over("customer", "c_custkey", CUSTOMER_RULES),
    "q15_qc_status": with_records(
        "SELECT kafka_offset, qc_status, qc_summary FROM routed WHERE route <> 'corrupt'"
    ),
    "q16_qc_failed": with_records(
        f"SELECT {DEVICE_COLS}, qc_status, qc_summary FROM routed WHERE route = 'failed'"
    ),
    "q17_device_data": with_records(f"SELECT {DEVICE_COLS}, qc_status FROM routed WHERE route = 'clean'"),
    "q18_qc_audit": with_records(_audit_sql()),
    "q24_publish_frame": with_records(
        f"SELECT car_id AS key, {_json_sql()} AS value, "
        f"'{PUBLISH_TOPIC}' AS topic FROM routed WHERE route <> 'corrupt'"
    ),
    "q25_required_fields": with_records(
        """SELECT kafka_offset, refusal_reason IS NULL AS accepted, refusal_reason
FROM (SELECT kafka_offset, CASE
        WHEN cls IN (0, 1, 2, 10) THEN 'Malformed JSON'
        WHEN cls IN (3, 8) THEN 'Field required or invalid: fuel_level'
        WHEN cls = 5 THEN 'Field required or invalid: speed_kmph'
        WHEN cls = 7 THEN 'Field required or invalid: car_id'
      END AS refusal_reason FROM rec) t"""
    ),
    "q26_vehicle_qc": with_records(
        f"""SELECT car_id, count(*) AS rows_checked,
       count(*) FILTER (WHERE route = 'failed') AS rows_failed,
       CAST(sum({cells_failed_sql()}) AS BIGINT) AS cells_failed
FROM routed WHERE route <> 'corrupt' GROUP BY car_id"""
    ),
    "q27_date_partitioned": with_records(
        f"SELECT {DEVICE_COLS}, qc_status FROM routed WHERE route = 'clean' "
        f"AND trip_start_date = DATE '{REPORT_DAY}'"
    ),
    "q28_strict_json": with_records(
        """SELECT kafka_offset AS event_id,
       CASE WHEN c <= 9 THEN 'Malformed JSON' END AS error_reason,
       CASE c WHEN 0 THEN replace(good, '"T', '"T' || chr(9))
              WHEN 1 THEN replace(good, '"T', '"T' || chr(10))
              WHEN 2 THEN good || good
              WHEN 3 THEN good || ',' || good
              WHEN 4 THEN good || ' xyz'
              WHEN 5 THEN good || ']'
              WHEN 6 THEN good || '] xyz'
              WHEN 7 THEN good || ']' || good
              WHEN 8 THEN good || ',1]'
              WHEN 9 THEN replace(good, '"', '''') END AS corrupt_text,
       CASE WHEN c > 9 THEN CAST(kafka_offset % 90 AS DOUBLE) + CAST(0.25 AS DOUBLE) END AS latitude,
       CASE WHEN c > 9 THEN 'T' || CAST(user_id AS VARCHAR) END AS trip_id
FROM (SELECT *, kafka_offset % 13 AS c FROM env) t"""
    ),
    "q29_dedupe_audit": with_records(_audit_sql()),
    "q30_two_runs": with_records(f"SELECT {DEVICE_COLS}, qc_status FROM routed WHERE route = 'clean'"),
    "q36_publish_order": with_records(
        """SELECT car_id AS key, kafka_partition, kafka_offset,
       CAST(row_number() OVER (PARTITION BY car_id ORDER BY kafka_partition, kafka_offset) AS INTEGER) AS position
FROM routed WHERE route <> 'corrupt'"""
    ),
    "q39_nested_schema": """
SELECT 'corrupt' AS route, v.*, (SELECT count(*) FROM orders) AS batch_rows
FROM (VALUES
    (1, 'customer.terms.price', 'mismatch', 'DecimalType(12,2)', 'DoubleType()'),
    (2, 'customer.terms.currency', 'missing', 'StringType()', NULL),
    (3, 'customer.terms.priority', 'unexpected', NULL, 'StringType()'),
    (4, 'history.element.at', 'unexpected', NULL, 'TimestampNTZType()'),
    (5, 'steps.value.status', 'mismatch', 'IntegerType()', 'StringType()')
) AS v(ordinal, path, change, expected, actual)
WHERE (SELECT count(*) FROM orders) > 0""",
    "q40_observed_schema": with_records(_observed_sql()),
    "q41_compacted_day": with_records(
        f"""SELECT trip_start_date, count(*) AS records_before, count(*) AS records,
       true AS same_offsets, trip_start_date = DATE '{REPORT_DAY}' AS fewer_files
FROM routed WHERE route = 'clean' GROUP BY trip_start_date"""
    ),
}
