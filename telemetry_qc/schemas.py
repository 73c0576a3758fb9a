"""Schemas of the telemetry payload, the record envelope and the sink tables.

Everything here is metadata: ``StructType`` constants used to parse the
payload and to check frames before they are written.
"""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    BinaryType,
    BooleanType,
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    MapType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
    TimestampType,
)

# --- fixed values: the device payload contract (field names, order, types) ---
PAYLOAD_SCHEMA = StructType(
    [
        StructField("trip_id", StringType()),
        StructField("car_id", StringType()),
        StructField("latitude", DoubleType()),
        StructField("longitude", DoubleType()),
        StructField("timestamp", TimestampType()),
        StructField("speed_kmph", DoubleType()),
        StructField("fuel_level", DoubleType()),
        StructField("engine_temp_c", DoubleType()),
        StructField("trip_start_time", TimestampType()),
        StructField("trip_start_latitude", DoubleType()),
        StructField("trip_start_longitude", DoubleType()),
    ]
)
# --- end of fixed values ---

TIMESTAMP_FIELDS = tuple(
    f.name for f in PAYLOAD_SCHEMA if isinstance(f.dataType, TimestampType)
)

# Record envelope as a Kafka source delivers it.  File sources used in place
# of Kafka carry the same columns.
ENVELOPE_SCHEMA = StructType(
    [
        StructField("key", BinaryType()),
        StructField("value", BinaryType()),
        StructField("topic", StringType()),
        StructField("partition", IntegerType()),
        StructField("offset", LongType()),
        StructField("timestamp", TimestampType()),
    ]
)

# Identity of a record: unique per (topic, partition, offset).  A table
# without topic_name holds the records of one topic; the audit table has one
# row per record and ruled column.
TABLE_KEYS = {
    "device_data": ("kafka_partition", "kafka_offset"),
    "qc_failed_table": ("kafka_partition", "kafka_offset"),
    "corrupt_records": ("topic_name", "kafka_partition", "kafka_offset"),
    "qc_audit_log_table": ("kafka_partition", "kafka_offset", "column_name"),
}

# Device times carry no zone; outputs hold them as wall-clock TIMESTAMP_NTZ.
_TS = TimestampNTZType()

# --- fixed values: sink table names, column names and column order ---

DEVICE_DATA_SCHEMA = StructType(
    [
        StructField("trip_id", StringType()),
        StructField("car_id", StringType()),
        StructField("latitude", DoubleType()),
        StructField("longitude", DoubleType()),
        StructField("event_timestamp", _TS),
        StructField("speed_kmph", DoubleType()),
        StructField("fuel_level", DoubleType()),
        StructField("engine_temp_c", DoubleType()),
        StructField("trip_start_time", _TS),
        StructField("trip_start_latitude", DoubleType()),
        StructField("trip_start_longitude", DoubleType()),
        StructField("trip_start_date", DateType()),
        StructField("message_key", StringType()),
        StructField("kafka_partition", IntegerType()),
        StructField("kafka_offset", LongType()),
        StructField("qc_status", StringType()),
        StructField("load_timestamp", _TS),
    ]
)

CORRUPT_RECORDS_SCHEMA = StructType(
    [
        StructField("message_key", StringType()),
        StructField("kafka_partition", IntegerType()),
        StructField("kafka_offset", LongType()),
        StructField("value_str", StringType()),
        StructField("error_reason", StringType()),
        StructField("load_timestamp", _TS),
        StructField("topic_name", StringType()),
    ]
)

ERROR_LOG_SCHEMA = StructType(
    [
        StructField("error_message", StringType()),
        StructField("log_time", _TS),
        StructField("target_table", StringType()),
        StructField("batch_id", LongType()),
    ]
)

QC_FAILED_SCHEMA = StructType(
    [f for f in DEVICE_DATA_SCHEMA if f.name not in ("qc_status", "load_timestamp")]
    + [
        StructField("qc_status", StringType()),
        StructField("qc_summary", StringType()),
        StructField("load_timestamp", _TS),
    ]
)

QC_AUDIT_SCHEMA = StructType(
    [
        StructField("trip_id", StringType()),
        StructField("column_name", StringType()),
        StructField("passed", BooleanType()),
        StructField("fail_reason", StringType()),
        StructField("checked_at", _TS),
        StructField("kafka_partition", IntegerType()),
        StructField("kafka_offset", LongType()),
    ]
)

# Not a table of the original design: which batches are whole (sinks/published.py).
MANIFEST_SCHEMA = StructType(
    [
        StructField("tables", ArrayType(StringType())),
        StructField("counts", MapType(StringType(), LongType())),
        StructField("published_at", _TS),
        StructField("table_name", StringType()),
        StructField("partition_value", StringType()),
        StructField(
            "replaced",
            ArrayType(StructType([StructField("run_id", StringType()), StructField("batch_id", LongType())])),
        ),
    ]
)

SINK_SCHEMAS = {
    "device_data": DEVICE_DATA_SCHEMA,
    "corrupt_records": CORRUPT_RECORDS_SCHEMA,
    "consumer_error_log": ERROR_LOG_SCHEMA,
    "qc_failed_table": QC_FAILED_SCHEMA,
    "qc_audit_log_table": QC_AUDIT_SCHEMA,
}
# --- end of fixed values ---
