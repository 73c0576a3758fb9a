"""Decode + typed parse + enrichment of a record envelope (row-wise projections)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType, TimestampType

from ..functions.decode import decode_envelope
from ..schemas import PAYLOAD_SCHEMA
from .contract import with_contract


def parse_records(
    env: DataFrame,
    expected: StructType = PAYLOAD_SCHEMA,
    allow_unexpected: bool = False,
) -> DataFrame:
    """Envelope -> decoded record with ``parsed`` struct and ``error_reason``
    (see ``contract.with_contract``).  Pure projections: no shuffle."""
    return with_contract(decode_envelope(env), "value_str", expected, allow_unexpected)


def flatten_payload(expected: StructType = PAYLOAD_SCHEMA) -> list[Column]:
    """``parsed.<f> AS <f>`` for every payload field."""
    return [F.col(f"parsed.{n}").alias(n) for n in expected.names]


def enrich(
    parsed: DataFrame,
    load_ts: Column | None = None,
    expected: StructType = PAYLOAD_SCHEMA,
    keep: tuple[str, ...] = ("value_str", "topic_name", "error_reason"),
) -> DataFrame:
    """Payload fields, trip date, record coordinates and load time.

    ``load_ts`` defaults to ``current_timestamp()``, which Spark fixes once per
    query, hence once per micro-batch.
    """
    load_ts = load_ts if load_ts is not None else F.current_timestamp()
    cols = flatten_payload(expected)
    if "trip_start_time" in expected.names:
        cols.append(F.to_date(F.col("parsed.trip_start_time")).alias("trip_start_date"))
    cols += [
        F.col("message_key"),
        F.col("kafka_partition"),
        F.col("kafka_offset"),
        load_ts.alias("load_timestamp"),
    ]
    cols += [F.col(k) for k in keep if k in parsed.columns]
    return parsed.select(*cols)


def wall_clock(df: DataFrame) -> DataFrame:
    """Zoned timestamps -> session-zone wall clock (TIMESTAMP_NTZ).

    Sink tables hold times without zone, as device times carry none.
    """
    return df.select(
        *(
            F.col(f.name).cast("timestamp_ntz").alias(f.name)
            if isinstance(f.dataType, TimestampType)
            else F.col(f.name)
            for f in df.schema
        )
    )
