"""Telemetry validation and quality control on Spark.

Typical use::

    from telemetry_qc import annotate, route, process, run_stream, StreamConfig

    staged = process(envelope_df).staged          # batch: one pass, one write
    outputs = route(staged)                       # the four routed tables

    run_stream(spark, kafka_df, sinks, StreamConfig(checkpoint_location=...))

The library uses the caller's SparkSession as it is and never configures it.
"""

from .operators.contract import (
    batch_route,
    contract_errors,
    required_fields_errors,
    route_by_schema,
    schema_diff,
    tree_diff,
    with_contract,
)
from .operators.observed import observed_schema
from .operators.offsets import merge_intervals, offset_account, offset_intervals
from .operators.qc import DEFAULT_RULES, Rule, apply_rules, audit, bounds, null_check, split_qc, threshold
from .operators.rollup import vehicle_qc
from .plans.batch import annotate, corrupt_records, device_data, qc_audit, qc_failed, route, stage
from .plans.process import process
from .schemas import PAYLOAD_SCHEMA, SINK_SCHEMAS
from .streaming.consumer import ConsumerSettings, consume_topic
from .sinks.published import Manifest
from .streaming.rollup import VehicleRollup
from .streaming.runner import StreamConfig, await_end, request_stop, run_stream, stop_gracefully

__all__ = [
    "DEFAULT_RULES", "PAYLOAD_SCHEMA", "SINK_SCHEMAS", "ConsumerSettings", "Manifest", "Rule",
    "StreamConfig", "VehicleRollup", "annotate", "apply_rules", "audit", "await_end", "batch_route", "bounds",
    "consume_topic", "contract_errors", "corrupt_records", "device_data", "merge_intervals", "null_check",
    "observed_schema", "offset_account", "offset_intervals", "process", "qc_audit", "qc_failed",
    "request_stop", "required_fields_errors", "route", "route_by_schema", "run_stream", "schema_diff",
    "split_qc", "stage", "stop_gracefully", "threshold", "tree_diff", "vehicle_qc", "with_contract",
]
