"""Command line: ``spark-submit -m``-style entry points.

    python -m telemetry_qc process --input <envelope parquet> --output <folder>
    python -m telemetry_qc consume --bootstrap-servers host:9092 --topic t \\
        --checkpoint-dir <shared>/ckpt --jdbc-url jdbc:postgresql://db/x \\
        --jdbc-option driver=org.postgresql.Driver --jdbc-user-env DB_USER \\
        --jdbc-password-env DB_PASSWORD
    python -m telemetry_qc stop --checkpoint-dir <shared>/ckpt

The session comes from ``spark-submit`` (``getOrCreate``); all cluster
settings stay with the submitter.  Credentials are read from environment
variables named on the command line, never passed as arguments.
"""

from __future__ import annotations

import argparse
import json
import os
import sys

from pyspark.sql import SparkSession

from .operators.qc import DEFAULT_RULES, rules_from_config
from .plans.process import process
from .sinks.published import Manifest
from .sinks.routing import SINK_ORDER
from .sinks.tables import ParquetTableSink, checked_run_id, new_run_id
from .sources.files import read_envelope
from .streaming.consumer import ConsumerSettings, consume_topic
from .streaming.runner import FAIL, ISOLATE, LOG, request_stop


def _rules(path: str | None):
    if not path:
        return DEFAULT_RULES
    with open(path) as f:
        return rules_from_config(json.load(f))


def _options(pairs: list[str]) -> dict[str, str]:
    out = {}
    for p in pairs:
        k, sep, v = p.partition("=")
        if not sep:
            raise SystemExit(f"expected key=value, got {p!r}")
        out[k] = v
    return out


def cmd_process(spark: SparkSession, a: argparse.Namespace) -> dict:
    sinks = {n: ParquetTableSink(n, f"{a.output}/{n}") for n in SINK_ORDER}
    sinks["device_data"] = ParquetTableSink(
        "device_data", f"{a.output}/device_data", ("trip_start_date",), rebalance=True
    )
    run_id = checked_run_id(a.run_id or new_run_id())
    result = process(
        read_envelope(spark, a.input),
        sinks,
        rules=_rules(a.rules),
        stage_path=f"{a.output}/_stage/{run_id}",
        batch_id=a.batch_id,
        run_id=run_id,
        allow_unexpected=a.allow_unexpected,
        manifest=Manifest(a.manifest) if a.manifest else None,
    )
    return result.metrics


def cmd_consume(spark: SparkSession, a: argparse.Namespace) -> None:
    jdbc = _options(a.jdbc_option)
    if a.jdbc_user_env:
        jdbc["user"] = os.environ[a.jdbc_user_env]
    if a.jdbc_password_env:
        jdbc["password"] = os.environ[a.jdbc_password_env]
    settings = ConsumerSettings(
        app_label=a.app_label,
        bootstrap_servers=a.bootstrap_servers,
        topic=a.topic,
        checkpoint_dir=a.checkpoint_dir,
        jdbc_url=a.jdbc_url,
        jdbc_options=jdbc,
        on_error=a.on_error,
        rules=_rules(a.rules),
        max_offsets_per_trigger=a.max_offsets_per_trigger,
        min_partitions=a.min_partitions,
        kafka_options=_options(a.kafka_option),
        allow_unexpected=a.allow_unexpected,
        counts_table=a.counts_table,
    )
    consume_topic(spark, settings, await_termination=True)


def cmd_stop(spark: SparkSession, a: argparse.Namespace) -> None:
    request_stop(spark, a.checkpoint_dir)


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="telemetry_qc")
    sub = p.add_subparsers(dest="command", required=True)

    b = sub.add_parser("process", help="landed envelope parquet -> routed parquet tables")
    b.add_argument("--input", required=True)
    b.add_argument("--output", required=True)
    b.add_argument("--rules", help="JSON list of rules (default: built-in rules)")
    b.add_argument("--run-id", help="name of this run (default: a fresh one); a run repeated under its name replaces what it wrote")
    b.add_argument("--batch-id", type=int, default=0)
    b.add_argument("--allow-unexpected", action="store_true", help="accept extra JSON keys")
    b.add_argument("--manifest", help="folder of the manifest that publishes the tables together")

    c = sub.add_parser("consume", help="Kafka topic -> routed JDBC tables (streaming)")
    c.add_argument("--app-label", default="telemetry-qc")
    c.add_argument("--bootstrap-servers", required=True)
    c.add_argument("--topic", required=True)
    c.add_argument("--checkpoint-dir", required=True)
    c.add_argument("--jdbc-url", required=True)
    c.add_argument("--jdbc-option", action="append", default=[], metavar="KEY=VALUE")
    c.add_argument("--jdbc-user-env")
    c.add_argument("--jdbc-password-env")
    c.add_argument("--kafka-option", action="append", default=[], metavar="KEY=VALUE")
    c.add_argument("--on-error", choices=(FAIL, LOG, ISOLATE), default=FAIL)
    c.add_argument("--counts-table", help="table for the records per route of every batch")
    c.add_argument("--rules")
    c.add_argument("--max-offsets-per-trigger", type=int)
    c.add_argument("--min-partitions", type=int)
    c.add_argument("--allow-unexpected", action="store_true", help="accept extra JSON keys")

    s = sub.add_parser("stop", help="end the consumer with this checkpoint after its batch in flight")
    s.add_argument("--checkpoint-dir", required=True)
    return p


def main(argv: list[str] | None = None):
    a = parser().parse_args(argv)
    spark = SparkSession.builder.appName(f"telemetry-qc {a.command}").getOrCreate()
    if a.command == "process":
        metrics = cmd_process(spark, a)
        print(json.dumps(metrics))
        return metrics
    {"consume": cmd_consume, "stop": cmd_stop}[a.command](spark, a)
    return None


if __name__ == "__main__":
    main(sys.argv[1:])
