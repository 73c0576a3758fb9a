"""Topic consumer: Kafka topic -> contract -> QC -> JDBC tables.

The parametrised entry point of the original job, with its settings taken
from the caller: broker, topic, checkpoint folder, database URL, table names
and connection options (driver, user, password).  Nothing is hard-coded and
the caller's session is used as it is.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..operators.qc import DEFAULT_RULES, Rule
from ..schemas import SINK_SCHEMAS
from ..sinks.jdbc import JdbcSink
from ..sinks.routing import SINK_ORDER
from ..sources.kafka import kafka_source_options, read_kafka_stream
from .runner import FAIL, StreamConfig, run_stream

DEFAULT_TABLES = {name: name for name in SINK_SCHEMAS}


@dataclass
class ConsumerPlan:
    source_options: dict[str, str]
    sinks: dict[str, JdbcSink]
    error_log: JdbcSink
    config: StreamConfig
    counts: JdbcSink | None


@dataclass
class ConsumerSettings:
    app_label: str
    bootstrap_servers: str
    topic: str
    checkpoint_dir: str
    jdbc_url: str
    jdbc_options: Mapping[str, str] = field(default_factory=dict)
    tables: Mapping[str, str] = field(default_factory=lambda: dict(DEFAULT_TABLES))
    on_error: str = FAIL
    rules: Sequence[Rule] = DEFAULT_RULES
    trigger: Mapping[str, object] | None = None
    max_offsets_per_trigger: int | None = None
    min_partitions: int | None = None
    starting_offsets: str = "earliest"
    kafka_options: Mapping[str, str] = field(default_factory=dict)
    # Without a rate limit the first micro-batch is the topic's whole
    # backlog, so batches are staged to shared storage by default rather
    # than held in executor memory.
    materialize: str = "stage"
    stage_dir: str | None = None
    allow_unexpected: bool = False
    # Table for the records per route of every batch; none is written unless
    # it is named.
    counts_table: str | None = None
    # With a schema, batches of the source (by default the topic's envelope;
    # ``project`` may turn it into typed columns) are checked and routed whole.
    expected: StructType | None = None
    project: Callable[[DataFrame], DataFrame] | None = None


def plan_consumer(s: ConsumerSettings) -> ConsumerPlan:
    """Everything the consumer will use, without touching any service."""
    tables = {**DEFAULT_TABLES, **dict(s.tables)}
    opts = dict(s.jdbc_options)
    sinks = {
        name: JdbcSink(name, s.jdbc_url, tables[name], opts)
        for name in SINK_ORDER
    }
    error_log = JdbcSink("consumer_error_log", s.jdbc_url, tables["consumer_error_log"], opts)
    config = StreamConfig(
        checkpoint_location=s.checkpoint_dir,
        on_error=s.on_error,
        rules=s.rules,
        trigger=s.trigger,
        app_label=s.app_label,
        materialize=s.materialize,
        stage_dir=s.stage_dir or f"{s.checkpoint_dir.rstrip('/')}_stage",
        allow_unexpected=s.allow_unexpected,
    )
    source = kafka_source_options(
        s.bootstrap_servers,
        s.topic,
        s.starting_offsets,
        s.max_offsets_per_trigger,
        s.min_partitions,
        dict(s.kafka_options),
    )
    counts = JdbcSink("batch_counts", s.jdbc_url, s.counts_table, opts) if s.counts_table else None
    return ConsumerPlan(source, sinks, error_log, config, counts)


def consume_topic(
    spark: SparkSession, settings: ConsumerSettings, await_termination: bool = False
) -> StreamingQuery:
    """Start the consumer (needs the Kafka connector and the JDBC driver on
    the session's classpath)."""
    p = plan_consumer(settings)
    source = read_kafka_stream(spark, p.source_options)
    if settings.project is not None:
        source = settings.project(source)
    return run_stream(
        spark, source, p.sinks, p.config, p.error_log, await_termination, settings.expected, p.counts
    )
