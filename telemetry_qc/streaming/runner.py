"""Structured Streaming runner: stream of records -> routed tables.

The row path (decode, contract, QC, route) is the same projection as in
batch, applied to the streaming frame; ``foreachBatch`` only materialises a
micro-batch once and writes its four outputs.  Replay safety:

* the checkpoint records offsets; a batch that raises under policy ``fail``
  is not committed, and the restarted query runs it again with the same id
  and the same records;
* every table sink absorbs a replay (overwrite per run and batch, see
  ``sinks``; the run is the query's id, which its checkpoint keeps), so the
  replay neither loses nor doubles rows, and other runs only add.

Policy ``log`` keeps the original behaviour: the error goes to the error log
with the name of the table whose write failed, and the batch is committed.
Policy ``isolate`` writes such a table without the records that it refuses, and
logs each of them (``sinks.isolate``); where too many fail, the store is to
blame and the batch is not committed.

With a ``Manifest`` a batch is published as one (``sinks.published``).
"""

from __future__ import annotations

import threading
import time
import uuid
from dataclasses import dataclass
from typing import Callable, Mapping, Sequence

from pyspark import StorageLevel
from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..operators.contract import SEP, batch_route
from ..operators.qc import DEFAULT_RULES, Rule, audit_cells
from ..functions.json_text import JSON_OPTIONS
from ..operators.offsets import offset_intervals
from ..paths import path_exists, remove_path, touch
from ..plans.batch import CLEAN, annotate, route, route_count_columns, stage
from ..schemas import CORRUPT_RECORDS_SCHEMA
from ..sinks.error_log import error_rows, log_error
from ..sinks.isolate import write_rest
from ..sinks.published import Manifest
from ..sinks.routing import SinkWriteError, write_routed
from ..sinks.tables import SinkSchemaError, check_frame

FAIL, LOG, ISOLATE = "fail", "log", "isolate"
METRICS_NAME = "qc_batch"


@dataclass
class StreamConfig:
    """Settings of one streaming run.

    ``app_label`` only names the query.  ``trigger`` is passed to
    ``DataStreamWriter.trigger`` (e.g. ``{"availableNow": True}`` or
    ``{"processingTime": "10 seconds"}``); unset means back-to-back batches.
    ``materialize``: ``"stage"`` (default) writes a micro-batch once to
    ``stage_dir`` in shared storage (default: beside the checkpoint) before
    its outputs are written, and removes it after; that bounds memory
    whatever the batch size and survives executor loss without re-reading the
    source.  ``"persist"`` keeps it in executor memory / disk instead, for
    bounded batches.  ``spread_partitions`` round-robins each batch over that
    many tasks when the source has few partitions.
    """

    checkpoint_location: str
    on_error: str = FAIL
    rules: Sequence[Rule] = DEFAULT_RULES
    trigger: Mapping[str, object] | None = None
    materialize: str = "stage"
    stage_dir: str | None = None
    spread_partitions: int | None = None
    concurrent_writes: bool = True
    column_metrics: bool = False
    allow_unexpected: bool = False
    app_label: str | None = None
    output_mode: str = "append"
    # Policy isolate: so many single offsets may be left out of a table's batch.
    max_refused: int = 8

    def __post_init__(self) -> None:
        if self.on_error not in (FAIL, LOG, ISOLATE):
            raise ValueError("on_error must be 'fail', 'log' or 'isolate'")
        if self.materialize not in ("persist", "stage"):
            raise ValueError("materialize must be 'persist' or 'stage'")
        if self.materialize == "stage" and not self.stage_dir:
            self.stage_dir = f"{self.checkpoint_location.rstrip('/')}_stage"


def batch_metrics(annotated: DataFrame, rules: Sequence[Rule] = ()) -> DataFrame:
    """Per-batch counts by route, reported in the query progress
    (``observedMetrics``) instead of printing rows."""
    return annotated.observe(METRICS_NAME, *route_count_columns(rules))


@dataclass
class BatchExtras:
    """What else a batch writes, all optional: ``manifest`` publishes its
    tables as one, with their counts; ``counts`` is a sink for one row a
    batch, its records per route; ``offsets`` one for the interval set of its
    records' offsets; ``rollup`` a ``VehicleRollup``."""

    manifest: Manifest | None = None
    counts: object | None = None
    offsets: object | None = None
    rollup: object | None = None


def make_batch_writer(
    sinks: Mapping[str, object],
    config: StreamConfig,
    error_log=None,
    extras: BatchExtras | None = None,
) -> Callable[[DataFrame, int], None]:
    """The ``foreachBatch`` function: materialise, route, write in order."""
    if config.on_error != FAIL and error_log is None:
        raise ValueError(f"policy '{config.on_error}' needs an error_log sink")
    extras = extras or BatchExtras()

    # Column expressions are plain values: the audit cells are built on the
    # first batch and reused (building them costs hundreds of JVM calls).
    prepared: dict[str, object] = {}

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        run_id = _begin(spark, config)
        held, path = None, None
        refused: list[tuple[str, str]] = []
        lock = threading.Lock()

        def rescue(table: str, frame: DataFrame, error: BaseException) -> None:
            # Side tables are written by threads of their own.
            if isinstance(error, SinkSchemaError):
                raise error
            found = write_rest(sinks[table], frame, batch_id, run_id, config.max_refused)
            with lock:
                refused.extend((r.message(), table) for r in found)

        try:
            if config.materialize == "stage":
                path = f"{config.stage_dir}/{run_id}-{batch_id}-{uuid.uuid4().hex[:8]}"
                observed = Observation()
                held = stage(batch.observe(observed, *route_count_columns()), path)
                counts = {k: int(v) for k, v in observed.get.items()}
            else:
                # Aggregated first, so that it is computed by all of its tasks
                # and not by the few that a sink may write with.
                held = batch.persist(StorageLevel.MEMORY_AND_DISK)
                counts = held.agg(*route_count_columns()).first().asDict()
            if extras.manifest is not None:
                extras.manifest.withdraw(spark, batch_id, run_id)
            more = []
            if extras.counts is not None:
                row = spark.createDataFrame([tuple(counts.values())], ", ".join(f"{c} bigint" for c in counts))
                extras.counts.write(row.coalesce(1), batch_id, run_id)
            if extras.offsets is not None:
                extras.offsets.write(offset_intervals(held), batch_id, run_id)
                more.append(extras.offsets.name)
            if extras.rollup is not None:
                extras.rollup.write(held, batch_id, run_id)
                more.append(extras.rollup.name)
            if "cells" not in prepared:
                prepared["cells"] = audit_cells(config.rules, held.schema)
            write_routed(
                route(held, config.rules, cells=prepared["cells"]),
                sinks,
                batch_id,
                run_id,
                concurrent=config.concurrent_writes,
                rescue=rescue if config.on_error == ISOLATE else None,
                manifest=extras.manifest,
                counts=counts,
                published=more,
            )
            if refused:
                error_log.write(error_rows(spark, sorted(refused), batch_id), batch_id, run_id)
        except SinkWriteError as e:
            if config.on_error != LOG:
                raise
            log_error(error_log, spark, str(e.cause), batch_id, e.table, run_id)
        except Exception as e:  # noqa: BLE001 - policy decides
            if config.on_error != LOG:
                raise
            log_error(error_log, spark, str(e), batch_id, "materialize", run_id)
        finally:
            if path is not None:
                remove_path(spark, path)
            elif held is not None:
                held.unpersist()

    return write_batch


class StopRequested(RuntimeError):
    """Ends a query before its next batch; that batch is not begun."""


def stop_marker(checkpoint_location: str) -> str:
    return f"{checkpoint_location.rstrip('/')}_stop"


def request_stop(spark: SparkSession, checkpoint_location: str) -> None:
    """Ask the query with this checkpoint, in whatever process it runs, to end
    after the micro-batch in flight: a marker beside the checkpoint, which
    every batch looks for before it begins, and ``await_end`` between them.
    The next start of the query removes it."""
    touch(spark, stop_marker(checkpoint_location))


def _begin(spark: SparkSession, config: StreamConfig) -> str:
    """The run id of the query whose batch this is; refuses to begin one
    after a stop was asked for."""
    query_id = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
    if path_exists(spark, stop_marker(config.checkpoint_location)):
        raise StopRequested(f"stop of query {query_id} requested")
    return f"query-{query_id}"


def corrupt_batch(batch: DataFrame, reasons: Sequence[str]) -> DataFrame:
    """A batch of any columns in the shape of ``corrupt_records``: each row as
    JSON text (or its own text, where it has one), the reasons, and the
    record's coordinates where the source has them, by the names of the tables
    or of the envelope."""

    def first(kind: str, *names: str):
        found = [F.col(f"`{n}`") for n in names if n in batch.columns]
        return (found[0] if found else F.lit(None)).cast(kind)

    text = F.to_json(F.struct(*(F.col(f"`{c}`") for c in batch.columns)), JSON_OPTIONS)
    columns = {
        "message_key": first("string", "message_key", "key"),
        "kafka_partition": first("int", "kafka_partition", "partition"),
        "kafka_offset": first("bigint", "kafka_offset", "offset"),
        "value_str": first("string", "value_str") if "value_str" in batch.columns else text,
        "error_reason": F.lit(SEP.join(reasons)),
        "load_timestamp": F.coalesce(first("timestamp_ntz", "load_timestamp"), F.current_timestamp().cast("timestamp_ntz")),
        "topic_name": first("string", "topic_name", "topic"),
    }
    return batch.select(*(c.alias(n) for n, c in columns.items()))


def make_schema_batch_writer(
    sinks: Mapping[str, object],
    expected: StructType,
    config: StreamConfig,
    error_log=None,
) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function for typed sources: a micro-batch whose schema
    differs from ``expected`` goes whole to ``sinks["corrupt_records"]``, in
    that table's columns, with the differences as ``error_reason``, any other
    to ``sinks["device_data"]``, in the expected ones."""
    if config.on_error == ISOLATE:
        raise ValueError("policy 'isolate' needs records with offsets; typed batches go whole")
    if config.on_error == LOG and error_log is None:
        raise ValueError("policy 'log' needs an error_log sink")

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        run_id = _begin(spark, config)
        target, reasons = batch_route(batch, expected)
        table = "device_data" if target == CLEAN else "corrupt_records"
        try:
            if table == "corrupt_records":
                frame = check_frame(corrupt_batch(batch, reasons), CORRUPT_RECORDS_SCHEMA, table)
            else:
                frame = check_frame(batch, expected, table)
            sinks[table].write(frame, batch_id, run_id)
        except Exception as e:  # noqa: BLE001 - policy decides
            if config.on_error == FAIL:
                raise
            log_error(error_log, spark, str(e), batch_id, table, run_id)

    return write_batch


def annotated_stream(source: DataFrame, config: StreamConfig) -> DataFrame:
    src = source.repartition(config.spread_partitions) if config.spread_partitions else source
    metric_rules = config.rules if config.column_metrics else ()
    annotated = annotate(src, config.rules, allow_unexpected=config.allow_unexpected)
    return batch_metrics(annotated, metric_rules)


def run_stream(
    spark: SparkSession,
    source: DataFrame,
    sinks: Mapping[str, object],
    config: StreamConfig,
    error_log=None,
    await_termination: bool = False,
    expected: StructType | None = None,
    counts=None,
    manifest: Manifest | None = None,
    offsets=None,
    rollup=None,
) -> StreamingQuery:
    """Start the routed streaming query over an envelope stream.

    ``source`` is a streaming envelope (Kafka or file source).  With
    ``expected`` it may be any typed stream instead, whose micro-batches are
    checked and routed as a whole (``make_schema_batch_writer``).  ``counts``
    is a sink for the records per route of each batch of an envelope: the
    query's progress keeps the last batches only.  ``manifest``, ``offsets``
    and ``rollup``: see ``BatchExtras``.  With ``await_termination`` the call
    blocks until the query ends (for an ``availableNow`` trigger: when the
    backlog is done; or on ``request_stop``) and re-raises a failure.
    """
    remove_path(spark, stop_marker(config.checkpoint_location))
    if expected is None:
        extras = BatchExtras(manifest, counts, offsets, rollup)
        frame, write = annotated_stream(source, config), make_batch_writer(sinks, config, error_log, extras)
    else:
        frame, write = source, make_schema_batch_writer(sinks, expected, config, error_log)
    writer = (
        frame.writeStream.foreachBatch(write)
        .outputMode(config.output_mode)
        .option("checkpointLocation", config.checkpoint_location)
    )
    if config.app_label:
        writer = writer.queryName(config.app_label)
    if config.trigger:
        writer = writer.trigger(**dict(config.trigger))
    query = writer.start()
    query.checkpoint_location = config.checkpoint_location
    if await_termination:
        await_end(query)
    return query


def _checkpoint_of(query: StreamingQuery, checkpoint_location: str | None) -> str:
    found = checkpoint_location or getattr(query, "checkpoint_location", None)
    if not found:
        raise ValueError("the query was not started here: name its checkpoint_location")
    return found


def await_end(query: StreamingQuery, checkpoint_location: str | None = None, poll_seconds: float = 1.0) -> bool:
    """Wait until ``query`` ends, and end it after the batch in flight once a
    stop is requested (also where it is idle).  Returns whether it was stopped
    so; re-raises any other failure."""
    where = _checkpoint_of(query, checkpoint_location)
    spark = SparkSession.active()
    try:
        while not query.awaitTermination(poll_seconds):
            if path_exists(spark, stop_marker(where)):
                stop_gracefully(query, checkpoint_location=where)
                return True
    except StreamingQueryException as e:
        if StopRequested.__name__ not in str(e):
            raise
        return True
    return False


def stop_gracefully(
    query: StreamingQuery,
    poll_seconds: float = 0.2,
    timeout_seconds: float | None = None,
    checkpoint_location: str | None = None,
) -> bool:
    """End ``query`` after the micro-batch in flight.

    That batch is written and committed; the next, if there is a backlog, is
    refused before it begins, which ends the query with ``StopRequested`` (so
    ``awaitTermination`` elsewhere raises).  An idle query is just stopped.
    A restart from the checkpoint goes on with the refused batch.  Returns
    False if the timeout passed first (the query is stopped regardless).
    """
    deadline = None if timeout_seconds is None else time.monotonic() + timeout_seconds
    clean = True
    request_stop(SparkSession.active(), _checkpoint_of(query, checkpoint_location))
    while query.isActive and query.status.get("isTriggerActive", False):
        if deadline is not None and time.monotonic() > deadline:
            clean = False
            break
        time.sleep(poll_seconds)
    query.stop()
    return clean
