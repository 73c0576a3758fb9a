"""Batch plan: envelope -> row contract -> QC -> routed outputs.

``annotate`` is a chain of row-wise projections (decode; typed parse + key
scan; raw key map for flagged records only; contract, enrichment, QC verdict,
route).  Nothing in it shuffles: each record is handled
in the partition it was read in, so the work spreads over as many tasks as
the source has partitions (Kafka partitions, file splits) and no key can
skew it.

Routing must not filter the lazy annotation directly: Catalyst pushes the
filter below the projection and substitutes the whole contract expression
into it, parsing every record again per output (measured: 3-5x slower).
``stage`` therefore writes the annotated rows once to the shared folder,
partitioned by ``route``; each output then reads only its own partition
(partition pruning) and only its own columns (column pruning), with no
second parse.  A micro-batch does the same (or persists, see streaming).
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType, TimestampNTZType

from ..operators.enrich import enrich, parse_records
from ..operators.qc import DEFAULT_RULES, SUCCESS, Rule, apply_rules, audit, rule_fails
from ..sinks.routing import SINK_ORDER  # noqa: F401 - re-exported
from ..schemas import (
    CORRUPT_RECORDS_SCHEMA,
    DEVICE_DATA_SCHEMA,
    PAYLOAD_SCHEMA,
    QC_AUDIT_SCHEMA,
    QC_FAILED_SCHEMA,
)

ROUTE = "route"
CORRUPT, CLEAN, FAILED = "corrupt", "clean", "failed"


def spread(df: DataFrame, partitions: int | None = None) -> DataFrame:
    """Round-robin ``df`` over ``partitions`` tasks; without a number it stays
    as it is.

    Parsing is CPU-bound, so a source read as a handful of splits leaves most
    cores idle, and dealing its rows out pays.  It moves every row, though:
    only the caller, who knows the source, can ask for it.  Sources with
    splits of their own (``minPartitions``, ``maxPartitionBytes``) need it not.
    """
    return df.repartition(partitions) if partitions else df


def annotate(
    env: DataFrame,
    rules: Sequence[Rule] = DEFAULT_RULES,
    expected: StructType = PAYLOAD_SCHEMA,
    load_ts: Column | None = None,
    allow_unexpected: bool = False,
) -> DataFrame:
    """Every record with its contract verdict, QC verdict and route.

    Columns: the payload fields (``timestamp`` named ``event_timestamp``),
    ``trip_start_date``, record coordinates, ``load_timestamp``,
    ``value_str``, ``topic_name``, ``error_reason`` (NULL = schema-valid),
    ``qc_summary``, ``qc_status`` and ``route`` (corrupt / clean / failed).
    Works unchanged on a streaming frame.
    """
    parsed = parse_records(env, expected, allow_unexpected)
    enriched = enrich(parsed, load_ts, expected).withColumnRenamed(
        "timestamp", "event_timestamp"
    )
    checked = apply_rules(enriched, rules)
    route = (
        F.when(F.col("error_reason").isNotNull(), F.lit(CORRUPT))
        .when(F.col("qc_status") == SUCCESS, F.lit(CLEAN))
        .otherwise(F.lit(FAILED))
    )
    return checked.withColumn(ROUTE, route)


def route_count_columns(rules: Sequence[Rule] = ()) -> list[Column]:
    """Aggregates for ``DataFrame.observe``: records in total and per route,
    and per ruled column the schema-valid records failing it
    (``failed_<column>``).  Computed while the batch is processed anyway."""
    r = F.col(ROUTE)
    cols = [
        F.count(F.lit(1)).alias("records"),
        F.count(F.when(r == CORRUPT, 1)).alias(CORRUPT),
        F.count(F.when(r == CLEAN, 1)).alias(CLEAN),
        F.count(F.when(r == FAILED, 1)).alias(FAILED),
    ]
    cols += [
        F.count(F.when((r == FAILED) & rule_fails(rule), 1)).alias(
            f"failed_{rule.column}"
        )
        for rule in rules
    ]
    return cols


def stage(annotated: DataFrame, path: str) -> DataFrame:
    """Write the annotated rows once, partitioned by route; read them back.

    The raw text is kept for corrupt rows only (the clean and failed tables
    do not carry it), which keeps the staged table close to the typed size.
    Overwrites ``path`` as a whole (static, whatever the session's mode), so
    a retried batch replaces its own partial output.  Read back by the known
    schema: a batch without rows leaves no file to infer one from.
    """
    slim = annotated.withColumn(
        "value_str",
        F.when(F.col(ROUTE) == CORRUPT, F.col("value_str")),
    )
    w = slim.write.mode("overwrite").option("partitionOverwriteMode", "static")
    w.partitionBy(ROUTE).parquet(path)
    return annotated.sparkSession.read.schema(slim.schema).parquet(path)


def schema_valid(annotated: DataFrame) -> DataFrame:
    return annotated.filter(F.col(ROUTE).isin(CLEAN, FAILED))


def schema_invalid(annotated: DataFrame) -> DataFrame:
    return annotated.filter(F.col(ROUTE) == CORRUPT)


def _shape(df: DataFrame, schema: StructType) -> DataFrame:
    """The sink's columns in its order, times as wall clock: one projection
    (each DataFrame call re-analyses the plan below it, so fewer calls keep
    per-batch planning short)."""
    return df.select(
        *(
            F.col(f.name).cast("timestamp_ntz").alias(f.name)
            if isinstance(f.dataType, TimestampNTZType)
            else F.col(f.name)
            for f in schema
        )
    )


def corrupt_records(annotated: DataFrame) -> DataFrame:
    return _shape(schema_invalid(annotated), CORRUPT_RECORDS_SCHEMA)


def device_data(annotated: DataFrame) -> DataFrame:
    return _shape(annotated.filter(F.col(ROUTE) == CLEAN), DEVICE_DATA_SCHEMA)


def qc_failed(annotated: DataFrame) -> DataFrame:
    return _shape(annotated.filter(F.col(ROUTE) == FAILED), QC_FAILED_SCHEMA)


def qc_audit(
    annotated: DataFrame,
    rules: Sequence[Rule] = DEFAULT_RULES,
    checked_at: Column | None = None,
    cells: Column | None = None,
) -> DataFrame:
    out = audit(schema_valid(annotated), rules, checked_at, cells=cells)
    return _shape(out, QC_AUDIT_SCHEMA)


def route(
    annotated: DataFrame,
    rules: Sequence[Rule] = DEFAULT_RULES,
    checked_at: Column | None = None,
    cells: Column | None = None,
) -> dict[str, DataFrame]:
    """The four sink frames of one batch, keyed by table name.  Pass a staged
    (or persisted) annotation, see the module note.  ``cells``: audit cells
    built once (``audit_cells``) and reused across batches."""
    return {
        "qc_audit_log_table": qc_audit(annotated, rules, checked_at, cells),
        "qc_failed_table": qc_failed(annotated),
        "corrupt_records": corrupt_records(annotated),
        "device_data": device_data(annotated),
    }
