"""One batch run over a bounded envelope (a table, a landed topic export)."""

from __future__ import annotations

from dataclasses import dataclass
from typing import Mapping, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators.qc import DEFAULT_RULES, Rule
from ..paths import fresh_path, remove_path
from ..sinks.routing import write_routed
from ..sinks.tables import checked_run_id, new_run_id
from .batch import (
    CLEAN,
    CORRUPT,
    FAILED,
    annotate,
    route,
    route_count_columns,
    spread,
    stage,
)


@dataclass
class BatchResult:
    """``staged`` and ``outputs`` are None and empty where the staged table
    was removed after the writes."""

    staged: DataFrame | None
    outputs: dict[str, DataFrame]
    metrics: dict[str, int]
    run_id: str

    def counts(self) -> dict[str, int]:
        """Rows per route, observed while the staged table was written (no
        extra job)."""
        return {r: self.metrics[r] for r in (CORRUPT, CLEAN, FAILED) if self.metrics.get(r)}


def process(
    env: DataFrame,
    sinks: Mapping[str, object] | None = None,
    rules: Sequence[Rule] = DEFAULT_RULES,
    stage_path: str | None = None,
    batch_id: int = 0,
    run_id: str | None = None,
    partitions: int | None = None,
    concurrent_writes: bool = True,
    column_metrics: bool = False,
    allow_unexpected: bool = False,
    keep_stage: bool | None = None,
    manifest=None,
) -> BatchResult:
    """Annotate and stage ``env`` once, then write each output to its sink.

    One pass parses every record; each sink reads its own route partition of
    the staged table (side tables as concurrent jobs, the clean table last).
    Every call is a run of its own (``run_id``, fresh unless given) and adds
    to the tables; a call with an earlier run's id and the same ``batch_id``
    replaces what that wrote.  The staged table is removed after the writes
    unless ``keep_stage``.  Without ``sinks`` it stays and the routed frames
    are returned for the caller to use.  ``partitions``: deal the input over
    so many tasks first (see ``spread``).  ``manifest`` publishes the tables
    together, with the counts, once all are written.
    """
    spark: SparkSession = env.sparkSession
    run_id = checked_run_id(run_id or new_run_id())
    path = stage_path or fresh_path(spark, "stage")
    observed = Observation("qc_batch")
    metric_rules = rules if column_metrics else ()
    annotated = route_counts(
        annotate(spread(env, partitions), rules, allow_unexpected=allow_unexpected),
        observed,
        metric_rules,
    )
    staged = stage(annotated, path)
    metrics = {k: int(v) for k, v in observed.get.items()}
    outputs = route(staged, rules)
    if not sinks:
        return BatchResult(staged, outputs, metrics, run_id)
    write_routed(
        outputs, sinks, batch_id, run_id, concurrent=concurrent_writes, manifest=manifest, counts=metrics
    )
    if keep_stage:
        return BatchResult(staged, outputs, metrics, run_id)
    remove_path(spark, path)
    return BatchResult(None, {}, metrics, run_id)


def route_counts(annotated: DataFrame, observation, rules: Sequence[Rule] = ()) -> DataFrame:
    """Count records per route (and failures per ruled column) as a side
    effect of the next action on the frame (``DataFrame.observe``): no extra
    pass over the data."""
    return annotated.observe(observation, *route_count_columns(rules))


def drop_run_columns(df: DataFrame) -> DataFrame:
    """Remove per-run stamps (load, check and log times; run and batch ids) so a
    result can be compared across runs."""
    volatile = {"load_timestamp", "checked_at", "log_time", "batch_id", "run_id"}
    return df.select(*[F.col(c) for c in df.columns if c not in volatile])
