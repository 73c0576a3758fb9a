"""The vehicle roll-up as a running view over a stream.

Every micro-batch adds its partial sums per vehicle and event-time window to a
table; the view adds them up.  A batch's watermark is the latest event time of
the batches before it in its run, less a delay: a row whose window ended by
then is late and is summed apart, so that a closed window's figures stay as
they were and no row is lost.  (Spark's own windowed aggregation drops late rows.)

The state is the table: a batch that is run again has the same watermark and
replaces its own part, a lost executor costs its tasks only, and the sums of a
batch ride on the rows staged for its other outputs, with one partial
aggregation.  The state grows by vehicles x windows in a batch, not by records.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, LongType, StringType, StructField, StructType, TimestampNTZType

from ..operators.qc import DEFAULT_RULES, Rule
from ..operators.rollup import rollup_sums
from ..plans.batch import schema_valid
from ..sinks.tables import ParquetTableSink

SUMS = ("rows_checked", "rows_failed", "cells_failed")

PARTS_SCHEMA = StructType(
    [
        StructField("car_id", StringType()),
        StructField("window_start", TimestampNTZType()),
        StructField("window_end", TimestampNTZType()),
        StructField("late", BooleanType()),
        *(StructField(n, LongType()) for n in SUMS),
        StructField("latest", TimestampNTZType()),
    ]
)


@dataclass
class VehicleRollup:
    """Roll-up by vehicle and window of ``event_timestamp``, kept under
    ``path``.  Rows without an event time have a window of their own, which
    never ends."""

    path: str
    window: str = "1 hour"
    delay: str = "1 hour"
    rules: Sequence[Rule] = field(default_factory=lambda: DEFAULT_RULES)

    name = "vehicle_rollup"

    @property
    def _table(self) -> ParquetTableSink:
        return ParquetTableSink(self.name, self.path, schema=PARTS_SCHEMA)

    def watermark(self, spark: SparkSession, run_id: str, batch_id: int | None = None):
        """As a batch of the run finds it (default: the next one); None
        before the first event time."""
        rows = self._table.read(spark).where(F.col("run_id") == run_id)
        if batch_id is not None:
            rows = rows.where(F.col("batch_id") < batch_id)
        latest = rows.agg(F.max("latest").alias("latest"))
        return latest.select((F.col("latest") - F.expr(f"INTERVAL {self.delay}")).alias("w")).first()["w"]

    def write(self, annotated: DataFrame, batch_id: int, run_id: str) -> None:
        """Add a batch's sums; ``annotated`` is its staged rows."""
        mark = self.watermark(annotated.sparkSession, run_id, batch_id)
        late = F.lit(False)
        if mark is not None:
            ended = F.col("window_end") <= F.lit(mark.isoformat(sep=" ")).cast("timestamp_ntz")
            late = F.coalesce(ended, F.lit(False))
        rows = self._windowed(schema_valid(annotated)).withColumn("late", late)
        parts = rows.groupBy("car_id", "window_start", "window_end", "late").agg(
            *rollup_sums(rows, self.rules), F.max("event_timestamp").alias("latest")
        )
        self._table.write(parts.select(*PARTS_SCHEMA.names), batch_id, run_id)

    def _windowed(self, rows: DataFrame) -> DataFrame:
        # window() leaves out rows without a time: they are put back.
        there = rows.withColumn("_w", F.window("event_timestamp", self.window))
        none = F.lit(None).cast("timestamp_ntz")
        bounds = {"window_start": F.col("_w.start"), "window_end": F.col("_w.end")}
        there = there.withColumns({n: c.cast("timestamp_ntz") for n, c in bounds.items()}).drop("_w")
        return there.unionByName(rows.where("event_timestamp is null").withColumns({n: none for n in bounds}))

    def read(self, spark: SparkSession, manifest=None) -> DataFrame:
        """car_id, window_start, rows_checked, rows_failed, cells_failed and
        late_rows: the sums of rows in time, and the number of late ones."""
        parts = self._table.read(spark) if manifest is None else manifest.read(spark, self._table)
        in_time = lambda n: F.coalesce(F.sum(F.when(~F.col("late"), F.col(n))), F.lit(0)).alias(n)
        late = F.coalesce(F.sum(F.when(F.col("late"), F.col("rows_checked"))), F.lit(0)).alias("late_rows")
        return parts.groupBy("car_id", "window_start").agg(*(in_time(n) for n in SUMS), late)

    def totals(self, spark: SparkSession, manifest=None) -> DataFrame:
        """The batch roll-up of all rows, late ones included."""
        parts = self._table.read(spark) if manifest is None else manifest.read(spark, self._table)
        return parts.groupBy("car_id").agg(*(F.sum(n).alias(n) for n in SUMS))
