"""Batches published as one, and compaction of what was published.

The tables of a batch are written one after the other.  A ``Manifest`` has a
row for every batch whose tables are all written: it is written last, as one
file, and withdrawn before a batch is written again.  ``Manifest.read`` gives
the rows of published batches only, so that no reader sees a batch in one table
and not in another.

A partition value (a day) that many batches added to can be rewritten into few
files.  The new files belong to a run of their own; one manifest row shows
them and hides what they replace, so that the switch is one file as well.  The
replaced files stay, for readers that began before, until ``vacuum``.

A reader lists the manifest first and the table's files after it: a batch
published in between is not seen, one that is seen is whole.
"""

from __future__ import annotations

import re
import uuid
from dataclasses import dataclass, replace
from datetime import datetime
from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..paths import remove_path
from ..schemas import MANIFEST_SCHEMA
from .tables import ParquetTableSink

_PLAIN = re.compile(r"[A-Za-z0-9._-]+")


@dataclass
class Manifest:
    """A parquet table under ``path``, one folder per run and batch."""

    path: str

    @property
    def _table(self) -> ParquetTableSink:
        return ParquetTableSink("batch_manifest", self.path, schema=MANIFEST_SCHEMA)

    def withdraw(self, spark: SparkSession, batch_id: int, run_id: str) -> None:
        """Hide a batch that is about to be written (again)."""
        remove_path(spark, self._table.batch_path(batch_id, run_id))

    def publish(
        self,
        spark: SparkSession,
        batch_id: int,
        run_id: str,
        tables: Sequence[str],
        counts: Mapping[str, int] | None = None,
    ) -> None:
        """Show a batch whose ``tables`` are all written; ``counts`` are its
        records per route."""
        row = (list(tables), dict(counts or {}))
        frame = spark.createDataFrame([row], "tables array<string>, counts map<string,bigint>")
        self._write(frame.withColumn("table_name", F.lit(None).cast("string")), batch_id, run_id)

    def _write(self, frame: DataFrame, batch_id: int, run_id: str) -> None:
        absent = [f for f in MANIFEST_SCHEMA if f.name not in (*frame.columns, "published_at")]
        frame = frame.withColumns({f.name: F.lit(None).cast(f.dataType) for f in absent})
        frame = frame.withColumn("published_at", F.current_timestamp().cast("timestamp_ntz"))
        self._table.write(frame.select(*MANIFEST_SCHEMA.names).coalesce(1), batch_id, run_id)

    def entries(self, spark: SparkSession) -> DataFrame:
        return self._table.read(spark)

    def counts(self, spark: SparkSession) -> DataFrame:
        """(run_id, batch_id, route, records) of the published batches."""
        return self.entries(spark).select("run_id", "batch_id", F.explode("counts").alias("route", "records"))

    def read(self, spark: SparkSession, sink: ParquetTableSink, file_column: str | None = None) -> DataFrame:
        """The rows of ``sink`` that are published.  The joins are on its
        folders' names, so that files of other batches are not opened.
        ``file_column`` adds the path of each row's file."""
        entries = self.entries(spark).where(F.array_contains("tables", sink.name))
        rows = sink.read(spark)
        if file_column:
            rows = rows.withColumn(file_column, F.col("_metadata.file_path"))
        rows = rows.join(entries.select("run_id", "batch_id"), ["run_id", "batch_id"], "left_semi")
        if not sink.partition_by:
            return rows
        gone = entries.where(F.col("table_name") == sink.name).select(
            F.explode("replaced").alias("gone"), F.col("partition_value").alias("gone_value")
        )
        same = (
            (rows["run_id"] == F.col("gone.run_id"))
            & (rows["batch_id"] == F.col("gone.batch_id"))
            & _text(rows[sink.partition_by[0]]).eqNullSafe(F.col("gone_value"))
        )
        return rows.join(gone, same, "left_anti")

    def compact(self, spark: SparkSession, sink: ParquetTableSink, value) -> str | None:
        """Rewrite the published rows whose first partition column is
        ``value`` into few files; returns the id of the run that holds them,
        or None where there are no rows.

        Batches published meanwhile are left for the next time.  Not for two
        writers at once on one table and value.
        """
        column = sink.partition_by[0]
        rows = self.read(spark, sink).where(F.col(column).eqNullSafe(F.lit(value)))
        replaced = rows.groupBy().agg(
            F.collect_set(F.struct("run_id", "batch_id")).alias("replaced"), F.max(_text(F.col(column))).alias("partition_value")
        )
        # One row that names batches; kept, as the files listed are these.
        kept = replaced.first()
        if not kept["replaced"]:
            return None
        run_id = f"compact-{uuid.uuid4().hex}"
        replace(sink, rebalance=True).write(rows.drop("run_id", "batch_id"), 0, run_id)
        frame = spark.createDataFrame(
            [([sink.name], sink.name, kept["partition_value"], [tuple(r) for r in kept["replaced"]])],
            "tables array<string>, table_name string, partition_value string, "
            "replaced array<struct<run_id:string,batch_id:bigint>>",
        )
        self._write(frame, 0, run_id)
        return run_id

    def vacuum(self, spark: SparkSession, sink: ParquetTableSink, before: datetime | None = None) -> int:
        """Delete the files that compactions published before ``before``
        (default: all) have replaced; returns the number of folders.  Readers
        that began before those compactions must have ended."""
        column = sink.partition_by[0]
        done = self.entries(spark).where(F.col("table_name") == sink.name)
        if before is not None:
            done = done.where(F.col("published_at") < F.lit(before))
        found = 0
        # Folder names, one batch and value each.
        for row in done.select(F.explode("replaced").alias("r"), "partition_value").toLocalIterator():
            value = row["partition_value"] or "__HIVE_DEFAULT_PARTITION__"
            if not _PLAIN.fullmatch(value):
                raise ValueError(f"no plain folder name: {value!r}")
            remove_path(spark, f"{sink.batch_path(row['r']['batch_id'], row['r']['run_id'])}/{column}={value}")
            found += 1
        return found


def _text(c: Column) -> Column:
    return c.cast("string")
