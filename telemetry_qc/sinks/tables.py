"""Table sinks.  Every sink writes one batch's frame and may be asked to write
the same batch again after a failure (``foreachBatch`` is at-least-once), so
each one states how a replay is absorbed."""

from __future__ import annotations

import re
import uuid
from dataclasses import dataclass, field
from typing import Protocol, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from ..operators.contract import schema_diff
from ..paths import path_exists, remove_path
from ..schemas import SINK_SCHEMAS


class SinkSchemaError(ValueError):
    pass


def check_frame(df: DataFrame, expected: StructType, table: str) -> DataFrame:
    """Refuse to write a frame whose columns differ from the table definition
    (names and types; order and nullability ignored).  Metadata only."""
    problems = schema_diff(df, expected)
    if problems:
        raise SinkSchemaError(f"{table}: " + "; ".join(problems))
    return df


_RUN_ID = re.compile(r"[A-Za-z][A-Za-z0-9._-]*")


def checked_run_id(run_id: str) -> str:
    """A run id usable as a partition value: it starts with a letter, so no
    reader takes it for a number or a date."""
    if not _RUN_ID.fullmatch(run_id):
        raise ValueError(f"run_id must start with a letter and hold letters, digits, . _ - only: {run_id!r}")
    return run_id


def new_run_id() -> str:
    return f"run-{uuid.uuid4().hex}"


class Sink(Protocol):
    """``run_id`` names the run a batch belongs to: the id of the streaming
    query (kept in its checkpoint), or of one batch run.  Batch ids start at
    0 in every run, so the two together identify a batch.

    ``clear`` and ``append`` are needed only where a batch may be written in
    parts (policy ``isolate``): clear what a failed write of the batch has
    left, then append each part."""

    name: str

    def write(self, df: DataFrame, batch_id: int, run_id: str) -> None: ...


RUN_FIELDS = [StructField("run_id", StringType()), StructField("batch_id", LongType())]


def read_known(spark: SparkSession, path: str, schema: StructType | None, folders: list[StructField]) -> DataFrame:
    """The table at ``path`` by its known schema, with the columns its
    ``folders`` name: empty where nothing, or no row, was written yet.
    Without a schema Spark infers one from the files, and there must be some."""
    if schema is None:
        return spark.read.parquet(path)
    named = [f.name for f in folders]
    whole = StructType([f for f in schema if f.name not in named] + folders)
    if not path_exists(spark, path):
        return spark.createDataFrame([], whole)
    return spark.read.schema(whole).parquet(path)


@dataclass
class ParquetTableSink:
    """A parquet table under ``path``, one directory per run and batch.

    Batch N of run R is written with mode overwrite to
    ``path/run_id=R/batch_id=N``: a replayed batch (same run, same id, same
    records) replaces its earlier, possibly partial, output, so replays never
    duplicate rows; other runs append.  ``partition_by`` adds Hive-style
    partitions inside each batch (e.g. ``trip_start_date``); readers of
    ``path`` see ``run_id``, ``batch_id`` and those columns as partition
    columns and get partition pruning on them.  The overwrite is static
    whatever the session says: a replay that has no rows for a partition must
    not keep the earlier ones.  ``schema`` is the table's, without run and
    batch (default: the definition of that ``name``).
    """

    name: str
    path: str
    partition_by: Sequence[str] = field(default_factory=tuple)
    options: dict[str, str] = field(default_factory=dict)
    # Cluster rows by the partition columns before writing (REBALANCE hint),
    # so each partition folder gets a few full files instead of one small
    # file per task; AQE splits a hot value (one day with a third of all
    # rows) over several tasks and merges small ones.  Costs one shuffle.
    rebalance: bool = False
    schema: StructType | None = None

    def __post_init__(self) -> None:
        if self.schema is None:
            self.schema = SINK_SCHEMAS.get(self.name)

    def batch_path(self, batch_id: int, run_id: str) -> str:
        return f"{self.path}/run_id={checked_run_id(run_id)}/batch_id={int(batch_id)}"

    def write(self, df: DataFrame, batch_id: int, run_id: str) -> None:
        self._write(df, batch_id, run_id, "overwrite")

    def append(self, df: DataFrame, batch_id: int, run_id: str) -> None:
        """Add a part of a batch to what is there of it."""
        self._write(df, batch_id, run_id, "append")

    def clear(self, spark: SparkSession, batch_id: int, run_id: str) -> None:
        remove_path(spark, self.batch_path(batch_id, run_id))

    def _write(self, df: DataFrame, batch_id: int, run_id: str, mode: str) -> None:
        if self.rebalance and self.partition_by:
            df = df.hint("rebalance", *self.partition_by)
        w = df.write.mode(mode).option("partitionOverwriteMode", "static").options(**self.options)
        if self.partition_by:
            w = w.partitionBy(*self.partition_by)
        w.parquet(self.batch_path(batch_id, run_id))

    def read(self, spark: SparkSession) -> DataFrame:
        folders = [f for n in self.partition_by for f in self.schema or () if f.name == n]
        return read_known(spark, self.path, self.schema, RUN_FIELDS + folders)


@dataclass
class ErrorLogSink:
    """The error log: one folder per run and batch, so that a batch that is
    run again replaces its rows (the driver may be lost between the log's row
    and the batch's commit)."""

    name: str
    path: str

    def write(self, df: DataFrame, batch_id: int, run_id: str) -> None:
        path = f"{self.path}/run_id={checked_run_id(run_id)}/logged_batch={int(batch_id)}"
        df.coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)

    def read(self, spark: SparkSession) -> DataFrame:
        schema = SINK_SCHEMAS["consumer_error_log"]
        folders = [StructField("run_id", StringType()), StructField("logged_batch", LongType())]
        return read_known(spark, self.path, schema, folders).select(*schema.names)


@dataclass
class CatalogTableSink:
    """A catalog table partitioned by ``run_id`` and ``batch_id`` (plus
    ``partition_by``).

    The first batch creates the table (data at ``path`` when given); later
    batches are inserted with ``INSERT OVERWRITE ... PARTITION (run_id = R,
    batch_id = N, ...)`` after that batch's partitions were dropped, in the
    catalog and on disk.  A replayed batch therefore replaces all of its own
    rows, also those of a partition value it has no more rows for, whatever
    the session's overwrite mode.
    """

    name: str
    table: str
    partition_by: Sequence[str] = field(default_factory=tuple)
    format: str = "parquet"
    path: str | None = None

    def write(self, df: DataFrame, batch_id: int, run_id: str) -> None:
        spark = df.sparkSession
        framed = df.withColumns(
            {"run_id": F.lit(checked_run_id(run_id)), "batch_id": F.lit(int(batch_id)).cast("bigint")}
        )
        parts = ["run_id", "batch_id", *self.partition_by]
        if not spark.catalog.tableExists(self.table):
            w = framed.write.format(self.format).partitionBy(*parts)
            if self.path:
                w = w.option("path", self.path)
            w.saveAsTable(self.table)
            return
        self.clear(spark, batch_id, run_id)
        self._insert(df, batch_id, run_id, "OVERWRITE TABLE")

    def append(self, df: DataFrame, batch_id: int, run_id: str) -> None:
        """Add a part of a batch to what is there of it."""
        if df.sparkSession.catalog.tableExists(self.table):
            self._insert(df, batch_id, run_id, "INTO TABLE")
        else:
            self.write(df, batch_id, run_id)

    def clear(self, spark: SparkSession, batch_id: int, run_id: str) -> None:
        if not spark.catalog.tableExists(self.table):
            return
        run_id, batch_id = checked_run_id(run_id), int(batch_id)
        spark.sql(f"ALTER TABLE {self.table} DROP IF EXISTS PARTITION (run_id = '{run_id}', batch_id = {batch_id})")
        # An external table keeps the files of a partition it drops.
        detail = spark.sql(f"DESCRIBE TABLE EXTENDED {self.table}").where("col_name = 'Location'").first()
        remove_path(spark, f"{detail['data_type']}/run_id={run_id}/batch_id={batch_id}")

    def _insert(self, df: DataFrame, batch_id: int, run_id: str, how: str) -> None:
        spark = df.sparkSession
        parts = ["run_id", "batch_id", *self.partition_by]
        data_cols = [c for c in spark.table(self.table).columns if c not in parts]
        view = f"_batch_{uuid.uuid4().hex[:12]}"
        df.createOrReplaceTempView(view)
        try:
            spec = ", ".join(
                [f"run_id = '{run_id}'", f"batch_id = {int(batch_id)}", *self.partition_by]
            )
            cols = ", ".join(f"`{c}`" for c in [*data_cols, *self.partition_by])
            spark.sql(
                f"INSERT {how} {self.table} PARTITION ({spec}) "
                f"SELECT {cols} FROM {view}"
            )
        finally:
            spark.catalog.dropTempView(view)

    def read(self, spark: SparkSession) -> DataFrame:
        return spark.table(self.table)
