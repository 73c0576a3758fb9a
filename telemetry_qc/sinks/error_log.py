"""The consumer error log: one row per failed batch, or per record that a
store refused."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import ERROR_LOG_SCHEMA


def error_row(
    spark: SparkSession,
    error_message: str,
    batch_id: int,
    target_table: str,
    log_time: Column | None = None,
) -> DataFrame:
    """One-row frame in the log's column order.

    Built from an explicit DDL schema (no inference) and stamped with the
    log time (``current_timestamp()`` unless given).
    """
    log_time = log_time if log_time is not None else F.current_timestamp()
    return error_rows(spark, [(error_message, target_table)], batch_id, log_time)


def error_rows(
    spark: SparkSession, errors: list[tuple[str, str]], batch_id: int, log_time: Column | None = None
) -> DataFrame:
    """A row for each (message, table) of one batch."""
    log_time = log_time if log_time is not None else F.current_timestamp()
    base = spark.createDataFrame(
        [(message, table, int(batch_id)) for message, table in errors],
        "error_message STRING, target_table STRING, batch_id BIGINT",
    )
    stamped = base.withColumn("log_time", log_time.cast("timestamp_ntz"))
    return stamped.select(*ERROR_LOG_SCHEMA.names)


def log_error(
    sink, spark: SparkSession, error_message: str, batch_id: int, target_table: str, run_id: str
) -> None:
    """Write the log's row of one failed batch."""
    sink.write(error_row(spark, error_message, batch_id, target_table), batch_id, run_id)
