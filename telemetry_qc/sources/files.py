"""File-backed envelope source: the same columns as Kafka delivers, read from
parquet files (landed topic exports, or test input)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..schemas import ENVELOPE_SCHEMA


def read_envelope_stream(
    spark: SparkSession,
    directory: str,
    max_files_per_trigger: int | None = None,
    glob: str | None = None,
) -> DataFrame:
    """Streaming envelope over a directory of parquet files.

    The schema is declared, never inferred.  ``max_files_per_trigger`` bounds
    a micro-batch.  Pass a directory (with ``glob`` to pick files): a single
    file path is not accepted by the file stream source.
    """
    r = spark.readStream.schema(ENVELOPE_SCHEMA).format("parquet")
    if max_files_per_trigger is not None:
        r = r.option("maxFilesPerTrigger", str(int(max_files_per_trigger)))
    if glob is not None:
        r = r.option("pathGlobFilter", glob)
    return r.load(directory)


def read_envelope(spark: SparkSession, path: str) -> DataFrame:
    """Batch read of landed envelope files."""
    return spark.read.schema(ENVELOPE_SCHEMA).parquet(path)


def land(df: DataFrame, path: str, files: int | None = None, order_by: str | None = None) -> str:
    """Write a frame as parquet, optionally as ``files`` files (one
    micro-batch each when read with ``max_files_per_trigger=1``); with
    ``order_by`` each file holds one range of that column, as a topic
    partition holds one range of offsets."""
    out = df
    if files and order_by:
        out = df.repartitionByRange(files, order_by)
    elif files:
        out = df.repartition(files)
    out.write.mode("overwrite").parquet(path)
    return path
