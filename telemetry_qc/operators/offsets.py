"""Which offsets of a topic's partitions are there: interval sets by gaps and
islands.

Offsets are cut into buckets of ``WIDTH``; islands are found within a bucket,
so that a partition with most of a topic's records is worked on by as many
tasks as it has buckets.  Only the first and the last island of a bucket can
touch one of the next bucket: these, two a bucket, are joined in a second step.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Offsets of a bucket.
WIDTH = 1 << 20

KEYS = ("topic_name", "kafka_partition")


def _islands(df: DataFrame, *keys: str) -> DataFrame:
    """Intervals (first, last, records) that overlap or touch become one."""
    order = Window.partitionBy(*keys).orderBy("first", "last")
    reach = F.max("last").over(order.rowsBetween(Window.unboundedPreceding, -1))
    new = F.when(F.col("first") > F.coalesce(reach + 1, F.col("first") - 1), 1).otherwise(0)
    numbered = df.withColumn("_new", new).withColumn("_island", F.sum("_new").over(order))
    found = numbered.groupBy(*keys, "_island").agg(
        F.min("first").alias("first"), F.max("last").alias("last"), F.sum("records").alias("records")
    )
    return found.drop("_island")


def merge_intervals(intervals: DataFrame, width: int = WIDTH) -> DataFrame:
    """Interval sets put together: topic_name, kafka_partition, first, last,
    records, with no two rows that overlap or touch.  ``records`` of the input
    are added up; an interval that is stated again adds records, no offsets.

    An interval over several buckets is cut at their bounds, its records
    counted with its first part."""
    same = intervals.groupBy(*KEYS, "first", "last").agg(F.sum("records").alias("records"))
    bucket = F.floor(F.col("first") / width)
    cut = same.withColumn("bucket", F.explode(F.sequence(bucket, F.floor(F.col("last") / width))))
    here = F.col("bucket") * width
    cut = cut.select(
        *KEYS,
        "bucket",
        F.greatest("first", here).alias("first"),
        F.least("last", here + (width - 1)).alias("last"),
        F.when(F.col("first") >= here, F.col("records")).otherwise(0).alias("records"),
    )
    parts = _islands(cut, *KEYS, "bucket")
    # An island that reaches a bound of its bucket may go on beyond it.
    start, end = F.col("bucket") * width, (F.col("bucket") + 1) * width - 1
    parts = parts.withColumn("_open", (F.col("first") == start) | (F.col("last") == end)).drop("bucket")
    joined = _islands(parts.where("_open").drop("_open"), *KEYS)
    return parts.where(~F.col("_open")).drop("_open").unionByName(joined)


def offset_intervals(records: DataFrame, width: int = WIDTH) -> DataFrame:
    """The interval set of records (topic_name, kafka_partition,
    kafka_offset); records without an offset are not in it."""
    single = records.where("kafka_offset is not null").groupBy(*KEYS, "kafka_offset").agg(F.count(F.lit(1)).alias("records"))
    return merge_intervals(
        single.select(*KEYS, F.col("kafka_offset").alias("first"), F.col("kafka_offset").alias("last"), "records"), width
    )


def offset_account(intervals: DataFrame) -> DataFrame:
    """Per topic partition: first and last offset, records, gaps (runs of
    absent offsets between them), absent offsets and repeats (records beyond
    one for each offset)."""
    there = F.sum(F.col("last") - F.col("first") + 1)
    found = intervals.groupBy(*KEYS).agg(
        F.min("first").alias("first_offset"),
        F.max("last").alias("last_offset"),
        F.sum("records").alias("records"),
        (F.count(F.lit(1)) - 1).alias("gaps"),
        there.alias("there"),
    )
    return found.select(
        *KEYS,
        "first_offset",
        "last_offset",
        "records",
        "gaps",
        (F.col("last_offset") - F.col("first_offset") + 1 - F.col("there")).alias("absent"),
        (F.col("records") - F.col("there")).alias("repeats"),
    )


def table_offsets(tables: dict[str, DataFrame], topic: str) -> DataFrame:
    """The records of the routed tables, by their coordinates: every record
    is in one of the clean, failed and corrupt tables.  Tables without a topic
    column hold ``topic``."""
    out = None
    for name in ("device_data", "qc_failed_table", "corrupt_records"):
        df = tables[name]
        topic_name = F.col("topic_name") if "topic_name" in df.columns else F.lit(topic)
        part = df.select(topic_name.alias("topic_name"), "kafka_partition", "kafka_offset")
        out = part if out is None else out.unionByName(part)
    return out
