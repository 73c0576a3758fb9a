"""Kafka source and publish frame.

The Kafka connector jar must be on the classpath of the caller's session;
this module never configures the session.  All connection, security and
delivery settings come from the caller as option dicts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.json_text import payload_json
from ..schemas import PAYLOAD_SCHEMA


def kafka_source_options(
    bootstrap_servers: str,
    topic: str,
    starting_offsets: str = "earliest",
    max_offsets_per_trigger: int | None = None,
    min_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> dict[str, str]:
    """Options of a one-topic subscription.

    ``startingOffsets`` applies to the first start only; afterwards the
    checkpoint decides.  ``maxOffsetsPerTrigger`` bounds a micro-batch (and so
    the memory a batch may pin); ``minPartitions`` splits large topic
    partitions into more read tasks.
    """
    opts = {
        "kafka.bootstrap.servers": bootstrap_servers,
        "subscribe": topic,
        "startingOffsets": starting_offsets,
    }
    if max_offsets_per_trigger is not None:
        opts["maxOffsetsPerTrigger"] = str(int(max_offsets_per_trigger))
    if min_partitions is not None:
        opts["minPartitions"] = str(int(min_partitions))
    opts.update(extra or {})
    return opts


def read_kafka_stream(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    """Streaming envelope: key, value, topic, partition, offset, timestamp."""
    return spark.readStream.format("kafka").options(**options).load()


def read_kafka_batch(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    """The same envelope as a bounded batch read (offset range replays)."""
    return spark.read.format("kafka").options(**options).load()


# Producer delivery settings of the original publisher, expressed as Kafka
# client options of Spark's Kafka sink.
# --- fixed values: delivery settings ---
DEFAULT_DELIVERY = {
    "kafka.acks": "all",
    "kafka.enable.idempotence": "true",
    "kafka.retries": "1",
    "kafka.linger.ms": "10",
    "kafka.batch.size": "16384",
    "kafka.compression.type": "gzip",
    "kafka.request.timeout.ms": "5000",
    "kafka.delivery.timeout.ms": "10000",
}
# --- end of fixed values ---


def publish_frame(
    df: DataFrame,
    key_column: str = "car_id",
    schema: StructType = PAYLOAD_SCHEMA,
    topic: str | None = None,
) -> DataFrame:
    """Rows -> (``key``, ``value``[, ``topic``]) ready for the Kafka sink.

    Key is the car id, so one car's records land in one topic partition; value
    is the payload as JSON text.  A projection: the rows stay in the order
    they have (see ``in_key_order``).
    """
    cols = [
        F.col(key_column).cast("string").alias("key"),
        payload_json(schema).alias("value"),
    ]
    if topic is not None:
        cols.append(F.lit(topic).alias("topic"))
    return df.select(*cols)


def in_key_order(
    df: DataFrame,
    key_column: str = "car_id",
    order_by: tuple[str, ...] = ("kafka_partition", "kafka_offset"),
    tasks: int | None = None,
) -> DataFrame:
    """Rows dealt by key, each task's sorted by key and source coordinates: a
    key's records are written by one task, in the order they came in.

    The sort spills and the task streams, so a car with a third of all records
    costs time in its task, not memory; its records end in one topic
    partition, one log, in any case.
    """
    dealt = df.repartition(tasks, key_column) if tasks else df.repartition(key_column)
    return dealt.sortWithinPartitions(key_column, *order_by)


def publish(
    df: DataFrame,
    bootstrap_servers: str,
    topic: str,
    delivery: dict[str, str] | None = None,
    tasks: int | None = None,
) -> None:
    """Batch write of a publish frame to a topic, each car's records in their
    order (``in_key_order``).  The delivery settings keep a task's order: an
    idempotent producer's retries don't overtake."""
    (
        publish_frame(in_key_order(df, tasks=tasks))
        .write.format("kafka")
        .option("kafka.bootstrap.servers", bootstrap_servers)
        .option("topic", topic)
        .options(**(delivery if delivery is not None else DEFAULT_DELIVERY))
        .save()
    )
