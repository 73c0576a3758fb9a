"""JDBC table sink (append), as the relational store of the original design.

The caller supplies url, driver and credentials; nothing is hard-coded.
Throughput options (``batchsize``, ``numPartitions``, ``isolationLevel``)
pass straight through to Spark's JDBC writer.  Append is at-least-once: a
replayed micro-batch appends its rows again.  Either the target table holds a
unique key, or readers de-duplicate (``dedupe_records``); the key of each table
is ``TABLE_KEYS``.  Tables without a topic column hold one topic's records: a
second topic needs tables of its own.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from ..schemas import TABLE_KEYS


# Write defaults sized for a large cluster writing into one database: Spark
# coalesces to ``numPartitions`` before writing, so at most that many
# connections are open at once, and ``batchsize`` rows go per round trip.
# Callers override either through ``options``.  The frame written should be a
# materialised one (staged, or cached and counted, as the stream runner has
# it): whatever is still to be computed would run in so few tasks.
WRITE_DEFAULTS = {"numPartitions": "64", "batchsize": "10000"}


@dataclass
class JdbcSink:
    name: str
    url: str
    table: str
    options: dict[str, str] = field(default_factory=dict)
    mode: str = "append"

    def writer_options(self) -> dict[str, str]:
        return {"url": self.url, "dbtable": self.table, **WRITE_DEFAULTS, **self.options}

    def write(self, df: DataFrame, batch_id: int, run_id: str) -> None:
        df.write.format("jdbc").mode(self.mode).options(**self.writer_options()).save()

    def append(self, df: DataFrame, batch_id: int, run_id: str) -> None:
        self.write(df, batch_id, run_id)

    def clear(self, spark: SparkSession, batch_id: int, run_id: str) -> None:
        """Nothing: an append has no way back, and rows that a failed write
        left in the table are told apart by their key."""

    def read(self, spark: SparkSession, **read_options: str) -> DataFrame:
        """Table scan (``SELECT * FROM table``); pass ``partitionColumn``,
        ``lowerBound``, ``upperBound``, ``numPartitions`` for parallel reads."""
        return (
            spark.read.format("jdbc")
            .options(url=self.url, dbtable=self.table, **self.options, **read_options)
            .load()
        )


def dedupe_records(df: DataFrame, table: str) -> DataFrame:
    """Drop replayed copies: keep one row per key of ``table``
    (``TABLE_KEYS``).  A frame without one of the key's columns is refused,
    since a shorter key would merge different rows.

    ``dropDuplicates`` shuffles whole rows on the key; keys are unique but for
    replays, so none is hot.
    """
    key = TABLE_KEYS[table]
    missing = [k for k in key if k not in df.columns]
    if missing:
        raise ValueError(f"{table}: no column {', '.join(missing)} to tell rows apart")
    return df.dropDuplicates(list(key))
