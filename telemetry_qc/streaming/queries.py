"""Registered streaming queries: the envelope of ``events`` landed as parquet
files (offset ranges in order) and consumed as a file stream in micro-batches
of one file per core each, of bounded size."""

from __future__ import annotations

import threading
from dataclasses import dataclass
from datetime import datetime
from functools import reduce

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from ..fixtures.events_envelope import TOPIC
from ..fixtures.faults import FailOnce, RefuseRecords
from ..operators.offsets import merge_intervals, offset_account, offset_intervals, table_offsets
from ..paths import fresh_path, path_version
from ..plans.oracle import ORACLE_SQL, cells_failed_sql, with_records
from ..plans.process import drop_run_columns
from ..plans.queries import envelope
from ..schemas import CORRUPT_RECORDS_SCHEMA, DEVICE_DATA_SCHEMA
from ..sinks.published import Manifest
from ..sinks.routing import SINK_ORDER
from ..sinks.tables import ErrorLogSink, ParquetTableSink
from ..sources.files import land, read_envelope_stream
from .rollup import VehicleRollup
from .runner import FAIL, ISOLATE, LOG, StreamConfig, run_stream

#: Batches a small input is read in; a larger one has more, of at most
#: BATCH_ROWS records in each of a batch's files, one a core.
N_BATCHES = 4
BATCH_ROWS = 250_000
FAILING_BATCHES = (1, 2)
FAILING_BATCH = 1
FAILING_SINK = "device_data"

INTERVALS_SCHEMA = StructType(
    [
        StructField("topic_name", StringType()),
        StructField("kafka_partition", IntegerType()),
        StructField("first", LongType()),
        StructField("last", LongType()),
        StructField("records", LongType()),
    ]
)
COUNTS = ("records", "corrupt", "clean", "failed")
COUNTS_SCHEMA = StructType([StructField(n, LongType()) for n in COUNTS])


@dataclass
class StreamRun:
    sinks: dict
    error_log: ErrorLogSink
    counts: ParquetTableSink
    attempts: int
    progress: list
    began: datetime
    ended: datetime
    manifest: Manifest
    offsets: ParquetTableSink
    rollup: VehicleRollup
    base: str


def wall_clock_now(spark: SparkSession) -> datetime:
    """The session's wall clock, as the log has it."""
    return spark.sql("SELECT CAST(current_timestamp() AS timestamp_ntz) AS t").first()["t"]


def files_per_batch(spark: SparkSession) -> int:
    """One file per core in each micro-batch: a batch is read by as many
    tasks as the cluster runs at once (the file-source analogue of Kafka's
    ``minPartitions``), with no shuffle."""
    return max(1, spark.sparkContext.defaultParallelism)


def land_envelope(spark: SparkSession, sf_dir: str, batches: int | None = None) -> str:
    """The envelope as ``batches`` x ``files_per_batch`` parquet files, each
    holding one range of offsets; the number of batches follows the rows, so
    that a file is of bounded size.  A batch costs some seconds whatever its
    size, so a larger cluster has larger ones, and not more."""
    if batches is None:
        rows = spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet").count()
        batches = max(N_BATCHES, -(-rows // (BATCH_ROWS * files_per_batch(spark))))
    files = batches * files_per_batch(spark)
    return land(envelope(spark, sf_dir), fresh_path(spark, "envelope-files"), files, "offset")


def run_landed(
    spark: SparkSession,
    sf_dir: str,
    on_error: str = FAIL,
    fail_batches: tuple[int, ...] = (),
    column_metrics: bool = False,
    landed: str | None = None,
    base: str | None = None,
    materialize: str = "stage",
    wrap: dict | None = None,
    after_failure=None,
    concurrent: bool = True,
    max_refused: int = 8,
    extras: tuple[str, ...] = (),
) -> StreamRun:
    """Stream the landed envelope to parquet sinks (``availableNow``).

    ``landed`` reuses envelope files landed before (``land_envelope``),
    ``base`` the folder of the tables (the checkpoint is always a new one).
    With ``fail_batches`` the clean sink raises once on each of them.  Under
    policy ``fail`` the query stops; it is then restarted from the same
    checkpoint, which replays the failed batch.  ``wrap`` gives a function of
    a sink for some tables, ``after_failure`` is called with the run between
    the failure and the restart.  ``extras``: which of ``counts``,
    ``manifest``, ``offsets`` and ``rollup`` the batches write besides.
    """
    src = landed or land_envelope(spark, sf_dir)
    base = base or fresh_path(spark, "stream")
    sinks = {n: ParquetTableSink(n, f"{base}/{n}") for n in SINK_ORDER}
    sinks["device_data"] = ParquetTableSink(
        "device_data", f"{base}/device_data", ("trip_start_date",), rebalance=True
    )
    if fail_batches:
        sinks[FAILING_SINK] = FailOnce(sinks[FAILING_SINK], fail_batches)
    for table, wrapped in (wrap or {}).items():
        sinks[table] = wrapped(sinks[table])
    error_log = ErrorLogSink("consumer_error_log", f"{base}/consumer_error_log")
    counts = ParquetTableSink("batch_counts", fresh_path(spark, "batch-counts"), schema=COUNTS_SCHEMA)
    manifest = Manifest(f"{base}/manifest")
    offsets = ParquetTableSink("offset_intervals", f"{base}/offset_intervals", schema=INTERVALS_SCHEMA)
    rollup = VehicleRollup(f"{base}/vehicle_rollup", ROLLUP_WINDOW, ROLLUP_DELAY)
    more = {"counts": counts, "manifest": manifest, "offsets": offsets, "rollup": rollup}
    more = {name: more[name] for name in extras}
    config = StreamConfig(
        checkpoint_location=fresh_path(spark, "stream-checkpoint"),
        on_error=on_error,
        materialize=materialize,
        trigger={"availableNow": True},
        column_metrics=column_metrics,
        concurrent_writes=concurrent,
        max_refused=max_refused,
    )
    attempts, progress, began = 0, [], wall_clock_now(spark)

    def result() -> StreamRun:
        ended = wall_clock_now(spark)
        return StreamRun(
            sinks, error_log, counts, attempts, progress, began, ended, manifest, offsets, rollup, base
        )

    while True:
        attempts += 1
        source = read_envelope_stream(spark, src, max_files_per_trigger=files_per_batch(spark))
        query = run_stream(spark, source, sinks, config, error_log, **more)
        try:
            query.awaitTermination()
            progress += query.recentProgress
            break
        except StreamingQueryException:
            progress += query.recentProgress
            if attempts > len(fail_batches) and (after_failure is None or attempts > 1):
                raise
            if after_failure is not None:
                after_failure(result())
    return result()


_runs: dict[tuple, StreamRun] = {}
_lock = threading.Lock()


def _memo(spark: SparkSession, sf_dir: str, kind: str, **kw) -> StreamRun:
    where = sf_dir.rstrip("/")
    version = path_version(spark, f"{where}/events.parquet")
    key = (spark.sparkContext.applicationId, id(spark), where, version, kind)
    with _lock:
        if key not in _runs:
            _runs[key] = run_landed(spark, sf_dir, **kw)
        return _runs[key]


def _clean_table(run: StreamRun, spark: SparkSession) -> DataFrame:
    return drop_run_columns(run.sinks["device_data"].read(spark).select(*DEVICE_DATA_SCHEMA.names))


def q19_error_log(spark, sf_dir):
    run = _memo(spark, sf_dir, "log", on_error=LOG, fail_batches=FAILING_BATCHES)
    log = run.error_log.read(spark)
    return log.filter(F.col("batch_id") == FAILING_BATCH).select(
        "error_message", "target_table", "batch_id"
    )


def q21_stream_clean(spark, sf_dir):
    return _clean_table(_memo(spark, sf_dir, "clean", extras=("counts",)), spark)


def q22_stream_replay(spark, sf_dir):
    run = _memo(spark, sf_dir, "replay", on_error=FAIL, fail_batches=(FAILING_BATCH,))
    return _clean_table(run, spark)


def q23_error_log_scan(spark, sf_dir):
    """The log's rows beside what is left of the clean table: per failed
    batch its row, that it was stamped while the stream ran, and no clean
    record of the batch."""
    run = _memo(spark, sf_dir, "log", on_error=LOG, fail_batches=FAILING_BATCHES)
    log = run.error_log.read(spark)
    written = run.sinks[FAILING_SINK].read(spark).groupBy("batch_id").count()
    inside = F.col("log_time").between(F.lit(run.began), F.lit(run.ended))
    return log.join(written, "batch_id", "left").select(
        "error_message",
        "target_table",
        "batch_id",
        inside.alias("stamped_in_run"),
        F.coalesce("count", F.lit(0)).alias("clean_records"),
    )


def q31_stream_counts(spark, sf_dir):
    """Records per route, summed over the counts each micro-batch wrote."""
    run = _memo(spark, sf_dir, "clean", extras=("counts",))
    return run.counts.read(spark).agg(*(F.sum(n).alias(n) for n in COUNTS))


def q32_two_streams(spark, sf_dir):
    """Two streams with checkpoints of their own into the same tables, each
    over half of the records; one of the files between is empty, and the
    session's overwrite mode is left as it is."""
    env = envelope(spark, sf_dir)
    base = fresh_path(spark, "two-streams")
    for half in (0, 1):
        mine = env.where(F.col("offset") % 2 == half)
        landed = land(mine, fresh_path(spark, "envelope-half"), files_per_batch(spark), "offset")
        mine.limit(0).coalesce(1).write.mode("append").parquet(landed)
        run = run_landed(spark, sf_dir, landed=landed, base=base)
    return _clean_table(run, spark)


def q33_stream_batch_contract(spark, sf_dir):
    """A typed stream (``orders``) checked batch by batch: once against its
    own schema, once against a drifted one, where its rows go to the columns
    of ``corrupt_records`` as JSON text."""
    path = fresh_path(spark, "orders-files")
    orders = spark.read.parquet(f"{sf_dir.rstrip('/')}/orders.parquet")
    orders.write.parquet(path)
    drifted = StructType(
        [StructField(f.name, StringType()) if f.name == "o_totalprice" else f for f in orders.schema]
    )
    out = None
    for name, expected in (("matching", orders.schema), ("drifted", drifted)):
        base = fresh_path(spark, "orders-stream")
        sinks = {
            "device_data": ParquetTableSink("orders", f"{base}/orders", schema=orders.schema),
            "corrupt_records": ParquetTableSink("corrupt_records", f"{base}/corrupt_records"),
        }
        config = StreamConfig(f"{base}/_checkpoint", trigger={"availableNow": True})
        source = spark.readStream.schema(orders.schema).parquet(path)
        run_stream(spark, source, sinks, config, await_termination=True, expected=expected)
        for table, sink in sinks.items():
            rows = sink.read(spark).withColumns({"contract": F.lit(name), "target": F.lit(table)})
            for f in (*orders.schema, *CORRUPT_RECORDS_SCHEMA):
                if f.name not in rows.columns:
                    rows = rows.withColumn(f.name, F.lit(None).cast(f.dataType))
            rows = rows.select(
                "contract",
                "target",
                "o_orderkey",
                "o_totalprice",
                *(n for n in CORRUPT_RECORDS_SCHEMA.names if n != "load_timestamp"),
                F.col("load_timestamp").isNotNull().alias("stamped"),
            )
            out = rows if out is None else out.unionByName(rows)
    return out


def q34_published_batches(spark, sf_dir):
    """A batch that fails after two of its four writes: by table, whether its
    rows were written, how many of them a reader of published batches sees
    before the replay and after it, and the rows of all batches in the end."""
    seen = {}

    def published(run: StreamRun, batch: int | None = None) -> dict[str, int]:
        out = {}
        for name in SINK_ORDER:
            sink = run.sinks[name]
            rows = run.manifest.read(spark, getattr(sink, "inner", sink))
            out[name] = (rows if batch is None else rows.where(F.col("batch_id") == batch)).count()
        return out

    def failed(run: StreamRun) -> None:
        for name, shown in published(run, FAILING_BATCH).items():
            written = run.sinks[name].read(spark).where(F.col("batch_id") == FAILING_BATCH).count()
            seen[name] = (written > 0, shown)

    run = run_landed(
        spark,
        sf_dir,
        wrap={"corrupt_records": lambda sink: FailOnce(sink, (FAILING_BATCH,))},
        after_failure=failed,
        concurrent=False,
        extras=("manifest",),
    )
    after = published(run, FAILING_BATCH)
    rows = [(name, *seen[name], after[name] > 0) for name in SINK_ORDER]
    first = spark.createDataFrame(
        rows, "table_name string, written_before boolean, shown_before long, shown_after boolean"
    )
    # The rows in the end, counted with the query.
    total = None
    for name in SINK_ORDER:
        sink = run.sinks[name]
        part = run.manifest.read(spark, getattr(sink, "inner", sink)).groupBy().agg(F.count(F.lit(1)).alias("records"))
        part = part.withColumn("table_name", F.lit(name))
        total = part if total is None else total.unionByName(part)
    return first.join(total, "table_name")


#: Offsets that q35's topic lacks, and those that are in it twice.
REMOVED, DOUBLED = "offset % 97 IN (5, 6)", "offset % 101 = 3"


def q35_offset_account(spark, sf_dir):
    """First and last offset, gaps and repeats of every topic partition over a
    stream with removed and doubled records: from the output tables, and from
    the interval sets that the batches wrote."""
    env = envelope(spark, sf_dir).where(f"NOT ({REMOVED})")
    env = env.unionByName(env.where(DOUBLED))
    landed = land(env, fresh_path(spark, "envelope-holes"), N_BATCHES * files_per_batch(spark), "offset")
    run = run_landed(spark, sf_dir, landed=landed, extras=("offsets",))
    tables = {name: sink.read(spark) for name, sink in run.sinks.items()}
    accounts = {
        "tables": offset_intervals(table_offsets(tables, TOPIC)),
        "batches": merge_intervals(run.offsets.read(spark).drop("run_id", "batch_id")),
    }
    parts = [offset_account(found).withColumn("counted_from", F.lit(name)) for name, found in accounts.items()]
    return reduce(DataFrame.unionByName, parts)


ROLLUP_WINDOW, ROLLUP_DELAY = "6 hours", "1 day"
#: Records that reach the topic with its last batch, whenever they were sent.
DELAYED = "event_id % 13 = 5"


def land_in_batches(spark: SparkSession, env: DataFrame, batch, path: str) -> str:
    """The envelope landed so that each micro-batch holds the records of one
    value of ``batch`` (0 to N_BATCHES - 1), by the order of the files."""
    files = files_per_batch(spark)
    for b in range(N_BATCHES):
        env.where(batch == b).repartition(files).write.mode("append").parquet(path)
    return path


def q37_vehicle_stream(spark, sf_dir):
    """The roll-up by car and window over four micro-batches, with delayed
    records: sums of those in time, and late ones apart."""
    env = envelope(spark, sf_dir)
    n = spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet").count()
    quarter = F.expr(f"CASE WHEN {DELAYED.replace('event_id', 'offset')} THEN 3 ELSE offset * 4 div {max(n, 1)} END")
    landed = land_in_batches(spark, env, quarter, fresh_path(spark, "envelope-delayed"))
    run = run_landed(spark, sf_dir, landed=landed, extras=("rollup",))
    return run.rollup.read(spark)


def q38_isolated_records(spark, sf_dir):
    """A store that refuses five records: all others of its table are there,
    and the log names these."""
    n = spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet").count()
    bad = F.expr(f"kafka_offset % {max(n // 5, 1)} = {REFUSED}")
    run = run_landed(
        spark,
        sf_dir,
        on_error=ISOLATE,
        wrap={"device_data": lambda sink: RefuseRecords(sink, bad)},
        extras=("manifest",),
    )
    shown = run.manifest.read(spark, run.sinks["device_data"].inner).select(
        "kafka_partition", "kafka_offset", F.lit("written").alias("state"), F.lit(None).cast("string").alias("error_message")
    )
    place = r"^partition (\d+) offset (\d+): "
    logged = run.error_log.read(spark).where("target_table = 'device_data'")
    logged = logged.select(
        F.regexp_extract("error_message", place, 1).cast("int").alias("kafka_partition"),
        F.regexp_extract("error_message", place, 2).cast("long").alias("kafka_offset"),
        F.lit("refused").alias("state"),
        F.regexp_replace("error_message", place, "").alias("error_message"),
    )
    return shown.unionByName(logged)


#: Which of the n // 5 offsets of a fifth is refused.
REFUSED = 21


STREAM_QUERIES = {
    "q19_error_log": q19_error_log,
    "q21_stream_clean": q21_stream_clean,
    "q22_stream_replay": q22_stream_replay,
    "q23_error_log_scan": q23_error_log_scan,
    "q31_stream_counts": q31_stream_counts,
    "q32_two_streams": q32_two_streams,
    "q33_stream_batch_contract": q33_stream_batch_contract,
    "q34_published_batches": q34_published_batches,
    "q35_offset_account": q35_offset_account,
    "q37_vehicle_stream": q37_vehicle_stream,
    "q38_isolated_records": q38_isolated_records,
}

NO_TEXT = "CAST(NULL AS VARCHAR)"
_UNAVAILABLE = "'sink device_data unavailable' AS error_message, 'device_data' AS target_table"
_SOME_EVENTS = "(SELECT count(*) AS n FROM events) e WHERE n > 0"

STREAM_ORACLE_SQL = {
    "q19_error_log": f"SELECT {_UNAVAILABLE}, CAST(1 AS BIGINT) AS batch_id FROM {_SOME_EVENTS}",
    "q21_stream_clean": ORACLE_SQL["q17_device_data"],
    "q22_stream_replay": ORACLE_SQL["q17_device_data"],
    "q23_error_log_scan": " UNION ALL ".join(
        f"SELECT {_UNAVAILABLE}, CAST({b} AS BIGINT) AS batch_id, true AS stamped_in_run, "
        f"CAST(0 AS BIGINT) AS clean_records FROM {_SOME_EVENTS}"
        for b in FAILING_BATCHES
    ),
    "q31_stream_counts": with_records(
        "SELECT count(*) AS records, count(*) FILTER (WHERE route = 'corrupt') AS corrupt, "
        "count(*) FILTER (WHERE route = 'clean') AS clean, "
        "count(*) FILTER (WHERE route = 'failed') AS failed FROM routed"
    ),
    "q32_two_streams": ORACLE_SQL["q17_device_data"],
    "q33_stream_batch_contract": f"""
SELECT 'matching' AS contract, 'device_data' AS target, o_orderkey, o_totalprice,
       {NO_TEXT} AS message_key, CAST(NULL AS INTEGER) AS kafka_partition, CAST(NULL AS BIGINT) AS kafka_offset,
       {NO_TEXT} AS value_str, {NO_TEXT} AS error_reason, {NO_TEXT} AS topic_name, false AS stamped FROM orders
UNION ALL
SELECT 'drifted', 'corrupt_records', NULL, NULL, NULL, NULL, NULL,
       '{{"o_orderkey":' || o_orderkey || ',"o_custkey":' || o_custkey || ',"o_orderstatus":"' || o_orderstatus
       || '","o_totalprice":' || CAST(o_totalprice AS VARCHAR) || ',"o_orderdate":"'
       || strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S.%f') || '","o_orderpriority":"' || o_orderpriority || '"}}',
       'Type mismatch for column ''o_totalprice'': expected StringType(), got DoubleType()', NULL, true
FROM orders""",
    "q34_published_batches": with_records(
        """SELECT t.table_name, t.written_before, CAST(0 AS BIGINT) AS shown_before, true AS shown_after, t.records
FROM (SELECT 'qc_audit_log_table' AS table_name, true AS written_before,
             11 * count(*) FILTER (WHERE route <> 'corrupt') AS records FROM routed
      UNION ALL SELECT 'qc_failed_table', true, count(*) FILTER (WHERE route = 'failed') FROM routed
      UNION ALL SELECT 'corrupt_records', false, count(*) FILTER (WHERE route = 'corrupt') FROM routed
      UNION ALL SELECT 'device_data', false, count(*) FILTER (WHERE route = 'clean') FROM routed) t"""
    ),
    "q35_offset_account": """
WITH kept AS (
    SELECT CAST(user_id % 5 AS INTEGER) AS kafka_partition, event_id AS o FROM events WHERE event_id % 97 NOT IN (5, 6)
),
records AS (SELECT * FROM kept UNION ALL SELECT * FROM kept WHERE o % 101 = 3),
steps AS (
    SELECT kafka_partition, o, lag(o) OVER (PARTITION BY kafka_partition ORDER BY o) AS before FROM kept
),
account AS (
    SELECT kafka_partition, min(o) AS first_offset, max(o) AS last_offset,
           count(*) FILTER (WHERE o > before + 1) AS gaps,
           CAST(coalesce(sum(o - before - 1), 0) AS BIGINT) AS absent, count(*) AS there
    FROM steps GROUP BY kafka_partition
),
sizes AS (SELECT kafka_partition, count(*) AS records FROM records GROUP BY kafka_partition)
SELECT 'telemetry' AS topic_name, kafka_partition, first_offset, last_offset, records, gaps, absent,
       records - there AS repeats, counted_from
FROM account JOIN sizes USING (kafka_partition) CROSS JOIN (VALUES ('tables'), ('batches')) AS v(counted_from)""",
    "q37_vehicle_stream": with_records(
        f"""SELECT car_id, window_start,
       count(*) FILTER (WHERE NOT late) AS rows_checked,
       count(*) FILTER (WHERE NOT late AND route = 'failed') AS rows_failed,
       CAST(coalesce(sum(cells) FILTER (WHERE NOT late), 0) AS BIGINT) AS cells_failed,
       count(*) FILTER (WHERE late) AS late_rows
FROM (
    SELECT r.*, coalesce(window_start + INTERVAL 6 HOUR <= mark, false) AS late
    FROM (
        SELECT *, {cells_failed_sql()} AS cells,
               time_bucket(INTERVAL 6 HOUR, event_timestamp, TIMESTAMP '1970-01-01') AS window_start,
               CASE WHEN kafka_offset % 13 = 5 THEN 3
                    ELSE kafka_offset * 4 // (SELECT count(*) FROM events) END AS batch
        FROM routed WHERE route <> 'corrupt'
    ) r LEFT JOIN (
        SELECT b.batch, max(event_timestamp) - INTERVAL 1 DAY AS mark
        FROM (VALUES (1), (2), (3)) AS b(batch), routed
        WHERE route <> 'corrupt'
          AND CASE WHEN kafka_offset % 13 = 5 THEN 3
                   ELSE kafka_offset * 4 // (SELECT count(*) FROM events) END < b.batch
        GROUP BY b.batch
    ) m ON m.batch = r.batch
) t GROUP BY car_id, window_start"""
    ),
    "q38_isolated_records": with_records(
        f"""SELECT kafka_partition, kafka_offset,
       CASE WHEN bad THEN 'refused' ELSE 'written' END AS state,
       CASE WHEN bad THEN 'sink device_data refuses a record' END AS error_message
FROM (SELECT *, kafka_offset % ((SELECT count(*) FROM events) // 5) = {REFUSED} AS bad FROM routed) t
WHERE route = 'clean'"""
    ),
}
