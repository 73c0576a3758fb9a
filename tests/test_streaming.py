"""Streaming runner: stream = batch, failure policies, replay, metrics."""

import os

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from telemetry_qc.plans import queries as Q
from telemetry_qc.plans.process import drop_run_columns
from telemetry_qc.streaming.queries import FAILING_BATCH, N_BATCHES, files_per_batch, run_landed
from telemetry_qc.streaming.runner import FAIL, LOG, METRICS_NAME, StreamConfig


def rows(df):
    cols = sorted(c for c in df.columns if c not in ("load_timestamp", "batch_id", "run_id"))
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=repr)


@pytest.fixture(scope="module")
def batch_tables(spark):
    return {
        "device_data": rows(Q.q17_device_data(spark, SF_SMALL)),
        "qc_failed_table": rows(Q.q16_qc_failed(spark, SF_SMALL)),
        "corrupt_records": rows(Q.q07_corrupt_records(spark, SF_SMALL)),
        "qc_audit_log_table": rows(Q.q18_qc_audit(spark, SF_SMALL)),
    }


def table_rows(spark, run, name):
    df = run.sinks[name].read(spark)
    return rows(drop_run_columns(df).drop("checked_at"))


def test_stream_equals_batch(spark, batch_tables):
    run = run_landed(spark, SF_SMALL)
    assert run.attempts == 1
    for name, expected in batch_tables.items():
        assert table_rows(spark, run, name) == expected, name
    batches = [p for p in run.progress if p["numInputRows"] > 0]
    assert len(batches) == N_BATCHES
    metrics = [p["observedMetrics"][METRICS_NAME] for p in batches]
    total = spark.read.parquet(f"{SF_SMALL}/events.parquet").count()
    assert sum(int(m["records"]) for m in metrics) == total
    assert sum(int(m["clean"]) for m in metrics) == len(batch_tables["device_data"])


def test_fail_policy_replays_without_loss_or_duplicates(spark, batch_tables):
    run = run_landed(spark, SF_SMALL, on_error=FAIL, fail_batches=(FAILING_BATCH,))
    assert run.attempts == 2
    for name, expected in batch_tables.items():
        assert table_rows(spark, run, name) == expected, name
    assert run.sinks["device_data"].failed == {FAILING_BATCH}


def test_log_policy_logs_once_and_moves_on(spark, batch_tables):
    run = run_landed(spark, SF_SMALL, on_error=LOG, fail_batches=(FAILING_BATCH,))
    assert run.attempts == 1
    log = run.error_log.read(spark).collect()
    assert [(r["error_message"], r["target_table"], r["batch_id"]) for r in log] == [
        ("sink device_data unavailable", "device_data", FAILING_BATCH)
    ]
    assert log[0]["log_time"] is not None
    # the failed batch's clean rows are not written (the documented cost of
    # 'log'); every other table is complete
    clean = run.sinks["device_data"].read(spark)
    assert clean.filter(F.col("batch_id") == FAILING_BATCH).count() == 0
    assert clean.count() < len(batch_tables["device_data"])
    for name in ("qc_failed_table", "corrupt_records", "qc_audit_log_table"):
        assert table_rows(spark, run, name) == batch_tables[name], name


def test_config_validation():
    with pytest.raises(ValueError):
        StreamConfig(checkpoint_location="x", on_error="ignore")
    with pytest.raises(ValueError):
        StreamConfig(checkpoint_location="x", materialize="memory")
    assert StreamConfig(checkpoint_location="x/").stage_dir == "x_stage"


@pytest.mark.parametrize("materialize", ["stage", "persist"])
def test_materialization(spark, scratch, batch_tables, materialize):
    """Both ways write the same, an empty batch included, also where the
    session overwrites partitions one by one; no staged batch is left."""
    from telemetry_qc.sinks.tables import ParquetTableSink
    from telemetry_qc.sources.files import read_envelope_stream
    from telemetry_qc.streaming.queries import land_envelope
    from telemetry_qc.streaming.runner import run_stream

    src = land_envelope(spark, SF_SMALL)
    spark.read.parquet(src).limit(0).coalesce(1).write.mode("append").parquet(src)
    base = scratch("stage-stream")
    sinks = {"device_data": ParquetTableSink("device_data", f"{base}/device_data", ("trip_start_date",))}
    cfg = StreamConfig(checkpoint_location=f"{base}/_ckpt", materialize=materialize,
                       stage_dir=f"{base}/_stage", trigger={"availableNow": True})
    old = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        q = run_stream(spark, read_envelope_stream(spark, src, files_per_batch(spark)), sinks, cfg)
        q.awaitTermination()
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", old)
    assert rows(drop_run_columns(sinks["device_data"].read(spark))) == batch_tables["device_data"]
    if materialize == "stage":
        assert not os.listdir(f"{base}/_stage")


def test_stop_gracefully_when_idle(spark, scratch):
    from telemetry_qc.sinks.tables import ParquetTableSink
    from telemetry_qc.sources.files import read_envelope_stream
    from telemetry_qc.streaming.queries import land_envelope
    from telemetry_qc.streaming.runner import run_stream, stop_gracefully

    src = land_envelope(spark, SF_SMALL)
    base = scratch("graceful")
    sinks = {"corrupt_records": ParquetTableSink("corrupt_records", f"{base}/corrupt")}
    cfg = StreamConfig(checkpoint_location=f"{base}/_ckpt", trigger={"processingTime": "1 second"})
    q = run_stream(spark, read_envelope_stream(spark, src, files_per_batch(spark)), sinks, cfg)
    q.processAllAvailable()
    assert stop_gracefully(q, timeout_seconds=60)
    assert not q.isActive
    done = [p for p in q.recentProgress if p["numInputRows"] > 0]
    written = sinks["corrupt_records"].read(spark).select("batch_id").distinct().count()
    assert written == len(done) == N_BATCHES


def test_stop_gracefully_during_a_backlog(spark, scratch, batch_tables):
    """The batch in flight is committed, the backlog left; a restart does it."""
    import time

    from telemetry_qc.sinks.tables import ParquetTableSink
    from telemetry_qc.sources.files import read_envelope_stream
    from telemetry_qc.streaming.queries import land_envelope
    from telemetry_qc.streaming.runner import run_stream, stop_gracefully

    src = land_envelope(spark, SF_SMALL, batches=2)  # one file a batch
    base = scratch("graceful-backlog")
    sink = ParquetTableSink("corrupt_records", f"{base}/corrupt")
    cfg = StreamConfig(checkpoint_location=f"{base}/_ckpt")
    q = run_stream(spark, read_envelope_stream(spark, src, 1), {"corrupt_records": sink}, cfg)
    while not q.recentProgress:
        time.sleep(0.05)
    before = len(os.listdir(f"{base}/_ckpt/commits"))
    assert stop_gracefully(q, timeout_seconds=60)
    assert not q.isActive
    committed = [f for f in os.listdir(f"{base}/_ckpt/commits") if f.isdigit()]
    assert len(committed) < 2 * files_per_batch(spark)
    written = sink.read(spark).select("batch_id").distinct().count()
    assert written == len(committed) <= before + 1
    again = StreamConfig(checkpoint_location=f"{base}/_ckpt", trigger={"availableNow": True})
    run_stream(spark, read_envelope_stream(spark, src, 1), {"corrupt_records": sink}, again, await_termination=True)
    assert rows(drop_run_columns(sink.read(spark))) == batch_tables["corrupt_records"]


def test_per_column_failure_metrics(spark, batch_tables):
    run = run_landed(spark, SF_SMALL, column_metrics=True)
    metrics = [p["observedMetrics"][METRICS_NAME] for p in run.progress if p["numInputRows"] > 0]
    failed = Q.q16_qc_failed(spark, SF_SMALL)
    for col in ("fuel_level", "latitude", "speed_kmph", "engine_temp_c"):
        want = failed.filter(F.col("qc_summary").contains(f"{col} ")).count()
        if col == "latitude":  # "trip_start_latitude" never fails here
            want = failed.filter(F.col("qc_summary").rlike(r"(^|; )latitude ")).count()
        assert sum(int(m[f"failed_{col}"]) for m in metrics) == want, col


def test_catalog_sink_replay_in_a_stream(spark, scratch, batch_tables):
    import uuid

    from pyspark.errors import StreamingQueryException

    from telemetry_qc.sinks.tables import CatalogTableSink
    from telemetry_qc.sources.files import read_envelope_stream
    from telemetry_qc.fixtures.faults import FailOnce
    from telemetry_qc.streaming.queries import land_envelope
    from telemetry_qc.streaming.runner import run_stream

    src = land_envelope(spark, SF_SMALL)
    base = scratch("catalog-stream")
    table = f"clean_{uuid.uuid4().hex[:8]}"
    sink = FailOnce(CatalogTableSink("device_data", table, path=f"{base}/table"), (1,))
    cfg = StreamConfig(checkpoint_location=f"{base}/_ckpt", trigger={"availableNow": True})
    for attempt in range(2):
        q = run_stream(spark, read_envelope_stream(spark, src, files_per_batch(spark)),
                       {"device_data": sink}, cfg)
        try:
            q.awaitTermination()
            break
        except StreamingQueryException:
            assert attempt == 0
    got = rows(drop_run_columns(spark.table(table)))
    assert got == batch_tables["device_data"]
    spark.sql(f"DROP TABLE {table}")


def test_counts_of_more_batches_than_the_progress_keeps(spark, monkeypatch):
    """q31 sums all batches, also those that Spark's progress has dropped."""
    from telemetry_qc.streaming import queries as Q

    key = "spark.sql.streaming.numRecentProgressUpdates"
    monkeypatch.setattr(Q, "_runs", {})
    spark.conf.set(key, "2")
    try:
        got = Q.q31_stream_counts(spark, SF_SMALL).first()
    finally:
        spark.conf.unset(key)
    (run,) = Q._runs.values()
    events = spark.read.parquet(f"{SF_SMALL}/events.parquet").count()
    assert sum(p["numInputRows"] for p in run.progress) < events == got["records"]
    assert got["corrupt"] + got["clean"] + got["failed"] == events


def test_batches_follow_the_rows_of_a_core(spark, monkeypatch):
    """A batch holds BATCH_ROWS records a file, one file a core: a larger
    cluster has larger batches, and not more."""
    from telemetry_qc.streaming import queries as S

    rows = spark.read.parquet(f"{SF_SMALL}/events.parquet").count()
    monkeypatch.setattr(S, "BATCH_ROWS", -(-rows // 20))
    monkeypatch.setattr(S, "files_per_batch", lambda spark: 5)
    landed = spark.read.parquet(S.land_envelope(spark, SF_SMALL))
    assert len(landed.inputFiles()) == 5 * N_BATCHES and landed.count() == rows
