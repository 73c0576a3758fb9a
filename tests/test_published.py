"""Batches published as one, compaction, isolation of refused records, stop
from outside, offset accounting, the running roll-up, nested and observed
schemas."""

import os
import threading
import time
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, MapType, StringType, StructField, StructType

from conftest import SF_SMALL
from telemetry_qc.fixtures.faults import FailOnce, RecordRefused, RefuseRecords
from telemetry_qc.operators.contract import batch_route, schema_diff, tree_diff
from telemetry_qc.operators.observed import observed_schema, observed_types
from telemetry_qc.operators.offsets import merge_intervals, offset_account, offset_intervals
from telemetry_qc.plans import queries as Q
from telemetry_qc.sinks.isolate import Span, TooManyRefused, halves, write_rest
from telemetry_qc.sinks.published import Manifest
from telemetry_qc.sinks.routing import SINK_ORDER
from telemetry_qc.sinks.tables import CatalogTableSink, ErrorLogSink, ParquetTableSink
from telemetry_qc.streaming import queries as S
from telemetry_qc.streaming import runner as R

DAY = StructType([StructField("x", IntegerType()), StructField("d", StringType())])


def day_sink(path):
    return ParquetTableSink("t", path, ("d",), schema=DAY)


def xs(df):
    return sorted(r["x"] for r in df.collect())


# --- manifest and compaction -------------------------------------------------

def test_only_published_batches_are_read(spark, scratch):
    base = scratch("manifest")
    sink, manifest = day_sink(f"{base}/t"), Manifest(f"{base}/m")
    assert xs(manifest.read(spark, sink)) == []  # nothing written yet
    df = spark.createDataFrame([(1, "a"), (2, "b")], DAY)
    sink.write(df, 0, "r")
    assert xs(manifest.read(spark, sink)) == [] and xs(sink.read(spark)) == [1, 2]
    manifest.publish(spark, 0, "r", ["t"], {"records": 2})
    sink.write(df, 1, "r")
    manifest.publish(spark, 1, "r", ["other"])
    assert xs(manifest.read(spark, sink)) == [1, 2]
    assert [tuple(r) for r in manifest.counts(spark).collect()] == [("r", 0, "records", 2)]
    manifest.withdraw(spark, 0, "r")
    assert xs(manifest.read(spark, sink)) == []
    manifest.publish(spark, 0, "r", ["t"])
    manifest.publish(spark, 0, "r", ["t"])  # again: still one row
    assert manifest.entries(spark).where("batch_id = 0").count() == 1


def test_compaction_keeps_rows_and_readers(spark, scratch):
    base = scratch("compact")
    sink, manifest = day_sink(f"{base}/t"), Manifest(f"{base}/m")
    for b in range(4):
        sink.write(spark.createDataFrame([(10 * b + i, "ab"[i % 2]) for i in range(6)], DAY).repartition(3), b, "r")
        manifest.publish(spark, b, "r", ["t"])
    sink.write(spark.createDataFrame([(99, "a")], DAY), 4, "r")  # not published
    every = xs(manifest.read(spark, sink))
    before = manifest.read(spark, sink)
    files = lambda: manifest.read(spark, sink, "file").where("d = 'a'").select("file").distinct().count()
    many = files()
    run = manifest.compact(spark, sink, "a")
    assert run.startswith("compact-")
    assert files() == 1 < many
    assert xs(manifest.read(spark, sink)) == every == xs(before)
    assert xs(manifest.read(spark, sink).where("d = 'a' and run_id = 'r'")) == []
    # More rows, and compacted once more: the first compaction is replaced too.
    sink.write(spark.createDataFrame([(77, "a")], DAY), 5, "r")
    manifest.publish(spark, 5, "r", ["t"])
    again = manifest.compact(spark, sink, "a")
    assert xs(manifest.read(spark, sink)) == sorted([*every, 77])
    assert {r["run_id"] for r in manifest.read(spark, sink).where("d = 'a'").select("run_id").collect()} == {again}
    assert manifest.vacuum(spark, sink, datetime(2000, 1, 1)) == 0
    assert manifest.vacuum(spark, sink) == 4 + 2
    assert xs(manifest.read(spark, sink)) == sorted([*every, 77])
    assert xs(sink.read(spark).where("d = 'a'")) == sorted([x for x in every if x % 10 % 2 == 0] + [77, 99])
    assert manifest.compact(spark, sink, "none such") is None


def test_compaction_of_rows_without_a_day(spark, scratch):
    base = scratch("compact-null")
    sink, manifest = day_sink(f"{base}/t"), Manifest(f"{base}/m")
    for b in (0, 1):
        sink.write(spark.createDataFrame([(b, None), (b + 5, "a")], DAY), b, "r")
        manifest.publish(spark, b, "r", ["t"])
    manifest.compact(spark, sink, None)
    assert xs(manifest.read(spark, sink)) == [0, 1, 5, 6]
    assert manifest.vacuum(spark, sink) == 2
    assert xs(manifest.read(spark, sink)) == [0, 1, 5, 6]


def test_process_publishes_with_counts(spark, scratch):
    base = scratch("process-manifest")
    sink, manifest = ParquetTableSink("device_data", f"{base}/d"), Manifest(f"{base}/m")
    result = Q.process(Q.envelope(spark, SF_SMALL), {"device_data": sink}, manifest=manifest)
    counts = {r["route"]: r["records"] for r in manifest.counts(spark).collect()}
    assert counts == result.metrics and manifest.read(spark, sink).count() == counts["clean"]
    failing = FailOnce(sink, (7,))
    with pytest.raises(Exception, match="unavailable"):
        Q.process(Q.envelope(spark, SF_SMALL), {"device_data": failing}, manifest=manifest, batch_id=7)
    assert manifest.entries(spark).count() == 1


# --- sinks by their known schema -----------------------------------------------

def test_tables_without_rows_can_be_read(spark, scratch):
    base = scratch("empty")
    sink = ParquetTableSink("device_data", f"{base}/d", ("trip_start_date",))
    assert sink.read(spark).count() == 0  # nothing written
    clean = Q.q17_device_data(spark, SF_SMALL).withColumn("load_timestamp", F.current_timestamp().cast("timestamp_ntz"))
    sink.write(clean.limit(0), 0, "r")
    got = sink.read(spark)  # a batch without rows, partitioned
    assert got.count() == 0 and got.schema["trip_start_date"].dataType.simpleString() == "date"
    sink.write(clean, 1, "r")
    assert sink.read(spark).schema == got.schema and sink.read(spark).count() == clean.count()
    assert ErrorLogSink("consumer_error_log", f"{base}/log").read(spark).collect() == []


def test_error_log_of_a_batch_that_is_run_again(spark, scratch):
    from telemetry_qc.schemas import ERROR_LOG_SCHEMA
    from telemetry_qc.sinks.error_log import log_error

    log = ErrorLogSink("consumer_error_log", scratch("log"))
    for _ in range(2):
        log_error(log, spark, "boom", 3, "device_data", "r")
    log_error(log, spark, "other", 4, "device_data", "r")
    got = log.read(spark)
    assert got.columns == ERROR_LOG_SCHEMA.names
    assert sorted((r["error_message"], r["batch_id"]) for r in got.collect()) == [("boom", 3), ("other", 4)]


@pytest.mark.parametrize("mode", ["static", "dynamic"])
@pytest.mark.parametrize("external", [True, False])
def test_catalog_replay_without_a_day(spark, scratch, mode, external):
    name = f"t_{os.urandom(4).hex()}"
    sink = CatalogTableSink("t", name, ("d",), path=scratch("catalog") if external else None)
    df = spark.createDataFrame([(1, "a"), (2, "b")], DAY)
    old = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", mode)
    try:
        sink.write(df, 0, "r")
        sink.write(df, 1, "r")
        sink.write(df.where("x = 1"), 0, "r")
        assert xs(sink.read(spark).where("batch_id = 0")) == [1]
        sink.append(df.where("x = 2"), 0, "r")
        assert xs(sink.read(spark)) == [1, 1, 2, 2]
        sink.clear(spark, 1, "r")
        spark.catalog.refreshTable(name)
        assert xs(sink.read(spark)) == [1, 2]
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", old)
        spark.sql(f"DROP TABLE IF EXISTS {name}")


# --- isolation -----------------------------------------------------------------

RECORDS = "kafka_partition int, kafka_offset long, x int"


def test_halves_cover_everything():
    assert halves([Span(0, 0, 9), Span(1, 5, 5), Span(2, 0, 1)]) == [[Span(0, 0, 9)], [Span(1, 5, 5), Span(2, 0, 1)]]
    assert halves([Span(0, 4, 9)]) == [[Span(0, 4, 6)], [Span(0, 7, 9)]]
    assert halves([Span(0, -1, 0)]) == [[Span(0, -1, -1)], [Span(0, 0, 0)]]


def test_all_but_the_refused_records_are_written(spark, scratch):
    rows = [(i % 3, i, i) for i in range(90)] + [(1, 40, 400), (None, 7, 1000), (2, None, 1001)]
    df = spark.createDataFrame(rows, RECORDS).cache()
    bad = F.col("x").isin(17, 40, 1001)
    sink = RefuseRecords(ParquetTableSink("t", scratch("isolate")), bad)
    with pytest.raises(RecordRefused):
        sink.write(df, 0, "r")
    refused = write_rest(sink, df, 0, "r")
    # Both records of partition 1, offset 40 go; -1 stands for no offset.
    assert {(r.span.partition, r.span.first) for r in refused} == {(2, 17), (1, 40), (2, -1)}
    assert all(r.span.first == r.span.last and "refuses a record" in r.message() for r in refused)
    assert xs(sink.read(spark)) == sorted(x for _, _, x in rows if x not in (17, 40, 400, 1001))


def test_a_store_that_fails_throughout_is_no_matter_of_records(spark, scratch):
    df = spark.createDataFrame([(0, i, i) for i in range(64)], RECORDS).cache()
    sink = RefuseRecords(ParquetTableSink("t", scratch("down"), schema=df.schema), F.lit(True))
    with pytest.raises(TooManyRefused):
        write_rest(sink, df, 0, "r", limit=3)
    assert sink.read(spark).count() == 0
    assert sink.writes < 40


def test_isolate_policy_in_a_stream(spark):
    bad = F.col("kafka_offset").isin(21, 421, 423)
    run = S.run_landed(
        spark, SF_SMALL, on_error=R.ISOLATE, wrap={"qc_failed_table": lambda s: RefuseRecords(s, bad)}, extras=("manifest",)
    )
    want = Q.q16_qc_failed(spark, SF_SMALL)
    gone = sorted(r["kafka_offset"] for r in want.where(bad).collect())
    got = run.manifest.read(spark, run.sinks["qc_failed_table"].inner)
    assert got.count() == want.count() - len(gone) and got.where(bad).count() == 0
    log = run.error_log.read(spark).collect()
    assert sorted(int(r["error_message"].split("offset ")[1].split(":")[0]) for r in log) == gone
    clean = run.manifest.read(spark, run.sinks["device_data"])
    assert clean.count() == Q.q17_device_data(spark, SF_SMALL).count()


def test_a_span_is_told_from_the_files(spark, scratch):
    """By ranges of the plain column; records without offset are before 0."""
    path = scratch("span")
    rows = [(0, None), (0, 0), (0, 5), (1, 5), (None, 5)]
    spark.createDataFrame(rows, "kafka_partition int, kafka_offset long").write.parquet(path)
    df = spark.read.parquet(path)
    found = lambda s: sorted((tuple(r) for r in df.where(s.within()).collect()), key=repr)
    assert found(Span(0, -1, 0)) == [(0, 0), (0, None)] and found(Span(0, 0, 9)) == [(0, 0), (0, 5)]
    assert found(Span(None, 5, 5)) == [(None, 5)]
    pushed = df.where(Span(0, 1, 5).within())._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(kafka_offset,1)" in pushed


def test_isolate_needs_a_log_and_records(spark):
    config = R.StreamConfig("x", on_error=R.ISOLATE)
    with pytest.raises(ValueError, match="error_log"):
        R.make_batch_writer({}, config)
    with pytest.raises(ValueError, match="whole"):
        R.make_schema_batch_writer({}, DAY, config, error_log=object())


# --- stop from outside -----------------------------------------------------------

def test_stop_marker_during_a_backlog(spark, scratch):
    """Written by someone who knows the checkpoint only: the batch in flight
    is committed at most, and a restart goes on."""
    from telemetry_qc.sources.files import read_envelope_stream

    src = S.land_envelope(spark, SF_SMALL, batches=2)
    base = scratch("stop")
    sink = ParquetTableSink("corrupt_records", f"{base}/corrupt")
    config = R.StreamConfig(f"{base}/_ckpt")
    commits = lambda: sorted(int(f) for f in os.listdir(f"{base}/_ckpt/commits") if f.isdigit())
    ended = []

    def serve():
        query = R.run_stream(spark, read_envelope_stream(spark, src, 1), {"corrupt_records": sink}, config)
        ended.append(R.await_end(query, poll_seconds=0.2))

    thread = threading.Thread(target=serve)
    thread.start()
    while not (os.path.isdir(f"{base}/_ckpt/commits") and commits()):
        time.sleep(0.02)
    R.request_stop(spark, config.checkpoint_location)
    at_request = commits()
    thread.join(120)
    assert ended == [True]
    done = commits()
    assert len(at_request) <= len(done) <= len(at_request) + 1 < 2 * S.files_per_batch(spark)
    assert sink.read(spark).select("batch_id").distinct().count() == len(done)
    again = R.StreamConfig(f"{base}/_ckpt", trigger={"availableNow": True})
    R.run_stream(spark, read_envelope_stream(spark, src, 1), {"corrupt_records": sink}, again, await_termination=True)
    assert len(commits()) == 2 * S.files_per_batch(spark)
    assert sink.read(spark).count() == Q.q07_corrupt_records(spark, SF_SMALL).count()


def test_stop_marker_ends_an_idle_query(spark, scratch):
    from telemetry_qc.sources.files import read_envelope_stream

    base = scratch("stop-idle")
    src = S.land_envelope(spark, SF_SMALL, batches=1)
    sink = ParquetTableSink("corrupt_records", f"{base}/corrupt")
    config = R.StreamConfig(f"{base}/_ckpt", trigger={"processingTime": "1 second"})
    query = R.run_stream(spark, read_envelope_stream(spark, src, S.files_per_batch(spark)), {"corrupt_records": sink}, config)
    query.processAllAvailable()
    R.request_stop(spark, f"{base}/_ckpt")
    assert R.await_end(query, poll_seconds=0.2) is True and not query.isActive


def test_stop_from_the_command_line(spark, scratch):
    from telemetry_qc.__main__ import main

    where = scratch("stop-cli")
    main(["stop", "--checkpoint-dir", where])
    assert os.path.exists(R.stop_marker(where))


# --- offsets ---------------------------------------------------------------------

def islands(offsets):
    out = []
    for o in sorted(set(offsets)):
        if out and o == out[-1][1] + 1:
            out[-1][1] = o
        else:
            out.append([o, o])
    return [tuple(i) for i in out]


def test_intervals_over_buckets_and_batches(spark):
    import random

    rnd = random.Random(1)
    offsets = [o for o in range(5, 260) if rnd.random() < 0.8] + list(range(300, 420)) + [10**12, 10**12 + 1]
    records = [("t", 0, o) for o in offsets] + [("t", 0, o) for o in offsets[::7]] + [("t", 1, 3), ("u", 0, None)]
    df = spark.createDataFrame(records, "topic_name string, kafka_partition int, kafka_offset long")
    for width in (1, 16, 1 << 20):
        got = offset_intervals(df, width).collect()
        mine = sorted((r["first"], r["last"]) for r in got if r["topic_name"] == "t" and r["kafka_partition"] == 0)
        assert mine == islands(offsets), width
        assert sum(r["records"] for r in got) == len(records) - 1
    # Batches overlap, repeat and touch; merged they are the whole.
    parts = [df.where(F.col("kafka_offset") % 3 == i) for i in range(3)] + [df.where("kafka_offset between 50 and 90")]
    sets = [offset_intervals(p) for p in parts]
    merged = merge_intervals(sets[0].unionByName(sets[1]).unionByName(sets[2]).unionByName(sets[3]), 16)
    mine = sorted((r["first"], r["last"]) for r in merged.collect() if r["kafka_partition"] == 0)
    assert mine == islands(offsets)
    account = {r["kafka_partition"]: r for r in offset_account(offset_intervals(df)).collect()}[0]
    found = islands(offsets)
    assert (account["first_offset"], account["last_offset"]) == (min(offsets), max(offsets))
    assert account["gaps"] == len(found) - 1
    assert account["absent"] == max(offsets) - min(offsets) + 1 - len(set(offsets))
    assert account["repeats"] == len(offsets[::7])
    assert offset_account(offset_intervals(df.limit(0))).collect() == []


# --- running roll-up ---------------------------------------------------------------

def test_rollup_totals_equal_the_batch_rollup(spark):
    run = S.run_landed(spark, SF_SMALL, fail_batches=(1,), extras=("rollup", "manifest"))
    assert run.attempts == 2
    got = sorted(tuple(r) for r in run.rollup.totals(spark, run.manifest).collect())
    assert got == sorted(tuple(r) for r in Q.q26_vehicle_qc(spark, SF_SMALL).collect())
    view = run.rollup.read(spark).agg(F.sum("rows_checked"), F.sum("late_rows")).first()
    assert sum(view) == sum(r[1] for r in got)


def test_rollup_watermark_and_rows_without_time(spark, scratch):
    from telemetry_qc.plans.batch import annotate
    from telemetry_qc.streaming.rollup import VehicleRollup

    roll = VehicleRollup(scratch("rollup"), "1 hour", "30 minutes")
    rows = Q.staged_envelope(spark, SF_SMALL).where("route <> 'corrupt'").limit(4).cache()
    at = lambda text: rows.limit(2).withColumn("event_timestamp", F.lit(text).cast("timestamp_ntz"))
    assert roll.watermark(spark, "r") is None
    roll.write(at("2024-01-01 10:15:00"), 0, "r")
    roll.write(at("2024-01-01 12:40:00").unionByName(at(None)), 1, "r")
    assert roll.watermark(spark, "r") == datetime(2024, 1, 1, 12, 10)
    assert roll.watermark(spark, "other") is None
    for _ in range(2):  # a replay replaces its part
        roll.write(at("2024-01-01 11:59:00").unionByName(at("2024-01-01 12:01:00")), 2, "r")
    sums = roll.read(spark).groupBy("window_start").agg(F.sum("rows_checked").alias("n"), F.sum("late_rows").alias("late"))
    got = {r["window_start"] and r["window_start"].hour: (r["n"], r["late"]) for r in sums.collect()}
    assert got == {10: (2, 0), 11: (0, 2), 12: (4, 0), None: (2, 0)}


# --- nested and observed schemas ---------------------------------------------------

def test_tree_diff_paths():
    inner = lambda *f: StructType([StructField(n, t) for n, t in f])
    expected = inner(
        ("a", inner(("b", IntegerType()), ("c", ArrayType(inner(("d", StringType())))))),
        ("m", MapType(StringType(), inner(("v", LongType())))),
        ("k", MapType(StringType(), LongType())),
        ("gone", inner(("x", LongType()))),
    )
    actual = inner(
        ("a", inner(("b", LongType()), ("c", ArrayType(inner(("d", StringType()), ("e", StringType())))))),
        ("m", MapType(StringType(), inner(("w", LongType())))),
        ("k", MapType(IntegerType(), LongType())),
        ("new", LongType()),
    )
    got = [(c.path, c.change) for c in tree_diff(actual, expected)]
    assert got == [
        ("a.b", "mismatch"),
        ("a.c.element.e", "unexpected"),
        ("m.value.v", "missing"),
        ("m.value.w", "unexpected"),
        ("k.key", "mismatch"),
        ("gone", "missing"),
        ("new", "unexpected"),
    ]
    assert tree_diff(expected, expected) == []
    flat = inner(("x", LongType())), inner(("x", StringType()), ("y", LongType()))
    assert [c.message() for c in tree_diff(*flat)] == schema_diff(*flat)
    assert batch_route.__defaults__[-1] is False  # flat unless asked for


def test_tree_diff_struct_against_scalar():
    (change,) = tree_diff(
        StructType([StructField("a", StructType([StructField("b", LongType())]))]),
        StructType([StructField("a", LongType())]),
    )
    assert (change.path, change.change) == ("a", "mismatch")


def test_observed_types_of_odd_texts(spark):
    texts = [
        '{"a":1,"b":[1],"c":{"d":2}}', '{"a":1.5,"b":null}', '{"a":1e3}', '{"a":"x","c":true}',
        None, "", "[1]", "7", "{", '{"a":1}{"a":2}', '{"a":1}] x',
    ]
    df = spark.createDataFrame([(t,) for t in texts], "value_str string")
    got = sorted(tuple(r) for r in observed_types(df).collect())
    assert got == sorted(
        [("a", "BIGINT", 1), ("a", "DECIMAL", 1), ("a", "DOUBLE", 1), ("a", "STRING", 1), ("b", "ARRAY", 1),
         ("b", "VOID", 1), ("c", "OBJECT", 1), ("c", "BOOLEAN", 1)]
    )
    expected = StructType([StructField("a", LongType()), StructField("b", StringType())])
    found = {(r["key"], r["observed_type"]): (r["records"], r["finding"]) for r in observed_schema(df, expected=expected).collect()}
    assert found[("a", "STRING")] == (1, "type") and found[("a", "DOUBLE")] == (1, "ok")
    assert found[("b", "ARRAY")] == (1, "type") and found[("c", "OBJECT")] == (1, "unexpected")
    assert found[("a", None)] == (7, "missing") and found[("b", None)] == (9, "missing")
    assert observed_schema(df.limit(0), expected=expected).count() == 0


def test_published_day_query_value_is_a_date():
    assert date.fromisoformat(Q.REPORT_DAY).day == 15
    assert set(SINK_ORDER) == {"qc_audit_log_table", "qc_failed_table", "corrupt_records", "device_data"}
