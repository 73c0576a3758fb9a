"""Whole batch path on the generated envelope: class counts, conservation,
staging, sinks, and plan properties."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from telemetry_qc.plans import queries as Q
from telemetry_qc.plans.batch import CLEAN, CORRUPT, FAILED, ROUTE, annotate, route, stage
from telemetry_qc.plans.process import process
from telemetry_qc.operators.qc import DEFAULT_RULES
from telemetry_qc.schemas import SINK_SCHEMAS
from telemetry_qc.sinks.tables import ParquetTableSink


@pytest.fixture(scope="module")
def staged(spark):
    return Q.staged_envelope(spark, SF_SMALL)


def test_class_reasons(spark):
    got = {
        (r["cls"], r["error_reason"])
        for r in Q.q06_contract_errors(spark, SF_SMALL)
        .select((F.col("kafka_offset") % 40).alias("cls"), "error_reason")
        .distinct()
        .collect()
    }
    expected_corrupt = {
        0: "Malformed JSON", 1: "Malformed JSON", 2: "Malformed JSON", 10: "Malformed JSON",
        3: "Missing column: fuel_level", 4: "Unexpected column: firmware",
        5: "Type mismatch for column 'speed_kmph'", 6: "Type mismatch for column 'timestamp'",
        7: "Missing column: car_id; Unexpected column: Car_ID",
    }
    for cls in range(40):
        assert (cls, expected_corrupt.get(cls)) in got


def test_conservation(spark, staged):
    total = spark.read.parquet(f"{SF_SMALL}/events.parquet").count()
    counts = {r[ROUTE]: r["count"] for r in staged.groupBy(ROUTE).count().collect()}
    assert sum(counts.values()) == total
    outs = route(staged)
    n_corrupt = outs["corrupt_records"].count()
    n_clean = outs["device_data"].count()
    n_failed = outs["qc_failed_table"].count()
    assert n_corrupt + n_clean + n_failed == total
    assert outs["qc_audit_log_table"].count() == (n_clean + n_failed) * len(DEFAULT_RULES)
    offsets = [
        outs[n].select("kafka_offset") for n in ("corrupt_records", "device_data", "qc_failed_table")
    ]
    union = offsets[0].union(offsets[1]).union(offsets[2])
    assert union.distinct().count() == total


def test_sink_schemas(staged):
    outs = route(staged)
    for name, df in outs.items():
        assert [(f.name, f.dataType) for f in df.schema] == [
            (f.name, f.dataType) for f in SINK_SCHEMAS[name]
        ], name


def test_clean_rows_pass_all_rules(staged):
    dd = route(staged)["device_data"]
    assert dd.filter(F.col("qc_status") != "success").count() == 0
    failed = route(staged)["qc_failed_table"]
    assert failed.filter(F.col("qc_summary").isNull()).count() == 0


def test_process_writes_idempotent_sinks(spark, scratch):
    base = scratch("process")
    sinks = {n: ParquetTableSink(n, f"{base}/{n}") for n in SINK_SCHEMAS if n != "consumer_error_log"}
    env = Q.envelope(spark, SF_SMALL)
    r1 = process(env, sinks, stage_path=f"{base}/_stage", batch_id=7)
    assert sum(r1.counts().values()) == env.count() == r1.metrics["records"]
    assert r1.counts()["corrupt"] == sinks["corrupt_records"].read(spark).count()
    first = {n: s.read(spark).count() for n, s in sinks.items()}
    # The same run again replaces what it wrote; another run adds to it.
    process(env, sinks, stage_path=f"{base}/_stage", batch_id=7, run_id=r1.run_id)
    assert {n: s.read(spark).count() for n, s in sinks.items()} == first
    process(env, sinks, stage_path=f"{base}/_stage", batch_id=7)
    assert {n: s.read(spark).count() for n, s in sinks.items()} == {n: 2 * c for n, c in first.items()}


def test_annotation_has_no_shuffle_and_no_python(spark):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    from telemetry_qc.fixtures.events_envelope import envelope_from_events

    plan = annotate(envelope_from_events(ev))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    for node in ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "MapInPandas"):
        assert node not in plan
    # two parses per record, not one per referenced field
    assert plan.count("from_json") == 2


def test_routed_reads_prune_partitions(staged):
    plan = route(staged)["device_data"]._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(route" in plan and "clean" in plan
    assert "from_json" not in plan


def test_routed_plans_stay_small(staged):
    for name, df in route(staged).items():
        text = df._jdf.queryExecution().optimizedPlan().toString()
        assert len(text) < 20_000, name


def test_date_partition_pruning(spark):
    df = Q.q27_date_partitioned(spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "trip_start_date" in plan
    assert df.filter(F.col("trip_start_date") != F.lit(Q.REPORT_DAY).cast("date")).count() == 0


def test_flagship_entry(spark):
    import __spark_entry__ as E

    df = E.entry(spark)
    assert df.count() > 0
    assert "qc_status" in df.columns and "event_timestamp" in df.columns


def test_spread_only_on_request(spark):
    from telemetry_qc.plans.batch import spread

    few = spark.range(1000).coalesce(1)
    assert spread(few) is few
    assert spread(few, 7).rdd.getNumPartitions() == 7


def test_planning_starts_no_job(spark):
    """Annotating a shuffled input runs nothing before its first action."""
    from telemetry_qc.plans.batch import annotate, route, spread

    env = Q.envelope(spark, SF_SMALL).repartition(5, "key")
    sc = spark.sparkContext
    sc.setJobGroup("planning", "no job expected")
    try:
        route(annotate(spread(env)))
        assert sc.statusTracker().getJobIdsForGroup("planning") == []
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)


def test_process_on_no_records(spark, scratch):
    env = Q.envelope(spark, SF_SMALL).limit(0)
    out = process(env, stage_path=scratch("empty"))
    assert all(df.count() == 0 for df in out.outputs.values())


def test_stage_replaces_all_of_a_batch(spark, scratch):
    """Also where the session overwrites partitions one by one."""
    from telemetry_qc.plans.batch import annotate, stage

    path = scratch("restage")
    env = Q.envelope(spark, SF_SMALL)
    old = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        stage(annotate(env), path)
        # Records of these classes are never corrupt (FIXTURES.md).
        again = stage(annotate(env.where(F.col("offset") % 40 > 10)), path)
        assert {r[ROUTE] for r in again.select(ROUTE).distinct().collect()} == {"clean", "failed"}
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", old)


def test_stage_is_removed_after_the_writes(spark, scratch):
    import os

    base = scratch("cleanup")
    sinks = {"corrupt_records": ParquetTableSink("corrupt_records", f"{base}/corrupt")}
    process(Q.envelope(spark, SF_SMALL), sinks, stage_path=f"{base}/_stage")
    assert not os.path.exists(f"{base}/_stage")


@pytest.mark.parametrize("zone,skipped,repeated", [
    ("America/New_York", "2024-03-10T02:30:00", "2024-11-03T01:30:00"),
    ("Europe/Berlin", "2024-03-31T02:30:00", "2024-10-27T02:30:00"),
])
def test_times_without_zone_survive_clock_changes(spark, zone, skipped, repeated):
    import datetime

    from telemetry_qc.operators.contract import with_contract

    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        for text in (skipped, repeated):
            df = spark.createDataFrame([('{"timestamp":"%s"}' % text,)], "value_str string")
            got = with_contract(df).select("parsed.timestamp").first()[0]
            assert got == datetime.datetime.fromisoformat(text), (zone, text)
        zoned = spark.createDataFrame([('{"timestamp":"2024-07-01T12:00:00Z"}',)], "value_str string")
        hour = with_contract(zoned).select("parsed.timestamp").first()[0].hour
        assert hour == {"America/New_York": 8, "Europe/Berlin": 14}[zone]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_wall_clock_is_zone_independent(spark):
    import datetime

    from telemetry_qc.operators.enrich import enrich, wall_clock
    from telemetry_qc.operators.contract import with_contract

    text = ('{"trip_id":"T","car_id":"C","latitude":1.0,"longitude":2.0,'
            '"timestamp":"2024-01-01T23:30:00.000001","speed_kmph":3.0,"fuel_level":4.0,'
            '"engine_temp_c":5.0,"trip_start_time":"2024-01-01T23:00:00",'
            '"trip_start_latitude":6.0,"trip_start_longitude":7.0}')
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("UTC", "America/New_York", "Asia/Kolkata"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            df = spark.createDataFrame([(text, "k", "t", 0, 1)],
                                       "value_str string, message_key string, topic_name string, "
                                       "kafka_partition int, kafka_offset bigint")
            row = wall_clock(enrich(with_contract(df)).drop("load_timestamp")).first()
            assert row["timestamp"] == datetime.datetime(2024, 1, 1, 23, 30, 0, 1), zone
            assert row["trip_start_date"] == datetime.date(2024, 1, 1), zone
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_process_column_metrics(spark, scratch):
    r = process(Q.envelope(spark, SF_SMALL), stage_path=scratch("colmetrics"), column_metrics=True)
    failed = r.outputs["qc_failed_table"]
    assert r.metrics["failed"] == failed.count()
    want = failed.filter(F.col("qc_summary").contains("fuel_level ")).count()
    assert r.metrics["failed_fuel_level"] == want
    assert r.metrics["failed_engine_temp_c"] == failed.filter(
        F.col("qc_summary").contains("engine_temp_c ")).count()
    plain = process(Q.envelope(spark, SF_SMALL), stage_path=scratch("plain"))
    assert not any(k.startswith("failed_") for k in plain.metrics)


def test_process_allow_unexpected(spark, scratch):
    strict = process(Q.envelope(spark, SF_SMALL), stage_path=scratch("strict"))
    lenient = process(Q.envelope(spark, SF_SMALL), stage_path=scratch("lenient"), allow_unexpected=True)
    total = strict.metrics["records"]
    # class 4 carries one extra key and nothing else wrong: it becomes valid
    assert strict.metrics["corrupt"] - lenient.metrics["corrupt"] == total // 40
    reasons = {r["error_reason"] for r in lenient.outputs["corrupt_records"].select("error_reason").distinct().collect()}
    assert not any("Unexpected column" in x for x in reasons)
    assert "Missing column: car_id" in reasons


@pytest.mark.parametrize("name", [
    "q07_corrupt_records", "q08_schema_valid", "q12_qc_nulls", "q15_qc_status",
    "q16_qc_failed", "q17_device_data", "q18_qc_audit", "q24_publish_frame",
    "q26_vehicle_qc", "q27_date_partitioned",
])
def test_routed_queries_never_reparse(spark, name):
    """Routed outputs read the staged annotation: no JSON parse in their plan
    (a filter on the lazy annotation would re-parse every record)."""
    df = Q.QUERIES[name](spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "from_json" not in plan and "json_object_keys" not in plan, name
