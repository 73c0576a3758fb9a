"""QC rules at their limits, just beyond, NULL and NaN; status, summary, audit."""

import math

import pytest
from pyspark.sql import functions as F

from telemetry_qc.operators.qc import (
    DEFAULT_RULES,
    Rule,
    apply_rules,
    audit,
    bounds,
    null_check,
    split_qc,
    threshold,
)
from telemetry_qc.operators.rollup import vehicle_qc

NAN = float("nan")

EDGES = [
    # (rule, value, expected reason)
    (bounds("x", 0, 100), 0.0, None),
    (bounds("x", 0, 100), 100.0, None),
    (bounds("x", 0, 100), -0.0, None),
    (bounds("x", 0, 100), -1e-9, "x below 0"),
    (bounds("x", 0, 100), 100.000001, "x above 100"),
    (bounds("x", 0, 100), None, "x null"),
    (bounds("x", 0, 100), NAN, "x NaN"),
    (bounds("x", 0, 100, not_null=False), None, None),
    (threshold("x", max=130), 130.0, None),
    (threshold("x", max=130), 130.5, "x above 130"),
    (threshold("x", max=130), -1e9, None),
    (threshold("x", max=130), NAN, "x NaN"),
    (threshold("x", min=0.01), 0.01, None),
    (threshold("x", min=0.01), 0.0099, "x below 0.01"),
    (threshold("x", min=0.01), NAN, "x NaN"),
    (null_check("x"), 5.0, None),
    (null_check("x"), None, "x null"),
    (null_check("x"), NAN, None),
]


@pytest.mark.parametrize("rule,value,expected", EDGES)
def test_rule_edges(spark, rule, value, expected):
    df = spark.createDataFrame([(value,)], "x double")
    row = apply_rules(df, [rule]).first()
    assert row["qc_summary"] == expected
    assert row["qc_status"] == ("success" if expected is None else "fail")


def test_threshold_needs_one_side():
    with pytest.raises(ValueError):
        threshold("x")
    with pytest.raises(ValueError):
        threshold("x", min=1, max=2)


def test_summary_in_rule_order(spark):
    df = spark.createDataFrame([(None, 500.0, 95.0)], "a double, b double, c double")
    rules = [null_check("a"), threshold("b", max=200), bounds("c", -90, 90)]
    row = apply_rules(df, rules).first()
    assert row["qc_summary"] == "a null; b above 200; c above 90"


def test_integer_column_rules(spark):
    df = spark.createDataFrame([(5,), (50,), (None,)], "n int")
    got = [r["qc_summary"] for r in apply_rules(df, [bounds("n", 0, 10)]).orderBy("n").collect()]
    assert got == ["n null", None, "n above 10"]


def test_split_and_audit(spark):
    rows = [("T1", 1, 10, 50.0), ("T2", 1, 11, 250.0), ("T3", 2, 12, None)]
    df = spark.createDataFrame(rows, "trip_id string, kafka_partition int, kafka_offset bigint, speed double")
    rules = [null_check("trip_id"), Rule("speed", True, 0, 200)]
    checked = apply_rules(df, rules)
    passed, failed = split_qc(checked)
    assert passed.count() == 1 and failed.count() == 2
    a = audit(checked, rules, checked_at=F.lit(None).cast("timestamp"))
    assert a.count() == len(rows) * len(rules)
    bad = {(r["trip_id"], r["column_name"]): r["fail_reason"] for r in a.filter(~F.col("passed")).collect()}
    assert bad == {("T2", "speed"): "speed above 200", ("T3", "speed"): "speed null"}
    assert a.columns == ["trip_id", "column_name", "passed", "fail_reason", "checked_at",
                         "kafka_partition", "kafka_offset"]


def test_vehicle_rollup(spark):
    rows = [("A", 1.0, 300.0), ("A", None, 50.0), ("B", 1.0, 50.0)]
    df = spark.createDataFrame(rows, "car_id string, lat double, speed double")
    rules = [null_check("lat"), Rule("speed", True, 0, 200)]
    out = {r["car_id"]: r for r in vehicle_qc(apply_rules(df, rules), rules).collect()}
    assert (out["A"]["rows_checked"], out["A"]["rows_failed"], out["A"]["cells_failed"]) == (2, 2, 2)
    assert (out["B"]["rows_checked"], out["B"]["rows_failed"], out["B"]["cells_failed"]) == (1, 0, 0)


def test_default_rules_cover_payload():
    from telemetry_qc.schemas import PAYLOAD_SCHEMA
    cols = [r.column for r in DEFAULT_RULES]
    assert cols == ["event_timestamp" if n == "timestamp" else n for n in PAYLOAD_SCHEMA.names]
    assert all(r.not_null for r in DEFAULT_RULES)
    assert not math.isnan(0.0)


def test_rules_round_trip_through_plain_data():
    import json

    from telemetry_qc.operators.qc import rules_from_config

    text = json.dumps([r.to_dict() for r in DEFAULT_RULES])
    assert rules_from_config(json.loads(text)) == DEFAULT_RULES
    with pytest.raises(ValueError):
        rules_from_config([{"column": "x", "maximum": 3}])
    with pytest.raises(ValueError):
        rules_from_config([{"column": "x"}, {"column": "x", "max": 1}])


@pytest.mark.parametrize("rule,value,expected", EDGES)
def test_rule_fails_agrees_with_reason(spark, rule, value, expected):
    from telemetry_qc.operators.qc import rule_fails

    df = spark.createDataFrame([(value,)], "x double")
    assert df.select(rule_fails(rule, df).alias("f")).first()["f"] == (expected is not None)


def test_invalid_rules_are_refused_up_front(spark):
    from telemetry_qc.operators.qc import validate_rules

    df = spark.createDataFrame([(1.0, "x")], "a double, s string")
    for rules, text in [
        ([null_check("nope")], "nope: no such column"),
        ([bounds("a", 10, 1)], "a: min 10 is above max 1"),
        ([bounds("s", 0, 1)], "s: limits on a string column"),
        ([null_check("a"), threshold("a", max=3)], "more than one rule for a column"),
    ]:
        with pytest.raises(ValueError, match=text):
            apply_rules(df, rules)
    validate_rules(DEFAULT_RULES[:2], spark.createDataFrame([("t", "c")], "trip_id string, car_id string").schema)
