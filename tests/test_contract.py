"""Row contract and schema diff on literal rows."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StringType, StructField, StructType

from telemetry_qc.operators.contract import (
    batch_route,
    required_fields_errors,
    with_required_fields,
    schema_diff,
    with_contract,
)
from telemetry_qc.schemas import PAYLOAD_SCHEMA, TIMESTAMP_FIELDS

GOOD = (
    '{"trip_id":"T1","car_id":"Car_1","latitude":22.5,"longitude":88.3,'
    '"timestamp":"2024-01-01T10:00:00.123456","speed_kmph":50.5,"fuel_level":40.0,'
    '"engine_temp_c":90.0,"trip_start_time":"2024-01-01T00:00:00",'
    '"trip_start_latitude":22.5,"trip_start_longitude":88.25}'
)


def with_field(key, text):
    import json
    d = json.loads(GOOD)
    out = []
    for k, v in d.items():
        if k == key:
            if text is not None:
                out.append(f'"{k}":{text}')
        else:
            out.append(f'"{k}":{json.dumps(v)}')
    return "{" + ",".join(out) + "}"


CASES = [
    ("good", GOOD, None),
    ("truncated", GOOD[:60], "Malformed JSON"),
    ("not json", "hello", "Malformed JSON"),
    ("null", None, "Malformed JSON"),
    ("blank", "   ", "Malformed JSON"),
    ("empty", "", "Malformed JSON"),
    ("array", "[" + GOOD + "]", "Malformed JSON"),
    ("json null", "null", "Malformed JSON"),
    ("missing key", with_field("fuel_level", None), "Missing column: fuel_level"),
    ("extra key", '{"firmware":"v2",' + GOOD[1:], "Unexpected column: firmware"),
    ("two extra keys sorted", '{"zz":1,"aa":2,' + GOOD[1:],
     "Unexpected column: aa; Unexpected column: zz"),
    ("missing, extra and mismatch together",
     '{"zz":1,' + with_field("fuel_level", None)[1:].replace('"speed_kmph":50.5', '"speed_kmph":"x"'),
     "Missing column: fuel_level; Unexpected column: zz; Type mismatch for column 'speed_kmph'"),
    ("two mismatches in schema order",
     with_field("speed_kmph", '"x"').replace('"latitude":22.5', '"latitude":true'),
     "Type mismatch for column 'latitude'; Type mismatch for column 'speed_kmph'"),
    ("duplicate key, last value wins", GOOD[:-1] + ',"fuel_level":41.0}', None),
    ("string for double", with_field("speed_kmph", '"fast"'),
     "Type mismatch for column 'speed_kmph'"),
    ("quoted number for double", with_field("speed_kmph", '"50.1"'),
     "Type mismatch for column 'speed_kmph'"),
    ("bad timestamp", with_field("timestamp", '"yesterday"'),
     "Type mismatch for column 'timestamp'"),
    ("renamed key", GOOD.replace('"car_id"', '"Car_ID"'),
     "Missing column: car_id; Unexpected column: Car_ID"),
    ("explicit null is QC's business", with_field("fuel_level", "null"), None),
    ("number for string kept as text", with_field("trip_id", "123"), None),
    ("NaN literal is not JSON", with_field("speed_kmph", "NaN"), "Malformed JSON"),
    ("empty object", "{}", "; ".join(f"Missing column: {n}" for n in PAYLOAD_SCHEMA.names)),
    ("trailing text", GOOD + " trailing", "Malformed JSON"),
    ("second object", GOOD + GOOD, "Malformed JSON"),
    ("comma and second object", GOOD + "," + GOOD, "Malformed JSON"),
    ("blanks at the end", GOOD + " \n\t ", None),
    ("brace inside a string", with_field("trip_id", '"a}b"'), None),
    ("brace inside a string and trailing text", with_field("trip_id", '"a}b"') + "x", "Malformed JSON"),
    ("raw tab in a string", with_field("trip_id", '"a\tb"'), "Malformed JSON"),
    ("raw newline in a string", with_field("trip_id", '"a\nb"'), "Malformed JSON"),
    ("escaped newline in a string", with_field("trip_id", r'"a\nb"'), None),
    ("zoned time", with_field("timestamp", '"2024-01-01T10:00:00+02:00"'), None),
    ("epoch seconds", with_field("timestamp", "1704103200"), None),
    ("zoned nonsense", with_field("timestamp", '"2024-13-41T10:00:00Z"'),
     "Type mismatch for column 'timestamp'"),
]


@pytest.fixture(scope="module")
def checked(spark):
    df = spark.createDataFrame([(c[0], c[1]) for c in CASES], "tag string, value string")
    out = with_contract(df, "value").select("tag", F.col("parsed").alias("p"), F.col("error_reason").alias("err"))
    return {r["tag"]: r for r in out.collect()}


@pytest.mark.parametrize("tag,text,expected", CASES, ids=[c[0] for c in CASES])
def test_row_contract(checked, tag, text, expected):
    assert checked[tag]["err"] == expected


def test_partial_parse_keeps_other_fields(checked):
    p = checked["string for double"]["p"]
    assert p["speed_kmph"] is None and p["fuel_level"] == 40.0 and p["trip_id"] == "T1"


def test_allow_unexpected(spark):
    df = spark.createDataFrame([('{"firmware":"v2",' + GOOD[1:],)], "value string")
    assert with_contract(df, "value", allow_unexpected=True).first()["error_reason"] is None


def test_schema_diff_messages():
    actual = StructType([
        StructField("trip_id", StringType()),
        StructField("speed_kmph", StringType()),
        StructField("zeta", IntegerType()),
        StructField("alpha", LongType()),
    ] + [f for f in PAYLOAD_SCHEMA if f.name not in ("trip_id", "speed_kmph", "car_id")])
    assert schema_diff(actual) == [
        "Missing column: car_id",
        "Type mismatch for column 'speed_kmph': expected DoubleType(), got StringType()",
        "Unexpected column: alpha",
        "Unexpected column: zeta",
    ]


def test_schema_diff_ignores_order_and_nullability():
    reordered = StructType([StructField(f.name, f.dataType, False) for f in reversed(PAYLOAD_SCHEMA)])
    assert schema_diff(reordered) == []


def test_batch_route(spark):
    df = spark.createDataFrame([(1, 2.0)], "a int, b double")
    expected = StructType([StructField("a", IntegerType()), StructField("b", DoubleType())])
    assert batch_route(df, expected) == ("clean", [])
    drift = StructType([StructField("a", IntegerType()), StructField("b", StringType())])
    target, reasons = batch_route(df, drift)
    assert target == "corrupt" and reasons == [
        "Type mismatch for column 'b': expected StringType(), got DoubleType()"
    ]


REQUIRED = [
    (GOOD, None),
    ('{"firmware":"v2",' + GOOD[1:], None),
    (with_field("timestamp", '"yesterday"'), None),
    (with_field("speed_kmph", '"50.1"'), None),
    (with_field("speed_kmph", '"fast"'), "Field required or invalid: speed_kmph"),
    (with_field("fuel_level", "null"), "Field required or invalid: fuel_level"),
    (with_field("fuel_level", None), "Field required or invalid: fuel_level"),
    ("hello", "Malformed JSON"),
]


def test_required_fields(spark):
    df = spark.createDataFrame([(t,) for t, _ in REQUIRED], "value string")
    why = required_fields_errors(F.col("value"), text_fields=TIMESTAMP_FIELDS)
    got = [r["w"] for r in df.select(why.alias("w")).collect()]
    assert got == [e for _, e in REQUIRED]


def test_required_fields_in_steps(spark):
    """The staged form gives the same, and refuses trailing content."""
    cases = REQUIRED + [(GOOD + GOOD, "Malformed JSON"), (GOOD + " x", "Malformed JSON"), (None, "Malformed JSON")]
    df = spark.createDataFrame(list(enumerate(t for t, _ in cases)), "i int, value string")
    out = with_required_fields(df, "value", text_fields=TIMESTAMP_FIELDS)
    assert out.columns == ["i", "value", "refusal_reason"]
    got = [r["refusal_reason"] for r in out.orderBy("i").collect()]
    assert got == [e for _, e in cases]


def test_malformed_text_is_kept(spark, scratch):
    """A record the parsers refuse reaches the corrupt table with its text."""
    from telemetry_qc.plans.process import process
    from telemetry_qc.schemas import ENVELOPE_SCHEMA

    bad = with_field("trip_id", '"a\tb"')
    env = spark.createDataFrame(
        [(b"k", t.encode(), "t", 0, i, None) for i, t in enumerate([GOOD, bad])], ENVELOPE_SCHEMA
    )
    out = process(env, stage_path=scratch("malformed")).outputs
    assert [r["value_str"] for r in out["corrupt_records"].collect()] == [bad]
    assert out["qc_failed_table"].count() == 0


def test_required_fields_without_coercion(spark):
    rows = [GOOD, with_field("speed_kmph", '"50.1"'), with_field("speed_kmph", "50")]
    df = spark.createDataFrame([(t,) for t in rows], "value string")
    strict = required_fields_errors(F.col("value"), text_fields=TIMESTAMP_FIELDS,
                                    coerce_numeric_text=False)
    got = [r["w"] for r in df.select(strict.alias("w")).collect()]
    assert got == [None, "Field required or invalid: speed_kmph", None]
