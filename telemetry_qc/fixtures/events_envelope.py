"""Kafka-shaped record envelope derived from the ``events`` table.

No broker is available for tests and benchmarks, so this builds the records a
device fleet would publish, one per ``events`` row, with the same columns a
Kafka source delivers (``key``, ``value`` as BINARY, ``topic``, ``partition``,
``offset``, ``timestamp``).  Every 40th-residue class of ``event_id`` carries a
known defect so the corrupt and QC paths are exercised; see FIXTURES.md.

It is a pure projection of ``events``: no shuffle, scales with the table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TOPIC = "telemetry"
N_CLASSES = 40
N_CARS = 20
N_PARTITIONS = 5


def _q(text: Column) -> Column:
    """JSON string literal around an already safe text."""
    return F.concat(F.lit('"'), text, F.lit('"'))


def _pair(key: str, value: Column) -> Column:
    return F.concat(F.lit(f'"{key}":'), value)


def _pieces(events: DataFrame) -> DataFrame:
    """Per row: the defect class, the good JSON text and the edited one.

    A projection of its own, so the shared pieces (timestamp text, good
    object) are computed once per row and not once per CASE branch."""
    eid, uid = F.col("event_id"), F.col("user_id")
    cls = eid % N_CLASSES
    ts_text = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    base = events.select(
        "event_id", "user_id", "ts", "value", cls.alias("cls"), ts_text.alias("ts_text")
    )
    cls, ts_text = F.col("cls"), F.col("ts_text")

    good = {
        "trip_id": _q(F.concat(F.lit("T"), uid.cast("string"))),
        "car_id": _q(F.concat(F.lit("Car_"), (uid % N_CARS).cast("string"))),
        "latitude": F.concat((eid % 90).cast("string"), F.lit(".25")),
        "longitude": F.lit("88.5"),
        "timestamp": _q(ts_text),
        "speed_kmph": F.col("value").cast("string"),
        "fuel_level": F.concat((eid % 121).cast("string"), F.lit(".0")),
        "engine_temp_c": F.concat((F.lit(60) + eid % 71).cast("string"), F.lit(".5")),
        "trip_start_time": _q(F.concat(F.substring(ts_text, 1, 10), F.lit("T00:00:00"))),
        "trip_start_latitude": F.lit("22.5"),
        "trip_start_longitude": F.lit("88.25"),
    }

    # Per-class edits of single pairs; a NULL pair is dropped by concat_ws.
    value_edits = {
        "speed_kmph": {5: F.lit('"fast"')},
        "timestamp": {6: F.lit('"yesterday"')},
        "fuel_level": {8: F.lit("null")},
        "latitude": {9: F.lit("95.0")},
    }
    pairs = []
    for key, text in good.items():
        edited = text
        for c, alt in value_edits.get(key, {}).items():
            edited = F.when(cls == c, alt).otherwise(edited)
        if key == "fuel_level":
            pair = F.when(cls == 3, F.lit(None).cast("string")).otherwise(_pair(key, edited))
        elif key == "car_id":
            pair = F.when(cls == 7, _pair("Car_ID", edited)).otherwise(_pair(key, edited))
        else:
            pair = _pair(key, edited)
        pairs.append(pair)

    edited_obj = F.concat(
        F.lit("{"),
        F.when(cls == 4, F.lit('"firmware":"v2",')).otherwise(F.lit("")),
        F.concat_ws(",", *pairs),
        F.lit("}"),
    )
    good_obj = F.concat(
        F.lit("{"), F.concat_ws(",", *(_pair(k, v) for k, v in good.items())), F.lit("}")
    )
    # Only classes 3-9 edit single pairs; other rows skip building that text.
    edited = F.when(cls.between(3, 9), edited_obj)
    return base.select(
        "event_id", "user_id", "ts", "cls", good_obj.alias("good"), edited.alias("edited")
    )


def strict_cases(events: DataFrame) -> DataFrame:
    """(event_id, value_str): the good text, by ``event_id % 13`` with a raw
    tab in a string, a raw newline in one, a second object behind it, a comma
    and a second object, other text behind it, a closing bracket, one with
    text, one with a second object, one with a comma before it, single quotes,
    a key given twice (the last counts), the keys in reverse, or as it is but
    for blanks at the end."""
    good, eid = F.col("good"), F.col("event_id")
    inner = F.expr("substring(good, 2, length(good) - 2)")
    backwards = F.concat(
        F.lit("{"), F.array_join(F.reverse(F.split(inner, ",")), ","), F.lit("}")
    )
    texts = [
        F.replace(good, F.lit('"T'), F.lit('"T\t')),
        F.replace(good, F.lit('"T'), F.lit('"T\n')),
        F.concat(good, good),
        F.concat(good, F.lit(","), good),
        F.concat(good, F.lit(" xyz")),
        F.concat(good, F.lit("]")),
        F.concat(good, F.lit("] xyz")),
        F.concat(good, F.lit("]"), good),
        F.concat(good, F.lit(",1]")),
        F.replace(good, F.lit('"'), F.lit("'")),
        F.concat(F.lit('{"latitude":1.5,'), inner, F.lit("}")),
        backwards,
        F.concat(good, F.lit(" \n ")),
    ]
    text = F.when(eid % len(texts) == 0, texts[0])
    for i, t in enumerate(texts[1:], 1):
        text = text.when(eid % len(texts) == i, t)
    return _pieces(events).select("event_id", text.alias("value_str"))


def payload_text() -> Column:
    """The defect-injected JSON text, over the columns of ``_pieces``."""
    cls, good = F.col("cls"), F.col("good")
    return (
        F.when(cls == 0, F.substring(good, 1, 60))
        .when(cls == 1, F.lit("hello"))
        .when(cls == 2, F.lit(None).cast("string"))
        .when(cls == 10, F.concat(F.lit("["), good, F.lit("]")))
        .otherwise(F.coalesce(F.col("edited"), good))
    )


def envelope_from_events(events: DataFrame) -> DataFrame:
    """Kafka-shaped envelope, one record per ``events`` row."""
    uid = F.col("user_id")
    return _pieces(events).select(
        F.concat(F.lit("Car_"), (uid % N_CARS).cast("string")).cast("binary").alias("key"),
        payload_text().cast("binary").alias("value"),
        F.lit(TOPIC).alias("topic"),
        (uid % N_PARTITIONS).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
        F.col("ts").cast("timestamp").alias("timestamp"),
    )
