"""Column functions for decoding records: bytes to text, text to typed fields.

All are built-in Spark expressions (no UDF), so they run JVM-side and compose
into any projection, batch or streaming.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    MapType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
    TimestampType,
)

from ..schemas import PAYLOAD_SCHEMA

# Options of the parses used by the row contract: strict JSON, so a text with
# a non-numeric literal such as NaN, or with single quotes, is not one JSON
# object and is reported as malformed.
CONTRACT_PARSE_OPTIONS = {"allowNonNumericNumbers": "false", "allowSingleQuotes": "false"}

RAW_MAP = MapType(StringType(), StringType())

# Field the typed parse fills with the record's text when any value fails to
# parse to its declared type (or the text is not JSON at all).
CORRUPT_FIELD = "_unparsed_text"


def with_corrupt_field(schema: StructType) -> StructType:
    return StructType(list(schema.fields) + [StructField(CORRUPT_FIELD, StringType())])


def wall_clock_schema(schema: StructType) -> StructType:
    """``schema`` with its timestamps as wall-clock times (TIMESTAMP_NTZ)."""
    return StructType(
        [
            StructField(f.name, TimestampNTZType(), f.nullable)
            if isinstance(f.dataType, TimestampType)
            else f
            for f in schema
        ]
    )


def zoned_as_wall_clock(text: Column) -> Column:
    """Wall-clock time in the session zone of a text with a zone, or of a
    number of seconds since the epoch; NULL for any other text."""
    zoned = F.when(text.rlike(r"(?:[Zz]|[+-]\d\d:?\d\d)$"), text.try_cast("timestamp"))
    epoch = F.when(text.rlike(r"^-?\d+(?:\.\d+)?$"), text.try_cast("double").try_cast("timestamp"))
    return F.coalesce(zoned, epoch).cast("timestamp_ntz")


def one_value(text: Column) -> Column:
    """False where other text follows the first JSON value, which the parsers
    ignore.  Only texts with something behind their first closing brace are
    looked at more closely: as an array of the text and a mark.  The mark is
    the second element only if the text is one value; it is a hash of the
    text, which the text can't hold itself."""
    body = F.rtrim(text, F.lit(" \t\r\n"))
    mark = F.xxhash64(text).cast("string")
    second = F.get_json_object(F.concat(F.lit("["), text, F.lit(","), mark, F.lit("]")), "$[1]")
    return F.when(F.instr(body, "}") < F.length(body), F.coalesce(second == mark, F.lit(False))).otherwise(True)


def contract_parse_options() -> dict[str, str]:
    return {**CONTRACT_PARSE_OPTIONS, "columnNameOfCorruptRecord": CORRUPT_FIELD}


def as_text(c: Column | str) -> Column:
    """``cast(binary as string)`` (UTF-8), as done for Kafka key and value."""
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def typed_payload(
    text: Column | str,
    schema: StructType = PAYLOAD_SCHEMA,
    options: dict[str, str] | None = None,
) -> Column:
    """``from_json`` in the default permissive mode.

    Malformed text gives a struct of NULLs (a NULL struct for NULL or blank
    text); a field whose value does not fit its type is NULL, others are kept.
    """
    return F.from_json(text, schema, options or {})


def raw_fields(text: Column | str) -> Column:
    """The object's top-level keys with their raw text values.

    NULL when the text is not one strict JSON object (malformed, truncated,
    an array, NULL, blank, or holding a non-numeric literal such as NaN).
    JSON ``null`` values map to NULL; strings lose their quotes; nested
    values keep their JSON text.
    """
    return F.from_json(text, RAW_MAP, CONTRACT_PARSE_OPTIONS)


def decode_envelope(env: DataFrame, timestamp: bool = False) -> DataFrame:
    """Record envelope -> text value plus the record coordinates; with
    ``timestamp`` also the record's time as wall clock."""
    more = [F.col("timestamp").cast("timestamp_ntz").alias("kafka_timestamp")] if timestamp else []
    return env.select(
        as_text("value").alias("value_str"),
        as_text("key").alias("message_key"),
        F.col("topic").alias("topic_name"),
        F.col("partition").alias("kafka_partition"),
        F.col("offset").alias("kafka_offset"),
        *more,
    )
