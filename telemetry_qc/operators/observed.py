"""What a topic's texts hold: the keys of its JSON objects and the types of
their values, in one pass, against the expected schema.

The types come from Spark's variant parse, so they are those of the texts and
not of the schema that the records are parsed with.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType,
    DataType,
    DateType,
    NumericType,
    StringType,
    StructType,
    TimestampNTZType,
    TimestampType,
)

from ..functions.decode import one_value
from ..schemas import PAYLOAD_SCHEMA

NUMBERS = ("BIGINT", "DECIMAL", "DOUBLE")


def accepted(kind: DataType) -> tuple[str, ...]:
    """Variant types that a declared type may be read from; VOID, JSON's
    null, goes with any."""
    if isinstance(kind, NumericType):
        return (*NUMBERS, "VOID")
    if isinstance(kind, BooleanType):
        return ("BOOLEAN", "VOID")
    if isinstance(kind, (TimestampType, TimestampNTZType)):
        return ("STRING", *NUMBERS, "VOID")  # a text, or seconds
    if isinstance(kind, (StringType, DateType)):
        return ("STRING", "VOID")
    return ("OBJECT", "ARRAY", "VOID")


def observed_types(records: DataFrame, text: str = "value_str", by: tuple[str, ...] = ()) -> DataFrame:
    """``by``, key, observed_type, records: how many objects hold the key
    with a value of that type (BIGINT, DECIMAL, DOUBLE, STRING, BOOLEAN, VOID,
    OBJECT or ARRAY).  Texts that are not one JSON object have no keys.

    Partial aggregation: a task sends one row per key and type it has met."""
    one = F.when(one_value(F.col(text)), F.try_parse_json(text))
    # A variant read as a map has a variant for each key; NULL if no object.
    fields = F.try_variant_get(one, "$", "map<string, variant>")
    cells = records.select(*by, F.explode(fields).alias("key", "value"))
    kind = F.regexp_extract(F.schema_of_variant("value"), r"^\w+", 0)
    return cells.groupBy(*by, "key", kind.alias("observed_type")).agg(F.count(F.lit(1)).alias("records"))


def observed_schema(
    records: DataFrame, text: str = "value_str", expected: StructType = PAYLOAD_SCHEMA, by: tuple[str, ...] = ()
) -> DataFrame:
    """``observed_types`` with the expected type and a finding: ``ok``,
    ``type`` (a value the type can't be read from) or ``unexpected``; for every
    expected key that some texts lack, a row more, without observed type,
    that counts them as ``missing`` (texts that are no object among them)."""
    types = observed_types(records, text, by)
    wanted = records.sparkSession.createDataFrame(
        [(f.name, f.dataType.simpleString(), list(accepted(f.dataType))) for f in expected],
        "key string, expected_type string, accepted array<string>",
    )
    wanted = F.broadcast(wanted)  # a row for each field of the schema
    finding = (
        F.when(F.col("expected_type").isNull(), "unexpected")
        .when(F.array_contains("accepted", F.col("observed_type")), "ok")
        .otherwise("type")
    )
    names = [*by, "key", "observed_type", "records", "expected_type", "finding"]
    there = types.join(wanted, "key", "left").withColumn("finding", finding)
    # Every expected key of every group, counted from the rows above.
    totals = records.groupBy(*by).agg(F.count(F.lit(1)).alias("total"))
    held = types.groupBy(*by, "key").agg(F.sum("records").alias("held"))
    every = totals.withColumn("key", F.explode(F.array(*(F.lit(n) for n in expected.names))))
    every = every.join(wanted, "key")
    same = [every[c].eqNullSafe(held[c]) for c in (*by, "key")]
    lacking = every.join(held, same, "left").select(
        *(every[c] for c in (*by, "key")),
        F.lit(None).cast("string").alias("observed_type"),
        (F.col("total") - F.coalesce("held", F.lit(0))).alias("records"),
        "expected_type",
        F.lit("missing").alias("finding"),
    )
    return there.select(*names).unionByName(lacking.where("records > 0").select(*names))
