"""Schema contract: batch-level schema diff and row-level validation.

``schema_diff`` compares a frame's schema with the expected one on the driver
(metadata only, no job).  ``contract_errors`` states, per row, why a JSON text
breaks the contract, as column expressions over the parse results: no UDF, no
shuffle.  The parses are expressions that Spark evaluates outside generated
code; the reasons over their results are inside it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType, TimestampType

from ..functions.decode import (
    CONTRACT_PARSE_OPTIONS,
    CORRUPT_FIELD,
    contract_parse_options,
    one_value,
    raw_fields,
    typed_payload,
    wall_clock_schema,
    with_corrupt_field,
    zoned_as_wall_clock,
)
from ..schemas import PAYLOAD_SCHEMA

# --- fixed values: discrepancy messages and their separator ---
MISSING = "Missing column: "
UNEXPECTED = "Unexpected column: "
MISMATCH = "Type mismatch for column '{name}'"
MISMATCH_TYPES = "Type mismatch for column '{name}': expected {expected}, got {actual}"
SEP = "; "
# --- end of fixed values ---

# Reason for a text that is not one JSON object (row-level contract only).
MALFORMED = "Malformed JSON"


@dataclass(frozen=True)
class SchemaChange:
    """One difference between two schemas, at ``path``: ``missing``,
    ``unexpected`` or ``mismatch``."""

    path: str
    change: str
    expected: str | None
    actual: str | None

    def message(self) -> str:
        if self.change == "missing":
            return MISSING + self.path
        if self.change == "unexpected":
            return UNEXPECTED + self.path
        return MISMATCH_TYPES.format(name=self.path, expected=self.expected, actual=self.actual)


def _schema_of(df_or_schema: DataFrame | StructType) -> StructType:
    return df_or_schema if isinstance(df_or_schema, StructType) else df_or_schema.schema


def _type_text(t: DataType) -> str:
    return repr(t)


def schema_diff(
    df_or_schema: DataFrame | StructType, expected: StructType = PAYLOAD_SCHEMA
) -> list[str]:
    """Name and type differences between a frame's schema and ``expected``.

    Nullability and column order are ignored.  Messages follow the expected
    schema's order (missing columns and type mismatches), then the unexpected
    column names sorted, so the text is the same on every run.
    """
    actual = {f.name: f.dataType for f in _schema_of(df_or_schema)}
    wanted = {f.name: f.dataType for f in expected}
    out: list[str] = []
    for name, t in wanted.items():
        if name not in actual:
            out.append(MISSING + name)
        elif actual[name] != t:
            out.append(
                MISMATCH_TYPES.format(
                    name=name, expected=_type_text(t), actual=_type_text(actual[name])
                )
            )
    out.extend(UNEXPECTED + n for n in sorted(set(actual) - set(wanted)))
    return out


def tree_diff(df_or_schema: DataFrame | StructType, expected: StructType) -> list[SchemaChange]:
    """``schema_diff`` down to the fields of structs, the elements of arrays
    and the keys and values of maps, each named by its path: ``a.b``,
    ``a.element``, ``m.key``, ``m.value``.  What is missing, unexpected or of
    another kind is reported once, at the top of its subtree.  Nullability and
    order are ignored; the changes follow the expected tree, then the
    unexpected names sorted, level by level.
    """
    return _tree_changes(_schema_of(df_or_schema), expected, "")


def _tree_changes(actual: DataType, expected: DataType, path: str) -> list[SchemaChange]:
    if isinstance(actual, StructType) and isinstance(expected, StructType):
        below = lambda name: f"{path}.{name}" if path else name
        there, out = {f.name: f.dataType for f in actual}, []
        for f in expected:
            if f.name in there:
                out += _tree_changes(there[f.name], f.dataType, below(f.name))
            else:
                out.append(SchemaChange(below(f.name), "missing", _type_text(f.dataType), None))
        extra = sorted(set(there) - set(expected.names))
        return out + [SchemaChange(below(n), "unexpected", None, _type_text(there[n])) for n in extra]
    if isinstance(actual, ArrayType) and isinstance(expected, ArrayType):
        return _tree_changes(actual.elementType, expected.elementType, f"{path}.element")
    if isinstance(actual, MapType) and isinstance(expected, MapType):
        return _tree_changes(actual.keyType, expected.keyType, f"{path}.key") + _tree_changes(
            actual.valueType, expected.valueType, f"{path}.value"
        )
    if actual == expected:
        return []
    return [SchemaChange(path, "mismatch", _type_text(expected), _type_text(actual))]


def _join_reasons(parts: list[Column]) -> Column:
    """Non-NULL parts joined by "; "; NULL when there are none.

    ``concat_ws`` skips NULLs, so no array or lambda is needed and the
    expression stays inside whole-stage code generation."""
    return F.nullif(F.concat_ws(SEP, *parts), F.lit(""))


def contract_errors(
    keys: Column,
    parsed: Column,
    raw: Column,
    expected: StructType = PAYLOAD_SCHEMA,
    allow_unexpected: bool = False,
    parsed_fields: tuple[str, ...] = (),
) -> Column:
    """Why a JSON text breaks the contract, or NULL when it keeps it.

    ``keys`` is ``json_object_keys(text)`` (NULL unless the text is one
    strict JSON object), ``parsed`` the typed ``from_json`` and ``raw`` the
    raw key -> text map of the record (it may be NULL for records whose typed
    parse flagged no failure: they cannot hold a type mismatch).  Reasons,
    joined by "; ": ``Malformed JSON`` alone when ``keys`` is NULL, or when the
    typed parse refused the text (``CORRUPT_FIELD`` is set) and nothing else
    tells why, such as a raw control character in a string; else every
    expected key absent (``Missing column: X``, expected order), every other
    key (``Unexpected column: X``, sorted), then every field whose raw value
    is present but did not parse to its type (``Type mismatch for column
    'X'``).  An explicit JSON ``null`` is not a violation (QC handles nulls).

    Every part is NULL when ``keys`` is NULL, so "Malformed JSON" stands
    alone without an enclosing CASE.  Measured on 1M records: the contract
    adds about 15% to the two parses.
    """
    names = F.array(*(F.lit(n) for n in expected.names))
    # Most records carry exactly the expected keys in the expected order:
    # one array comparison settles both key checks for them, and the set
    # differences are computed only for the others.
    odd_keys = keys != names
    parts = [
        F.when(keys.isNull(), F.lit(MALFORMED)),
        F.when(odd_keys, _listed(MISSING, F.array_except(names, keys))),
    ]
    if not allow_unexpected:
        extra = F.sort_array(F.array_except(keys, names))
        parts.append(F.when(odd_keys, _listed(UNEXPECTED, extra)))
    # ``raw`` is NULL unless the typed parse flagged a failure.
    mismatch = [
        F.when(
            raw[n].isNotNull() & parsed[n].isNull(),
            F.lit(MISMATCH.format(name=n)),
        )
        for n in expected.names
    ]
    parts.append(F.when(raw.isNotNull(), _join_reasons(mismatch)))
    reasons = _join_reasons(parts)
    if CORRUPT_FIELD not in parsed_fields:
        return reasons
    # Flagged, and no raw map to say which field: the parsers refused it.
    unread = parsed[CORRUPT_FIELD].isNotNull() & raw.isNull()
    return F.coalesce(reasons, F.when(unread, F.lit(MALFORMED)))


def _listed(prefix: str, names: Column) -> Column:
    """``prefix`` before each name, joined by "; "; NULL for an empty list."""
    return F.when(
        F.size(names) > 0, F.concat(F.lit(prefix), F.array_join(names, SEP + prefix))
    )


def with_contract(
    df: DataFrame,
    text: str = "value_str",
    expected: StructType = PAYLOAD_SCHEMA,
    allow_unexpected: bool = False,
) -> DataFrame:
    """Adds ``parsed`` (typed fields) and ``error_reason`` to ``df``.

    Three projections, none of them shuffling:

    1. the typed parse, which also flags any field that failed its type
       (``columnNameOfCorruptRecord``), and the object's key list;
    2. the raw key -> text map, built only for flagged records (a separate
       projection, so it stays conditional);
    3. the contract expression over keys, typed fields and raw map.

    A record without type failures costs one typed parse and one key scan.
    Times are parsed as wall clock, so a time without zone is kept as it
    stands, also one that a change of clocks skips; a time with a zone, or a
    number of seconds, becomes wall clock in the session's zone.
    """
    t = F.col(text)
    schema = with_corrupt_field(wall_clock_schema(expected))
    flagged = typed_payload(t, schema, contract_parse_options())
    keys = F.when(one_value(t), F.json_object_keys(t))
    step1 = df.select("*", flagged.alias("parsed"), keys.alias("_keys"))
    step2 = step1.select(
        "*",
        F.when(F.col("parsed")[CORRUPT_FIELD].isNotNull(), raw_fields(t)).alias("_raw"),
    )
    raw = F.col("_raw")
    # Only flagged records have a raw map, and so a time with a zone.
    parsed = F.col("parsed")
    for f in expected:
        if isinstance(f.dataType, TimestampType):
            time = F.coalesce(F.col("parsed")[f.name], zoned_as_wall_clock(raw[f.name]))
            parsed = parsed.withField(f.name, time)
    # Flagged without a raw map: the parsers refused the text (single quotes,
    # a raw control character), and its keys mean nothing.
    refused = F.col("parsed")[CORRUPT_FIELD].isNotNull() & raw.isNull()
    step3 = step2.withColumns({"parsed": parsed, "_keys": F.when(~refused, F.col("_keys"))})
    return step3.select(
        *df.columns,
        "parsed",
        contract_errors(
            F.col("_keys"), F.col("parsed"), raw, expected, allow_unexpected, tuple(schema.names)
        ).alias("error_reason"),
    )


def required_fields_errors(
    text: Column,
    expected: StructType = PAYLOAD_SCHEMA,
    text_fields: tuple[str, ...] = (),
    raw: Column | None = None,
    coerce_numeric_text: bool = True,
    parsed: Column | None = None,
) -> Column:
    """Validation of an ingest gateway's request model (all fields required).

    The text must be one JSON object; every expected key must be present and
    non-null; extra keys are ignored; ``text_fields`` only need to be
    present.  Numeric fields accept numbers and, with
    ``coerce_numeric_text``, numeric text (``try_cast``); without it they
    must be JSON numbers, judged by the typed parse ``parsed`` (default:
    ``from_json(text, expected)``).  Returns the reasons joined by "; ", or
    NULL when accepted.
    """
    raw = raw if raw is not None else raw_fields(text)
    if not coerce_numeric_text and parsed is None:
        parsed = typed_payload(text, expected, CONTRACT_PARSE_OPTIONS)
    parts = [F.when(raw.isNull(), F.lit(MALFORMED))]
    for f in expected:
        v = raw[f.name]
        if f.name in text_fields or f.dataType.typeName() == "string":
            bad = v.isNull()
        elif coerce_numeric_text:
            bad = v.isNull() | v.try_cast(f.dataType).isNull()
        else:
            bad = v.isNull() | parsed[f.name].isNull()
        parts.append(
            F.when(raw.isNotNull() & bad, F.lit(f"Field required or invalid: {f.name}"))
        )
    return _join_reasons(parts)


def with_required_fields(
    df: DataFrame,
    text: str = "value_str",
    expected: StructType = PAYLOAD_SCHEMA,
    text_fields: tuple[str, ...] = (),
) -> DataFrame:
    """Adds ``refusal_reason`` to ``df``: ``required_fields_errors`` with
    numeric text accepted.  The raw map is built only for texts whose typed
    parse left something open: it flagged a failure, or a field is NULL."""
    t = F.col(text)
    typed = typed_payload(t, with_corrupt_field(wall_clock_schema(expected)), contract_parse_options())
    step1 = df.select("*", typed.alias("_typed"), one_value(t).alias("_one"))
    plain = F.col("_one") & F.col("_typed")[CORRUPT_FIELD].isNull()
    for n in expected.names:
        plain &= F.col("_typed")[n].isNotNull()
    step2 = step1.withColumn("_open", F.coalesce(~plain, F.lit(True)))
    step3 = step2.withColumn("_raw", F.when(F.col("_open") & F.col("_one"), raw_fields(t)))
    why = required_fields_errors(t, expected, text_fields, raw=F.col("_raw"))
    return step3.select(*df.columns, F.when(F.col("_open"), why).alias("refusal_reason"))


def batch_route(
    batch: DataFrame, expected: StructType = PAYLOAD_SCHEMA, deep: bool = False
) -> tuple[str, list[str]]:
    """Batch-level routing: ``("corrupt", reasons)`` if the batch's schema
    differs from ``expected`` in any name or type, else ``("clean", [])``.
    With ``deep`` the reasons name the inner fields (``tree_diff``).

    Decided from metadata alone, so it costs no job.
    """
    reasons = [c.message() for c in tree_diff(batch, expected)] if deep else schema_diff(batch, expected)
    return ("corrupt" if reasons else "clean"), reasons


def route_by_schema(
    df: DataFrame, expected: StructType = PAYLOAD_SCHEMA, deep: bool = False
) -> DataFrame:
    """Batch-level routing of a whole frame: every row gets ``route``
    ('corrupt' when the frame's schema differs from ``expected``, else
    'clean') and ``error_reason`` (the differences joined by "; ", or NULL).

    The decision is made once from metadata; the rows are only projected.
    """
    target, reasons = batch_route(df, expected, deep)
    reason = F.lit(SEP.join(reasons)) if reasons else F.lit(None).cast("string")
    return df.select("*", F.lit(target).alias("route"), reason.alias("error_reason"))
