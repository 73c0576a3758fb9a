"""Declarative column-level quality control: nulls, thresholds, bounds.

Rules are data.  Each rule becomes one reason expression per row; the row's
status, summary and the cell-wise audit are derived from those expressions,
all as built-in column functions (no UDF, no shuffle).
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, StructType

# --- fixed values: row QC status ---
SUCCESS = "success"
FAIL = "fail"
# --- end of fixed values ---
SEP = "; "


@dataclass(frozen=True)
class Rule:
    """Checks on one column.

    ``not_null``: NULL fails (null check).  ``min`` / ``max``: inclusive
    limits; one of them is a threshold, both a bounds check.  NaN fails any
    range.  A NULL value passes range checks; only ``not_null`` refuses it.
    """

    column: str
    not_null: bool = True
    min: float | int | None = None
    max: float | int | None = None

    @property
    def has_range(self) -> bool:
        return self.min is not None or self.max is not None

    @classmethod
    def from_dict(cls, d: dict) -> "Rule":
        """``{"column": "speed_kmph", "not_null": true, "min": 0, "max": 200}``
        (``not_null`` defaults to true; ``min`` / ``max`` are optional)."""
        unknown = set(d) - {"column", "not_null", "min", "max"}
        if unknown or "column" not in d:
            raise ValueError(f"bad rule {d!r}: unknown keys {sorted(unknown)}")
        return cls(d["column"], bool(d.get("not_null", True)), d.get("min"), d.get("max"))

    def to_dict(self) -> dict:
        out = {"column": self.column, "not_null": self.not_null}
        if self.min is not None:
            out["min"] = self.min
        if self.max is not None:
            out["max"] = self.max
        return out


def rules_from_config(items: Sequence[dict]) -> tuple[Rule, ...]:
    """Rules from plain data (e.g. a JSON or YAML file), in the given order."""
    rules = tuple(Rule.from_dict(d) for d in items)
    names = [r.column for r in rules]
    if len(set(names)) != len(names):
        raise ValueError("one rule per column")
    return rules


def null_check(column: str) -> Rule:
    return Rule(column, not_null=True)


def threshold(column: str, *, min=None, max=None, not_null: bool = True) -> Rule:
    if (min is None) == (max is None):
        raise ValueError("a threshold has exactly one of min / max")
    return Rule(column, not_null, min, max)


def bounds(column: str, lo, hi, not_null: bool = True) -> Rule:
    return Rule(column, not_null, lo, hi)


# Default rules (limits inclusive).
DEFAULT_RULES: tuple[Rule, ...] = (
    null_check("trip_id"),
    null_check("car_id"),
    bounds("latitude", -90, 90),
    bounds("longitude", -180, 180),
    null_check("event_timestamp"),
    Rule("speed_kmph", True, 0, 200),
    bounds("fuel_level", 0, 100),
    threshold("engine_temp_c", max=130),
    null_check("trip_start_time"),
    bounds("trip_start_latitude", -90, 90),
    bounds("trip_start_longitude", -180, 180),
)


def _schema(df: DataFrame | StructType | None) -> StructType | None:
    """Resolve a frame's schema once (``DataFrame.schema`` is a JVM round
    trip on every access)."""
    return df.schema if isinstance(df, DataFrame) else df


def _is_floating(schema: StructType | None, column: str) -> bool:
    if schema is None or column not in schema.names:
        return True
    return isinstance(schema[column].dataType, (DoubleType, FloatType))


def rule_reason(rule: Rule, df: DataFrame | StructType | None = None) -> Column:
    """Reason the rule fails on a row (``"<col> null"``, ``"<col> NaN"``,
    ``"<col> below <min>"``, ``"<col> above <max>"``), or NULL if it passes.
    One reason per column, checked in that order; limits print as given."""
    c = F.col(rule.column)
    name = rule.column
    schema = _schema(df)
    out = None

    def add(cond: Column, text: str) -> None:
        nonlocal out
        out = F.when(cond, F.lit(text)) if out is None else out.when(cond, F.lit(text))

    if rule.not_null:
        add(c.isNull(), f"{name} null")
    if rule.has_range and _is_floating(schema, name):
        add(F.isnan(c), f"{name} NaN")
    if rule.min is not None:
        add(c < F.lit(rule.min), f"{name} below {rule.min}")
    if rule.max is not None:
        add(c > F.lit(rule.max), f"{name} above {rule.max}")
    return out if out is not None else F.lit(None).cast("string")


def rule_fails(rule: Rule, df: DataFrame | StructType | None = None) -> Column:
    """TRUE when the rule fails on a row (the same decision as
    ``rule_reason`` without building the text)."""
    c = F.col(rule.column)
    conds = []
    if rule.not_null:
        conds.append(c.isNull())
    if rule.has_range and _is_floating(_schema(df), rule.column):
        conds.append(F.isnan(c))
    if rule.min is not None:
        conds.append(c < F.lit(rule.min))
    if rule.max is not None:
        conds.append(c > F.lit(rule.max))
    if not conds:
        return F.lit(False)
    out = conds[0]
    for x in conds[1:]:
        out = out | x
    return F.coalesce(out, F.lit(False))


def summary(rules: Sequence[Rule], df: DataFrame | None = None) -> Column:
    """Failing rules' reasons in rule order, joined by "; "; NULL if none.

    ``concat_ws`` skips NULLs, so the expression needs no array or lambda and
    stays inside whole-stage code generation."""
    schema = _schema(df)
    parts = [rule_reason(r, schema) for r in rules]
    return F.nullif(F.concat_ws(SEP, *parts), F.lit(""))


def validate_rules(rules: Sequence[Rule], schema: StructType) -> None:
    """Refuse rules that cannot run: unknown columns, ``min`` above ``max``,
    limits on non-numeric columns, two rules for one column."""
    problems = []
    names = [r.column for r in rules]
    if len(set(names)) != len(names):
        problems.append("more than one rule for a column")
    for r in rules:
        if r.column not in schema.names:
            problems.append(f"{r.column}: no such column")
            continue
        if r.min is not None and r.max is not None and r.min > r.max:
            problems.append(f"{r.column}: min {r.min} is above max {r.max}")
        if r.has_range and schema[r.column].dataType.typeName() in ("string", "boolean", "binary"):
            problems.append(f"{r.column}: limits on a {schema[r.column].dataType.typeName()} column")
    if problems:
        raise ValueError("invalid QC rules: " + "; ".join(problems))


def apply_rules(df: DataFrame, rules: Sequence[Rule] = DEFAULT_RULES) -> DataFrame:
    """Adds ``qc_summary`` (reasons joined by "; ", NULL when the row passes)
    and ``qc_status`` ('success' / 'fail')."""
    schema = df.schema
    validate_rules(rules, schema)
    with_summary = df.withColumn("qc_summary", summary(rules, schema))
    return with_summary.withColumn(
        "qc_status",
        F.when(F.col("qc_summary").isNull(), F.lit(SUCCESS)).otherwise(F.lit(FAIL)),
    )


def split_qc(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(passed, failed) by ``qc_status``; complementary filters."""
    return (
        df.filter(F.col("qc_status") == SUCCESS),
        df.filter(F.col("qc_status") == FAIL),
    )


def audit_cells(rules: Sequence[Rule], df: DataFrame | None = None) -> Column:
    """One struct per ruled column: ``column_name, passed, fail_reason``."""
    schema = _schema(df)
    cells = []
    for r in rules:
        why = rule_reason(r, schema)
        cells.append(
            F.struct(
                F.lit(r.column).alias("column_name"),
                why.isNull().alias("passed"),
                why.alias("fail_reason"),
            )
        )
    return F.array(*cells)


def audit(
    df: DataFrame,
    rules: Sequence[Rule] = DEFAULT_RULES,
    checked_at: Column | None = None,
    key_columns: Sequence[str] = ("trip_id",),
    id_columns: Sequence[str] = ("kafka_partition", "kafka_offset"),
    cells: Column | None = None,
) -> DataFrame:
    """Cell-wise audit: one row per (row, ruled column), passed and failed.

    A generator over each row (``inline``); rows never leave their partition.
    ``cells`` may pass ``audit_cells(rules, schema)`` built once, for callers
    that audit many batches of the same schema.
    """
    checked_at = checked_at if checked_at is not None else F.current_timestamp()
    cells = cells if cells is not None else audit_cells(rules, df)
    return df.select(
        *key_columns, *id_columns, checked_at.alias("checked_at"), F.inline(cells)
    ).select(
        *key_columns,
        "column_name",
        "passed",
        "fail_reason",
        "checked_at",
        *id_columns,
    )
