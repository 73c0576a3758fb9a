"""Vehicle-level QC roll-up (data side of a per-vehicle QC dashboard)."""

from __future__ import annotations

from functools import reduce
from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .qc import DEFAULT_RULES, FAIL, Rule, rule_fails


def failed_cells(rules: Sequence[Rule], df: DataFrame | None = None):
    """Number of ruled cells of a row that fail (an INT column expression)."""
    schema = df.schema if isinstance(df, DataFrame) else df
    flags = [F.when(rule_fails(r, schema), 1).otherwise(0) for r in rules]
    return reduce(lambda a, b: a + b, flags)


def vehicle_qc(
    checked: DataFrame, rules: Sequence[Rule] = DEFAULT_RULES, *keys: str
) -> DataFrame:
    """Per vehicle (or other ``keys``): ``rows_checked``, ``rows_failed``,
    ``cells_failed``.

    ``checked`` holds schema-valid rows with ``qc_status``.  A plain
    ``groupBy().agg()``: every task pre-aggregates its rows (partial
    aggregation) before the shuffle, so the shuffle carries one row per
    vehicle per task, however many rows a single busy vehicle sends.
    """
    return checked.groupBy(*(keys or ("car_id",))).agg(*rollup_sums(checked, rules))


def rollup_sums(checked: DataFrame, rules: Sequence[Rule] = DEFAULT_RULES) -> list[Column]:
    """The roll-up's aggregates; sums of them over parts are those of the whole."""
    return [
        F.count(F.lit(1)).alias("rows_checked"),
        F.count(F.when(F.col("qc_status") == FAIL, 1)).alias("rows_failed"),
        F.sum(failed_cells(rules, checked)).cast("bigint").alias("cells_failed"),
    ]
