"""Data checks compiled to a few aggregates per table."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCKING, WARNING = "blocking", "warning"

# The published names of the check types.
ROW_COUNT = "expect_table_row_count_to_be_between"
NOT_NULL = "expect_column_values_to_not_be_null"
UNIQUE = "expect_column_values_to_be_unique"
IN_SET = "expect_column_values_to_be_in_set"
BETWEEN = "expect_column_values_to_be_between"
MEAN_BETWEEN = "expect_column_mean_to_be_between"


@dataclass(frozen=True)
class Check:
    """One check. ``low``/``high`` are inclusive; None leaves a side open."""

    kind: str
    column: str | None = None
    low: float | None = None
    high: float | None = None
    values: tuple = ()
    severity: str = BLOCKING


def outside(value: Column, low, high) -> Column:
    """True where a non-null value leaves [low, high]."""
    rules = []
    if low is not None:
        rules.append(value < low)
    if high is not None:
        rules.append(value > high)
    return reduce(or_, rules)


def _measure(check: Check) -> Column:
    """The aggregate behind a check: an observed value or an unexpected count."""
    value = F.col(check.column) if check.column else None
    if check.kind == ROW_COUNT:
        return F.count(F.lit(1))
    if check.kind == NOT_NULL:
        return F.count_if(value.isNull())
    if check.kind == IN_SET:
        return F.count_if(~value.isin(*check.values))
    if check.kind == BETWEEN:
        return F.count_if(outside(value, check.low, check.high))
    if check.kind == MEAN_BETWEEN:
        return F.avg(value)
    raise ValueError(f"unknown check {check.kind}")


def _result(check: Check, position: int, measured: Column) -> Column:
    if check.kind in (ROW_COUNT, MEAN_BETWEEN):
        success = F.coalesce(~outside(measured, check.low, check.high), F.lit(False))
        observed, unexpected = measured.cast("string"), F.lit(None).cast("long")
    else:
        success, observed, unexpected = measured == 0, F.lit(None).cast("string"), measured
    return F.struct(
        F.lit(position).alias("position"),
        F.lit(check.kind).alias("expectation_type"),
        F.lit(check.column).cast("string").alias("column_name"),
        F.lit(check.severity).alias("severity"),
        success.alias("success"),
        observed.alias("observed_value"),
        unexpected.cast("long").alias("unexpected_count"),
    )


def repeated_rows(df: DataFrame, column: str) -> DataFrame:
    """One row: how many rows share their non-null value with another row.

    Counts are combined before the shuffle, so one very frequent value is cheap.
    """
    per_value = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    return per_value.agg(F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0)).alias("measured"))


def run_checks(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """One row per check, in order of ``position``.

    Everything but uniqueness is a single pass; each uniqueness check adds one
    pass over its own column only.
    """
    parts = []
    single = [(i, c) for i, c in enumerate(checks) if c.kind != UNIQUE]
    if single:
        measured = df.agg(*[_measure(c).alias(f"m{i}") for i, c in single])
        rows = [_result(c, i, F.col(f"m{i}")) for i, c in single]
        parts.append(measured.select(F.inline(F.array(*rows))))
    for i, check in enumerate(checks):
        if check.kind == UNIQUE:
            row = _result(check, i, F.col("measured"))
            parts.append(repeated_rows(df, check.column).select(F.inline(F.array(row))))
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def not_null_failures(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column_name, failures): rows where the column is NULL, one pass for all."""
    counted = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    rows = [F.struct(F.lit(c).alias("column_name"), F.col(c).alias("failures")) for c in columns]
    return counted.select(F.inline(F.array(*rows)))


def unique_failures(df: DataFrame, column: str) -> DataFrame:
    """(column_name, failures): how many non-null values occur more than once."""
    per_value = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    return per_value.agg(F.count_if(F.col("n") > 1).alias("failures")).select(
        F.lit(column).alias("column_name"), "failures"
    )


def accepted_values_failures(df: DataFrame, column: str, accepted: Sequence) -> DataFrame:
    """(column_name, value, n_records) per value outside the list; NULL passes."""
    return (
        df.filter(~F.col(column).isin(*accepted))
        .groupBy(F.col(column).cast("string").alias("value"))
        .agg(F.count(F.lit(1)).alias("n_records"))
        .select(F.lit(column).alias("column_name"), "value", "n_records")
    )


def fk_orphans(child: DataFrame, column: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """(orphan, n_rows): non-null child values no parent row has.

    The child is folded to one row per value before the join, so a value that
    fills most of the child joins once.
    """
    values = (
        child.filter(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("orphan"))
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )
    keys = parent.select(F.col(parent_key).alias("orphan"))
    return values.join(keys, "orphan", "left_anti")
