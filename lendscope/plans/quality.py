"""The gold suites, their results, the gate and the summaries."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendscope.functions import round_half_away
from lendscope.operators.checks import (
    BETWEEN,
    BLOCKING,
    IN_SET,
    MEAN_BETWEEN,
    NOT_NULL,
    ROW_COUNT,
    UNIQUE,
    WARNING,
    Check,
    run_checks,
)
from lendscope.plans.gold import SEGMENT_DIMENSIONS

# Rows expected in the client-grained tables of the public client file.
CLIENT_ROWS = (25_000, 35_000)

RESULT_COLUMNS = (
    "run_id",
    "run_at",
    "suite_name",
    "target_table",
    "expectation_type",
    "column_name",
    "severity",
    "success",
    "observed_value",
    "unexpected_count",
)


class GateFailed(RuntimeError):
    """A blocking check failed; nothing may be published."""


def gold_suites(client_rows: tuple[int, int] = CLIENT_ROWS) -> dict[str, list[Check]]:
    """Checks per gold table. Bounds are the fixed values of the data contract."""
    low, high = client_rows
    return {
        "feature_default_prediction": [
            Check(ROW_COUNT, low=low, high=high),
            Check(NOT_NULL, "client_id"),
            Check(UNIQUE, "client_id"),
            Check(NOT_NULL, "is_default"),
            Check(IN_SET, "is_default", values=(0, 1)),
            Check(BETWEEN, "credit_limit", low=0, high=2_000_000),
            Check(BETWEEN, "age", low=18, high=100),
            Check(BETWEEN, "months_delinquent", low=0, high=6),
            Check(MEAN_BETWEEN, "is_default", low=0.15, high=0.30, severity=WARNING),
            Check(BETWEEN, "max_repay_status", low=-2, high=9, severity=WARNING),
        ],
        "dim_borrower": [
            Check(ROW_COUNT, low=low, high=high),
            Check(NOT_NULL, "client_id"),
            Check(UNIQUE, "client_id"),
            Check(IN_SET, "sex", values=("male", "female", "unknown")),
        ],
        "mart_portfolio_risk": [
            Check(ROW_COUNT, low=1, high=100),
            Check(BETWEEN, "default_rate", low=0, high=1),
            Check(BETWEEN, "n_clients", low=1),
            Check(IN_SET, "segment_dimension", values=SEGMENT_DIMENSIONS, severity=WARNING),
        ],
    }


def dq_suite(tables: Mapping[str, DataFrame], suites: Mapping[str, list[Check]]) -> DataFrame:
    """Check results of every suite: suite, table and one row per check."""
    parts = [
        run_checks(tables[name], checks).select(
            F.lit(name).alias("suite_name"), F.lit(f"marts.{name}").alias("target_table"), "*"
        )
        for name, checks in suites.items()
    ]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def run_id_of(run_at: datetime) -> str:
    """Run ids sort as text, so the largest is the newest."""
    return run_at.strftime("%Y%m%dT%H%M%SZ")


def dq_results(suite_rows: DataFrame, run_at: datetime) -> DataFrame:
    """Suite rows stamped with their run, in the stored layout."""
    stamp = run_at.strftime("%Y-%m-%d %H:%M:%S")
    return suite_rows.withColumns(
        {
            "run_id": F.lit(run_id_of(run_at)),
            "run_at": F.lit(stamp).cast("timestamp_ntz"),
        }
    ).select(*RESULT_COLUMNS)


def failed_checks(results: DataFrame, severity: str = BLOCKING) -> DataFrame:
    """The checks of one severity that did not pass."""
    return results.filter(~F.col("success") & (F.col("severity") == severity))


def dq_gate(results: DataFrame, enforce: bool = True) -> list[str]:
    """Stop on a failed blocking check; returns the failures when not enforced.

    At most one row per check reaches the driver.
    """
    rows = failed_checks(results).select("target_table", "expectation_type", "column_name").collect()
    failures = [f"{r.target_table} :: {r.expectation_type} ({r.column_name})" for r in rows]
    if failures and enforce:
        raise GateFailed("; ".join(sorted(failures)))
    return failures


def mart_data_quality(results: DataFrame) -> DataFrame:
    """Checks, passes and pass rate per run, table and severity."""
    summary = results.groupBy("run_id", "run_at", "target_table", "severity").agg(
        F.count(F.lit(1)).alias("checks"),
        F.count_if(F.col("success")).alias("passed"),
        F.count_if(~F.col("success")).alias("failed"),
        round_half_away(F.avg(F.col("success").cast("int")), 4).alias("pass_rate"),
    )
    newest = results.agg(F.max("run_id")).scalar()
    return summary.withColumn("is_latest", F.col("run_id") == newest)


def dq_latest_detail(results: DataFrame) -> DataFrame:
    """Every check of the newest run."""
    newest = results.agg(F.max("run_id")).scalar()
    return (
        results.filter(F.col("run_id") == newest)
        .select("target_table", "expectation_type", "column_name", "severity", "success", "observed_value")
        .orderBy("target_table", "severity", "expectation_type")
    )


def dq_latest_kpis(summary: DataFrame) -> DataFrame:
    """Checks, passes and pass rate of the newest run; the rate is 0 without checks."""
    totals = summary.filter("is_latest").agg(
        F.max("run_id").alias("run_id"),
        F.coalesce(F.sum("checks"), F.lit(0)).alias("checks"),
        F.coalesce(F.sum("passed"), F.lit(0)).alias("passed"),
    )
    rate = F.when(F.col("checks") > 0, F.col("passed") / F.col("checks")).otherwise(F.lit(0.0))
    return totals.withColumn("pass_rate", rate)


class StaleSource(RuntimeError):
    """A source is older than its error limit."""


def require_fresh(freshness: DataFrame) -> str:
    """The status of a one-row freshness report; raises on ``error``."""
    row = freshness.first()
    if row.status == "error":
        raise StaleSource(f"newest load {row.max_loaded_at}, {row.age_seconds} seconds old")
    return row.status


def source_freshness(
    df: DataFrame, as_of: datetime, warn_after: timedelta, error_after: timedelta, loaded_at: str = "_loaded_at"
) -> DataFrame:
    """Age of the newest load against the limits: pass, warn or error."""
    moment = F.lit(as_of.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp_ntz")
    newest = F.max(F.col(loaded_at).cast("timestamp_ntz")).alias("max_loaded_at")
    aged = df.agg(newest).withColumn(
        "age_seconds", F.timestamp_diff("SECOND", F.col("max_loaded_at"), moment)
    )
    age = F.col("age_seconds")
    status = (
        F.when(age.isNull() | (age > int(error_after.total_seconds())), "error")
        .when(age > int(warn_after.total_seconds()), "warn")
        .otherwise("pass")
    )
    return aged.withColumn("status", status)
