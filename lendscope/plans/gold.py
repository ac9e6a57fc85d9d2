"""Gold tables built from client silver."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendscope.functions import (
    age_band,
    credit_limit_band,
    education_level,
    guarded_ratio,
    marital_status,
    region,
    round_half_away,
    sex,
)
from lendscope.schemas import MONTHS

# The segments of the risk mart and the columns of the dimension.
SEGMENT_DIMENSIONS = (
    "age_band",
    "credit_limit_band",
    "education_level",
    "sex",
    "marital_status",
    "region",
)

DIM_BORROWER_COLUMNS = (
    "client_id",
    "credit_limit",
    "sex_code",
    "sex",
    "education_code",
    "education_level",
    "marriage_code",
    "marital_status",
    "age",
    "age_band",
    "credit_limit_band",
    "region",
)


def _with_segments(clients: DataFrame) -> DataFrame:
    return clients.withColumns(
        {
            "sex": sex(F.col("sex_code")),
            "education_level": education_level(F.col("education_code")),
            "marital_status": marital_status(F.col("marriage_code")),
            "age_band": age_band(F.col("age")),
            "credit_limit_band": credit_limit_band(F.col("credit_limit")),
            "region": region(F.col("client_id")),
        }
    )


def dim_borrower(clients: DataFrame) -> DataFrame:
    """Borrower attributes and segments, one row per client."""
    return _with_segments(clients).select(*DIM_BORROWER_COLUMNS)


def labelled_borrowers(clients: DataFrame) -> DataFrame:
    """The dimension with the default label.

    Both sides of that 1:1 join are projections of silver, so it is one select.
    """
    return _with_segments(clients).select(*DIM_BORROWER_COLUMNS, "is_default")


def _by_month(prefix: str) -> list[Column]:
    return [F.col(f"{prefix}_m{m}") for m in MONTHS]


def fct_payment_history(clients: DataFrame) -> DataFrame:
    """One row per client and statement month, unpivoted in a single scan."""
    slots = ", ".join(f"{m}, repay_status_m{m}, bill_amt_m{m}, pay_amt_m{m}" for m in MONTHS)
    monthly = clients.select(
        "client_id",
        "credit_limit",
        F.expr(f"stack({len(MONTHS)}, {slots}) as (month_index, repay_status, bill_amt, pay_amt)"),
    )
    key = F.concat(F.col("client_id").cast("string"), F.lit("-"), F.col("month_index").cast("string"))
    return monthly.select(
        F.md5(key).alias("payment_history_id"),
        "client_id",
        "month_index",
        "repay_status",
        (F.col("repay_status") > 0).alias("is_delinquent"),
        "bill_amt",
        "pay_amt",
        guarded_ratio(F.col("bill_amt"), F.col("credit_limit")).alias("utilization"),
    )


def feature_default_prediction(clients: DataFrame) -> DataFrame:
    """The wide table both training and scoring read, one row per client."""
    status = _by_month("repay_status")
    limit = F.col("credit_limit")
    totals = clients.withColumns(
        {
            "total_bill_amt": reduce(add, _by_month("bill_amt")),
            "total_pay_amt": reduce(add, _by_month("pay_amt")),
        }
    )
    bill, paid = F.col("total_bill_amt"), F.col("total_pay_amt")
    n_months = F.lit(float(len(MONTHS)))
    return totals.select(
        "client_id",
        "credit_limit",
        "age",
        "sex_code",
        "education_code",
        "marriage_code",
        (reduce(add, status) / n_months).alias("avg_repay_status"),
        F.greatest(*status).alias("max_repay_status"),
        reduce(add, [(s > 0).cast("int") for s in status]).alias("months_delinquent"),
        "total_bill_amt",
        "total_pay_amt",
        guarded_ratio(bill / n_months, limit).alias("avg_utilization"),
        age_band(F.col("age")).alias("age_band"),
        credit_limit_band(limit).alias("credit_limit_band"),
        "is_default",
        guarded_ratio(paid, bill).alias("pay_to_bill_ratio"),
    )


def mart_portfolio_risk(labelled: DataFrame) -> DataFrame:
    """Default rate and exposure per (dimension, value), long format.

    Rows are first folded to one per combination of the six segments (a few
    thousand at most), so unpivoting them costs nothing and a segment that
    holds most clients is summed before the shuffle.
    """
    folded = labelled.groupBy(*SEGMENT_DIMENSIONS).agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum("is_default").alias("defaults"),
        F.count("is_default").alias("labels"),
        F.sum("credit_limit").alias("limits"),
        F.count("credit_limit").alias("limit_rows"),
    )
    pairs = ", ".join(f"'{d}', {d}" for d in SEGMENT_DIMENSIONS)
    long = folded.select(
        F.expr(f"stack({len(SEGMENT_DIMENSIONS)}, {pairs}) as (segment_dimension, segment_value)"),
        "rows",
        "defaults",
        "labels",
        "limits",
        "limit_rows",
    )
    merged = long.groupBy("segment_dimension", "segment_value").agg(
        *[F.sum(c).alias(c) for c in ("rows", "defaults", "labels", "limits", "limit_rows")]
    )

    def mean(total: str, n: str) -> Column:
        return F.when(F.col(n) > 0, F.col(total) / F.col(n))

    return merged.select(
        "segment_dimension",
        "segment_value",
        F.col("rows").alias("n_clients"),
        F.col("defaults").alias("n_default"),
        round_half_away(mean("defaults", "labels"), 4).alias("default_rate"),
        round_half_away(mean("limits", "limit_rows"), 2).alias("avg_credit_limit"),
        F.col("limits").alias("total_credit_limit_exposure"),
    )
