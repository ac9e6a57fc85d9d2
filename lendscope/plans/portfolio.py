"""Loan-tape cleaning, portfolio and roll-rate marts, calendar."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lendscope.functions import round_half_away
from lendscope.operators.dedupe import dedupe_latest
from lendscope.schemas import MONTHS

# Statuses of the tape that count as a default.
DEFAULT_STATUSES = ("charged off", "default")


def clean_loan_tape(
    raw: DataFrame, schema: T.StructType, key: Sequence[str], newest_first: Sequence[str | Column]
) -> DataFrame:
    """Declared types, trimmed lower-case text, one row per natural key."""
    columns = []
    for field in schema.fields:
        value = F.col(field.name)
        if isinstance(field.dataType, T.StringType):
            value = F.lower(F.trim(F.regexp_replace(value.cast("string"), r"\s+", " ")))
        columns.append(value.cast(field.dataType).alias(field.name))
    extra = [c for c in newest_first if isinstance(c, str) and c not in schema.names]
    return dedupe_latest(raw.select(*columns, *extra), key, newest_first).select(*schema.names)


def fct_loan(tape: DataFrame) -> DataFrame:
    """One row per loan, with its issue date as a calendar key."""
    return tape.select(
        "loan_id",
        "client_id",
        date_key(F.col("issue_date")).alias("issue_date_key"),
        "principal",
        "int_rate",
        "grade",
        "loan_status",
        F.col("loan_status").isin(*DEFAULT_STATUSES).alias("is_defaulted"),
    )


def fct_payment(payments: DataFrame) -> DataFrame:
    """One row per payment event, with its date as a calendar key."""
    return payments.select(
        "txn_id",
        "client_id",
        date_key(F.col("txn_ts")).alias("txn_date_key"),
        "amount",
        "channel",
        "txn_type",
        "status",
        (F.col("status") == "POSTED").alias("is_posted"),
    )


def date_key(moment: Column) -> Column:
    return F.year(moment) * 10000 + F.month(moment) * 100 + F.dayofmonth(moment)


def dim_date(df: DataFrame, column: str) -> DataFrame:
    """The calendar from the first to the last date found in a column."""
    day = F.col(column).cast("date")
    span = df.agg(F.min(day).alias("first"), F.max(day).alias("last"))
    days = span.select(F.explode(F.sequence("first", "last")).alias("date_day"))
    d = F.col("date_day")
    return days.select(
        date_key(d).alias("date_key"),
        "date_day",
        F.year(d).alias("year"),
        F.quarter(d).alias("quarter"),
        F.month(d).alias("month"),
        F.dayofmonth(d).alias("day"),
        (F.weekday(d) + 1).alias("iso_weekday"),
        (F.weekday(d) >= 5).alias("is_weekend"),
    )


def portfolio_overview(loans: DataFrame) -> DataFrame:
    """Balance, balance-weighted rate and share of loans per status.

    Balances are added as decimals, so the sums do not depend on task order.
    """
    balance = F.col("principal").cast("decimal(18,2)")
    weighted = balance * F.col("int_rate").cast("decimal(9,4)")
    per_status = loans.groupBy("loan_status").agg(
        F.count(F.lit(1)).alias("n_loans"),
        F.sum(balance).cast("double").alias("balance"),
        F.sum(weighted).cast("double").alias("weighted"),
    )
    book = Window.partitionBy(F.lit(0))  # one row per status
    return per_status.select(
        "loan_status",
        "n_loans",
        "balance",
        round_half_away(F.when(F.col("balance") > 0, F.col("weighted") / F.col("balance")), 4).alias("avg_rate"),
        round_half_away(F.col("n_loans") / F.sum("n_loans").over(book), 4).alias("share"),
    )


def expected_loss_share(
    scores: DataFrame, dim: DataFrame, segment: str = "credit_limit_band", score: str = "pd_xgboost"
) -> DataFrame:
    """Expected loss (score times limit) per segment and its share of the book.

    Losses are added as decimals, so the sums do not depend on task order.
    """
    loss = F.col(score).cast("decimal(18,12)") * F.col("credit_limit").cast("decimal(12,0)")
    limits = dim.select("client_id", segment, "credit_limit")
    per_segment = (
        scores.join(limits, "client_id")
        .groupBy(segment)
        .agg(F.sum(loss.cast("decimal(28,10)")).alias("total"))
        .select(segment, F.col("total").cast("double").alias("loss"))
    )
    book = Window.partitionBy(F.lit(0))  # one row per segment
    return per_segment.select(
        segment,
        round_half_away(F.col("loss"), 2).alias("expected_loss"),
        round_half_away(F.col("loss") / F.sum("loss").over(book), 4).alias("loss_share"),
    )


def mart_delinquency_trend(history: DataFrame) -> DataFrame:
    """Accounts, delinquent accounts and mean utilization per statement month."""
    return history.groupBy("month_index").agg(
        F.count(F.lit(1)).alias("n_accounts"),
        F.count_if("is_delinquent").alias("n_delinquent"),
        round_half_away(F.avg(F.col("is_delinquent").cast("int")), 4).alias("delinquency_rate"),
        round_half_away(F.avg("utilization"), 4).alias("avg_utilization"),
    )


def roll_rate(clients: DataFrame) -> DataFrame:
    """How often one month's status is followed by each status the next month.

    The five month pairs sit side by side in silver (m1 is the newest), so they
    are unpivoted in place; no row has to meet its predecessor in a shuffle.
    """
    pairs = ", ".join(f"repay_status_m{m + 1}, repay_status_m{m}" for m in MONTHS[:-1])
    moves = clients.select(F.expr(f"stack({len(MONTHS) - 1}, {pairs}) as (from_status, to_status)"))
    counted = moves.groupBy("from_status", "to_status").agg(F.count(F.lit(1)).alias("n_moves"))
    # One row per pair of statuses from here on.
    leaving = F.sum("n_moves").over(Window.partitionBy("from_status"))
    return counted.withColumn("roll_rate", round_half_away(F.col("n_moves") / leaving, 4))


def default_horizon(rolls: DataFrame, horizon: int, default_from: int) -> DataFrame:
    """(from_status, months, default_probability): the chance of default within 1 to ``horizon`` months.

    ``rolls`` are the moves of ``roll_rate``. Statuses of ``default_from`` and above are default, which is not left
    again; a status that no move leaves stays what it is, and rows without a status move nowhere. The chain's matrix
    has a row per status, so its powers are taken on the driver.
    """
    spark = rolls.sparkSession
    moves = rolls.filter("from_status IS NOT NULL AND to_status IS NOT NULL").select("from_status", "to_status", "n_moves")
    counts = moves.collect()  # one row per pair of statuses
    states = sorted({r.from_status for r in counts} | {r.to_status for r in counts})
    place = {status: i for i, status in enumerate(states)}
    matrix = np.zeros((len(states), len(states)))
    for r in counts:
        if r.from_status < default_from:
            matrix[place[r.from_status], place[r.to_status]] += r.n_moves
    still = matrix.sum(axis=1) == 0
    matrix[still, still.nonzero()[0]] = 1.0
    matrix /= matrix.sum(axis=1, keepdims=True)
    late = np.array([s >= default_from for s in states], bool)
    found, power = [], np.eye(len(states))
    for month in range(1, horizon + 1):
        power = power @ matrix
        found += [(s, month, float(power[i, late].sum())) for i, s in enumerate(states) if not late[i]]
    return spark.createDataFrame(found, "from_status int, months int, default_probability double")


def expected_defaults(clients: DataFrame, chances: DataFrame, status: str = "repay_status_m1") -> DataFrame:
    """Per horizon the clients not in default now and how many of them are expected to be by then."""
    book = clients.groupBy(F.col(status).alias("from_status")).agg(F.count(F.lit(1)).alias("n"))
    return book.join(chances, "from_status").groupBy("months").agg(
        F.sum("n").alias("n_clients"), F.sum(F.col("n") * F.col("default_probability")).alias("expected_defaults")
    )


def survival_curves(
    loans: DataFrame, as_of: str, issued: str = "issue_date", defaulted: str = "default_date", closed: str | None = None
) -> DataFrame:
    """Kaplan-Meier curve of each issue quarter as seen on ``as_of``: loans still open, or closed, are censored.

    One row per cohort and month on book in which a loan defaulted or was last seen: loans at risk, defaults,
    censored, hazard and survival. A loan of the same month as a default is at risk when it happens. Loans issued
    after ``as_of`` or without a date are not in a cohort; a default or close before the issue counts in month 0.
    """
    seen = F.lit(as_of).cast("date")
    ends = [F.when(F.col(c) <= seen, F.col(c)) for c in (defaulted, closed) if c]
    last = F.coalesce(F.least(*ends) if len(ends) > 1 else ends[0], seen)
    event = F.col(defaulted).isNotNull() & (F.col(defaulted) <= seen) & (F.col(defaulted) == last)
    age = (F.year(last) - F.year(issued)) * 12 + F.month(last) - F.month(issued)
    known = loans.filter(F.col(issued) <= seen)
    counted = known.groupBy(
        F.concat_ws("-Q", F.year(issued).cast("string"), F.quarter(issued).cast("string")).alias("cohort"),
        F.greatest(age, F.lit(0)).alias("months_on_book"),
    ).agg(F.count_if(event).alias("defaults"), F.count_if(~event).alias("censored"))
    # One row per quarter and month from here on.
    by_age = Window.partitionBy("cohort").orderBy(F.desc("months_on_book")).rowsBetween(Window.unboundedPreceding, 0)
    upto = Window.partitionBy("cohort").orderBy("months_on_book").rowsBetween(Window.unboundedPreceding, 0)
    risk = counted.withColumn("at_risk", F.sum(F.col("defaults") + F.col("censored")).over(by_age))
    hazard = risk.withColumn("hazard", F.col("defaults") / F.col("at_risk"))
    # A product as a sum of logarithms; where all default nothing is left.
    left = F.when(F.max(F.col("hazard") >= 1).over(upto), F.lit(0.0)).otherwise(
        F.exp(F.sum(F.when(F.col("hazard") < 1, F.log1p(-F.col("hazard")))).over(upto))
    )
    return hazard.select(
        "cohort", "months_on_book", "at_risk", "defaults", "censored",
        round_half_away(F.col("hazard"), 6).alias("hazard"), round_half_away(left, 6).alias("survival"),
    )


def vintage_curves(loans: DataFrame, issued: str = "issue_date", defaulted: str = "default_date") -> DataFrame:
    """Share of each issue quarter that has defaulted by each month on book."""
    age = (F.year(defaulted) - F.year(issued)) * 12 + F.month(defaulted) - F.month(issued)
    counted = loans.groupBy(
        F.concat_ws("-Q", F.year(issued).cast("string"), F.quarter(issued).cast("string")).alias("cohort"),
        age.alias("months_on_book"),
    ).agg(F.count(F.lit(1)).alias("n"))
    # One row per quarter and age from here on; a NULL age has not defaulted.
    cohort = Window.partitionBy("cohort")
    so_far = cohort.orderBy("months_on_book").rowsBetween(Window.unboundedPreceding, 0)
    curve = counted.withColumn("cohort_loans", F.sum("n").over(cohort)).filter(F.col("months_on_book").isNotNull())
    cumulated = curve.withColumn("cum_defaults", F.sum("n").over(so_far))
    return cumulated.select(
        "cohort",
        "months_on_book",
        "cohort_loans",
        F.col("n").alias("defaults"),
        "cum_defaults",
        round_half_away(F.col("cum_defaults") / F.col("cohort_loans"), 4).alias("cum_default_rate"),
    )
