"""Declared column tests of every model and the singular tests."""

from __future__ import annotations

from collections.abc import Iterator, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendscope.functions.banding import REGIONS
from lendscope.functions.masking import MASKED_IP
from lendscope.plans.governance import pii_leaks, row_access_leaks
from lendscope.plans.quality import GateFailed
from lendscope.operators.checks import (
    accepted_values_failures,
    fk_orphans,
    not_null_failures,
    unique_failures,
)
from lendscope.session import side_by_side

# The tests declared per model.
NOT_NULL_COLUMNS = {
    "stg_clients": ("client_id", "is_default", "age", "credit_limit"),
    "stg_payments": ("txn_id", "client_id"),
    "dim_borrower": ("client_id", "age_band", "credit_limit_band", "region"),
    "fct_payment_history": ("payment_history_id", "client_id", "month_index"),
    "mart_portfolio_risk": ("segment_dimension", "segment_value", "default_rate"),
    "feature_default_prediction": ("client_id", "is_default"),
    "gov_borrower_risk_analyst": ("client_id",),
    "gov_borrower_analyst": ("client_id",),
    "gov_payments_analyst": ("txn_id",),
    "gov_borrower_regional": ("client_id",),
}
UNIQUE_COLUMNS = {
    "stg_clients": "client_id",
    "stg_payments": "txn_id",
    "dim_borrower": "client_id",
    "fct_payment_history": "payment_history_id",
    "feature_default_prediction": "client_id",
    "gov_borrower_risk_analyst": "client_id",
    "gov_borrower_analyst": "client_id",
    "gov_payments_analyst": "txn_id",
    "gov_borrower_regional": "client_id",
}
ACCEPTED_VALUES = {
    ("stg_clients", "is_default"): (0, 1),
    ("stg_clients", "sex_code"): (1, 2),
    ("stg_payments", "status"): ("POSTED", "PENDING", "FAILED"),
    ("dim_borrower", "sex"): ("male", "female", "unknown"),
    ("dim_borrower", "region"): REGIONS,
    ("fct_payment_history", "month_index"): (1, 2, 3, 4, 5, 6),
    ("feature_default_prediction", "is_default"): (0, 1),
    ("gov_payments_analyst", "borrower_ip"): (MASKED_IP,),
}
# (child model, column) -> (parent model, key)
RELATIONSHIPS = {
    ("stg_payments", "client_id"): ("stg_clients", "client_id"),
    ("fct_payment_history", "client_id"): ("dim_borrower", "client_id"),
    ("feature_default_prediction", "client_id"): ("dim_borrower", "client_id"),
}


def _union(parts: Iterator[DataFrame]) -> DataFrame:
    result = next(parts)
    for part in parts:
        result = result.unionByName(part)
    return result


def _named(model: str, df: DataFrame) -> DataFrame:
    return df.select(F.lit(model).alias("model"), "*")


def not_null_tests(models: Mapping[str, DataFrame]) -> DataFrame:
    """(model, column_name, failures) of every declared column."""
    return _union(
        _named(m, not_null_failures(models[m], columns)) for m, columns in NOT_NULL_COLUMNS.items() if m in models
    )


def unique_tests(models: Mapping[str, DataFrame]) -> DataFrame:
    """(model, column_name, failures): repeated values of every declared key."""
    return _union(_named(m, unique_failures(models[m], key)) for m, key in UNIQUE_COLUMNS.items() if m in models)


def accepted_values_tests(models: Mapping[str, DataFrame]) -> DataFrame:
    """(model, column_name, value, n_records): every value outside its list."""
    return _union(
        _named(m, accepted_values_failures(models[m], column, accepted))
        for (m, column), accepted in ACCEPTED_VALUES.items()
        if m in models
    )


def relationship_tests(models: Mapping[str, DataFrame]) -> DataFrame:
    """(model, column_name, orphan, n_rows): child values without a parent."""
    return _union(
        _named(m, fk_orphans(models[m], column, models[parent], key).withColumn("column_name", F.lit(column)))
        for (m, column), (parent, key) in RELATIONSHIPS.items()
        if m in models and parent in models
    )


def failing_column_tests(models: Mapping[str, DataFrame], most: int = 20) -> list[str]:
    """The tests that do not pass on the given models; at most ``most`` values of each kind are named."""
    reports = {
        "not_null": not_null_tests(models).filter("failures > 0"),  # one row per declared column
        "unique": unique_tests(models).filter("failures > 0"),
        "accepted_values": accepted_values_tests(models).limit(most),
        "relationships": relationship_tests(models).limit(most),
    }
    single: dict[str, DataFrame] = {}
    if "stg_payments" in models:
        single["non_negative_amount"] = negative_amounts(models["stg_payments"])
    if "gov_borrower_analyst" in models and "gov_payments_analyst" in models:
        single["pii_leaks"] = pii_leaks(models["gov_borrower_analyst"], models["gov_payments_analyst"])
    if "gov_borrower_regional" in models:
        single["row_access_leaks"] = row_access_leaks(models["gov_borrower_regional"])
    asked = [df.collect for df in reports.values()] + [df.isEmpty for df in single.values()]
    answers = side_by_side(next(iter(models.values())).sparkSession, asked)
    rows = dict(zip(reports, answers))
    found = [f"{kind} {r.model}.{r.column_name}: {r.failures}" for kind in ("not_null", "unique") for r in rows[kind]]
    for r in rows["accepted_values"]:
        found.append(f"accepted_values {r.model}.{r.column_name}: {r.value} in {r.n_records} rows")
    for r in rows["relationships"]:
        found.append(f"relationships {r.model}.{r.column_name}: {r.orphan} in {r.n_rows} rows")
    found += [f"{name}: rows found" for name, empty in zip(single, answers[len(reports) :]) if not empty]
    return sorted(found)


def require_column_tests(models: Mapping[str, DataFrame]) -> None:
    """Stop when a column test or a singular test fails."""
    failing = failing_column_tests(models)
    if failing:
        raise GateFailed("; ".join(failing))


def negative_amounts(payments: DataFrame) -> DataFrame:
    """Payments with a negative amount; empty means pass."""
    return payments.filter(F.col("amount") < 0).select("txn_id", "amount")

