"""Declared source schemas, column classes and the source registry."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import timedelta

from pyspark.sql import DataFrame
from pyspark.sql import types as T

MONTHS = range(1, 7)

# The client file has no PAY_1, its newest status column is PAY_0.
RAW_STATUS_COLUMNS = ("PAY_0", "PAY_2", "PAY_3", "PAY_4", "PAY_5", "PAY_6")
RAW_DEFAULT_FLAG = "default payment next month"

LOAD_STAMPS = ("_source_file", "_load_date", "_loaded_at")

_CLIENT_ATTRIBUTES = ("LIMIT_BAL", "SEX", "EDUCATION", "MARRIAGE", "AGE")

# Client ids are long throughout: an int ends at 2.1 billion clients.
RAW_CLIENTS = T.StructType(
    [T.StructField("ID", T.LongType())]
    + [T.StructField(c, T.IntegerType()) for c in (*_CLIENT_ATTRIBUTES, *RAW_STATUS_COLUMNS)]
    + [T.StructField(f"BILL_AMT{m}", T.DoubleType()) for m in MONTHS]
    + [T.StructField(f"PAY_AMT{m}", T.DoubleType()) for m in MONTHS]
    + [T.StructField(RAW_DEFAULT_FLAG, T.IntegerType())]
)

RAW_TRANSACTIONS = T.StructType(
    [
        T.StructField("txn_id", T.StringType()),
        T.StructField("borrower_id", T.LongType()),
        T.StructField("txn_ts", T.TimestampType()),
        T.StructField("amount", T.DoubleType()),
        T.StructField("channel", T.StringType()),
        T.StructField("txn_type", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("borrower_email", T.StringType()),
        T.StructField("borrower_ip", T.StringType()),
    ]
)

# Column classes that drive masking: silver column -> class.
PII, CONFIDENTIAL, PUBLIC = "PII", "CONFIDENTIAL", "PUBLIC"
CLASSES = {
    "sex_code": PII,
    "education_code": PII,
    "marriage_code": PII,
    "age": PII,
    "credit_limit": CONFIDENTIAL,
    "borrower_email": PII,
    "borrower_ip": PII,
}


def class_metadata(column: str) -> dict[str, str]:
    """Field metadata carrying the class of a silver column."""
    return {"classification": CLASSES[column]} if column in CLASSES else {}


def class_of(field: T.StructField) -> str:
    return field.metadata.get("classification", PUBLIC)


@dataclass(frozen=True)
class SourceSpec:
    """A bronze table: its declared columns, key and freshness limits."""

    table: str
    schema: T.StructType | None
    key: str | None = None
    warn_after: timedelta | None = None
    error_after: timedelta | None = None
    partition_by: str = "_load_date"


SOURCES = {
    "clients": SourceSpec("raw.uci_credit_default", RAW_CLIENTS, "ID"),
    "transactions": SourceSpec(
        "raw.transactions",
        RAW_TRANSACTIONS,
        "txn_id",
        warn_after=timedelta(hours=26),
        error_after=timedelta(hours=52),
    ),
    # The tape brings its own columns; one partition per delivery.
    "loan_tape": SourceSpec("raw.lending_club_loans", None, partition_by="_delivery"),
}


# The contracts of the gold tables, names and types in order.
GOLD_CONTRACTS = {
    "dim_borrower": (
        "client_id bigint, credit_limit int, sex_code int, sex string, education_code int, education_level string, "
        "marriage_code int, marital_status string, age int, age_band string, credit_limit_band string, region string"
    ),
    "fct_payment_history": (
        "payment_history_id string, client_id bigint, month_index int, repay_status int, is_delinquent boolean, "
        "bill_amt double, pay_amt double, utilization double"
    ),
    "mart_portfolio_risk": (
        "segment_dimension string, segment_value string, n_clients bigint, n_default bigint, default_rate double, "
        "avg_credit_limit double, total_credit_limit_exposure bigint"
    ),
    "feature_default_prediction": (
        "client_id bigint, credit_limit int, age int, sex_code int, education_code int, marriage_code int, "
        "avg_repay_status double, max_repay_status int, months_delinquent int, total_bill_amt double, "
        "total_pay_amt double, avg_utilization double, age_band string, credit_limit_band string, is_default int, "
        "pay_to_bill_ratio double"
    ),
}


def gold_contract(name: str) -> T.StructType:
    return T.StructType.fromDDL(GOLD_CONTRACTS[name])


class SchemaDrift(ValueError):
    """A landed file does not have the declared columns."""


def schema_differences(actual: T.StructType, declared: T.StructType) -> list[tuple[str, str | None, str | None, str]]:
    """(column, declared type, actual type, status) of every column of either side."""
    have = {f.name: f.dataType.simpleString() for f in actual.fields}
    want = {f.name: f.dataType.simpleString() for f in declared.fields}
    result = []
    for name in [*want, *[n for n in have if n not in want]]:
        if name not in have:
            status = "missing"
        elif name not in want:
            status = "unexpected"
        else:
            status = "ok" if have[name] == want[name] else "type_changed"
        result.append((name, want.get(name), have.get(name), status))
    return result


def require_schema(df: DataFrame, declared: T.StructType) -> DataFrame:
    """The frame itself, or SchemaDrift when its columns are not the declared ones in their order."""
    wrong = [d for d in schema_differences(df.schema, declared) if d[3] != "ok"]
    if wrong:
        raise SchemaDrift("; ".join(f"{n}: declared {w}, found {h}" for n, w, h, _ in wrong))
    if df.columns != declared.names:
        raise SchemaDrift(f"declared in the order {', '.join(declared.names)}, found {', '.join(df.columns)}")
    return df


def require_columns(df: DataFrame, declared: T.StructType) -> DataFrame:
    """The frame itself, or SchemaDrift when a column is missing or unknown."""
    wrong = [d for d in schema_differences(df.schema, declared) if d[3] in ("missing", "unexpected")]
    if wrong:
        raise SchemaDrift("; ".join(f"{name}: {status}" for name, _, _, status in wrong))
    return df
