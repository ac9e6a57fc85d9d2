"""Silver: typed, renamed, one row per natural key. No joins, no business rules."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendscope.operators.dedupe import dedupe_latest
from lendscope.schemas import MONTHS, RAW_DEFAULT_FLAG, RAW_STATUS_COLUMNS, class_metadata

# silver column -> (bronze column, type)
CLIENT_COLUMNS = {
    "client_id": ("ID", "long"),
    "credit_limit": ("LIMIT_BAL", "int"),
    "sex_code": ("SEX", "int"),
    "education_code": ("EDUCATION", "int"),
    "marriage_code": ("MARRIAGE", "int"),
    "age": ("AGE", "int"),
    **{f"repay_status_m{m}": (raw, "int") for m, raw in zip(MONTHS, RAW_STATUS_COLUMNS)},
    **{f"bill_amt_m{m}": (f"BILL_AMT{m}", "double") for m in MONTHS},
    **{f"pay_amt_m{m}": (f"PAY_AMT{m}", "double") for m in MONTHS},
    "is_default": (RAW_DEFAULT_FLAG, "int"),
    "load_date": ("_load_date", None),
    "loaded_at": ("_loaded_at", None),
}

PAYMENT_COLUMNS = {
    "txn_id": ("txn_id", "string"),
    "client_id": ("borrower_id", "long"),
    "txn_ts": ("txn_ts", "timestamp_ntz"),
    "amount": ("amount", "double"),
    "channel": ("channel", "string"),
    "txn_type": ("txn_type", "string"),
    "status": ("status", "string"),
    "borrower_email": ("borrower_email", "string"),
    "borrower_ip": ("borrower_ip", "string"),
    "load_date": ("_load_date", None),
    "loaded_at": ("_loaded_at", None),
}


def _cast_columns(raw: DataFrame, columns: dict, extra: Sequence[str]) -> DataFrame:
    chosen = []
    for name, (source, kind) in columns.items():
        value = F.col(f"`{source}`")
        value = value.cast(kind) if kind else value
        chosen.append(value.alias(name, metadata=class_metadata(name)))
    return raw.select(*chosen, *extra)


def typed_clients(raw: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    """Client rows with silver's names and types, not yet one per client."""
    return _cast_columns(raw, CLIENT_COLUMNS, extra)


def typed_payments(raw: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    """Payment rows with silver's names and types, not yet one per event."""
    return _cast_columns(raw, PAYMENT_COLUMNS, extra)


def _silver(raw: DataFrame, columns: dict, key: str, ties: Sequence[str]) -> DataFrame:
    # Casting below the window lets a filter on the key reach the scan.
    typed = _cast_columns(raw, columns, ties)
    return dedupe_latest(typed, [key], ["loaded_at", *ties]).select(*columns)


def stg_clients(raw: DataFrame, tie_breakers: Sequence[str] = ()) -> DataFrame:
    """One row per client, newest load wins."""
    return _silver(raw, CLIENT_COLUMNS, "client_id", tie_breakers)


def stg_payments(raw: DataFrame, tie_breakers: Sequence[str] = ()) -> DataFrame:
    """One row per payment event, newest load wins.

    ``tie_breakers`` are bronze columns that decide between rows of one load.
    """
    return _silver(raw, PAYMENT_COLUMNS, "txn_id", tie_breakers)
