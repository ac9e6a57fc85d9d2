"""Masking of personal and confidential columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values shown in place of the hidden text.
MASKED_LOCAL_PART = "****"
MASKED_IP = "***.***.***.***"
MASKED_TEXT = "***MASKED***"


def mask(value: Column, method: str = "full") -> Column:
    """Hide ``value``.

    ``email`` keeps the domain (NULL stays NULL), ``ip`` and any unknown method
    give a constant even for NULL, ``null`` and ``null_int`` give a typed NULL.
    """
    if method == "email":
        return F.regexp_replace(value, "^[^@]*", MASKED_LOCAL_PART)
    if method == "ip":
        return F.lit(MASKED_IP)
    if method == "null":
        return F.lit(None).cast("string")
    if method == "null_int":
        return F.lit(None).cast("int")
    return F.lit(MASKED_TEXT)
