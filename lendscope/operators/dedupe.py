"""Newest row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_RANK = "_newest_rank"


def dedupe_latest(df: DataFrame, keys: Sequence[str], newest_first: Sequence[str | Column]) -> DataFrame:
    """One row per key: the first in ``newest_first`` order.

    Plain names sort descending with NULL last. Name enough columns to break
    every tie, otherwise the pick among equal rows is arbitrary.

    The ``= 1`` filter lets Spark keep one row per key and task before the
    shuffle (WindowGroupLimit), so a key holding a third of the input sends one
    row per map task, and columns nobody reads later are pruned below it.
    """
    order = [F.col(c).desc_nulls_last() if isinstance(c, str) else c for c in newest_first]
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(_RANK, F.row_number().over(window)).filter(F.col(_RANK) == 1).drop(_RANK)
