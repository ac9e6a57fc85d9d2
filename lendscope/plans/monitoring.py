"""Volume, drift and anomaly checks over landed data."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lendscope.functions import round_half_away
from lendscope.schemas import schema_differences


def daily_volume(df: DataFrame, day: Column, source: Column) -> DataFrame:
    """(source, day, row_count); later windows see one row per day and source."""
    return df.groupBy(source.alias("source"), day.cast("date").alias("day")).agg(
        F.count(F.lit(1)).alias("row_count")
    )


def every_day(df: DataFrame, of: str, value: str, until: date | None = None) -> DataFrame:
    """(of, day, value) with a row for each day from the first of each series to the last of all, 0 where none is.

    ``until`` is a later last day, such as the day of the run. One row per series and day, never raw rows.
    """
    last = F.lit(until) if until else df.agg(F.max("day")).scalar()
    days = df.groupBy(of).agg(F.min("day").alias("first")).filter(F.col("first") <= last)
    spine = days.select(of, F.explode(F.sequence("first", last)).alias("day"))
    zero = F.lit(0).cast(df.schema[value].dataType)
    return spine.join(df.select(of, "day", value), [of, "day"], "left").withColumn(value, F.coalesce(value, zero))


def volume_band(volume: DataFrame, tolerance: float, trailing: int = 7, until: date | None = None) -> DataFrame:
    """Each day's rows against the mean of the days before; the first day passes.

    A day without rows is a day with 0 rows, both as the day that is checked and in the mean of later ones.
    """
    volume = every_day(volume, "source", "row_count", until)
    by_day = Window.partitionBy("source").orderBy("day")
    before = by_day.rowsBetween(-trailing, -1)
    n, usual = F.col("row_count"), F.col("trailing_avg")
    return (
        volume.withColumns(
            {"trailing_avg": F.avg("row_count").over(before), "row_delta": n - F.lag("row_count").over(by_day)}
        )
        .withColumn("within_band", F.coalesce(F.abs(n - usual) <= usual * tolerance, F.lit(True)))
        .withColumn("trailing_avg", round_half_away(usual, 4))
    )


def null_rate(df: DataFrame, threshold: float) -> DataFrame:
    """Share of NULL per column against a limit, one pass for all columns."""
    counted = df.agg(F.count(F.lit(1)).alias("_rows"), *[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    rows = [F.struct(F.lit(c).alias("column_name"), F.col(c).alias("n_null"), F.col("_rows").alias("n_rows")) for c in df.columns]
    rate = F.when(F.col("n_rows") > 0, F.col("n_null") / F.col("n_rows")).otherwise(F.lit(0.0))
    return (
        counted.select(F.inline(F.array(*rows)))
        .withColumn("null_rate", round_half_away(rate, 4))
        .withColumn("success", rate <= threshold)
    )


def schema_check(df: DataFrame, declared: T.StructType) -> DataFrame:
    """Per column: declared and actual type, status, values, and values that
    cannot be read as the declared type."""
    differences = schema_differences(df.schema, declared)
    kinds = {f.name: f.dataType for f in declared.fields}

    def bad(name: str) -> Column:
        value = F.col(f"`{name}`")
        return F.count_if(value.isNotNull() & value.try_cast(kinds[name]).isNull())

    present = [name for name, _, have, _ in differences if have]
    counted = df.agg(
        *[F.count(F.col(f"`{n}`")).alias(f"n_{n}") for n in present],
        *[bad(n).alias(f"bad_{n}") for n in present if n in kinds],
    )
    zero = F.lit(0).cast("long")
    rows = [
        F.struct(
            F.lit(name).alias("column_name"),
            F.lit(want).cast("string").alias("declared_type"),
            F.lit(have).cast("string").alias("actual_type"),
            F.lit(status).alias("status"),
            (F.col(f"`n_{name}`") if have else zero).alias("n_values"),
            (F.col(f"`bad_{name}`") if have and want else zero).alias("n_unreadable"),
        )
        for name, want, have, status in differences
    ]
    return counted.select(F.inline(F.array(*rows)))


def dq_anomaly(metrics: DataFrame, trailing: int = 7, limit: float = 3.0) -> DataFrame:
    """Each (metric, day, value) against the mean and spread of the days before.

    ``metrics`` holds one row per day and metric, never raw rows. A day that a metric lacks counts as 0.
    """
    metrics = every_day(metrics, "metric", "value")
    before = Window.partitionBy("metric").orderBy("day").rowsBetween(-trailing, -1)
    spread = F.stddev_pop("value").over(before)
    z = F.when(spread > 1e-9, (F.col("value") - F.avg("value").over(before)) / spread)
    return (
        metrics.withColumn("z_score", z)
        .withColumn("is_anomaly", F.coalesce(F.abs("z_score") > limit, F.lit(False)))
        .withColumn("z_score", round_half_away(F.col("z_score"), 4))
    )
