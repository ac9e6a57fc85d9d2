"""The questions the dashboard asks of gold, scores and check results."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendscope.functions import round_half_away


def portfolio_kpis(features: DataFrame) -> DataFrame:
    """Borrowers, exposure, mean limit and default rate of the whole book."""
    return features.agg(
        F.count(F.lit(1)).alias("borrowers"),
        F.sum("credit_limit").alias("total_exposure"),
        F.avg("credit_limit").alias("avg_limit"),
        F.avg("is_default").alias("default_rate"),
    )


def borrowers_by_limit_band(dim: DataFrame) -> DataFrame:
    """Borrowers per limit band, lowest band first."""
    return (
        dim.groupBy(F.col("credit_limit_band").alias("band"))
        .agg(F.count(F.lit(1)).alias("borrowers"), F.min("credit_limit").alias("lowest"))
        .orderBy("lowest")
        .drop("lowest")
    )


def borrowers_by_region(dim: DataFrame) -> DataFrame:
    return dim.groupBy("region").agg(F.count(F.lit(1)).alias("borrowers")).orderBy("region")


def segment_dimensions(mart: DataFrame) -> DataFrame:
    return mart.select("segment_dimension").distinct().orderBy("segment_dimension")


def segment_detail(mart: DataFrame, dimension: str = "credit_limit_band") -> DataFrame:
    """The segments of one dimension, riskiest first."""
    return (
        mart.filter(F.col("segment_dimension") == dimension)
        .select("segment_value", "n_clients", "n_default", "default_rate", "total_credit_limit_exposure")
        .orderBy(F.desc("default_rate"), "segment_value")
    )


def delinquency_trend(history: DataFrame) -> DataFrame:
    """Share of delinquent clients and mean utilization per statement month."""
    return (
        history.groupBy("month_index")
        .agg(
            F.avg(F.col("is_delinquent").cast("int")).alias("delinquency_rate"),
            F.avg("utilization").alias("avg_utilization"),
        )
        .orderBy("month_index")
        .select(
            F.concat(F.lit("m"), F.col("month_index").cast("string")).alias("statement_month"),
            "delinquency_rate",
            "avg_utilization",
        )
    )


def pd_histogram(scores: DataFrame, score: str = "pd_xgboost") -> DataFrame:
    """Borrowers per tenth of the score; tenths round half to even, so 0.0 to 1.0."""
    bucket = F.rint(F.col(score) * 10) / 10
    return scores.groupBy(bucket.alias("pd_bucket")).agg(F.count(F.lit(1)).alias("borrowers")).orderBy("pd_bucket")


def pd_vs_actual_by_band(scores: DataFrame, dim: DataFrame, score: str = "pd_xgboost") -> DataFrame:
    """Mean score against observed rate per limit band, riskiest first."""
    bands = dim.select("client_id", F.col("credit_limit_band").alias("band"))
    return (
        scores.join(bands, "client_id")
        .groupBy("band")
        .agg(F.avg(score).alias("predicted_pd"), F.avg("is_default").alias("actual_rate"))
        .orderBy(F.desc("predicted_pd"))
    )


def top_risk_borrowers(scores: DataFrame, dim: DataFrame, score: str = "pd_xgboost", n: int = 15) -> DataFrame:
    """The ``n`` borrowers of highest score; equal scores by client id.

    Only ids meet first; the ``n`` rows that are left bring the segments in.
    """
    segments = dim.select("client_id", "credit_limit_band", "age_band", "region")
    order = [F.desc(score), F.col("client_id")]
    known = scores.join(dim.select("client_id"), "client_id", "left_semi")
    top = known.select("client_id", score, "is_default").orderBy(*order).limit(n)
    return (
        segments.join(F.broadcast(top), "client_id")
        .orderBy(*order)
        .limit(n)
        .select(
            "client_id",
            round_half_away(F.col(score), 4).alias("pd"),
            "is_default",
            "credit_limit_band",
            "age_band",
            "region",
        )
    )
