"""Classifier metrics as distributed queries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lendscope.functions import round_half_even
from lendscope.operators.ranking import exact_quantiles, running_totals


def long_scores(scores: DataFrame, models: Sequence[tuple[str, str]], label: str = "is_default") -> DataFrame:
    """(model, score, label): one row per scored row and model."""
    pairs = ", ".join(f"'{name}', {column}" for name, column in models)
    return scores.select(F.expr(f"stack({len(models)}, {pairs}) as (model, score)"), F.col(label).alias("label"))


def roc_points(long: DataFrame) -> DataFrame:
    """The ROC curve per model: one row per distinct score, highest first."""
    flagged = long.select(
        "model",
        "score",
        F.col("label").cast("long").alias("positives"),
        (1 - F.col("label")).cast("long").alias("negatives"),
    )
    curve = running_totals(flagged, "score", ["positives", "negatives"], by=["model"])
    return curve.select(
        "model",
        "score",
        "positives",
        "negatives",
        "cum_positives",
        "cum_negatives",
        _share("cum_positives", "total_positives").alias("tpr"),
        _share("cum_negatives", "total_negatives").alias("fpr"),
    )


def _share(part: str, whole: str) -> Column:
    return F.when(F.col(whole) > 0, F.col(part) / F.col(whole))


def rank_metrics(points: DataFrame) -> DataFrame:
    """AUC (tied scores count half) and KS (never below 0) per model."""
    before = F.col("cum_positives") - F.col("positives") / 2
    return (
        points.groupBy("model")
        .agg(
            F.sum(F.col("negatives") * before).alias("area"),
            F.sum("positives").alias("p"),
            F.sum("negatives").alias("n"),
            F.max(F.col("tpr") - F.col("fpr")).alias("gap"),
        )
        .select(
            "model",
            F.when((F.col("p") > 0) & (F.col("n") > 0), F.col("area") / (F.col("p").cast("double") * F.col("n")))
            .alias("auc"),
            F.greatest(F.lit(0.0), F.col("gap")).alias("ks"),
        )
    )


def brier(long: DataFrame) -> DataFrame:
    """Mean squared distance of score and label per model."""
    miss = F.col("score") - F.col("label")
    return long.groupBy("model").agg(F.avg(miss * miss).alias("brier"))


def model_metrics(long: DataFrame) -> DataFrame:
    """AUC, KS and Brier score per model, rounded to 4 places, and the rows with and without a score.

    Rows without a score take part in no metric.
    """
    counted = long.groupBy("model").agg(
        F.count("score").alias("n_scored"), F.count_if(F.col("score").isNull()).alias("n_unscored")
    )
    both = rank_metrics(roc_points(long)).join(brier(long), "model").join(counted, "model")
    rounded = [round_half_even(F.col(m), 4).alias(m) for m in ("auc", "ks", "brier")]
    return both.select("model", *rounded, "n_scored", "n_unscored")


def split_report(scores: DataFrame, models: Sequence[tuple[str, str]], label: str = "is_default") -> DataFrame:
    """Rows, mean label and AUC of every model on the training and the test side."""
    parts = []
    for side, rows in (("train", scores.filter(~F.col("is_test"))), ("test", scores.filter("is_test"))):
        long = long_scores(rows, models, label)
        size = long.groupBy("model").agg(F.count(F.lit(1)).alias("n"), F.avg("label").alias("mean_label"))
        both = rank_metrics(roc_points(long)).join(size, "model")
        parts.append(both.select("model", F.lit(side).alias("side"), "n", "mean_label", "auc"))
    report = parts[0].unionByName(parts[1])
    return report.withColumns({c: round_half_even(F.col(c), 4) for c in ("mean_label", "auc")})


def champion_model(metrics: DataFrame, order: Sequence[str]) -> DataFrame:
    """The model of highest AUC; on a tie the one listed first in ``order``."""
    position = F.array_position(F.array(*[F.lit(m) for m in order]), F.col("model"))
    return metrics.orderBy(F.desc("auc"), position).limit(1).select("model", "auc")


def decile_edges(scores: DataFrame, score: str, bins: int = 10) -> list[float]:
    """The inner quantile edges of the score."""
    return exact_quantiles(scores, [score], [i / bins for i in range(1, bins)])[score]


def bin_of(score: Column, edges: Sequence[float | None]) -> Column:
    """How many edges lie strictly below the score; equal scores share a bin."""
    result = F.lit(0)
    for edge in edges:
        if edge is not None:
            result = result + (score > edge).cast("int")
    return result


def calibration_deciles(scores: DataFrame, score: str, label: str = "is_default", bins: int = 10) -> DataFrame:
    """Mean score and observed rate per quantile bin; empty bins are skipped."""
    edges = decile_edges(scores, score, bins)
    per_bin = scores.groupBy(bin_of(F.col(score), edges).alias("slot")).agg(
        F.avg(score).alias("predicted"), F.avg(label).alias("observed")
    )
    # At most ``bins`` rows reach this window.
    number = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy("slot"))
    return per_bin.select(
        number.alias("bin"),
        round_half_even(F.col("predicted"), 4).alias("predicted_pd"),
        round_half_even(F.col("observed"), 4).alias("observed_default_rate"),
    )


def segment_pd_report(
    scored: DataFrame, score: str, segment: str = "credit_limit_band", label: str = "is_default"
) -> DataFrame:
    """Rows, mean score and observed rate per segment, riskiest first."""
    report = scored.groupBy(segment).agg(
        F.count(F.lit(1)).alias("n"), F.avg(score).alias("predicted"), F.avg(label).alias("actual")
    )
    return report.select(
        segment,
        "n",
        round_half_even(F.col("predicted"), 4).alias("predicted_pd"),
        round_half_even(F.col("actual"), 4).alias("actual_default_rate"),
    ).orderBy(F.desc("predicted_pd"), segment)


def score_drift(baseline: DataFrame, current: DataFrame, score: str, bins: int = 10) -> DataFrame:
    """Population stability of a score against baseline deciles, one row per bin.

    An empty bin counts as half a row, so its term stays finite.
    """
    edges = decile_edges(baseline, score, bins)
    sides = baseline.select(F.lit(0).alias("now"), score).unionByName(current.select(F.lit(1).alias("now"), score))
    per_bin = sides.groupBy(bin_of(F.col(score), edges).alias("bin")).agg(
        F.count_if(F.col("now") == 0).alias("n_baseline"), F.count_if(F.col("now") == 1).alias("n_current")
    )
    everything = Window.partitionBy(F.lit(0))  # at most ``bins`` rows

    def share(n: str) -> Column:
        return F.greatest(F.col(n).cast("double"), F.lit(0.5)) / F.sum(n).over(everything)

    shares = per_bin.withColumns({"share_baseline": share("n_baseline"), "share_current": share("n_current")})
    move = F.col("share_current") - F.col("share_baseline")
    return shares.withColumn("psi", move * F.log(F.col("share_current") / F.col("share_baseline")))
