"""Choosing the champion model by rule, and its scores."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keepwell.operators.metrics import TOURNAMENT_RECORD

# Fixed value: the rule as it is recorded with the winner.
SELECTION_RULE = "highest top-10% lift; then lower Brier score; then average precision and ROC-AUC"


def ranked_models(metrics: DataFrame) -> DataFrame:
    """Best first. One row per model, so the sort is a handful of rows."""
    return metrics.orderBy(
        F.desc("lift_at_top_10_percent"),
        F.asc("brier_score"),
        F.desc("average_precision"),
        F.desc("roc_auc"),
        F.asc("model"),
    )


def champion(metrics: DataFrame) -> DataFrame:
    return ranked_models(metrics).limit(1)


def champion_record(metrics: DataFrame) -> DataFrame:
    """The winner as one JSON document: name, rule and metrics."""
    record = F.struct(
        F.col("model").alias("selected_model"),
        F.lit(SELECTION_RULE).alias("selection_rule"),
        F.struct(*[F.col(name) for name in TOURNAMENT_RECORD]).alias("metrics"),
    )
    return champion(metrics).select(F.to_json(record).alias("record"))


def champion_scores(scores: DataFrame, winner: DataFrame) -> DataFrame:
    """The winner's rows of the long score table (model, msno, is_churn, risk)."""
    return scores.filter(F.col("model") == winner.select("model").scalar())


def wide_predictions(scores: DataFrame, models: list[str], winner: DataFrame) -> DataFrame:
    """One row per customer: a probability column per model and the champion's."""
    chosen = winner.select("model").scalar()
    return scores.groupBy("msno", "is_churn").agg(
        *[F.max(F.when(F.col("model") == m, F.col("risk"))).alias(probability_column(m)) for m in models],
        F.max(F.when(F.col("model") == chosen, F.col("risk"))).alias("champion_calibrated_probability"),
    )


def probability_column(model: str) -> str:
    return f"{model.removesuffix('_isotonic_calibrated')}_calibrated_probability"


def reselect(predictions: DataFrame, models: list[str], winner: DataFrame) -> DataFrame:
    """Stored wide predictions with the champion column taken anew from the winner's."""
    chosen = winner.select("model").scalar()
    pick = F.coalesce(*[F.when(chosen == F.lit(m), F.col(probability_column(m))) for m in models])
    return predictions.withColumn("champion_calibrated_probability", pick)
