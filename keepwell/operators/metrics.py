"""Ranking and probability metrics, all from one score curve per model."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keepwell.operators.ranking import cut_totals, score_curve

TOP_PERCENT = 10.0


def _share(numerator: Column, denominator: Column) -> Column:
    """0 where there is nothing to divide by."""
    return F.coalesce(F.try_divide(numerator, denominator), F.lit(0.0))


def _curve_metrics() -> list[Column]:
    churned, customers = F.col("churned"), F.col("customers")
    kept = customers - churned
    above = F.col("cum_churned") - churned
    positives, negatives = F.sum(churned), F.sum(kept)
    flagged = F.col("risk") >= 0.5
    true_pos = F.sum(F.when(flagged, churned).otherwise(0))
    false_pos = F.sum(F.when(flagged, kept).otherwise(0))
    squared = churned * (1 - F.col("risk")) * (1 - F.col("risk")) + kept * F.col("risk") * F.col("risk")
    # A non-churner loses to every churner above it and ties with half of those at its score.
    wins = F.sum(kept.cast("double") * above + kept.cast("double") * churned / 2)
    precision_steps = F.sum(churned.cast("double") * F.col("cum_churned") / F.col("cum_customers"))
    return [
        F.sum(customers).alias("test_customers"),
        F.try_divide(positives, F.sum(customers)).alias("base_churn_rate"),
        F.try_divide(true_pos + negatives - false_pos, F.sum(customers)).alias("accuracy_at_50_percent_risk"),
        _share(true_pos, true_pos + false_pos).alias("precision_at_50_percent_risk"),
        _share(true_pos, positives).alias("recall_at_50_percent_risk"),
        F.try_divide(wins, positives.cast("double") * negatives).alias("roc_auc"),
        F.try_divide(precision_steps, positives).alias("average_precision"),
        F.try_divide(F.sum(squared), F.sum(customers)).alias("brier_score"),
    ]


def curve_metrics(curve: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Accuracy, precision, recall at 0.5, exact ROC-AUC, step-wise average precision, Brier score."""
    return curve.groupBy(*by).agg(*_curve_metrics())


def ranking_curve(scored: DataFrame) -> DataFrame:
    """True and false positives when everyone down to a score is contacted."""
    curve = score_curve(scored)
    hits, contacted = F.col("cum_churned"), F.col("cum_customers")
    return curve.select(
        "risk",
        "customers",
        "churned",
        hits.alias("true_positives"),
        (contacted - hits).alias("false_positives"),
        F.try_divide(hits, contacted).alias("precision"),
        F.try_divide(hits, F.col("total_churned")).alias("recall"),
    )


def _top_rates() -> dict[str, Column]:
    rate = F.try_divide(F.col("churned"), F.col("customers_targeted"))
    base = F.try_divide(F.col("total_churned"), F.col("total_customers"))
    return {
        "top_10_percent_actual_churn": rate,
        "lift_at_top_10_percent": F.try_divide(rate, base),
    }


def top_decile(scored: DataFrame, curve: DataFrame, by: Sequence[str] = (), id_col: str = "msno") -> DataFrame:
    """Churn among the first tenth, and its lift over the base rate."""
    cut = cut_totals(scored, curve, F.array(F.lit(TOP_PERCENT)), id_col, by)
    return cut.select(
        *by, "customers_targeted", *[column.alias(name) for name, column in _top_rates().items()]
    )


def campaign_threshold(scored: DataFrame, capacity: float = TOP_PERCENT, id_col: str = "msno") -> DataFrame:
    """The score at which the contact list of the given capacity ends."""
    cut = cut_totals(scored, score_curve(scored), F.array(F.lit(float(capacity))), id_col)
    return cut.select(
        F.lit(f"top {capacity:g} percent of customers by calibrated risk").alias("campaign_capacity"),
        F.col("capacity_percent").alias("campaign_capacity_percent"),
        F.col("risk_threshold").alias("calibrated_risk_threshold"),
        "customers_targeted",
        F.try_divide(F.col("churned"), F.col("customers_targeted")).alias("actual_churn_rate_in_targeted_group"),
        F.try_divide(F.col("total_churned"), F.col("total_customers")).alias("overall_test_churn_rate"),
    )


def model_metrics(scored: DataFrame, id_col: str = "msno") -> DataFrame:
    """One record per model of a long-form score table (model, id, is_churn, risk)."""
    curve = score_curve(scored, ["model"])
    # One row per model on both sides.
    return curve_metrics(curve, ["model"]).join(
        F.broadcast(top_decile(scored, curve, ["model"], id_col).drop("customers_targeted")), "model"
    )


# The three record shapes in which metrics are reported.
TOURNAMENT_RECORD = [
    "model",
    "test_customers",
    "accuracy_at_50_percent_risk",
    "precision_at_50_percent_risk",
    "recall_at_50_percent_risk",
    "roc_auc",
    "average_precision",
    "brier_score",
    "top_10_percent_actual_churn",
    "lift_at_top_10_percent",
]
CALIBRATION_RECORD = [
    "model",
    "test_customers",
    "roc_auc",
    "average_precision",
    "brier_score",
    "top_10_percent_actual_churn",
    "lift_at_top_10_percent",
]
BASELINE_RECORD = {
    "model": "model",
    "test_customers": "test_customers",
    "base_churn_rate": "base_churn_rate",
    "roc_auc": "roc_auc",
    "average_precision": "average_precision",
    "precision_at_50_percent_risk": "precision_at_0_50",
    "recall_at_50_percent_risk": "recall_at_0_50",
    "accuracy_at_50_percent_risk": "accuracy_at_0_50",
    "top_10_percent_actual_churn": "top_10_percent_churn_rate",
    "lift_at_top_10_percent": "lift_at_top_10_percent",
}


def report_rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles rounded for a report, everything else as it is."""
    return df.select(
        *[
            F.round(name, digits).alias(name) if kind == "double" else F.col(name)
            for name, kind in df.dtypes
        ]
    )


def tournament_records(metrics: DataFrame) -> DataFrame:
    return metrics.select(*TOURNAMENT_RECORD)


def calibration_records(metrics: DataFrame) -> DataFrame:
    return metrics.select(*CALIBRATION_RECORD)


def baseline_records(metrics: DataFrame) -> DataFrame:
    return metrics.select(*[F.col(name).alias(shown) for name, shown in BASELINE_RECORD.items()])
