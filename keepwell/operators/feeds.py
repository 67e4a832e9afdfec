"""Tables that a dashboard reads, and text search over a table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from keepwell.functions.columns import relabel

# Friendly model names.
FRIENDLY_MODELS = {
    "boosted_ordinal_isotonic_calibrated": "Calibrated boosted trees, ordinal",
    "boosted_nominal_deep_isotonic_calibrated": "Calibrated boosted trees, deep",
    "boosted_nominal_isotonic_calibrated": "Calibrated boosted trees, nominal",
}


def kpis(snapshot: DataFrame, winner: DataFrame) -> DataFrame:
    """One row: customers, churn rate, the champion and its two headline numbers."""
    head = winner.select(
        F.struct("model", "accuracy_at_50_percent_risk", "top_10_percent_actual_churn").alias("head")
    ).scalar()
    return (
        snapshot.agg(F.count(F.lit(1)).alias("customers"), F.avg("is_churn").alias("churn_rate"))
        .withColumn("head", head)
        .select(
            "customers",
            "churn_rate",
            relabel(F.col("head.model"), FRIENDLY_MODELS).alias("champion"),
            F.col("head.accuracy_at_50_percent_risk").alias("champion_accuracy"),
            F.col("head.top_10_percent_actual_churn").alias("top_10_percent_churn"),
        )
    )


def model_comparison(metrics: DataFrame) -> DataFrame:
    return metrics.select(
        relabel("model", FRIENDLY_MODELS).alias("model_name"),
        "roc_auc",
        F.col("lift_at_top_10_percent").alias("lift"),
        F.col("accuracy_at_50_percent_risk").alias("accuracy"),
    )


def campaign_curve(grid: DataFrame, recommended: DataFrame) -> DataFrame:
    """Spend options with a marker for the recommended one and each option's share of the best net value."""
    chosen = recommended.agg(F.max("capacity_percent")).scalar()
    # As many rows as the capacity grid has.
    best = F.max("scenario_net_value").over(Window.partitionBy())
    return grid.select(
        "capacity_percent",
        "customers_targeted",
        "campaign_spend",
        "within_budget",
        "scenario_net_value",
        F.try_divide(F.col("scenario_net_value"), best).alias("share_of_best_net_value"),
        F.coalesce(F.col("capacity_percent") == chosen, F.lit(False)).alias("recommended"),
    )


def matches_any(df: DataFrame, pattern: str) -> Column:
    """Whether any column, read as text, contains the pattern, whatever the case."""
    hits = [F.coalesce(F.col(c).cast("string").rlike(f"(?i){pattern}"), F.lit(False)) for c in df.columns]
    return F.greatest(*hits) if len(hits) > 1 else hits[0]


def first_matching_row(df: DataFrame, pattern: str, order: str) -> DataFrame:
    """The first row, by ``order``, that matches anywhere; the last row when none does.

    One pass that keeps a single row per task.
    """
    return (
        df.withColumn("_hit", matches_any(df, pattern))
        .orderBy(F.desc("_hit"), F.when(F.col("_hit"), F.col(order)).asc_nulls_last(), F.desc(order))
        .limit(1)
        .drop("_hit")
    )
