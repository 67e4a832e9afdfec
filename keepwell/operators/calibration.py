"""Isotonic calibration and the reliability table."""

from __future__ import annotations

from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BANDS = 10


def fit_isotonic(scored: DataFrame) -> IsotonicRegressionModel:
    """Monotone map from raw score to observed churn, learned on the calibration role.

    Ties are pooled first: one weighted row per distinct score gives the same fit, and the final
    merge, on the driver, sees the levels that each partition's own merge has left, not rows.
    """
    pooled = scored.groupBy("risk").agg(
        F.avg("is_churn").alias("churn_rate"), F.count(F.lit(1)).cast("double").alias("customers")
    )
    return IsotonicRegression(
        featuresCol="risk", labelCol="churn_rate", weightCol="customers", predictionCol="calibrated", isotonic=True
    ).fit(pooled)


def calibrate(scored: DataFrame, model: IsotonicRegressionModel) -> DataFrame:
    """Adds ``calibrated``: linear between the learned scores, clipped outside them."""
    return model.transform(scored)


def calibration_table(scored: DataFrame) -> DataFrame:
    """Ten right-closed risk bands over [0, 1], zero in the first; empty bands are kept.

    The edges are the doubles 0.1 * i, as an evenly spaced grid has them.
    """
    spark = scored.sparkSession
    edge = [0.1 * i for i in range(BANDS)] + [1.0]
    # Nested only ten deep, and evaluated in generated code.
    band = F.when(F.col("risk") < 0.0, F.lit(None))
    for i in range(1, BANDS + 1):
        band = band.when(F.col("risk") <= F.lit(edge[i]), F.lit(i - 1))
    counted = (
        scored.withColumn("band", band.cast("bigint"))
        .filter(F.col("band").isNotNull())
        .groupBy("band")
        .agg(
            F.count(F.lit(1)).alias("customers"),
            F.avg("risk").alias("average_predicted_risk"),
            F.avg("is_churn").alias("actual_churn_rate"),
        )
    )
    bands = spark.range(BANDS).select(
        F.col("id").alias("band"),
        (F.col("id") * F.lit(0.1)).alias("risk_over"),
        F.when(F.col("id") == BANDS - 1, F.lit(1.0)).otherwise((F.col("id") + 1) * F.lit(0.1)).alias("risk_up_to"),
    )
    # Ten rows on either side.
    return bands.join(F.broadcast(counted), "band", "left").select(
        "risk_over",
        "risk_up_to",
        F.coalesce("customers", F.lit(0)).alias("customers"),
        "average_predicted_risk",
        "actual_churn_rate",
    )
