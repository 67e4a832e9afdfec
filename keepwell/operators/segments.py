"""Churn tables by customer segment."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keepwell.functions.columns import as_text_or, bands, relabel

# Segment labels and their friendly names.
NO_HISTORY = "no safe payment history"
RECENCY_STEPS = [(7, "0-7 days since payment"), (30, "8-30 days since payment"), (90, "31-90 days since payment")]
RECENCY_BEYOND = "over 90 days since payment"
FREQUENCY_STEPS = [(3, "1-3 payments"), (10, "4-10 payments"), (25, "11-25 payments")]
FREQUENCY_BEYOND = "26+ payments"
FRIENDLY_SEGMENTS = {
    "0": "Auto-renewal is off",
    "1": "Auto-renewal is on",
    "no_history": "No recent payment record",
    "no safe payment history": "No recent payment record",
}


def latest_auto_renewal() -> Column:
    return as_text_or("latest_is_auto_renew", "no_history").alias("latest_auto_renewal")


def recency_segment() -> Column:
    days = "days_since_last_transaction"
    return bands(days, RECENCY_STEPS, RECENCY_BEYOND, F.col(days).isNull(), NO_HISTORY).alias("recency_segment")


def payment_frequency_segment() -> Column:
    count = "transaction_count_to_cutoff"
    return bands(count, FREQUENCY_STEPS, FREQUENCY_BEYOND, F.col(count) == 0, NO_HISTORY).alias(
        "payment_frequency_segment"
    )


SEGMENTS = {
    "churn_by_latest_auto_renewal": lambda: [latest_auto_renewal()],
    "churn_by_payment_recency": lambda: [recency_segment()],
    "churn_by_transaction_frequency": lambda: [payment_frequency_segment()],
    "churn_by_profile_availability": lambda: [
        F.col("has_transaction_history_flag"),
        F.col("has_member_profile_flag"),
    ],
}


def churn_by(snapshot: DataFrame, name: str) -> DataFrame:
    """Customers and churn percentage per segment, highest churn first.

    A handful of segments come out of map-side partial counts, so no segment is too large.
    """
    keys = SEGMENTS[name]()
    grouped = snapshot.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("customers"),
        F.round(F.lit(100.0) * F.avg("is_churn"), 2).alias("churn_percent"),
    )
    return grouped.orderBy(F.desc("churn_percent"), *grouped.columns[: len(keys)])


def labelled_drivers(snapshot: DataFrame) -> DataFrame:
    """The three single-key churn tables in long form, with the labels a reader sees.

    One pass: every customer contributes one row per driver to the same aggregation.
    """
    drivers = F.array(
        *[
            F.struct(F.lit(name).alias("driver"), F.col(column).alias("segment"))
            for name, column in (
                ("churn_by_latest_auto_renewal", "latest_auto_renewal"),
                ("churn_by_payment_recency", "recency_segment"),
                ("churn_by_transaction_frequency", "payment_frequency_segment"),
            )
        ]
    )
    return (
        snapshot.select("is_churn", latest_auto_renewal(), recency_segment(), payment_frequency_segment())
        .select("is_churn", F.inline(drivers))
        .groupBy("driver", "segment")
        .agg(
            F.count(F.lit(1)).alias("customers"),
            F.round(F.lit(100.0) * F.avg("is_churn"), 2).alias("churn_percent"),
        )
        .withColumn("display_label", relabel("segment", FRIENDLY_SEGMENTS))
    )
