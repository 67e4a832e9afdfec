"""The customer snapshot: one row per labelled customer, nothing after the cutoff."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keepwell.operators import history, profiles

ZERO_WITHOUT_HISTORY = [
    "transaction_count_to_cutoff",
    "payment_method_count",
    "plan_type_count",
    "total_amount_paid",
    "cancellation_count",
    "transaction_count_last_31_days",
    "amount_paid_last_31_days",
    "cancellations_last_31_days",
    "transaction_count_last_90_days",
]

SNAPSHOT_COLUMNS = [
    "msno",
    "is_churn",
    "transaction_count_to_cutoff",
    "first_transaction_date",
    "last_transaction_date",
    "payment_method_count",
    "plan_type_count",
    "total_amount_paid",
    "average_amount_paid",
    "total_list_price",
    "auto_renew_rate",
    "cancellation_count",
    "cancellation_rate",
    "days_since_first_transaction",
    "days_since_last_transaction",
    "total_discount_amount",
    "discount_rate",
    "transaction_count_last_31_days",
    "amount_paid_last_31_days",
    "cancellations_last_31_days",
    "transaction_count_last_90_days",
    "latest_payment_method_id",
    "latest_plan_days",
    "latest_list_price",
    "latest_amount_paid",
    "latest_is_auto_renew",
    "latest_is_cancel",
    "city",
    "age_clean",
    "age_unknown_flag",
    "gender_clean",
    "registered_via",
    "registration_date",
    "has_transaction_history_flag",
    "has_member_profile_flag",
    "days_since_registration",
]


def presence_flags() -> dict[str, Column]:
    """A profile counts as present when its city is known."""
    return {
        "has_transaction_history_flag": F.col("transaction_count_to_cutoff").isNotNull().cast("tinyint"),
        "has_member_profile_flag": F.col("city").isNotNull().cast("tinyint"),
    }


def customer_snapshot(
    labels: DataFrame, transactions: DataFrame, members: DataFrame, cutoff: dt.date
) -> DataFrame:
    """Labels left-joined to the one-pass transaction features and the masked profiles.

    Both joins are on the customer id, which is how the feature aggregation has already
    partitioned its output: the transactions are shuffled once, as per-customer partial aggregates.
    """
    features = history.transaction_features(history.history_as_of(transactions, cutoff), cutoff)
    return (
        labels.join(features, "msno", "left")
        .join(profiles.profile_as_of(members, cutoff), "msno", "left")
        .withColumns(
            {**presence_flags(), "days_since_registration": F.datediff(F.lit(cutoff), "registration_date")}
        )
        .fillna(0, subset=ZERO_WITHOUT_HISTORY)
        .select(*SNAPSHOT_COLUMNS)
    )


def snapshot_summary(snapshot: DataFrame) -> DataFrame:
    return snapshot.agg(
        F.count(F.lit(1)).alias("customers"),
        F.count_distinct("msno").alias("unique_customers"),
        F.sum("has_transaction_history_flag").alias("customers_with_safe_history"),
        F.sum("has_member_profile_flag").alias("customers_with_profile"),
        F.avg("is_churn").alias("churn_rate"),
    )
