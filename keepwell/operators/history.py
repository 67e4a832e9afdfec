"""Point-in-time transaction features: one pass and one shuffle over the payment history."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keepwell.functions.columns import compact_date, ratio

LATEST = {
    "latest_payment_method_id": "payment_method_id",
    "latest_plan_days": "payment_plan_days",
    "latest_list_price": "plan_list_price",
    "latest_amount_paid": "actual_amount_paid",
    "latest_is_auto_renew": "is_auto_renew",
    "latest_is_cancel": "is_cancel",
}


def parsed(transactions: DataFrame) -> DataFrame:
    """Adds the two parsed dates."""
    return transactions.withColumns(
        {
            "transaction_date_parsed": compact_date("transaction_date"),
            "membership_expire_date_parsed": compact_date("membership_expire_date"),
        }
    )


def of_labelled(transactions: DataFrame, labels: DataFrame) -> DataFrame:
    """Payments of labelled customers, filtered before anything is aggregated or shuffled.

    Worth it when many paying customers carry no label. The engine picks the join by the size of the
    id list; the snapshot is the same without it.
    """
    return transactions.join(labels.select("msno"), "msno", "left_semi")


def history_as_of(transactions: DataFrame, cutoff: dt.date) -> DataFrame:
    """Transactions dated on or before ``cutoff``; undated ones drop out.

    The same bound is also put on the raw integer. Valid compact dates order like dates, so the
    extra predicate removes nothing that the parsed one keeps, and unlike it reaches the scan.
    """
    raw_bound = int(cutoff.strftime("%Y%m%d"))
    return parsed(transactions.filter(F.col("transaction_date") <= raw_bound)).filter(
        F.col("transaction_date_parsed") <= F.lit(cutoff)
    )


def _total(col: Column) -> Column:
    return F.coalesce(F.sum(col), F.lit(0))


def distinct_codes(col: str) -> Column:
    """Distinct values, with null counting as one more value.

    The buffer holds the distinct codes of a column with a catalogue of codes (payment methods,
    plan lengths), never rows: a customer with a third of all payments has no larger a set than
    one with a few dozen. It stays in the same shuffle as the other aggregates, where two
    ``count_distinct`` would triple the rows.
    """
    has_null = F.coalesce(F.max(F.col(col).isNull().cast("int")), F.lit(0))
    return (F.size(F.collect_set(col)) + has_null).cast("bigint")


def within(cutoff: dt.date, days: int) -> Column:
    """True in the trailing window of ``days`` days, the cutoff day included."""
    return F.col("transaction_date_parsed") >= F.lit(cutoff - dt.timedelta(days=days - 1))


def lifetime_aggregates() -> list[Column]:
    return [
        F.count(F.lit(1)).alias("transaction_count_to_cutoff"),
        F.min("transaction_date_parsed").alias("first_transaction_date"),
        F.max("transaction_date_parsed").alias("last_transaction_date"),
        distinct_codes("payment_method_id").alias("payment_method_count"),
        distinct_codes("payment_plan_days").alias("plan_type_count"),
        _total(F.col("actual_amount_paid")).alias("total_amount_paid"),
        F.avg("actual_amount_paid").alias("average_amount_paid"),
        _total(F.col("plan_list_price")).alias("total_list_price"),
        F.avg("is_auto_renew").alias("auto_renew_rate"),
        _total(F.col("is_cancel")).alias("cancellation_count"),
        F.avg("is_cancel").alias("cancellation_rate"),
    ]


def month_aggregates(cutoff: dt.date) -> list[Column]:
    recent = within(cutoff, 31)
    return [
        F.count_if(recent).alias("transaction_count_last_31_days"),
        _total(F.when(recent, F.col("actual_amount_paid"))).alias("amount_paid_last_31_days"),
        _total(F.when(recent, F.col("is_cancel"))).alias("cancellations_last_31_days"),
    ]


def quarter_aggregates(cutoff: dt.date) -> list[Column]:
    return [F.count_if(within(cutoff, 90)).alias("transaction_count_last_90_days")]


def latest_aggregate() -> Column:
    """The last event by (date, cancel flag, expiry): a same-day cancellation comes last.

    Nulls order first inside a struct. The payload columns follow the three keys and so settle
    any remaining tie the same way on every run.
    """
    keys = ["transaction_date_parsed", F.col("is_cancel").alias("latest_is_cancel"), "membership_expire_date_parsed"]
    payload = [F.col(source).alias(name) for name, source in LATEST.items() if source != "is_cancel"]
    return F.max(F.struct(*keys, *payload)).alias("latest")


def recency_columns(cutoff: dt.date) -> dict[str, Column]:
    return {
        "days_since_first_transaction": F.datediff(F.lit(cutoff), "first_transaction_date"),
        "days_since_last_transaction": F.datediff(F.lit(cutoff), "last_transaction_date"),
    }


def discount_columns() -> dict[str, Column]:
    saved = F.col("total_list_price") - F.col("total_amount_paid")
    return {
        "total_discount_amount": saved,
        "discount_rate": ratio(saved, F.col("total_list_price")),
    }


def lifetime_features(history: DataFrame, cutoff: dt.date) -> DataFrame:
    return (
        history.groupBy("msno")
        .agg(*lifetime_aggregates())
        .withColumns({**recency_columns(cutoff), **discount_columns()})
    )


def latest_features(history: DataFrame) -> DataFrame:
    return history.groupBy("msno").agg(latest_aggregate()).select("msno", *[F.col(f"latest.{name}") for name in LATEST])


def transaction_features(history: DataFrame, cutoff: dt.date) -> DataFrame:
    """Lifetime, 31-day, 90-day and latest-state features together.

    Customers in a window are a subset of those with history, so conditional aggregates in one
    ``groupBy`` replace four aggregations and the joins between them.
    """
    return (
        history.groupBy("msno")
        .agg(
            *lifetime_aggregates(),
            *month_aggregates(cutoff),
            *quarter_aggregates(cutoff),
            latest_aggregate(),
        )
        .withColumns({**recency_columns(cutoff), **discount_columns()})
        .select("*", *[F.col(f"latest.{name}") for name in LATEST])
        .drop("latest")
    )
