"""Explicit schemas of the raw tables and the scenario config; nothing is inferred at read."""

from __future__ import annotations

from pyspark.sql import types as T


def transactions(id_type: T.DataType | None = None) -> T.StructType:
    """One row per payment event. Dates are compact ``yyyymmdd`` integers."""
    return T.StructType(
        [T.StructField("msno", id_type or T.StringType())]
        + [
            T.StructField(name, T.IntegerType())
            for name in ("transaction_date", "membership_expire_date", "payment_method_id", "payment_plan_days")
        ]
        + [T.StructField(name, T.LongType()) for name in ("plan_list_price", "actual_amount_paid")]
        + [T.StructField(name, T.IntegerType()) for name in ("is_auto_renew", "is_cancel")]
    )


def members(id_type: T.DataType | None = None) -> T.StructType:
    return T.StructType(
        [
            T.StructField("msno", id_type or T.StringType()),
            T.StructField("city", T.IntegerType()),
            T.StructField("bd", T.IntegerType()),
            T.StructField("gender", T.StringType()),
            T.StructField("registered_via", T.IntegerType()),
            T.StructField("registration_init_time", T.IntegerType()),
        ]
    )


def labels(id_type: T.DataType | None = None) -> T.StructType:
    return T.StructType(
        [T.StructField("msno", id_type or T.StringType()), T.StructField("is_churn", T.IntegerType())]
    )


SCENARIO = T.StructType(
    [
        T.StructField("campaign_capacity_percent", T.DoubleType()),
        T.StructField("offer_cost_per_customer", T.DoubleType()),
        T.StructField("assumed_save_rate", T.DoubleType()),
        T.StructField("value_months", T.IntegerType()),
        T.StructField("monetary_unit_label", T.StringType()),
        T.StructField("value_proxy_multiplier", T.DoubleType()),
        T.StructField("maximum_campaign_budget", T.DoubleType()),
        T.StructField("capacity_grid_percent", T.ArrayType(T.DoubleType())),
        T.StructField("sensitivity_capacity_percent", T.ArrayType(T.DoubleType())),
        T.StructField("sensitivity_save_rates", T.ArrayType(T.DoubleType())),
    ]
)
