"""The subscription tables, derived from the star-schema test tables."""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keepwell.functions.hashing import hash_bucket

CUTOFF = dt.date(1997, 12, 31)

# Fixed values of the scenario config.
OFFER_COST = 30.0
CAPACITY_GRID = [1.0, 2.0, 5.0, 10.0, 15.0, 20.0, 25.0, 30.0]
SENSITIVITY_CAPACITIES = [5.0, 10.0, 20.0]
SENSITIVITY_SAVE_RATES = [0.05, 0.1, 0.2]

# One hash seed per stand-in model.
MODEL_SEEDS = {
    "boosted_ordinal_isotonic_calibrated": "42|",
    "boosted_nominal_deep_isotonic_calibrated": "43|",
    "boosted_nominal_isotonic_calibrated": "44|",
}

# Plain statements, the same in any SQL dialect.
TRANSACTIONS_SQL = """
SELECT o.o_custkey AS msno,
  CASE WHEN o.o_orderkey % 997 = 0 THEN 0
       ELSE CAST(year(o.o_orderdate)*10000+month(o.o_orderdate)*100+day(o.o_orderdate) AS INT) END AS transaction_date,
  CAST(year(l.ship)*10000+month(l.ship)*100+day(l.ship) AS INT) AS membership_expire_date,
  CASE WHEN o.o_orderkey % 41 = 0 THEN NULL ELSE CAST(substr(o.o_orderpriority,1,1) AS INT) END AS payment_method_id,
  CAST(l.n * 30 AS INT) AS payment_plan_days,
  l.list_price AS plan_list_price, l.paid AS actual_amount_paid,
  CASE WHEN o.o_orderstatus='F' THEN 0 ELSE 1 END AS is_auto_renew,
  CASE WHEN o.o_orderstatus='P' THEN 1 ELSE 0 END AS is_cancel
FROM orders o JOIN (
  SELECT l_orderkey, max(l_shipdate) AS ship, count(*) AS n,
    CAST(floor(sum(CAST(l_extendedprice AS DECIMAL(12,2)))) AS BIGINT) AS list_price,
    CAST(floor(sum(CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))))) AS BIGINT) AS paid
  FROM lineitem GROUP BY l_orderkey) l ON l.l_orderkey = o.o_orderkey
"""

MEMBERS_SQL = """
SELECT c_custkey AS msno,
  CASE WHEN c_custkey % 10 = 0 THEN NULL ELSE c_nationkey END AS city,
  CAST(floor(c_acctbal/100) AS INT) AS bd,
  CASE c_mktsegment WHEN 'BUILDING' THEN 'female' WHEN 'MACHINERY' THEN 'male' ELSE NULL END AS gender,
  CAST(length(c_mktsegment) AS INT) AS registered_via,
  CAST((1994 + c_custkey % 5)*10000 + (1 + c_custkey % 12)*100 + 1 + c_custkey % 28 AS INT) AS registration_init_time
FROM customer WHERE c_custkey % 15 <> 3
"""

LABELS_SQL = """
SELECT c.c_custkey AS msno, CASE WHEN count(o.o_orderkey) = 0 THEN 1 ELSE 0 END AS is_churn
FROM customer c LEFT JOIN orders o ON o.o_custkey = c.c_custkey
  AND o.o_orderdate > TIMESTAMP '1997-12-31 00:00:00' AND o.o_orderdate <= TIMESTAMP '1999-06-30 00:00:00'
GROUP BY c.c_custkey
"""


# The columns in use, by type: no footer has to be read to plan a query.
STAR_SCHEMAS = {
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_orderdate timestamp_ntz, "
    "o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_extendedprice double, l_discount double, l_shipdate timestamp_ntz",
    "customer": "c_custkey bigint, c_nationkey int, c_acctbal double, c_mktsegment string",
}


def _derive(spark: SparkSession, sf_dir: str, statement: str) -> DataFrame:
    names = "|".join(STAR_SCHEMAS)
    tables = {
        name: spark.read.schema(STAR_SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")
        for name in set(re.findall(rf"\b(?:{names})\b", statement))
    }
    return spark.sql(re.sub(rf"\b({names})\b", r"{\1}", statement), **tables)


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``TRANSACTIONS_SQL`` with the money summed as whole cents and discounts as whole percents.

    The same amounts, but in 64-bit integers, where wide decimals would leave generated code.
    """
    in_cents = TRANSACTIONS_SQL.replace(
        "CAST(floor(sum(CAST(l_extendedprice AS DECIMAL(12,2)))) AS BIGINT)",
        "sum(floor(l_extendedprice * 100 + 0.5)) div 100",
    ).replace(
        "CAST(floor(sum(CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))))) AS BIGINT)",
        "sum(floor(l_extendedprice * 100 + 0.5) * (100 - floor(l_discount * 100 + 0.5))) div 10000",
    )
    return _derive(spark, sf_dir, in_cents)


def members(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _derive(spark, sf_dir, MEMBERS_SQL)


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``LABELS_SQL`` with the orders counted per customer before the join.

    A customer with a third of all orders is then one row on the way to the join.
    """
    return _derive(
        spark,
        sf_dir,
        """
SELECT c.c_custkey AS msno, CASE WHEN o.n IS NULL THEN 1 ELSE 0 END AS is_churn
FROM customer c LEFT JOIN (
  SELECT o_custkey, count(*) AS n FROM orders
  WHERE o_orderdate > TIMESTAMP '1997-12-31 00:00:00' AND o_orderdate <= TIMESTAMP '1999-06-30 00:00:00'
  GROUP BY o_custkey) o ON o.o_custkey = c.c_custkey
""",
    )


def scored(spark: SparkSession, sf_dir: str, seed: str = "42|") -> DataFrame:
    """Hash-drawn scores on 40 levels: they rank churners high and have plateaus."""
    first, second = hash_bucket(seed, "msno"), hash_bucket(seed, "msno", offset=9)
    draw = F.when(F.col("is_churn") == 1, F.greatest(first, second)).otherwise(F.least(first, second))
    return labels(spark, sf_dir).select(
        "msno", "is_churn", (F.floor(draw / F.lit(250.0)).cast("double") / 40).alias("risk")
    )


def scored_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same customers scored three times, in long form (model, msno, is_churn, risk)."""
    draws = F.array(
        *[
            F.struct(F.lit(model).alias("model"), F.lit(seed).alias("seed"))
            for model, seed in MODEL_SEEDS.items()
        ]
    )
    long = labels(spark, sf_dir).select("msno", "is_churn", F.inline(draws))
    first, second = hash_bucket(F.col("seed"), "msno"), hash_bucket(F.col("seed"), "msno", offset=9)
    draw = F.when(F.col("is_churn") == 1, F.greatest(first, second)).otherwise(F.least(first, second))
    return long.select(
        "model", "msno", "is_churn", (F.floor(draw / F.lit(250.0)).cast("double") / 40).alias("risk")
    )


def scenario(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The scenario config with a budget of 15 % of the customers, so the larger options do not fit."""
    budget = F.floor(F.count(F.lit(1)) * F.lit(0.15)).cast("double") * F.lit(OFFER_COST)
    return (
        labels(spark, sf_dir)
        .agg(budget.alias("maximum_campaign_budget"))
        .select(
            F.lit(10.0).alias("campaign_capacity_percent"),
            F.lit(OFFER_COST).alias("offer_cost_per_customer"),
            F.lit(0.1).alias("assumed_save_rate"),
            F.lit(6).alias("value_months"),
            F.lit("dataset currency units").alias("monetary_unit_label"),
            F.lit(1.0).alias("value_proxy_multiplier"),
            "maximum_campaign_budget",
            F.array(*map(F.lit, CAPACITY_GRID)).alias("capacity_grid_percent"),
            F.array(*map(F.lit, SENSITIVITY_CAPACITIES)).alias("sensitivity_capacity_percent"),
            F.array(*map(F.lit, SENSITIVITY_SAVE_RATES)).alias("sensitivity_save_rates"),
        )
    )
