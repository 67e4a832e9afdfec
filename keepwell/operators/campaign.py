"""From calibrated risk to contact lists, scenarios and a budgeted recommendation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from keepwell.operators.ranking import cut_totals, score_curve, top_customers


def check_scenario(config: Row) -> Row:
    """Raises before any customer row is read when a setting is out of range."""
    capacities = [
        config["campaign_capacity_percent"],
        *config["capacity_grid_percent"],
        *config["sensitivity_capacity_percent"],
    ]
    if not all(0 < c <= 100 for c in capacities):
        raise ValueError("Campaign capacities must be above 0 and at most 100 percent.")
    for name in ("offer_cost_per_customer", "maximum_campaign_budget", "value_proxy_multiplier"):
        if config[name] < 0:
            raise ValueError(f"{name} must not be negative.")
    if not all(0 <= r <= 1 for r in [config["assumed_save_rate"], *config["sensitivity_save_rates"]]):
        raise ValueError("Save rates must lie between 0 and 1.")
    return config


def merge_one_to_one(left: DataFrame, right: DataFrame, key: str = "msno") -> DataFrame:
    """Left join that fails when ``key`` is not unique on either side.

    Each side is grouped by the key first. The grouping collapses duplicates, however many, to
    one counted row and leaves the rows partitioned as the join needs them, so the check costs
    no shuffle of its own.
    """

    def keyed(side: DataFrame, name: str) -> DataFrame:
        others = [c for c in side.columns if c != key]
        counted = side.groupBy(key).agg(*[F.first(c).alias(c) for c in others], F.count(F.lit(1)).alias("_copies"))
        message = F.concat(F.lit(f"{key} is not unique on the {name} side: "), F.col(key).cast("string"))
        return counted.filter(
            F.when(F.col("_copies") > 1, F.raise_error(message).cast("boolean")).otherwise(F.lit(True))
        ).drop("_copies")

    return keyed(left, "left").join(keyed(right, "right"), key, "left")


def monthly_value_proxy(multiplier: float = 1.0) -> Column:
    """Latest payment, else the average one, else nothing."""
    base = F.coalesce(F.col("latest_amount_paid").cast("double"), F.col("average_amount_paid"), F.lit(0.0))
    return base if multiplier == 1.0 else base * F.lit(float(multiplier))


def scored_with_value(scored: DataFrame, model_input: DataFrame, multiplier: float = 1.0) -> DataFrame:
    values = model_input.select("msno", "latest_amount_paid", "average_amount_paid")
    return merge_one_to_one(scored, values).withColumn("monthly_value_proxy", monthly_value_proxy(multiplier))


def priority_list(valued: DataFrame, capacity: float) -> DataFrame:
    """The deployable list: ranked, without the label, which no real campaign would know."""
    return (
        top_customers(valued, capacity, "msno")
        .withColumn("campaign_capacity_percent", F.lit(float(capacity)))
        .drop("is_churn")
    )


def target_totals(valued: DataFrame, capacities: list[float]) -> DataFrame:
    """Count, expected churners and value of the top customers for every capacity, in one pass."""
    grid = F.array(*[F.lit(float(c)) for c in dict.fromkeys(capacities)])
    sums = {"value": F.col("monthly_value_proxy")}
    return cut_totals(valued, score_curve(valued, sums=sums), grid, "msno", sums=sums)


def scenario_table(
    targets: DataFrame, save_rates: list[float], offer_cost: float, value_months: int
) -> DataFrame:
    """One row per capacity and save rate: cost, retained value, net value, return."""
    k = F.col("customers_targeted")
    rate = F.col("save_rate")
    saved = F.col("risk_mass") * rate
    value = F.col("value") / k
    return (
        targets.withColumn("save_rate", F.explode(F.array(*[F.lit(float(r)) for r in save_rates])))
        .select(
            F.col("capacity_percent").alias("campaign_capacity_percent"),
            (rate * 100).alias("assumed_save_rate_percent"),
            "customers_targeted",
            (F.col("risk_mass") / k).alias("average_calibrated_risk"),
            F.col("risk_mass").alias("expected_churners_from_model"),
            value.alias("average_monthly_value_proxy"),
            F.lit(float(offer_cost)).alias("offer_cost_per_customer"),
            F.lit(int(value_months)).alias("value_months"),
            saved.alias("expected_saved_customers"),
            (saved * value * F.lit(int(value_months))).alias("scenario_retained_value"),
            (k * F.lit(float(offer_cost))).alias("campaign_cost"),
        )
        .withColumn("scenario_net_value", F.col("scenario_retained_value") - F.col("campaign_cost"))
        .withColumn("scenario_roi", F.try_divide("scenario_net_value", "campaign_cost"))
        .orderBy("campaign_capacity_percent", "assumed_save_rate_percent")
    )


def spend_grid(targets: DataFrame, config: Row) -> DataFrame:
    """One row per capacity: spend against budget, break-even save rate, net value."""
    k = F.col("customers_targeted")
    per_saved = F.col("value") / k * F.lit(config["value_months"])
    at_stake = F.col("expected_churners") * F.col("value_per_saved_customer")
    worth = (F.col("expected_churners") > 0) & (F.col("value_per_saved_customer") > 0)
    return (
        targets.select(
            "capacity_percent",
            "customers_targeted",
            (k * F.lit(config["offer_cost_per_customer"])).alias("campaign_spend"),
            (F.col("risk_mass") / k).alias("average_calibrated_risk"),
            F.col("risk_mass").alias("expected_churners"),
            F.lit(config["assumed_save_rate"] * 100).alias("assumed_save_rate_percent"),
            (F.col("risk_mass") * F.lit(config["assumed_save_rate"])).alias("expected_saved_customers"),
            per_saved.alias("value_per_saved_customer"),
        )
        .withColumns(
            {
                "within_budget": F.col("campaign_spend") <= F.lit(config["maximum_campaign_budget"]),
                "break_even_save_rate_percent": F.when(worth, F.col("campaign_spend") / at_stake * 100),
                "scenario_retained_value": F.col("expected_saved_customers") * F.col("value_per_saved_customer"),
            }
        )
        .withColumn("scenario_net_value", F.col("scenario_retained_value") - F.col("campaign_spend"))
        .withColumn("scenario_roi", F.try_divide("scenario_net_value", "campaign_spend"))
        .select(
            "capacity_percent",
            "customers_targeted",
            "campaign_spend",
            "within_budget",
            "average_calibrated_risk",
            "expected_churners",
            "assumed_save_rate_percent",
            "break_even_save_rate_percent",
            "expected_saved_customers",
            "value_per_saved_customer",
            "scenario_retained_value",
            "scenario_net_value",
            "scenario_roi",
        )
    )


def feasible(grid: DataFrame) -> DataFrame:
    return grid.filter("within_budget")


def recommendation(grid: DataFrame, capacities: list[float]) -> DataFrame:
    """The feasible option of highest net value, the earlier in the grid on a tie; empty if none fits."""
    place = F.array_position(F.array(*[F.lit(float(c)) for c in capacities]), F.col("capacity_percent"))
    return feasible(grid).orderBy(F.desc("scenario_net_value"), place).limit(1)


# Digits of the report tables.
SCENARIO_DIGITS = {
    "assumed_save_rate_percent": 2,
    "average_calibrated_risk": 4,
    "expected_churners_from_model": 1,
    "expected_churners": 1,
    "average_monthly_value_proxy": 2,
    "break_even_save_rate_percent": 2,
    "expected_saved_customers": 1,
    "value_per_saved_customer": 2,
    "scenario_retained_value": 2,
    "campaign_cost": 2,
    "campaign_spend": 2,
    "scenario_net_value": 2,
    "scenario_roi": 4,
}


def report(table: DataFrame) -> DataFrame:
    """The table as a reader sees it; the operators themselves keep full precision."""
    return table.select(
        *[F.round(c, SCENARIO_DIGITS[c]).alias(c) if c in SCENARIO_DIGITS else F.col(c) for c in table.columns]
    )
