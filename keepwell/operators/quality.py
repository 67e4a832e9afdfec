"""Data-quality contracts as tables: one row per rule with its number of violations."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keepwell.operators.champion import champion


def _rules(**violations: Column) -> Column:
    return F.inline(
        F.array(
            *[
                F.struct(F.lit(rule).alias("rule"), count.cast("bigint").alias("violations"))
                for rule, count in violations.items()
            ]
        )
    )


def _missed(holds: Column) -> Column:
    """1 unless the condition holds; unknown counts as missed."""
    return F.when(holds, F.lit(0)).otherwise(F.lit(1))


def duplicate_rows(df: DataFrame, key: str = "msno") -> DataFrame:
    """Rows beyond the first per key, as a one-row table; counted per key after partial counts."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).agg(
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("extra")
    )


def snapshot_measures(cutoff: dt.date) -> dict[str, Column]:
    """Aggregates of the snapshot's rows, to be observed while it is written."""
    return {
        "unlabelled": F.count_if(F.col("is_churn").isNull()),
        "off_domain": F.count_if(~F.col("is_churn").isin(0, 1)),
        "leaked": F.count_if(F.col("last_transaction_date") > F.lit(cutoff)),
        "churned": F.coalesce(F.sum("is_churn").cast("bigint"), F.lit(0)),
        "labelled": F.count("is_churn"),
    }


def _snapshot_rules(checked: DataFrame, base_rate_band: tuple[float, float]) -> DataFrame:
    low, high = base_rate_band
    rate = F.try_divide("churned", "labelled")
    return checked.select(
        _rules(
            snapshot_one_row_per_customer=F.col("extra"),
            label_known=F.col("unlabelled"),
            label_zero_or_one=F.col("off_domain"),
            no_transaction_after_cutoff=F.col("leaked"),
            base_rate_in_band=_missed((rate > low) & (rate < high)),
        )
    )


def snapshot_contracts(
    snapshot: DataFrame, cutoff: dt.date, base_rate_band: tuple[float, float] = (0.08, 0.10)
) -> DataFrame:
    """Grain, label and leakage rules of the snapshot, in one pass grouped by customer."""
    measures = snapshot_measures(cutoff)
    customers = snapshot.groupBy("msno").agg(
        (F.count(F.lit(1)) - 1).alias("extra"), *[column.alias(name) for name, column in measures.items()]
    )
    sums = [F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in ("extra", *measures)]
    return _snapshot_rules(customers.agg(*sums), base_rate_band)


def observed_snapshot_contracts(
    written: DataFrame, seen: dict[str, int], base_rate_band: tuple[float, float] = (0.08, 0.10)
) -> DataFrame:
    """The same rules, from what was observed while the snapshot was written; only its ids are read again."""
    values = [F.lit(value).cast("bigint").alias(name) for name, value in seen.items()]
    return _snapshot_rules(duplicate_rows(written).select("extra", *values), base_rate_band)


def id_set_difference(left: DataFrame, right: DataFrame, key: str = "msno") -> DataFrame:
    """Ids on one side only, with the side; empty when the id sets are equal.

    Ids are made distinct first, so a repeated id reaches the join once.
    """
    a, b = left.select(key).distinct(), right.select(key).distinct()
    return (
        a.join(b, key, "left_anti")
        .withColumn("only_in", F.lit("left"))
        .unionByName(b.join(a, key, "left_anti").withColumn("only_in", F.lit("right")))
    )


def model_input_contracts(snapshot: DataFrame, model_input: DataFrame) -> DataFrame:
    """Grain and schema rules of the model input against its snapshot; both sides meet in one pass grouped by customer."""
    required = {"latest_payment_method_category", "age_unknown_flag"}
    forbidden = {"latest_payment_method_id"}
    columns = set(model_input.columns)
    sides = snapshot.select("msno", F.lit(1).alias("a"), F.lit(0).alias("b")).unionByName(
        model_input.select("msno", F.lit(0).alias("a"), F.lit(1).alias("b"))
    )
    customers = sides.groupBy("msno").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    checked = customers.agg(
        F.coalesce(F.sum(F.greatest(F.col("b") - 1, F.lit(0))), F.lit(0)).alias("extra"),
        F.coalesce(F.abs(F.sum(F.col("b") - F.col("a"))), F.lit(0)).alias("rows"),
        F.count_if((F.col("a") == 0) | (F.col("b") == 0)).alias("ids"),
    )
    return checked.select(
        _rules(
            model_input_one_row_per_customer=F.col("extra"),
            model_input_row_count_kept=F.col("rows"),
            model_input_ids_kept=F.col("ids"),
            model_input_columns=F.lit(len(required - columns) + len(forbidden & columns)),
        )
    )


def score_contracts(scored: DataFrame, min_distinct: int = 101) -> DataFrame:
    """Every score is a probability, and there are enough different ones to rank by."""
    levels = scored.groupBy("risk").agg(F.count(F.lit(1)).alias("n"))
    known = F.col("risk").isNotNull()
    return levels.agg(
        F.coalesce(F.sum(F.when(~known, F.col("n"))), F.lit(0)).alias("unknown"),
        F.coalesce(F.sum(F.when(known & ~F.col("risk").between(0, 1), F.col("n"))), F.lit(0)).alias("outside"),
        _missed(F.count("risk") >= min_distinct).alias("too_few"),
    ).select(
        _rules(
            score_one_row_per_customer=duplicate_rows(scored).scalar(),
            score_known=F.col("unknown"),
            score_is_probability=F.col("outside"),
            score_distinct_values=F.col("too_few"),
        )
    )


def champion_contract(metrics: DataFrame, selected: DataFrame) -> DataFrame:
    """The recorded winner is the one that the rule picks."""
    picked = champion(metrics).select("model").scalar()
    return selected.agg(F.max("model").alias("model")).select(
        _rules(champion_follows_rule=_missed(F.col("model") == picked))
    )


def recommendation_contracts(grid: DataFrame, recommended: DataFrame, budget: float, capacities: list[float]) -> DataFrame:
    """The recommendation fits the budget, beats every feasible option and lies on the grid.

    Where no option is affordable, the rule is that nothing is recommended.
    """
    best = grid.filter("within_budget").agg(F.max("scenario_net_value")).scalar()
    nothing = best.isNull() & (F.col("n") == 0)
    on_grid = F.col("capacity").isin([float(c) for c in capacities])
    return recommended.agg(
        F.count(F.lit(1)).alias("n"),
        F.max("campaign_spend").alias("spend"),
        F.max("scenario_net_value").alias("net"),
        F.max("capacity_percent").alias("capacity"),
    ).select(
        _rules(
            recommendation_single=_missed(nothing | (best.isNotNull() & (F.col("n") == 1))),
            recommendation_affordable=_missed(nothing | (F.col("spend") <= F.lit(float(budget)))),
            recommendation_is_best=_missed(nothing | (F.col("net") == best)),
            recommendation_on_grid=_missed(nothing | on_grid),
        )
    )


def require(contracts: DataFrame) -> None:
    """Raises when any rule is violated; the table has one row per rule."""
    broken = contracts.filter("violations > 0").collect()
    if broken:
        raise ValueError("; ".join(f"{row['rule']}: {row['violations']}" for row in broken))
