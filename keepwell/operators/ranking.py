"""Global order, prefix sums and exact top-k cuts that no hot score or hot group can overload.

``row_number() over (order by …)`` would pull every row into one task. Here the rows are
range-partitioned on the full order, including the id, so even a plateau that holds a third of
all rows is spread over tasks; each row's place is then its partition's offset plus its place in
the partition. The order everywhere is score descending, then id ascending.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from keepwell.functions.columns import required, target_count
from keepwell.session import staged

# monotonically_increasing_id puts the partition index above bit 33 and the row below it.
_ROW_BITS = 33

# Probabilities to twelve places, and totals of them with room for any number of customers.
_SCORE = "decimal(15,12)"
_MASS = "decimal(30,12)"


def _placed(df: DataFrame, order: Sequence[Column], label: str) -> DataFrame:
    """Sort globally and pin every row's partition and place.

    The result is written, so that the offsets and the rows that use them agree on the range
    boundaries, also after a lost executor.
    """
    at = F.monotonically_increasing_id()
    placed = staged(df.orderBy(*order).withColumn("_at", at), label)
    return placed.withColumns(
        {
            "_part": F.shiftright("_at", _ROW_BITS),
            "_row": F.col("_at").bitwiseAND(F.lit((1 << _ROW_BITS) - 1)),
        }
    ).drop("_at")


def rank_rows(df: DataFrame, by: Sequence[str], order: Sequence[Column], name: str) -> DataFrame:
    """Adds ``name``: 1, 2, 3 … within each ``by`` group in the given total order."""
    placed = _placed(df, [*map(F.col, by), *order], "ranked")
    parts = placed.groupBy(*by, "_part").agg(F.count(F.lit(1)).alias("_rows"), F.min("_row").alias("_first"))
    earlier = Window.partitionBy(*by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select(
        *by,
        "_part",
        (F.coalesce(F.sum("_rows").over(earlier), F.lit(0)) - F.col("_first") + 1).alias("_offset"),
    )
    # Ranges split the sorted rows, so there are at most (partitions + groups) offsets.
    return (
        placed.join(F.broadcast(offsets), [*by, "_part"])
        .withColumn(name, F.col("_row") + F.col("_offset"))
        .drop("_part", "_row", "_offset")
    )


def running_totals(
    df: DataFrame, by: Sequence[str], order: Sequence[Column], measures: Sequence[str]
) -> DataFrame:
    """Adds ``cum_<m>`` (this row included) and ``total_<m>`` per ``by`` group for each measure.

    ``df`` has at most one row per (by, order) value, so ranges come out even; the window runs
    inside a range and the ranges' offsets are joined on.
    """
    placed = _placed(df, [*map(F.col, by), *order], "totals")
    parts = placed.groupBy(*by, "_part").agg(*[F.sum(m).alias(m) for m in measures])
    group = Window.partitionBy(*by)
    earlier = group.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select(
        *by,
        "_part",
        *[F.sum(m).over(earlier).alias(f"_before_{m}") for m in measures],
        *[F.sum(m).over(group).alias(f"total_{m}") for m in measures],
    )
    inside = Window.partitionBy(*by, "_part").orderBy("_row").rowsBetween(Window.unboundedPreceding, 0)
    # At most (partitions + groups) offsets, as above.
    return (
        placed.join(F.broadcast(offsets), [*by, "_part"])
        .withColumns(
            {
                f"cum_{m}": F.sum(m).over(inside) + F.coalesce(F.col(f"_before_{m}"), F.lit(0))
                for m in measures
            }
        )
        .drop("_part", "_row", *[f"_before_{m}" for m in measures])
    )


def score_curve(scored: DataFrame, by: Sequence[str] = (), sums: dict[str, Column] | None = None) -> DataFrame:
    """One row per distinct score, best first, with running counts.

    The scores are counted before anything is sorted: plateaus collapse map-side, and calibrated
    scores leave a few hundred rows. ``sums`` names further per-row quantities to total. A null score
    has no rank, so the job fails.
    """
    levels = scored.groupBy(*by, required(scored, "risk")).agg(
        F.count(F.lit(1)).alias("customers"),
        F.sum("is_churn").cast("bigint").alias("churned"),
        *[F.sum(col).alias(name) for name, col in (sums or {}).items()],
    )
    # Exact decimal mass: totals of scores do not depend on the order of addition.
    levels = levels.withColumn("risk_mass", (F.col("customers") * F.col("risk").cast(_SCORE)).cast(_MASS))
    return running_totals(
        levels, by, [F.desc("risk")], ["customers", "churned", "risk_mass", *(sums or {})]
    )


def cut_totals(
    scored: DataFrame,
    curve: DataFrame,
    capacities: Column,
    id_col: str,
    by: Sequence[str] = (),
    sums: dict[str, Column] | None = None,
) -> DataFrame:
    """Totals over the first ``ceil(n * capacity / 100)`` customers, for each capacity.

    Whole score levels come from the curve. Only a level that a cut falls into is looked at row
    by row: its customers are ranked by id, in ranges, and the first ones are taken.
    Returns one row per (by, capacity): capacity_percent, customers_targeted, risk_threshold,
    churned, risk_mass, the ``sums``, and total_customers, total_churned of the group.
    """
    extra = list(sums or {})
    measures = ["churned", *extra]
    before = F.col("cum_customers") - F.col("customers")
    wanted = F.filter(
        F.array_distinct(capacities),
        lambda c: (target_count(F.col("total_customers"), c) > before)
        & (target_count(F.col("total_customers"), c) <= F.col("cum_customers")),
    )
    k = target_count(F.col("total_customers"), F.col("capacity_percent"))
    # One row per (by, capacity): the size of the capacity grid, whatever the data.
    cuts = staged(
        curve.withColumn("capacity_percent", F.explode(wanted)).select(
            *by,
            "capacity_percent",
            k.alias("customers_targeted"),
            (k - before).alias("_need"),
            F.col("customers").alias("_level"),
            F.col("risk").alias("risk_threshold"),
            (F.col("cum_risk_mass").cast(_MASS) - F.col("risk_mass")).cast(_MASS).alias("_above_mass"),
            *[F.col(m).alias(f"_own_{m}") for m in measures],
            *[(F.col(f"cum_{m}") - F.col(m)).alias(f"_above_{m}") for m in measures],
            "total_customers",
            "total_churned",
        ),
        "cuts",
    )
    split = cuts.filter(F.col("_need") < F.col("_level"))
    edges = split.select(*by, F.col("risk_threshold").alias("risk")).distinct()
    edge_rows = scored.join(F.broadcast(edges), [*by, "risk"], "left_semi").select(
        *by, "risk", id_col, F.col("is_churn").alias("churned"), *[c.alias(n) for n, c in (sums or {}).items()]
    )
    edge_totals = (
        rank_rows(edge_rows, [*by, "risk"], [F.asc(id_col)], "_place")
        .withColumnRenamed("risk", "risk_threshold")
        .join(F.broadcast(split.select(*by, "risk_threshold", "capacity_percent", "_need")), [*by, "risk_threshold"])
        .filter(F.col("_place") <= F.col("_need"))
        .groupBy(*by, "capacity_percent")
        .agg(*[F.sum(m).alias(f"_edge_{m}") for m in measures])
    )
    taken_mass = (F.col("_need") * F.col("risk_threshold").cast(_SCORE)).cast(_MASS)
    return cuts.join(F.broadcast(edge_totals), [*by, "capacity_percent"], "left").select(
        *by,
        "capacity_percent",
        "customers_targeted",
        "risk_threshold",
        (F.col("_above_mass") + taken_mass).cast("double").alias("risk_mass"),
        *[
            (
                F.col(f"_above_{m}")
                + F.when(F.col("_need") < F.col("_level"), F.col(f"_edge_{m}")).otherwise(F.col(f"_own_{m}"))
            ).alias(m)
            for m in measures
        ],
        "total_customers",
        "total_churned",
    )


def top_customers(scored: DataFrame, capacity: float, id_col: str, name: str = "risk_rank") -> DataFrame:
    """The ranked list of the first ``ceil(n * capacity / 100)`` customers.

    The threshold score comes from the curve; only customers at or above it are sorted.
    """
    curve = score_curve(scored)
    k = target_count(F.col("total_customers"), F.lit(float(capacity)))
    reached = curve.filter(F.col("cum_customers") - F.col("customers") < k)
    threshold = staged(reached.agg(F.min("risk").alias("risk"), F.min(k).alias("k")), "threshold")
    candidates = scored.filter(F.col("risk") >= threshold.select("risk").scalar())
    ranked = rank_rows(candidates, [], [F.desc("risk"), F.asc(id_col)], name)
    return ranked.filter(F.col(name) <= threshold.select("k").scalar())
