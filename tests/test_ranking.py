import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from keepwell.operators import ranking


def population(spark, n=900, seed=3):
    """A third of all customers share one score."""
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        risk = 0.5 if i % 3 == 0 else round(float(rng.random()), 2)
        rows.append((i, int(rng.random() < 0.2), risk, float(rng.integers(0, 500))))
    return rows, spark.createDataFrame(rows, "msno long, is_churn int, risk double, value double").repartition(8)


def ordered(rows):
    return sorted(rows, key=lambda r: (-r[2], r[0]))


def test_global_rank_with_a_hot_plateau(spark):
    rows, df = population(spark)
    ranked = ranking.rank_rows(df, [], [F.desc("risk"), F.asc("msno")], "place")
    found = [r["msno"] for r in ranked.orderBy("place").collect()]
    assert found == [r[0] for r in ordered(rows)]
    assert [r["place"] for r in ranked.orderBy("place").collect()] == list(range(1, len(rows) + 1))


def test_the_hot_plateau_is_spread_over_tasks(spark):
    """Range partitions split a plateau by id, so no task gets all of it."""
    plateau = spark.range(60_000).select(
        F.col("id").alias("msno"), F.lit(0.5).alias("risk"), F.lit(0).alias("is_churn")
    )
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        placed = ranking._placed(plateau, [F.desc("risk"), F.asc("msno")], "test")
        sizes = [r["count"] for r in placed.groupBy("_part").count().collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(sizes) == 8
    assert max(sizes) < 60_000 / 4


def test_rank_within_groups(spark):
    _, df = population(spark, 300)
    grouped = df.withColumn("g", F.col("msno") % 4)
    ranked = ranking.rank_rows(grouped, ["g"], [F.desc("risk"), F.asc("msno")], "place")
    for g in range(4):
        part = ranked.filter(F.col("g") == g).orderBy("place").collect()
        assert [r["place"] for r in part] == list(range(1, len(part) + 1))
        assert [(-r["risk"], r["msno"]) for r in part] == sorted((-r["risk"], r["msno"]) for r in part)


def test_running_totals(spark):
    values = spark.createDataFrame([(g, i, i * 10 + g) for g in (1, 2) for i in range(500)], "g int, i int, n long")
    total = ranking.running_totals(values.repartition(6), ["g"], [F.asc("i")], ["n"]).collect()
    for g in (1, 2):
        part = sorted((r for r in total if r["g"] == g), key=lambda r: r["i"])
        assert [r["cum_n"] for r in part] == np.cumsum([r["n"] for r in part]).tolist()
        assert {r["total_n"] for r in part} == {sum(r["n"] for r in part)}


@pytest.mark.parametrize("n", [1, 7, 900])
def test_cut_totals_equal_brute_force(spark, n):
    rows, df = population(spark, n)
    capacities = [1.0, 5.0, 10.0, 33.0, 50.0, 100.0]
    sums = {"value": F.col("value")}
    curve = ranking.score_curve(df, sums=sums)
    cuts = ranking.cut_totals(df, curve, F.array(*map(F.lit, capacities)), "msno", sums=sums)
    found = {r["capacity_percent"]: r for r in cuts.collect()}
    assert set(found) == set(capacities)
    for c in capacities:
        top = ordered(rows)[: math.ceil(n * c / 100)]
        assert found[c]["customers_targeted"] == len(top)
        assert found[c]["churned"] == sum(r[1] for r in top)
        assert found[c]["value"] == sum(r[3] for r in top)
        assert found[c]["risk_mass"] == pytest.approx(sum(r[2] for r in top))
        assert found[c]["risk_threshold"] == top[-1][2]


def test_cut_totals_per_group(spark):
    rows, df = population(spark, 600)
    grouped = df.withColumn("model", (F.col("msno") % 2).cast("string"))
    curve = ranking.score_curve(grouped, ["model"])
    cuts = ranking.cut_totals(grouped, curve, F.array(F.lit(10.0)), "msno", ["model"]).collect()
    for cut in cuts:
        top = ordered([r for r in rows if str(r[0] % 2) == cut["model"]])[: cut["customers_targeted"]]
        assert cut["churned"] == sum(r[1] for r in top)


def test_repeated_capacity_counts_once(spark):
    rows, df = population(spark, 300)
    curve = ranking.score_curve(df)
    cuts = ranking.cut_totals(df, curve, F.array(F.lit(50.0), F.lit(50.0)), "msno").collect()
    assert len(cuts) == 1
    assert cuts[0]["churned"] == sum(r[1] for r in ordered(rows)[:150])


@pytest.mark.parametrize("capacity", [1, 10, 40, 100])
def test_top_customers(spark, capacity):
    rows, df = population(spark)
    top = ranking.top_customers(df, capacity, "msno").orderBy("risk_rank").collect()
    want = ordered(rows)[: math.ceil(len(rows) * capacity / 100)]
    assert [r["msno"] for r in top] == [r[0] for r in want]
    assert [r["risk_rank"] for r in top] == list(range(1, len(want) + 1))


def test_string_ids_break_ties_too(spark):
    df = spark.createDataFrame([(f"u{i:03d}", 0, 0.5) for i in range(100)], "msno string, is_churn int, risk double")
    top = ranking.top_customers(df.repartition(5), 7, "msno").orderBy("risk_rank").collect()
    assert [r["msno"] for r in top] == [f"u{i:03d}" for i in range(7)]


def test_no_single_partition_sort_of_customers(spark):
    _, df = population(spark)
    ranked = df.orderBy(F.desc("risk"), F.asc("msno"))
    plan = ranked._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" in plan and "SinglePartition" not in plan


def test_null_scores_fail(spark):
    scored = spark.createDataFrame([(1, 0, 0.5), (2, 1, None)], "msno long, is_churn int, risk double")
    with pytest.raises(Exception, match="risk is null"):
        ranking.top_customers(scored, 50.0, "msno").collect()
