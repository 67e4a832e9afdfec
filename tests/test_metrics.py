import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from keepwell.operators import calibration, metrics, ranking
from keepwell.sources import fixtures


def sample(spark, n=400, seed=5, levels=20):
    rng = np.random.default_rng(seed)
    y = (rng.random(n) < 0.25).astype(int)
    p = np.floor(np.clip(rng.normal(0.35 + 0.3 * y, 0.2), 0, 1) * levels) / levels
    rows = [(i, int(a), float(b)) for i, (a, b) in enumerate(zip(y, p))]
    return y, p, spark.createDataFrame(rows, "msno long, is_churn int, risk double").repartition(6)


def measured(scored):
    return metrics.curve_metrics(ranking.score_curve(scored)).first()


def test_auc_counts_pairs(spark):
    y, p, df = sample(spark)
    pairs = [(a > b) + 0.5 * (a == b) for a in p[y == 1] for b in p[y == 0]]
    assert measured(df)["roc_auc"] == pytest.approx(np.mean(pairs))


def test_average_precision_is_a_step_sum(spark):
    y, p, df = sample(spark)
    steps, recall = 0.0, 0.0
    for level in sorted(set(p), reverse=True):
        chosen = p >= level
        now = y[chosen].sum() / y.sum()
        steps += (now - recall) * y[chosen].mean()
        recall = now
    assert measured(df)["average_precision"] == pytest.approx(steps)


def test_threshold_metrics_and_brier(spark):
    y, p, df = sample(spark)
    found = measured(df)
    hit = p >= 0.5
    assert found["accuracy_at_50_percent_risk"] == pytest.approx((hit == y).mean())
    assert found["precision_at_50_percent_risk"] == pytest.approx(y[hit].mean())
    assert found["recall_at_50_percent_risk"] == pytest.approx(hit[y == 1].mean())
    assert found["brier_score"] == pytest.approx(((p - y) ** 2).mean())
    assert found["base_churn_rate"] == pytest.approx(y.mean())


def test_auc_is_invariant_under_increasing_maps(spark):
    _, _, df = sample(spark)
    assert measured(df)["roc_auc"] == pytest.approx(measured(df.withColumn("risk", F.col("risk") * F.col("risk")))["roc_auc"])


def test_top_decile(spark):
    y, p, df = sample(spark)
    top = sorted(range(len(y)), key=lambda i: (-p[i], i))[: math.ceil(len(y) * 0.1)]
    found = metrics.top_decile(df, ranking.score_curve(df)).first()
    assert found["top_10_percent_actual_churn"] == pytest.approx(y[top].mean())
    assert found["lift_at_top_10_percent"] == pytest.approx(y[top].mean() / y.mean())
    threshold = metrics.campaign_threshold(df).first()
    assert threshold["calibrated_risk_threshold"] == min(p[top])


@pytest.mark.parametrize("label", [0, 1])
def test_single_class_has_no_auc(spark, label):
    df = spark.createDataFrame([(i, label, i / 10) for i in range(10)], "msno long, is_churn int, risk double")
    found = measured(df)
    assert found["roc_auc"] is None
    lift = metrics.top_decile(df, ranking.score_curve(df)).first()["lift_at_top_10_percent"]
    assert lift == (1.0 if label else None)


def test_nobody_above_half_gives_zero_precision(spark):
    df = spark.createDataFrame([(1, 1, 0.2), (2, 0, 0.1)], "msno long, is_churn int, risk double")
    found = measured(df)
    assert (found["precision_at_50_percent_risk"], found["recall_at_50_percent_risk"]) == (0.0, 0.0)


def test_records_per_model(spark):
    _, _, a = sample(spark, seed=1)
    _, _, b = sample(spark, seed=2)
    long = a.withColumn("model", F.lit("a")).unionByName(b.withColumn("model", F.lit("b")))
    found = {r["model"]: r for r in metrics.model_metrics(long).collect()}
    assert found["a"]["roc_auc"] == pytest.approx(measured(a)["roc_auc"])
    assert found["b"]["average_precision"] == pytest.approx(measured(b)["average_precision"])
    full = metrics.model_metrics(long)
    assert len(metrics.baseline_records(full).columns) == 10
    assert len(metrics.calibration_records(full).columns) == 7
    assert len(metrics.tournament_records(full).columns) == 10


def test_fixture_figures(spark):
    scored = fixtures.scored(spark, "/root/testdata/sf0.01")
    found = measured(scored)
    assert round(found["roc_auc"], 6) == 0.855363
    assert round(found["average_precision"], 6) == 0.474485


def test_bands_are_right_closed_and_empty_ones_stay(spark):
    edges = np.linspace(0, 1, 11)
    values = [0.0, 0.1, edges[3], 0.3, edges[7], 0.7, 1.0]
    df = spark.createDataFrame([(i, i % 2, float(v)) for i, v in enumerate(values)], "msno long, is_churn int, risk double")
    rows = calibration.calibration_table(df).orderBy("risk_over").collect()
    assert [r["risk_up_to"] for r in rows] == edges[1:].tolist()
    counts = np.zeros(10, dtype=int)
    for v in values:
        counts[max(np.searchsorted(edges, v, side="left") - 1, 0)] += 1
    assert [r["customers"] for r in rows] == counts.tolist()
    assert rows[4]["customers"] == 0 and rows[4]["actual_churn_rate"] is None


def pool_adjacent(x, y):
    """Reference fit: pools of (sum, weight, scores), merged while out of order."""
    pools = []
    for level in sorted(set(x)):
        mine = y[x == level]
        pools.append([mine.sum(), len(mine), [level]])
        while len(pools) > 1 and pools[-2][0] / pools[-2][1] >= pools[-1][0] / pools[-1][1]:
            s, w, levels = pools.pop()
            pools[-1] = [pools[-1][0] + s, pools[-1][1] + w, pools[-1][2] + levels]
    return {level: s / w for s, w, levels in pools for level in levels}


def test_isotonic_fit(spark):
    y, p, df = sample(spark, levels=15)
    model = calibration.fit_isotonic(df)
    want = pool_adjacent(p, y)
    found = calibration.calibrate(df, model).collect()
    assert all(r["calibrated"] == pytest.approx(want[r["risk"]]) for r in found)
    assert np.mean([r["calibrated"] for r in found]) == pytest.approx(y.mean())
    ordered = [r["calibrated"] for r in sorted(found, key=lambda r: r["risk"])]
    assert ordered == sorted(ordered)


def test_isotonic_clips_and_interpolates(spark):
    df = spark.createDataFrame([(1, 0, 0.2), (2, 1, 0.6)], "msno long, is_churn int, risk double")
    model = calibration.fit_isotonic(df)
    new = spark.createDataFrame([(0.0,), (0.4,), (0.9,)], "risk double")
    assert [r["calibrated"] for r in calibration.calibrate(new, model).collect()] == pytest.approx([0.0, 0.5, 1.0])
