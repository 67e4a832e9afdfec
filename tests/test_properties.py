"""Random small populations against brute force."""

import math

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from keepwell.functions.columns import compact_date
from keepwell.operators import metrics, ranking

SCHEMA = "msno long, is_churn int, risk double"
people = st.lists(st.tuples(st.integers(0, 1), st.integers(0, 8)), min_size=1, max_size=60)
few = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))


def scored(spark, drawn):
    return spark.createDataFrame([(i, y, r / 8) for i, (y, r) in enumerate(drawn)], SCHEMA).repartition(3)


@few
@given(drawn=people)
def test_auc_and_precision(spark, drawn):
    found = metrics.curve_metrics(ranking.score_curve(scored(spark, drawn))).first()
    good = [r for y, r in drawn if y]
    bad = [r for y, r in drawn if not y]
    if good and bad:
        wins = sum((g > b) + 0.5 * (g == b) for g in good for b in bad)
        assert found["roc_auc"] == pytest.approx(wins / (len(good) * len(bad)))
    else:
        assert found["roc_auc"] is None
    if good:
        reached = [[y for y, r in drawn if r >= level] for level in good]
        assert found["average_precision"] == pytest.approx(sum(sum(p) / len(p) for p in reached) / len(good))


@few
@given(drawn=people, capacity=st.floats(0.5, 100))
def test_cuts(spark, drawn, capacity):
    df = scored(spark, drawn)
    cut = ranking.cut_totals(df, ranking.score_curve(df), F.array(F.lit(capacity)), "msno").first()
    order = sorted(range(len(drawn)), key=lambda i: (-drawn[i][1], i))[: math.ceil(len(drawn) * capacity / 100)]
    assert cut["customers_targeted"] == len(order)
    assert cut["churned"] == sum(drawn[i][0] for i in order)
    assert cut["risk_mass"] == pytest.approx(sum(drawn[i][1] / 8 for i in order))
    listed = ranking.top_customers(df, capacity, "msno").orderBy("risk_rank").collect()
    assert [r["msno"] for r in listed] == order


@few
@given(raw=st.lists(st.integers(-(2**31), 2**31 - 1), min_size=1, max_size=200))
def test_compact_dates_never_fail(spark, raw):
    rows = spark.createDataFrame([(r,) for r in raw], "d int").select("d", compact_date("d").alias("day")).collect()
    for row in rows:
        if row["day"] is not None:
            assert int(row["day"].strftime("%Y%m%d")) == row["d"]
