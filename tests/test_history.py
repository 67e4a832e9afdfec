import datetime as dt

import pytest
from pyspark.sql import functions as F

from keepwell.operators import history
from keepwell.sources import fixtures, schemas

CUTOFF = dt.date(2017, 1, 31)


def tx(spark, rows):
    """(id, date, expiry, method, plan, list, paid, renew, cancel)"""
    return spark.createDataFrame(rows, schemas.transactions())


def compact(day):
    return int(day.strftime("%Y%m%d"))


def features(spark, rows):
    past = history.history_as_of(tx(spark, rows), CUTOFF)
    return {r["msno"]: r.asDict() for r in history.transaction_features(past, CUTOFF).collect()}


def one(day, **changes):
    base = dict(id="a", day=day, end=20170301, method=1, plan=30, listed=100, paid=80, renew=1, cancel=0)
    base.update(changes)
    return tuple(base.values())


@pytest.mark.parametrize("day", [0, 20170229, 99999999, 2017131, None])
def test_undated_rows_leave_history(spark, day):
    assert history.history_as_of(tx(spark, [one(day)]), CUTOFF).count() == 0


def test_cutoff_is_inclusive(spark):
    past = history.history_as_of(tx(spark, [one(20170131), one(20170201)]), CUTOFF)
    assert [r["transaction_date"] for r in past.collect()] == [20170131]


@pytest.mark.parametrize(
    ("back", "month", "quarter"), [(0, 1, 1), (30, 1, 1), (31, 0, 1), (89, 0, 1), (90, 0, 0)]
)
def test_window_edges(spark, back, month, quarter):
    row = features(spark, [one(compact(CUTOFF - dt.timedelta(days=back)))])["a"]
    assert row["transaction_count_last_31_days"] == month
    assert row["amount_paid_last_31_days"] == 80 * month
    assert row["transaction_count_last_90_days"] == quarter


def test_cancellation_is_the_latest_state_of_a_day(spark):
    rows = [one(20170110, cancel=1, paid=5), one(20170110, cancel=0, end=20180101, paid=7), one(20170109, paid=9)]
    row = features(spark, rows)["a"]
    assert (row["latest_is_cancel"], row["latest_amount_paid"]) == (1, 5)


def test_later_expiry_wins_and_null_expiry_loses(spark):
    rows = [one(20170110, end=None, paid=1), one(20170110, end=20170210, paid=2), one(20170110, end=20170310, paid=3)]
    assert features(spark, rows)["a"]["latest_amount_paid"] == 3


def test_null_is_one_more_distinct_code(spark):
    rows = [one(20170101, method=1), one(20170102, method=None), one(20170103, method=None)]
    row = features(spark, rows)["a"]
    assert (row["payment_method_count"], row["plan_type_count"]) == (2, 1)


def test_all_null_amounts_total_zero_and_average_null(spark):
    row = features(spark, [one(20170101, paid=None), one(20170102, paid=None)])["a"]
    assert row["total_amount_paid"] == 0
    assert row["average_amount_paid"] is None


def test_no_list_price_no_discount_rate(spark):
    row = features(spark, [one(20170101, listed=0, paid=0)])["a"]
    assert row["total_discount_amount"] == 0
    assert row["discount_rate"] is None


def test_one_pass_equals_separate_aggregates(spark, sf_dir):
    past = history.history_as_of(fixtures.transactions(spark, sf_dir), fixtures.CUTOFF)
    together = history.transaction_features(past, fixtures.CUTOFF)
    apart = (
        history.lifetime_features(past, fixtures.CUTOFF)
        .join(past.groupBy("msno").agg(*history.month_aggregates(fixtures.CUTOFF)), "msno")
        .join(past.groupBy("msno").agg(*history.quarter_aggregates(fixtures.CUTOFF)), "msno")
        .join(history.latest_features(past), "msno")
    )
    assert together.exceptAll(apart.select(*together.columns)).count() == 0
    assert together.count() == apart.count()


def test_one_customer_with_a_third_of_all_payments(spark):
    hot = [one(20170101 + i % 28, id="hot", paid=i, plan=30 * (1 + i % 3)) for i in range(3000)]
    cold = [one(20170101 + i % 28, id=f"c{i}", paid=i) for i in range(6000)]
    rows = tx(spark, hot + cold).repartition(16)
    past = history.history_as_of(rows, CUTOFF)
    found = history.transaction_features(past, CUTOFF).filter("msno = 'hot'").first()
    assert found["transaction_count_to_cutoff"] == 3000
    assert found["total_amount_paid"] == sum(range(3000))
    assert found["plan_type_count"] == 3


def test_the_partial_aggregate_runs_before_the_only_shuffle(spark, sf_dir):
    past = history.history_as_of(spark.createDataFrame([one(20170101)], schemas.transactions()), CUTOFF)
    plan = history.transaction_features(past, CUTOFF)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert "partial_collect_set" in plan
    assert "Window" not in plan and "Expand" not in plan


def test_raw_date_bound_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "tx")
    tx(spark, [one(20170101)]).write.parquet(path)
    plan = history.history_as_of(spark.read.parquet(path), CUTOFF)._jdf.queryExecution().executedPlan().toString()
    assert "LessThanOrEqual(transaction_date,20170131)" in plan


def test_rows_after_the_cutoff_change_nothing(spark, sf_dir):
    raw = fixtures.transactions(spark, sf_dir)
    later = raw.withColumns({"transaction_date": F.lit(19980101), "actual_amount_paid": F.lit(10**9).cast("bigint")})
    before = history.transaction_features(history.history_as_of(raw, fixtures.CUTOFF), fixtures.CUTOFF)
    after = history.transaction_features(
        history.history_as_of(raw.unionByName(later), fixtures.CUTOFF), fixtures.CUTOFF
    )
    assert before.exceptAll(after).count() == 0 and after.exceptAll(before).count() == 0
