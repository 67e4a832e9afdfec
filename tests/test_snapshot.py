import datetime as dt

import pytest
from pyspark.sql import functions as F

from keepwell.operators import history, model_input, profiles, quality, segments, snapshot
from keepwell.sources import fixtures, schemas

CUTOFF = dt.date(2017, 1, 31)
MEMBER = "msno string, city int, bd int, gender string, registered_via int, registration_init_time int"


@pytest.mark.parametrize(
    ("bd", "age", "flag"), [(None, None, None), (9, None, 1), (10, 10, 0), (100, 100, 0), (101, None, 1)]
)
def test_age_range(spark, bd, age, flag):
    row = profiles.validated(spark.createDataFrame([("a", 1, bd, None, 1, 20160101)], MEMBER)).first()
    assert (row["age_clean"], row["age_unknown_flag"], row["gender_clean"]) == (age, flag, "unknown")


@pytest.mark.parametrize(("registered", "known"), [(20170131, True), (20170201, False), (0, False), (None, False)])
def test_profile_is_masked_unless_registered_by_the_cutoff(spark, registered, known):
    member = spark.createDataFrame([("a", 1, 30, "male", 4, registered)], MEMBER)
    row = profiles.profile_as_of(member, CUTOFF).first()
    assert row["msno"] == "a"
    assert all((row[c] is not None) == known for c in profiles.PROFILE_COLUMNS)


def small(spark):
    labels = spark.createDataFrame([("a", 0), ("b", 1), ("c", 0)], schemas.labels())
    transactions = spark.createDataFrame(
        [("a", 20170110, 20170210, 1, 30, 100, 80, 1, 0), ("z", 20170110, 20170210, 1, 30, 100, 80, 1, 0)],
        schemas.transactions(),
    )
    members = spark.createDataFrame([("a", 3, 30, "male", 4, 20160101), ("b", None, 30, "male", 4, 20160101)], MEMBER)
    return snapshot.customer_snapshot(labels, transactions, members, CUTOFF)


def test_every_labelled_customer_and_no_other(spark):
    assert sorted(r["msno"] for r in small(spark).collect()) == ["a", "b", "c"]


def test_customer_without_history(spark):
    row = small(spark).filter("msno = 'c'").first().asDict()
    assert all(row[c] == 0 for c in snapshot.ZERO_WITHOUT_HISTORY)
    assert (row["has_transaction_history_flag"], row["has_member_profile_flag"]) == (0, 0)
    rest = set(row) - {*snapshot.ZERO_WITHOUT_HISTORY, "msno", "is_churn"}
    assert all(row[c] is None for c in rest if not c.startswith("has_"))


def test_profile_without_city_counts_as_absent(spark):
    row = small(spark).filter("msno = 'b'").first()
    assert row["has_member_profile_flag"] == 0
    assert row["age_clean"] == 30


def test_column_counts(spark):
    built = small(spark)
    prepared = model_input.model_input(built)
    assert built.columns == snapshot.SNAPSHOT_COLUMNS and len(built.columns) == 36
    assert len(prepared.columns) == 33
    assert len(model_input.numeric_features(prepared)) == 26


def test_model_input_defaults(spark):
    row = model_input.model_input(small(spark)).filter("msno = 'c'").first()
    assert row["age_unknown_flag"] == 1
    assert all(row[c] == "unknown" for c in model_input.CATEGORIES)


def test_repartitioning_changes_nothing(spark, sf_dir):
    def build(n):
        return snapshot.customer_snapshot(
            fixtures.labels(spark, sf_dir).repartition(n),
            fixtures.transactions(spark, sf_dir).repartition(n),
            fixtures.members(spark, sf_dir).repartition(n),
            fixtures.CUTOFF,
        )

    assert build(1).exceptAll(build(7)).count() == 0


def test_filtering_to_labelled_customers_first_changes_nothing(spark, sf_dir):
    labels = fixtures.labels(spark, sf_dir).filter("msno % 2 = 0")
    raw = fixtures.transactions(spark, sf_dir)
    members = fixtures.members(spark, sf_dir)
    early = history.of_labelled(raw, labels)
    assert early.count() < raw.count()
    built = snapshot.customer_snapshot(labels, early, members, fixtures.CUTOFF)
    plain = snapshot.customer_snapshot(labels, raw, members, fixtures.CUTOFF)
    assert built.exceptAll(plain).count() == 0 and plain.exceptAll(built).count() == 0


def test_contracts_hold_and_fail(spark):
    good = small(spark)
    rules = {r["rule"]: r["violations"] for r in quality.snapshot_contracts(good, CUTOFF, (0.3, 0.4)).collect()}
    assert set(rules.values()) == {0}
    quality.require(quality.snapshot_contracts(good, CUTOFF, (0.3, 0.4)))
    doubled = good.unionByName(good.filter("msno = 'a'"))
    rules = {r["rule"]: r["violations"] for r in quality.snapshot_contracts(doubled, CUTOFF, (0.3, 0.4)).collect()}
    assert rules["snapshot_one_row_per_customer"] == 1
    assert rules["base_rate_in_band"] == 1
    with pytest.raises(ValueError, match="snapshot_one_row_per_customer"):
        quality.require(quality.snapshot_contracts(doubled, CUTOFF, (0.3, 0.4)))
    leaked = quality.snapshot_contracts(good, dt.date(2017, 1, 1), (0.3, 0.4)).collect()
    assert {r["rule"]: r["violations"] for r in leaked}["no_transaction_after_cutoff"] == 1


def test_observed_contracts_are_the_same(spark):
    good = small(spark)
    for rows in (good, good.unionByName(good.limit(1)), good.withColumn("is_churn", F.lit(None).cast("int"))):
        seen = rows.agg(*[c.alias(n) for n, c in quality.snapshot_measures(CUTOFF).items()]).first().asDict()
        assert quality.observed_snapshot_contracts(rows, seen, (0.3, 0.4)).collect() == quality.snapshot_contracts(
            rows, CUTOFF, (0.3, 0.4)
        ).collect()


def test_model_input_contracts(spark):
    built = small(spark)
    prepared = model_input.model_input(built)
    assert {r["violations"] for r in quality.model_input_contracts(built, prepared).collect()} == {0}
    fewer = quality.model_input_contracts(built, prepared.filter("msno <> 'a'").drop("age_unknown_flag"))
    broken = {r["rule"]: r["violations"] for r in fewer.collect()}
    assert broken["model_input_row_count_kept"] == 1
    assert broken["model_input_ids_kept"] == 1
    assert broken["model_input_columns"] == 1


def test_segments_cover_all_customers(spark, sf_dir):
    built = snapshot.customer_snapshot(
        fixtures.labels(spark, sf_dir),
        fixtures.transactions(spark, sf_dir),
        fixtures.members(spark, sf_dir),
        fixtures.CUTOFF,
    )
    n = built.count()
    for name in segments.SEGMENTS:
        rows = segments.churn_by(built, name).collect()
        assert sum(r["customers"] for r in rows) == n
        rates = [r["churn_percent"] for r in rows]
        assert rates == sorted(rates, reverse=True)
