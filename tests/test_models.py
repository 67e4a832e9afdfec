import dataclasses
import threading

import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from keepwell import session
from keepwell.operators import boosting, learners, quality, splitting
from keepwell.operators.model_input import model_input
from keepwell.operators.snapshot import customer_snapshot
from keepwell.plans import catalog
from keepwell.session import staged
from keepwell.sources import fixtures

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def rows(spark):
    built = customer_snapshot(
        fixtures.labels(spark, SF), fixtures.transactions(spark, SF), fixtures.members(spark, SF), fixtures.CUTOFF
    )
    return staged(splitting.split_roles(staged(model_input(built), "input")), "roles")


@pytest.fixture(scope="module")
def separable(rows):
    """The same table with a recency that gives the label away, so that a model has something to learn."""
    told = F.when(F.col("is_churn") == 1, F.lit(300)).otherwise(F.lit(5)) + F.col("msno") % 40
    return staged(rows.withColumn("days_since_last_transaction", told.cast("int")), "told")


def auc(scores):
    from keepwell.operators import metrics, ranking

    return metrics.curve_metrics(ranking.score_curve(scores)).first()["roc_auc"]


def test_saved_model_scores_the_same(spark, rows, tmp_path):
    features = learners.ordinal_features(rows)
    model = learners.fit_boosted_ordinal(features, learners.QUICK)
    model.write().overwrite().save(str(tmp_path / "m"))
    loaded = PipelineModel.load(str(tmp_path / "m"))
    test = features.role("test")
    assert learners.score(model, test).exceptAll(learners.score(loaded, test)).count() == 0
    table = learners.feature_importance(model, features.names, 100).collect()
    assert len(table) == len(features.names)
    assert sum(r["importance"] for r in table) == pytest.approx(1.0)


def test_training_twice_gives_the_same_scores(rows):
    scores = []
    for n in (3, 5):
        features = learners.ordinal_features(rows.repartition(n))
        scores.append(learners.score(learners.fit_boosted_ordinal(features, learners.QUICK), features.role("test")))
    assert scores[0].exceptAll(scores[1]).count() == 0


def test_baselines_learn(separable):
    models, scores, features = learners.baseline_scores(separable, learners.QUICK)
    assert set(models) == {"logistic_regression", "random_forest"}
    assert any("onehot" in n for n in features.names)
    for name in models:
        assert auc(scores.filter(F.col("model") == name)) > 0.95


def test_tournament(separable):
    found = learners.run_tournament(separable, learners.QUICK)
    measured = {r["model"]: r for r in found.metrics.collect()}
    assert len(measured) == 3
    assert all(r["roc_auc"] > 0.95 for r in measured.values())
    wide = found.predictions().withColumn("risk", F.col("champion_calibrated_probability"))
    rules = {r["rule"]: r["violations"] for r in quality.score_contracts(wide, 2).collect()}
    assert set(rules.values()) == {0}
    test_rows = separable.filter("role = 'test'").count()
    assert {r["test_customers"] for r in measured.values()} == {test_rows}


def test_nominal_inputs_reach_the_trees_as_categories(rows):
    features = learners.nominal_features(rows)
    attributes = features.rows.schema["features"].metadata["ml_attr"]["attrs"]
    assert len(attributes["nominal"]) == 5
    assert len(boosting.nominal_inputs(features.rows)) == 5


def test_levels_are_those_of_the_train_role(rows):
    odd = rows.withColumn(
        "city_category", F.when(F.col("role") == "test", F.lit("elsewhere")).otherwise(F.col("city_category"))
    )
    learned = learners.nominal_features(odd).rows.schema["features"].metadata["ml_attr"]["attrs"]["nominal"]
    assert "elsewhere" not in learned[0]["vals"]


def test_rows_beyond_the_caps_are_not_prepared(rows):
    capped = splitting.split_roles(rows.drop("role"), train_rows=400, calibration_rows=100)
    features = learners.ordinal_features(capped)
    assert features.role("unused").count() == 0
    assert features.role("train").count() == 400


def test_statistics_are_those_of_all_train_rows(spark):
    """A split of more train rows than 200,000 leaves none out."""
    from keepwell.operators.model_input import CATEGORIES

    customers = spark.range(400_000).select(
        F.col("id").alias("msno"), (F.col("id") % 7 == 0).cast("int").alias("is_churn"), (F.col("id") % 50).alias("days"),
        *[(F.col("id") % 3).cast("string").alias(c) for c in CATEGORIES],
    )
    roles = staged(splitting.split_roles(customers), "many-roles")
    features = learners.statistic_features(roles)
    assert features.rows.count() == 400_000 and features.training(learners.QUICK).count() > 200_000
    train = roles.filter("role = 'train'").groupBy(list(CATEGORIES)[0]).agg(F.sum("is_churn").alias("s"), F.count("*").alias("n"))
    prior = roles.filter("role = 'train'").agg(F.avg("is_churn")).first()[0]
    expected = sorted((r.s + prior) / (r.n + 1) for r in train.collect())
    seen = features.role("test").select(vector_to_array("features")[features.names.index(f"{list(CATEGORIES)[0]}_stat")].alias("v"))
    assert sorted(r.v for r in seen.distinct().collect()) == pytest.approx(expected, abs=1e-12)


def test_registered_queries_fit_each_candidate_once_with_the_reported_settings(spark, sf_dir, monkeypatch):
    fits = []

    def recorded(name, fit):
        def small(features, profile):
            fits.append((name, dataclasses.replace(profile, train_partitions=learners.FULL.train_partitions)))
            return fit(features, dataclasses.replace(learners.QUICK, ordinal_rounds=1, deep_rounds=1, nominal_rounds=1))

        return small

    monkeypatch.setattr(session, "_KEPT", {})
    monkeypatch.setattr(
        learners, "CANDIDATES", {n: (prepare, recorded(n, fit)) for n, (prepare, fit) in learners.CANDIDATES.items()}
    )
    for name in ("score_boosted_ordinal", "feature_importance_boosted", "model_save_load", "model_tournament", "score_boosted_nominal"):
        assert catalog.QUERIES[name](spark, sf_dir).count() > 0
    assert sorted(fits, key=lambda x: x[0]) == [(n, learners.FULL) for n in sorted(learners.CANDIDATES)]


def test_stored_preparation_scores_raw_customers(spark, rows, tmp_path):
    """Raw rows without label and role, one with unseen levels and gaps everywhere."""
    features = learners.ordinal_features(rows)
    model = learners.fit_boosted_ordinal(features, learners.QUICK)
    scores, calibrator = learners.calibrated_scores("m", model, features)
    learners.scoring_pipeline(features, model, calibrator).write().overwrite().save(str(tmp_path / "m"))
    loaded = PipelineModel.load(str(tmp_path / "m"))
    raw = rows.drop("role", "is_churn")
    again = {r.msno: r.calibrated for r in learners.score_raw(loaded, raw).collect()}
    assert len(again) == rows.count()
    assert all(again[r.msno] == r.risk for r in scores.collect())
    odd = raw.limit(1).select("msno", *[F.lit(None).cast(t).alias(c) for c, t in raw.dtypes if c != "msno"])
    odd = odd.withColumn("city_category", F.lit("nowhere"))
    assert 0 <= learners.score_raw(loaded, odd).first().calibrated <= 1
    with pytest.raises(ValueError, match="stored stages"):
        learners.scoring_pipeline(learners.nominal_features(rows), model, calibrator)


def test_candidates_are_fitted_at_the_same_time(spark):
    all_there = threading.Barrier(len(learners.CANDIDATES), timeout=60)

    def fitted(name):
        all_there.wait()
        return name, spark.range(3).count()

    assert learners.all_candidates(spark, fitted) == {n: (n, 3) for n in learners.CANDIDATES}
    assert list(learners.all_candidates(spark, fitted)) == list(learners.CANDIDATES)
