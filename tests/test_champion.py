import json

from pyspark.sql import functions as F

from keepwell.operators import champion, feeds, quality
from keepwell.operators.metrics import TOURNAMENT_RECORD
from keepwell.sources import sinks

# Published metrics of three calibrated boosted models, under our names.
PUBLISHED = [
    ("boosted_nominal_isotonic_calibrated", 194192, 0.933514, 0.766968, 0.374614, 0.868829, 0.571582, 0.054044, 0.50793, 5.647311),
    ("boosted_nominal_deep_isotonic_calibrated", 194192, 0.932268, 0.76347, 0.357781, 0.869718, 0.563544, 0.05467, 0.507827, 5.646166),
    ("boosted_ordinal_isotonic_calibrated", 194192, 0.932541, 0.803616, 0.330814, 0.869868, 0.567243, 0.05449, 0.506179, 5.627846),
]
MODELS = [row[0] for row in PUBLISHED]


def published(spark):
    return spark.createDataFrame(PUBLISHED, TOURNAMENT_RECORD)


def test_rule_picks_the_published_winner(spark):
    ranked = [r["model"] for r in champion.ranked_models(published(spark)).collect()]
    assert ranked == MODELS
    record = json.loads(champion.champion_record(published(spark)).first()["record"])
    assert record["selected_model"] == MODELS[0]
    assert record["selection_rule"] == champion.SELECTION_RULE
    assert record["metrics"]["roc_auc"] == 0.868829


def test_later_criteria_break_ties(spark):
    tied = published(spark).withColumn("lift_at_top_10_percent", F.lit(5.0))
    assert champion.champion(tied).first()["model"] == MODELS[0]  # lowest Brier score
    tied = tied.withColumn("brier_score", F.lit(0.05))
    assert champion.champion(tied).first()["model"] == MODELS[0]  # highest average precision
    tied = tied.withColumn("average_precision", F.lit(0.5))
    assert champion.champion(tied).first()["model"] == MODELS[2]  # highest AUC


def scores(spark):
    return spark.createDataFrame(
        [(m, i, i % 2, round(0.1 * (k + 1) + i / 100, 3)) for k, m in enumerate(MODELS) for i in range(5)],
        "model string, msno long, is_churn int, risk double",
    )


def test_champion_scores_and_wide_table(spark):
    winner = champion.champion(published(spark))
    mine = champion.champion_scores(scores(spark), winner)
    assert {r["model"] for r in mine.collect()} == {MODELS[0]}
    wide = champion.wide_predictions(scores(spark), MODELS, winner)
    assert wide.count() == 5
    assert wide.filter(
        F.col("champion_calibrated_probability") != F.col(champion.probability_column(MODELS[0]))
    ).count() == 0


def test_reselect_rewrites_the_table_it_reads(spark, tmp_path):
    path = str(tmp_path / "predictions")
    stored = champion.wide_predictions(scores(spark), MODELS, champion.champion(published(spark)))
    sinks.write_parquet(stored, path)
    other = published(spark).filter(F.col("model") == MODELS[2])
    after = sinks.rewrite_parquet(spark, path, lambda t: champion.reselect(t, MODELS, champion.champion(other)))
    assert after.count() == 5
    assert after.filter(
        F.col("champion_calibrated_probability") != F.col(champion.probability_column(MODELS[2]))
    ).count() == 0
    assert [p.name for p in tmp_path.iterdir() if not p.name.startswith(".")] == ["predictions"]


def test_champion_contract(spark):
    measured = published(spark)
    right = quality.champion_contract(measured, champion.champion(measured)).first()
    wrong = quality.champion_contract(measured, measured.filter(F.col("model") == MODELS[1])).first()
    assert (right["violations"], wrong["violations"]) == (0, 1)


def test_score_contracts(spark):
    good = scores(spark).filter(F.col("model") == MODELS[0])
    assert {r["violations"] for r in quality.score_contracts(good, 5).collect()} == {0}
    bad = good.withColumn("risk", F.when(F.col("msno") == 0, F.lit(1.5)).when(F.col("msno") != 1, F.col("risk")))
    found = {r["rule"]: r["violations"] for r in quality.score_contracts(bad, 5).collect()}
    assert found == {
        "score_one_row_per_customer": 0,
        "score_known": 1,
        "score_is_probability": 1,
        "score_distinct_values": 1,
    }


def test_model_comparison_names(spark):
    names = {r["model_name"] for r in feeds.model_comparison(published(spark)).collect()}
    assert names == set(feeds.FRIENDLY_MODELS.values())


def test_any_column_search(spark):
    table = spark.createDataFrame([(1, "Alpha", 10), (2, "beta", 20), (3, "BETA", 30)], "k int, name string, n int")
    assert feeds.first_matching_row(table, "beta", "k").first()["k"] == 2
    assert feeds.first_matching_row(table, "^30$", "k").first()["k"] == 3
    assert feeds.first_matching_row(table, "nothing", "k").first()["k"] == 3
