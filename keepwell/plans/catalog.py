"""Every operator as a named query over the test tables."""

from __future__ import annotations

import dataclasses
import uuid
from collections.abc import Callable

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keepwell.functions.columns import compact_date
from keepwell.functions.hashing import hash_bucket, hash_draw
from keepwell.operators import (
    boosting,
    calibration,
    campaign,
    champion,
    encoding,
    feeds,
    history,
    learners,
    metrics,
    model_input,
    profiles,
    quality,
    ranking,
    segments,
    snapshot,
    splitting,
)
from keepwell.session import kept, scratch_path, staged
from keepwell.sources import fixtures, readers, schemas, sinks

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

MIN_DISTINCT_SCORES = 30
BASE_RATE_BAND = (0.05, 0.20)
# Samples of a fixed size are the feature; these are small enough to bind on every test table.
SAMPLE_ROWS = 500
ROLE_CAPS = {"train_rows": 700, "calibration_rows": 200}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


# ---- shared inputs ----


def _history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return history.history_as_of(fixtures.transactions(spark, sf_dir), fixtures.CUTOFF)


def _snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return snapshot.customer_snapshot(
        fixtures.labels(spark, sf_dir),
        fixtures.transactions(spark, sf_dir),
        fixtures.members(spark, sf_dir),
        fixtures.CUTOFF,
    )


def _model_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    return model_input.model_input(_snapshot(spark, sf_dir))


def _rows_with_roles(spark: SparkSession, sf_dir: str, roles=splitting.split_roles) -> DataFrame:
    """Model input with its split, written once for all the passes that training makes.

    A role depends on id and label alone, so it is drawn on the narrow label table.
    """
    drawn = roles(staged(fixtures.labels(spark, sf_dir), "labels")).select("msno", "role")
    return staged(_model_input(spark, sf_dir).join(drawn, "msno"), "rows")


def _scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staged(fixtures.scored(spark, sf_dir), "scored")


def _scored_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staged(fixtures.scored_models(spark, sf_dir), "scored-models")


def _valued(spark: SparkSession, sf_dir: str, inputs: DataFrame | None = None) -> DataFrame:
    inputs = _model_input(spark, sf_dir) if inputs is None else inputs
    return staged(campaign.scored_with_value(fixtures.scored(spark, sf_dir), inputs), "valued")


def _scenario(spark: SparkSession, sf_dir: str) -> Row:
    return campaign.check_scenario(fixtures.scenario(spark, sf_dir).first())


def _metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One record per stand-in model."""
    return metrics.tournament_records(metrics.model_metrics(_scored_models(spark, sf_dir)))


def _spend_grid(spark: SparkSession, sf_dir: str, inputs: DataFrame | None = None) -> tuple[DataFrame, Row]:
    config = _scenario(spark, sf_dir)
    targets = campaign.target_totals(_valued(spark, sf_dir, inputs), config["capacity_grid_percent"])
    return campaign.spend_grid(targets, config), config


shown = metrics.report_rounded


# ---- scans and sinks ----


@query
def source_csv(spark, sf_dir):
    path = scratch_path(spark, "csv")
    raw = fixtures.transactions(spark, sf_dir)
    raw.select(*schemas.transactions().names).write.option("header", True).csv(path)
    return readers.read_csv(spark, path, schemas.transactions(T.LongType()))


@query
def source_parquet_projection(spark, sf_dir):
    path = scratch_path(spark, "input")
    _model_input(spark, sf_dir).write.parquet(path)
    return shown(readers.read_parquet(spark, path, ["msno", "latest_amount_paid", "average_amount_paid"]))


@query
def source_parquet_view(spark, sf_dir):
    """The written snapshot as a SQL view."""
    path = scratch_path(spark, "snapshot")
    _snapshot(spark, sf_dir).write.parquet(path)
    view = f"snapshot_{uuid.uuid4().hex}"
    readers.parquet_view(spark, path, view)
    table = spark.sql(
        f"SELECT plan_type_count, COUNT(*) AS customers, CAST(SUM(is_churn) AS BIGINT) AS churned, "
        f"MAX(total_amount_paid) AS highest_total FROM {view} GROUP BY plan_type_count"
    )
    spark.catalog.dropTempView(view)
    return table


@query
def source_json_config(spark, sf_dir):
    path = scratch_path(spark, "config")
    sinks.write_json(fixtures.scenario(spark, sf_dir), path)
    return readers.read_scenario(spark, path).select(
        "campaign_capacity_percent",
        "offer_cost_per_customer",
        "assumed_save_rate",
        "value_months",
        "monetary_unit_label",
        "value_proxy_multiplier",
        "maximum_campaign_budget",
        F.explode("capacity_grid_percent").alias("capacity_percent"),
    )


@query
def sink_parquet_roundtrip(spark, sf_dir):
    return shown(sinks.write_parquet(_snapshot(spark, sf_dir), scratch_path(spark, "snapshot")))


@query
def sink_csv_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "segments")
    table = segments.churn_by(_snapshot(spark, sf_dir), "churn_by_payment_recency")
    sinks.write_small_csv(table, path)
    return readers.read_csv(spark, path, table.schema)


@query
def rewrite_in_place(spark, sf_dir):
    """Stored predictions whose champion column was lost, restored in the same place."""
    scored = _scored_models(spark, sf_dir)
    winner = champion.champion(staged(metrics.tournament_records(metrics.model_metrics(scored)), "metrics"))
    models = list(fixtures.MODEL_SEEDS)
    path = scratch_path(spark, "predictions")
    wide = champion.wide_predictions(scored, models, winner)
    sinks.publish(wide.withColumn("champion_calibrated_probability", F.lit(None).cast("double")), path)
    return shown(sinks.rewrite_parquet(spark, path, lambda stored: champion.reselect(stored, models, winner)))


@query
def champion_record_json(spark, sf_dir):
    record = champion.champion_record(_metrics(spark, sf_dir))
    fields = "selected_model string, selection_rule string, metrics struct<test_customers: bigint, roc_auc: double>"
    return shown(
        record.select(F.from_json("record", fields).alias("r")).select(
            "r.selected_model", "r.selection_rule", "r.metrics.test_customers", "r.metrics.roc_auc"
        )
    )


@query
def schema_report(spark, sf_dir):
    return sinks.schema_report(_model_input(spark, sf_dir))


# ---- point-in-time features ----


@query
def parse_compact_date(spark, sf_dir):
    parsed = history.parsed(fixtures.transactions(spark, sf_dir))
    return (
        parsed.groupBy("transaction_date", "transaction_date_parsed")
        .agg(F.count(F.lit(1)).alias("transactions"))
        .withColumn("next_day_parsed", compact_date(F.col("transaction_date") + 1))
    )


@query
def history_as_of(spark, sf_dir):
    return _history(spark, sf_dir).drop("transaction_date", "membership_expire_date")


@query
def member_profile_as_of(spark, sf_dir):
    return profiles.profile_as_of(fixtures.members(spark, sf_dir), fixtures.CUTOFF)


@query
def age_validation(spark, sf_dir):
    return profiles.validated(fixtures.members(spark, sf_dir)).select("msno", "bd", "age_clean", "age_unknown_flag")


@query
def presence_flags(spark, sf_dir):
    return _snapshot(spark, sf_dir).select("msno", *snapshot.presence_flags())


@query
def recency_tenure_days(spark, sf_dir):
    return _snapshot(spark, sf_dir).select(
        "msno", "days_since_first_transaction", "days_since_last_transaction", "days_since_registration"
    )


@query
def discount_features(spark, sf_dir):
    return shown(
        _snapshot(spark, sf_dir).select(
            "msno", "total_list_price", "total_amount_paid", "total_discount_amount", "discount_rate"
        )
    )


@query
def tx_features_overall(spark, sf_dir):
    return shown(history.lifetime_features(_history(spark, sf_dir), fixtures.CUTOFF))


@query
def distinct_count_null_aware(spark, sf_dir):
    return (
        _history(spark, sf_dir)
        .groupBy("msno")
        .agg(
            history.distinct_codes("payment_method_id").alias("payment_method_count"),
            history.distinct_codes("payment_plan_days").alias("plan_type_count"),
        )
    )


@query
def tx_features_31d(spark, sf_dir):
    return _history(spark, sf_dir).groupBy("msno").agg(*history.month_aggregates(fixtures.CUTOFF))


@query
def tx_features_90d(spark, sf_dir):
    return _history(spark, sf_dir).groupBy("msno").agg(*history.quarter_aggregates(fixtures.CUTOFF))


@query
def tx_features_latest(spark, sf_dir):
    return history.latest_features(_history(spark, sf_dir))


@query
def customer_snapshot(spark, sf_dir):
    return shown(_snapshot(spark, sf_dir))


@query
def snapshot_summary(spark, sf_dir):
    return shown(snapshot.snapshot_summary(_snapshot(spark, sf_dir)))


# ---- segments ----


@query
def churn_by_latest_auto_renewal(spark, sf_dir):
    return segments.churn_by(_snapshot(spark, sf_dir), "churn_by_latest_auto_renewal")


@query
def churn_by_payment_recency(spark, sf_dir):
    return segments.churn_by(_snapshot(spark, sf_dir), "churn_by_payment_recency")


@query
def churn_by_transaction_frequency(spark, sf_dir):
    return segments.churn_by(_snapshot(spark, sf_dir), "churn_by_transaction_frequency")


@query
def churn_by_profile_availability(spark, sf_dir):
    return segments.churn_by(_snapshot(spark, sf_dir), "churn_by_profile_availability")


# ---- model input, splits, preparation ----


QUERIES["model_input"] = lambda spark, sf_dir: shown(_model_input(spark, sf_dir))


@query
def category_domain(spark, sf_dir):
    rows = splitting.stratified_split(staged(_model_input(spark, sf_dir), "input"))
    return model_input.category_domain(rows.filter("split = 'train'"), rows.filter("split = 'test'"))


@query
def stratified_split(spark, sf_dir):
    return splitting.stratified_split(fixtures.labels(spark, sf_dir))


@query
def stratified_split_exact(spark, sf_dir):
    return splitting.stratified_split_exact(staged(fixtures.labels(spark, sf_dir), "labels"))


@query
def train_sample_cap(spark, sf_dir):
    pool = splitting.stratified_split(staged(fixtures.labels(spark, sf_dir), "labels")).filter("split = 'train'")
    return splitting.sample_stratified(pool, SAMPLE_ROWS)


@query
def split_roles(spark, sf_dir):
    return splitting.split_roles(staged(fixtures.labels(spark, sf_dir), "labels"), **ROLE_CAPS)


@query
def class_weights(spark, sf_dir):
    train = splitting.stratified_split(fixtures.labels(spark, sf_dir)).filter("split = 'train'")
    return shown(splitting.class_weights(train))


@query
def class_ratio(spark, sf_dir):
    train = splitting.stratified_split(fixtures.labels(spark, sf_dir)).filter("split = 'train'")
    return shown(splitting.class_ratio(train))


@query
def split_alignment_violations(spark, sf_dir):
    """Scores of one model's test rows against another seed's test split: not aligned, so not empty."""
    labelled = staged(fixtures.labels(spark, sf_dir), "labels")
    stored = splitting.stratified_split(labelled, "split-43|").filter("split = 'test'")
    return splitting.alignment_violations(stored, splitting.stratified_split(labelled).filter("split = 'test'"))


@query
def numeric_medians(spark, sf_dir):
    rows = _rows_with_roles(spark, sf_dir)
    features = model_input.numeric_features(rows.drop("role"))
    counted = encoding.value_counts(rows.filter("role = 'train'"), features)
    return shown(encoding.numeric_medians(counted).select("feature", "median", "missing"))


def _prepared_numeric(spark, sf_dir, scale):
    rows = _rows_with_roles(spark, sf_dir)
    features = model_input.numeric_features(rows.drop("role"))
    learned = encoding.learn_numeric(rows.filter("role = 'train'"), features, scale)
    imputed = learned.impute(rows)
    return shown((learned.scale(imputed) if scale else imputed).select("msno", *learned.columns))


@query
def imputed_features(spark, sf_dir):
    return _prepared_numeric(spark, sf_dir, scale=False)


@query
def scaled_features(spark, sf_dir):
    return _prepared_numeric(spark, sf_dir, scale=True)


@query
def one_hot_features(spark, sf_dir):
    """Positions of the ones in each customer's joined one-hot vector."""
    rows = _rows_with_roles(spark, sf_dir)
    encoded = encoding.learn_one_hot(rows.filter("role = 'train'")).transform(encoding.with_known_categories(rows))
    joined = F.flatten(F.array(*[vector_to_array(f"{c}_onehot") for c in model_input.CATEGORIES]))
    ones = F.filter(F.transform(joined, lambda x, i: F.when(x == 1.0, i)), lambda i: i.isNotNull())
    return encoded.select(
        "msno",
        F.size(joined).alias("width"),
        F.concat_ws(",", F.transform(ones, lambda i: i.cast("string"))).alias("hot_positions"),
    )


@query
def ordinal_features(spark, sf_dir):
    rows = _rows_with_roles(spark, sf_dir)
    levels = encoding.ordinal_levels(rows.filter("role = 'train'"))
    return encoding.ordinal_encode(rows, levels).select("msno", *[f"{c}_code" for c in model_input.CATEGORIES])


# ---- ranking and probability metrics ----


@query
def ranking_curve(spark, sf_dir):
    return shown(metrics.ranking_curve(_scored(spark, sf_dir)))


def _curve_numbers(spark, sf_dir, *names):
    curve = ranking.score_curve(_scored(spark, sf_dir))
    return shown(metrics.curve_metrics(curve).select(*names))


@query
def roc_auc(spark, sf_dir):
    return _curve_numbers(spark, sf_dir, "test_customers", "roc_auc")


@query
def average_precision(spark, sf_dir):
    return _curve_numbers(spark, sf_dir, "test_customers", "average_precision")


@query
def brier_score(spark, sf_dir):
    return _curve_numbers(spark, sf_dir, "test_customers", "brier_score")


@query
def classification_metrics_at_threshold(spark, sf_dir):
    return _curve_numbers(
        spark,
        sf_dir,
        "test_customers",
        "accuracy_at_50_percent_risk",
        "precision_at_50_percent_risk",
        "recall_at_50_percent_risk",
    )


@query
def lift_at_top_decile(spark, sf_dir):
    scored = _scored(spark, sf_dir)
    return shown(metrics.top_decile(scored, ranking.score_curve(scored)))


@query
def campaign_threshold(spark, sf_dir):
    return shown(metrics.campaign_threshold(_scored(spark, sf_dir)))


@query
def model_metrics(spark, sf_dir):
    return shown(metrics.model_metrics(_scored_models(spark, sf_dir)))


@query
def baseline_metric_records(spark, sf_dir):
    return shown(metrics.baseline_records(metrics.model_metrics(_scored_models(spark, sf_dir))))


@query
def calibration_metric_records(spark, sf_dir):
    return shown(metrics.calibration_records(metrics.model_metrics(_scored_models(spark, sf_dir))))


@query
def calibration_table(spark, sf_dir):
    return shown(calibration.calibration_table(fixtures.scored(spark, sf_dir)))


@query
def isotonic_calibration(spark, sf_dir):
    """Fit on the calibration role, applied to the test role."""
    rows = staged(splitting.split_roles(_scored(spark, sf_dir)), "roles")
    model = calibration.fit_isotonic(rows.filter("role = 'calibration'"))
    return shown(
        calibration.calibrate(rows.filter("role = 'test'"), model).select("msno", "is_churn", "risk", "calibrated")
    )


# ---- champion ----


@query
def champion_selection(spark, sf_dir):
    return shown(champion.champion(_metrics(spark, sf_dir)))


@query
def champion_scores(spark, sf_dir):
    scored = _scored_models(spark, sf_dir)
    measured = metrics.tournament_records(metrics.model_metrics(scored))
    return champion.champion_scores(scored, champion.champion(measured))


@query
def tournament_predictions(spark, sf_dir):
    scored = _scored_models(spark, sf_dir)
    measured = metrics.tournament_records(metrics.model_metrics(scored))
    return shown(champion.wide_predictions(scored, list(fixtures.MODEL_SEEDS), champion.champion(measured)))


# ---- campaign ----


@query
def scored_with_value(spark, sf_dir):
    return shown(
        campaign.merge_one_to_one(
            fixtures.scored(spark, sf_dir),
            _model_input(spark, sf_dir).select("msno", "latest_amount_paid", "average_amount_paid"),
        )
    )


@query
def monthly_value_proxy(spark, sf_dir):
    return shown(_snapshot(spark, sf_dir).select("msno", campaign.monthly_value_proxy().alias("monthly_value_proxy")))


@query
def monthly_value_proxy_scaled(spark, sf_dir):
    return shown(
        _snapshot(spark, sf_dir).select("msno", campaign.monthly_value_proxy(0.25).alias("monthly_value_proxy"))
    )


@query
def campaign_priority_list(spark, sf_dir):
    config = _scenario(spark, sf_dir)
    return shown(campaign.priority_list(_valued(spark, sf_dir), config["campaign_capacity_percent"]))


@query
def campaign_scenario(spark, sf_dir):
    config = _scenario(spark, sf_dir)
    targets = campaign.target_totals(_valued(spark, sf_dir), [config["campaign_capacity_percent"]])
    return shown(
        campaign.scenario_table(
            targets, [config["assumed_save_rate"]], config["offer_cost_per_customer"], config["value_months"]
        )
    )


@query
def campaign_sensitivity(spark, sf_dir):
    config = _scenario(spark, sf_dir)
    targets = campaign.target_totals(_valued(spark, sf_dir), config["sensitivity_capacity_percent"])
    return shown(
        campaign.scenario_table(
            targets, config["sensitivity_save_rates"], config["offer_cost_per_customer"], config["value_months"]
        )
    )


@query
def campaign_spend_grid(spark, sf_dir):
    return shown(_spend_grid(spark, sf_dir)[0])


@query
def feasible_capacities(spark, sf_dir):
    return shown(campaign.feasible(_spend_grid(spark, sf_dir)[0]))


@query
def campaign_recommendation(spark, sf_dir):
    grid, config = _spend_grid(spark, sf_dir)
    return shown(campaign.recommendation(grid, config["capacity_grid_percent"]))


# ---- contracts ----


@query
def id_set_difference(spark, sf_dir):
    """Labelled customers against members: some customers have no member row."""
    return quality.id_set_difference(fixtures.labels(spark, sf_dir), fixtures.members(spark, sf_dir))


@query
def dq_contracts(spark, sf_dir):
    built = staged(_snapshot(spark, sf_dir), "snapshot")
    prepared = staged(model_input.model_input(built), "input")
    measured = staged(_metrics(spark, sf_dir), "metrics")
    grid, config = _spend_grid(spark, sf_dir, prepared)
    grid = staged(grid, "grid")
    capacities = config["capacity_grid_percent"]
    chosen = campaign.recommendation(grid, capacities)
    path = scratch_path(spark, "winner")
    champion.champion_record(measured).write.text(path)
    recorded = spark.read.text(path).select(F.get_json_object("value", "$.selected_model").alias("model"))
    parts = [
        quality.snapshot_contracts(built, fixtures.CUTOFF, BASE_RATE_BAND),
        quality.model_input_contracts(built, prepared),
        quality.score_contracts(_scored(spark, sf_dir), MIN_DISTINCT_SCORES),
        quality.champion_contract(measured, recorded),
        quality.recommendation_contracts(grid, chosen, config["maximum_campaign_budget"], capacities),
    ]
    table = parts[0]
    for part in parts[1:]:
        table = table.unionByName(part)
    return table


def _spoiled(table: DataFrame, copies: tuple[int, int], **changes: tuple[int, int, Column]) -> DataFrame:
    """``table`` with values changed and rows repeated, each for the customers of a range of hash buckets."""
    bucket = hash_bucket("spoiled", "msno")
    rows = table.withColumn("_bucket", bucket)
    for name, (low, high, value) in changes.items():
        rows = rows.withColumn(name, F.when(F.col("_bucket").between(low, high - 1), value).otherwise(F.col(name)))
    again = F.when(F.col("_bucket").between(copies[0], copies[1] - 1), F.lit(2)).otherwise(F.lit(1))
    return rows.withColumn("_copy", F.explode(F.array_repeat(F.lit(0), again))).drop("_bucket", "_copy")


@query
def dq_contract_violations(spark, sf_dir):
    """All contracts on copies of the tables that break every rule."""
    built = staged(_snapshot(spark, sf_dir), "snapshot")
    prepared = staged(model_input.model_input(built), "input")
    grid, config = _spend_grid(spark, sf_dir, prepared)
    capacities = config["capacity_grid_percent"]
    snapshots = _spoiled(
        built,
        (3000, 4000),
        is_churn=(0, 2000, F.when(hash_bucket("label", "msno") < 5000, F.lit(2))),
        last_transaction_date=(2000, 3000, F.lit(fixtures.CUTOFF) + F.expr("INTERVAL 5 DAYS")),
    )
    inputs = _spoiled(prepared.filter(hash_bucket("lost", "msno") >= 1000), (3000, 3500)).withColumnRenamed(
        "age_unknown_flag", "latest_payment_method_id"
    )
    nobody = (6000, 9000, F.lit(None).cast("double"))
    scores = _spoiled(_scored(spark, sf_dir).withColumn("risk", F.round("risk", 1)), (0, 1000), risk=nobody)
    scores = scores.withColumn("risk", F.when(F.col("risk") < 0.3, F.col("risk") - 1).otherwise(F.col("risk")))
    dear = grid.filter("NOT within_budget").withColumn("capacity_percent", F.lit(99.0))
    parts = [
        quality.snapshot_contracts(snapshots, fixtures.CUTOFF, BASE_RATE_BAND),
        quality.model_input_contracts(built, inputs),
        quality.score_contracts(scores, MIN_DISTINCT_SCORES),
        quality.champion_contract(_metrics(spark, sf_dir), spark.range(1).select(F.lit("nobody").alias("model"))),
        quality.recommendation_contracts(grid, dear, config["maximum_campaign_budget"], capacities),
    ]
    table = parts[0]
    for part in parts[1:]:
        table = table.unionByName(part)
    return table


# ---- feeds ----


@query
def kpi_feed(spark, sf_dir):
    return shown(feeds.kpis(_snapshot(spark, sf_dir), champion.champion(_metrics(spark, sf_dir))))


@query
def driver_feed_labels(spark, sf_dir):
    return segments.labelled_drivers(_snapshot(spark, sf_dir))


@query
def model_comparison_feed(spark, sf_dir):
    return shown(feeds.model_comparison(_metrics(spark, sf_dir)))


@query
def campaign_curve_feed(spark, sf_dir):
    grid, config = _spend_grid(spark, sf_dir)
    grid = staged(grid, "grid")
    return shown(feeds.campaign_curve(grid, campaign.recommendation(grid, config["capacity_grid_percent"])))


@query
def any_column_search(spark, sf_dir):
    return feeds.first_matching_row(
        profiles.profile_as_of(fixtures.members(spark, sf_dir), fixtures.CUTOFF), "^FEM.*e$", "msno"
    )


@query
def any_column_search_cases(spark, sf_dir):
    """A hit in a date column, and no hit at all, which gives the last row."""
    profile = profiles.profile_as_of(fixtures.members(spark, sf_dir), fixtures.CUTOFF)
    found = [
        feeds.first_matching_row(profile, pattern, "msno").select(F.lit(case).alias("search"), *profile.columns)
        for case, pattern in (("date", "^1995-07"), ("nothing", "no such value"))
    ]
    return found[0].unionByName(found[1])


# ---- models, all with the reported settings ----

# The reported settings; a small table needs no 32 partitions.
REPORTED = dataclasses.replace(learners.FULL, train_partitions=4)


def _baseline(spark, sf_dir, name):
    features = learners.linear_features(_rows_with_roles(spark, sf_dir, splitting.baseline_roles))
    return features, learners.BASELINES[name](features, REPORTED)


def _candidate(spark, sf_dir, name):
    """A candidate's features and model, made once a session and table set for all queries that need them."""
    prepare, fit = learners.CANDIDATES[name]
    features = kept(spark, (sf_dir, prepare.__name__), lambda: prepare(_rows_with_roles(spark, sf_dir)))
    return features, kept(spark, (sf_dir, name), lambda: fit(features, REPORTED))


def _test_scores(fitted):
    features, model = fitted
    return learners.score(model, features.role("test"))


@query
def target_statistics(spark, sf_dir):
    """Ordered target statistics of the categories, as the symmetric trees see them."""
    rows = encoding.with_known_categories(_rows_with_roles(spark, sf_dir).filter("role <> 'unused'"))
    found = boosting.ordered_statistics(
        rows,
        list(model_input.CATEGORIES),
        model_input.TARGET,
        model_input.ID,
        hash_draw(learners.STAT_SEED, model_input.ID),
        learners.churn_rate(rows.filter("role = 'train'")),
    )
    return shown(found.select("msno", "role", *[f"{c}_stat" for c in model_input.CATEGORIES]))


@query
def tournament_contracts(spark, sf_dir):
    """What holds of every candidate: each test customer scored once, within [0, 1], importances that
    sum to 1 (to 0 where nothing was split)."""
    found = None
    candidates = learners.all_candidates(spark, lambda name: _candidate(spark, sf_dir, name))
    for name, (features, model) in candidates.items():
        scores = learners.score(model, features.role("test"))
        total = float(sum(model.stages[-1].featureImportances.toArray()))
        split = any(max(t["left"]) >= 0 for t in model.stages[-1].state["trees"])
        row = scores.agg(
            F.lit(name).alias("model"),
            F.count(F.lit(1)).alias("test_rows"),
            F.count_distinct("msno").alias("test_customers"),
            F.count_if(F.col("risk").isNull()).alias("without_score"),
            F.count_if((F.col("risk") < 0) | (F.col("risk") > 1)).alias("outside"),
            F.lit(int(abs(total - split) > 1e-9)).cast("bigint").alias("importances_off"),
        )
        found = row if found is None else found.unionByName(row)
    return found


@query
def score_logistic(spark, sf_dir):
    return _test_scores(_baseline(spark, sf_dir, "logistic_regression"))


@query
def score_random_forest(spark, sf_dir):
    return _test_scores(_baseline(spark, sf_dir, "random_forest"))


@query
def score_boosted_ordinal(spark, sf_dir):
    return _test_scores(_candidate(spark, sf_dir, "boosted_ordinal"))


@query
def score_boosted_nominal_deep(spark, sf_dir):
    return _test_scores(_candidate(spark, sf_dir, "boosted_nominal_deep"))


@query
def score_boosted_nominal(spark, sf_dir):
    return _test_scores(_candidate(spark, sf_dir, "boosted_nominal"))


@query
def model_save_load(spark, sf_dir):
    """A stored model with its preparation and calibrator, loaded again, on raw model input, against the scores
    in memory: test customers scored, and scored otherwise."""
    features, model = _candidate(spark, sf_dir, "boosted_ordinal")
    calibrated, calibrator = learners.calibrated_scores("memory", model, features)
    path = scratch_path(spark, "model")
    learners.scoring_pipeline(features, model, calibrator).write().overwrite().save(path)
    raw = _model_input(spark, sf_dir).drop(model_input.TARGET)
    again = learners.score_raw(PipelineModel.load(path), raw).select("msno", F.col("calibrated").alias("again"))
    both = calibrated.join(again, "msno", "left")
    return both.agg(
        F.count(F.lit(1)).alias("customers"),
        F.count_if(~F.col("risk").eqNullSafe(F.col("again"))).alias("scored_otherwise"),
    )


@query
def feature_importance_forest(spark, sf_dir):
    features, model = _baseline(spark, sf_dir, "random_forest")
    return learners.feature_importance(model, features.names)


@query
def feature_importance_boosted(spark, sf_dir):
    features, model = _candidate(spark, sf_dir, "boosted_ordinal")
    return learners.feature_importance(model, features.names)


@query
def model_tournament(spark, sf_dir):
    rows = _rows_with_roles(spark, sf_dir)
    return shown(learners.run_tournament(rows, REPORTED, lambda name: _candidate(spark, sf_dir, name)).metrics)
