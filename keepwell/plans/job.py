"""The whole chain as one batch job, from raw tables to the campaign recommendation.

Each step reads tables that earlier steps wrote and writes its own, so any step can be run again
by itself:  python -m keepwell.plans.job --raw DIR --config FILE --out DIR [--steps snapshot …]
"""

from __future__ import annotations

import argparse
import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from keepwell.operators import (
    calibration,
    campaign,
    champion,
    feeds,
    learners,
    metrics,
    quality,
    segments,
    splitting,
)
from keepwell.operators.history import of_labelled
from keepwell.operators.model_input import model_input
from keepwell.operators.snapshot import customer_snapshot, snapshot_summary
from keepwell.session import release_scratch, staged
from keepwell.sources import readers, schemas, sinks

ORDINAL_MODEL = "boosted_ordinal"


@dataclass
class Run:
    """Where a run reads and writes, and its settings."""

    spark: SparkSession
    raw: str
    config: str
    out: str
    cutoff: dt.date = dt.date(2017, 1, 31)
    base_rate_band: tuple[float, float] = (0.08, 0.10)
    min_distinct_scores: int = 101
    profile: learners.Profile = field(default_factory=lambda: learners.FULL)
    transactions: str = "transactions.csv"
    members: str = "members.csv"
    labels: str = "labels.csv"

    def table(self, name: str) -> DataFrame:
        return sinks.published(self.spark, self.path(name))

    def path(self, name: str) -> str:
        return f"{self.out}/{name}"

    def raw_table(self, name: str, schema) -> DataFrame:
        return readers.read_raw(self.spark, f"{self.raw}/{name}", schema)

    def scenario(self) -> Row:
        """Checked before any customer row is read."""
        return campaign.check_scenario(readers.read_scenario(self.spark, self.config).first())


def build_snapshot(run: Run) -> None:
    """The rules are observed in the rows as they are written; readers see the table once they hold."""
    labels = run.raw_table(run.labels, schemas.labels())
    built = customer_snapshot(
        labels,
        of_labelled(run.raw_table(run.transactions, schemas.transactions()), labels),
        run.raw_table(run.members, schemas.members()),
        run.cutoff,
    )
    written = sinks.publish(
        built,
        run.path("silver/customer_snapshot"),
        lambda made, seen: quality.require(quality.observed_snapshot_contracts(made, seen, run.base_rate_band)),
        quality.snapshot_measures(run.cutoff),
    )
    sinks.write_small_csv(snapshot_summary(written), run.path("reports/snapshot_summary"))


def build_segments(run: Run) -> None:
    table = run.table("silver/customer_snapshot")
    for name in segments.SEGMENTS:
        sinks.write_small_csv(segments.churn_by(table, name), run.path(f"reports/tables/{name}"))


def prepare_model_input(run: Run) -> None:
    source = run.table("silver/customer_snapshot")
    written = sinks.publish(
        model_input(source),
        run.path("gold/model_input"),
        lambda made, _: quality.require(quality.model_input_contracts(source, made)),
    )
    sinks.write_small_csv(sinks.schema_report(written), run.path("reports/model_input_schema"))
    sinks.publish(splitting.split_roles(written), run.path("gold/model_input_roles"))
    sinks.publish(splitting.baseline_roles(written), run.path("gold/model_input_baseline_roles"))


def train_baselines(run: Run) -> None:
    models, scores, features = learners.baseline_scores(run.table("gold/model_input_baseline_roles"), run.profile)
    for name, model in models.items():
        model.write().overwrite().save(run.path(f"models/{name}"))
    scores = sinks.publish(scores, run.path("gold/test_scores_baselines"))
    records = metrics.baseline_records(metrics.model_metrics(scores))
    sinks.write_small_csv(metrics.report_rounded(records), run.path("reports/baseline_model_metrics"))
    sinks.write_small_csv(
        learners.feature_importance(models["random_forest"], features.names),
        run.path("reports/random_forest_feature_importance"),
    )


def train_and_calibrate(run: Run) -> None:
    """The ordinal candidate by itself: raw against calibrated, reliability, threshold, inputs."""
    prepare, fit = learners.CANDIDATES[ORDINAL_MODEL]
    features = prepare(run.table("gold/model_input_roles"))
    model = fit(features, run.profile)
    calibrator = calibration.fit_isotonic(learners.score(model, features.role("calibration")))
    whole = learners.scoring_pipeline(features, model, calibrator)
    whole.write().overwrite().save(run.path(f"models/{ORDINAL_MODEL}"))
    raw = learners.score(model, features.role("test"))
    both = sinks.publish(
        calibration.calibrate(raw, calibrator), run.path(f"gold/test_predictions_{ORDINAL_MODEL}")
    )
    pair = F.array(
        F.struct(F.lit(f"{ORDINAL_MODEL}_raw").alias("model"), F.col("risk").alias("risk")),
        F.struct(F.lit(f"{ORDINAL_MODEL}_isotonic_calibrated").alias("model"), F.col("calibrated").alias("risk")),
    )
    records = metrics.calibration_records(metrics.model_metrics(both.select("msno", "is_churn", F.inline(pair))))
    calibrated = both.select("msno", "is_churn", F.col("calibrated").alias("risk"))
    capacity = run.scenario()["campaign_capacity_percent"]
    sinks.write_small_csv(metrics.report_rounded(records), run.path("reports/ordinal_model_metrics"))
    sinks.write_small_csv(calibration.calibration_table(calibrated), run.path("reports/calibration_table"))
    sinks.write_small_csv(
        metrics.campaign_threshold(calibrated, capacity), run.path("reports/campaign_threshold")
    )
    sinks.write_small_csv(
        learners.feature_importance(model, features.names), run.path("reports/ordinal_feature_importance")
    )


def run_tournament(run: Run) -> None:
    """The ordinal candidate is taken over from its own step; its scores must cover the test split."""
    rows = run.table("gold/model_input_roles")
    stored = run.table(f"gold/test_predictions_{ORDINAL_MODEL}")
    splitting.require_aligned(stored, rows.filter(F.col("role") == "test"))
    name = f"{ORDINAL_MODEL}_isotonic_calibrated"
    scores = stored.select(F.lit(name).alias("model"), "msno", "is_churn", F.col("calibrated").alias("risk"))
    features = learners.nominal_features(rows)
    names = [name]
    for short in ("boosted_nominal_deep", "boosted_nominal"):
        model = learners.CANDIDATES[short][1](features, run.profile)
        model.write().overwrite().save(run.path(f"models/{short}"))
        names.append(f"{short}_isotonic_calibrated")
        part, calibrator = learners.calibrated_scores(names[-1], model, features)
        calibrator.write().overwrite().save(run.path(f"models/{short}_calibrator"))
        scores = scores.unionByName(part)
    scores = sinks.publish(scores, run.path("gold/test_scores_tournament"))
    measured = metrics.report_rounded(metrics.tournament_records(metrics.model_metrics(scores)))
    measured = sinks.publish(measured, run.path("gold/model_tournament_metrics"))
    _publish_champion(run, measured)
    sinks.publish(
        champion.wide_predictions(scores, names, champion.champion(measured)),
        run.path("gold/test_predictions_tournament"),
    )


def _publish_champion(run: Run, measured: DataFrame) -> None:
    sinks.write_small_csv(champion.ranked_models(measured), run.path("reports/model_tournament_metrics"))
    record = champion.champion_record(measured)
    record.coalesce(1).write.mode("overwrite").text(run.path("reports/model_tournament_winner"))


def reselect_champion(run: Run) -> None:
    """From the stored metrics, without training anything."""
    measured = run.table("gold/model_tournament_metrics")
    names = [row["model"] for row in measured.select("model").collect()]  # one row per model
    winner = champion.champion(measured)
    sinks.rewrite_parquet(
        run.spark,
        run.path("gold/test_predictions_tournament"),
        lambda stored: champion.reselect(stored, names, winner),
    )
    _publish_champion(run, measured)


def _valued(run: Run, multiplier: float = 1.0) -> DataFrame:
    predictions = run.table("gold/test_predictions_tournament").withColumn(
        "risk", F.col("champion_calibrated_probability")
    )
    return staged(campaign.scored_with_value(predictions, run.table("gold/model_input"), multiplier), "valued")


def plan_campaign(run: Run) -> None:
    config = run.scenario()
    valued = _valued(run)
    capacity, cost, months = (
        config["campaign_capacity_percent"],
        config["offer_cost_per_customer"],
        config["value_months"],
    )
    sinks.publish(campaign.priority_list(valued, capacity).drop("risk"), run.path("gold/campaign_priority_list"))
    grid = [capacity, *config["sensitivity_capacity_percent"]]
    targets = staged(campaign.target_totals(valued, grid), "targets")
    main = targets.filter(F.col("capacity_percent") == capacity)
    sinks.write_small_csv(
        campaign.report(campaign.scenario_table(main, [config["assumed_save_rate"]], cost, months)),
        run.path("reports/campaign_value_scenario"),
    )
    options = targets.filter(F.col("capacity_percent").isin(config["sensitivity_capacity_percent"]))
    sinks.write_small_csv(
        campaign.report(campaign.scenario_table(options, config["sensitivity_save_rates"], cost, months)),
        run.path("reports/campaign_sensitivity"),
    )


def optimize_spend(run: Run) -> None:
    config = run.scenario()
    capacities = config["capacity_grid_percent"]
    valued = _valued(run, config["value_proxy_multiplier"])
    grid = sinks.publish(
        campaign.spend_grid(campaign.target_totals(valued, capacities), config), run.path("gold/campaign_spend_grid")
    )
    chosen = sinks.publish(
        campaign.recommendation(grid, capacities), run.path("gold/campaign_spend_recommendation")
    )
    place = F.array_position(F.array(*[F.lit(c) for c in capacities]), F.col("capacity_percent"))
    sinks.write_small_csv(campaign.report(grid.orderBy(place)), run.path("reports/campaign_spend_optimization"))
    sinks.write_small_csv(campaign.report(chosen), run.path("reports/campaign_spend_recommendation"))


def check_contracts(run: Run) -> None:
    """All rules as one table, violations or not."""
    config = run.scenario()
    snapshot = run.table("silver/customer_snapshot")
    measured = run.table("gold/model_tournament_metrics")
    scored = run.table("gold/test_predictions_tournament").withColumn("risk", F.col("champion_calibrated_probability"))
    selected = run.spark.read.text(run.path("reports/model_tournament_winner")).select(
        F.get_json_object("value", "$.selected_model").alias("model")
    )
    parts = [
        quality.snapshot_contracts(snapshot, run.cutoff, run.base_rate_band),
        quality.model_input_contracts(snapshot, run.table("gold/model_input")),
        quality.score_contracts(scored, run.min_distinct_scores),
        quality.champion_contract(measured, selected),
        quality.recommendation_contracts(
            run.table("gold/campaign_spend_grid"),
            run.table("gold/campaign_spend_recommendation"),
            config["maximum_campaign_budget"],
            config["capacity_grid_percent"],
        ),
    ]
    table = parts[0]
    for part in parts[1:]:
        table = table.unionByName(part)
    sinks.write_small_csv(table, run.path("reports/contracts"))


def build_feeds(run: Run) -> None:
    snapshot = run.table("silver/customer_snapshot")
    measured = run.table("gold/model_tournament_metrics")
    chosen = run.table("gold/campaign_spend_recommendation")
    tables = {
        "kpis": feeds.kpis(snapshot, champion.champion(measured)),
        "drivers": segments.labelled_drivers(snapshot),
        "model_comparison": feeds.model_comparison(champion.ranked_models(measured)),
        "campaign_curve": feeds.campaign_curve(run.table("gold/campaign_spend_grid"), chosen),
    }
    for name, table in tables.items():
        sinks.write_small_csv(table, run.path(f"feeds/{name}"))


STEPS: dict[str, Callable[[Run], None]] = {
    "snapshot": build_snapshot,
    "segments": build_segments,
    "model_input": prepare_model_input,
    "baselines": train_baselines,
    "calibrated": train_and_calibrate,
    "tournament": run_tournament,
    "reselect": reselect_champion,
    "campaign": plan_campaign,
    "spend": optimize_spend,
    "contracts": check_contracts,
    "feeds": build_feeds,
}


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--raw", required=True, help="folder with the three raw tables")
    for name in ("transactions", "members", "labels"):
        parser.add_argument(f"--{name}", default=f"{name}.csv", help="below --raw; CSV if so named, else Parquet")
    parser.add_argument("--config", required=True, help="scenario JSON")
    parser.add_argument("--out", required=True)
    parser.add_argument("--cutoff", type=dt.date.fromisoformat, default=dt.date(2017, 1, 31))
    parser.add_argument("--base-rate", type=float, nargs=2, default=(0.08, 0.10))
    parser.add_argument("--min-distinct-scores", type=int, default=101)
    parser.add_argument("--quick", action="store_true", help="few trees, for a trial run")
    parser.add_argument("--steps", nargs="*", choices=list(STEPS), default=list(STEPS))
    given = parser.parse_args(arguments)
    run = Run(
        spark=SparkSession.builder.appName("keepwell").getOrCreate(),
        raw=given.raw,
        config=given.config,
        out=given.out,
        cutoff=given.cutoff,
        base_rate_band=tuple(given.base_rate),
        min_distinct_scores=given.min_distinct_scores,
        profile=learners.QUICK if given.quick else learners.FULL,
        transactions=given.transactions,
        members=given.members,
        labels=given.labels,
    )
    try:
        for step in given.steps:
            STEPS[step](run)
    finally:
        release_scratch(run.spark)


if __name__ == "__main__":
    main()
