import json

import pytest
from pyspark.sql import functions as F

from keepwell.plans import job
from keepwell.sources import fixtures, readers, schemas, sinks

SF = "/root/testdata/sf0.01"
RULES = "rule string, violations long"


@pytest.fixture(scope="module")
def arguments(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("job")
    for name, table, schema in (
        ("payments", fixtures.transactions(spark, SF), schemas.transactions()),
        ("members.csv", fixtures.members(spark, SF), schemas.members()),
        ("labels.csv", fixtures.labels(spark, SF), schemas.labels()),
    ):
        chosen = table.select(*[F.col(f.name).cast(f.dataType) for f in schema.fields])
        if name.endswith(".csv"):
            chosen.write.option("header", True).csv(str(base / "raw" / name))
        else:
            chosen.write.parquet(str(base / "raw" / name))
    (base / "scenario.json").write_text(json.dumps(fixtures.scenario(spark, SF).first().asDict()))
    return {
        "--raw": str(base / "raw"),
        "--transactions": "payments",
        "--config": str(base / "scenario.json"),
        "--out": str(base / "out"),
        "--cutoff": fixtures.CUTOFF.isoformat(),
        "--min-distinct-scores": "2",
    }


def run(arguments, *more):
    job.main([part for pair in arguments.items() for part in pair] + ["--base-rate", "0.05", "0.20", "--quick", *more])


def test_all_steps_then_single_steps(spark, arguments):
    run(arguments)
    out = arguments["--out"]
    rules = readers.read_csv(spark, f"{out}/reports/contracts", spark.createDataFrame([], RULES).schema).collect()
    assert len(rules) == 18
    assert {r["rule"] for r in rules if r["violations"]} == set()

    assert sinks.published(spark, f"{out}/silver/customer_snapshot").count() == 1500
    listed = sinks.published(spark, f"{out}/gold/campaign_priority_list")
    assert "is_churn" not in listed.columns
    assert listed.agg(F.max("risk_rank")).first()[0] == listed.count()
    record = json.loads(spark.read.text(f"{out}/reports/model_tournament_winner").first()["value"])
    assert record["selected_model"].endswith("_isotonic_calibrated")
    assert spark.read.option("header", True).csv(f"{out}/reports/campaign_sensitivity").count() == 9
    assert spark.read.option("header", True).csv(f"{out}/reports/campaign_spend_optimization").count() == 8
    assert spark.read.option("header", True).csv(f"{out}/reports/baseline_model_metrics").count() == 2
    assert spark.read.option("header", True).csv(f"{out}/reports/ordinal_model_metrics").count() == 2
    assert spark.read.option("header", True).csv(f"{out}/feeds/kpis").first()["customers"] == "1500"

    before = sinks.published(spark, f"{out}/gold/test_predictions_tournament").orderBy("msno").collect()
    run(arguments, "--steps", "reselect", "spend")
    after = sinks.published(spark, f"{out}/gold/test_predictions_tournament").orderBy("msno").collect()
    assert before == after


def test_bad_setting_stops_the_step_before_it_reads_customers(arguments, tmp_path):
    config = json.loads(open(arguments["--config"]).read())
    (tmp_path / "bad.json").write_text(json.dumps({**config, "assumed_save_rate": 1.5}))
    with pytest.raises(ValueError, match="Save rates"):
        run({**arguments, "--config": str(tmp_path / "bad.json")}, "--steps", "spend")


def test_failed_contract_stops_the_job_and_leaves_the_table(spark, arguments):
    path = f"{arguments['--out']}/silver/customer_snapshot"
    before = sinks.published(spark, path).inputFiles()
    with pytest.raises(ValueError, match="base_rate_in_band"):
        job.main([part for pair in arguments.items() for part in pair] + ["--quick", "--steps", "snapshot"])
    assert sorted(sinks.published(spark, path).inputFiles()) == sorted(before)
