import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from keepwell.operators import campaign, feeds, quality

# Published option table (capacity, customers, spend, fits, average risk, expected churners,
# save rate, break-even, saved, value per saved customer, retained, net, return).
PUBLISHED_OPTIONS = [
    (1, 1942, 58260.0, True, 0.9499, 1844.7, 10.0, 0.87, 184.5, 3625.06, 668730.3, 610470.3, 10.4784),
    (2, 3884, 116520.0, True, 0.9129, 3545.8, 10.0, 0.64, 354.6, 5160.53, 1829846.38, 1713326.38, 14.7041),
    (5, 9710, 291300.0, True, 0.7253, 7042.7, 10.0, 1.13, 704.3, 3646.15, 2567888.22, 2276588.22, 7.8153),
    (10, 19420, 582600.0, True, 0.5111, 9925.7, 10.0, 2.53, 992.6, 2322.57, 2305321.77, 1722721.77, 2.957),
    (15, 29129, 873870.0, True, 0.3937, 11468.7, 10.0, 4.37, 1146.9, 1744.97, 2001245.31, 1127375.31, 1.2901),
    (20, 38839, 1165170.0, False, 0.3274, 12716.7, 10.0, 6.17, 1271.7, 1484.84, 1888222.21, 723052.21, 0.6206),
    (25, 48548, 1456440.0, False, 0.2785, 13522.0, 10.0, 7.98, 1352.2, 1349.97, 1825421.54, 368981.54, 0.2533),
    (30, 58258, 1747740.0, False, 0.243, 14158.7, 10.0, 9.73, 1415.9, 1269.06, 1796820.66, 49080.66, 0.0281),
]
# Published sensitivity table (capacity, save rate %, customers, expected churners, value, net, return).
PUBLISHED_SENSITIVITY = [
    (5, 5.0, 9710, 7042.7, 607.13, 991462.8, 3.4036),
    (5, 10.0, 9710, 7042.7, 607.13, 2274225.61, 7.8072),
    (5, 20.0, 9710, 7042.7, 607.13, 4839751.21, 16.6143),
    (10, 5.0, 19420, 9925.7, 387.09, 570033.28, 0.9784),
    (10, 10.0, 19420, 9925.7, 387.09, 1722666.57, 2.9569),
    (10, 20.0, 19420, 9925.7, 387.09, 4027933.14, 6.9137),
    (20, 5.0, 38839, 12716.7, 247.47, -221063.12, -0.1897),
    (20, 10.0, 38839, 12716.7, 247.47, 723043.76, 0.6205),
    (20, 20.0, 38839, 12716.7, 247.47, 2611257.52, 2.2411),
]
CONFIG = Row(
    campaign_capacity_percent=10.0,
    offer_cost_per_customer=30.0,
    assumed_save_rate=0.1,
    value_months=6,
    monetary_unit_label="units",
    value_proxy_multiplier=1.0,
    maximum_campaign_budget=1_000_000.0,
    capacity_grid_percent=[1.0, 2.0, 5.0, 10.0, 15.0, 20.0, 25.0, 30.0],
    sensitivity_capacity_percent=[5.0, 10.0, 20.0],
    sensitivity_save_rates=[0.05, 0.1, 0.2],
)
TARGET = "capacity_percent double, customers_targeted long, risk_mass double, value double"


def changed(**values):
    return Row(**{**CONFIG.asDict(), **values})


def published_targets(spark):
    return spark.createDataFrame(
        [(float(c), k, mass, value / 6 * k) for c, k, _, _, _, mass, _, _, _, value, *_ in PUBLISHED_OPTIONS], TARGET
    )


def test_published_spend_options(spark):
    grid = campaign.report(campaign.spend_grid(published_targets(spark), CONFIG)).orderBy("capacity_percent").collect()
    for found, want in zip(grid, PUBLISHED_OPTIONS, strict=True):
        assert (found["capacity_percent"], found["customers_targeted"]) == want[:2]
        assert (found["campaign_spend"], found["within_budget"]) == want[2:4]
        assert found["average_calibrated_risk"] == pytest.approx(want[4], abs=1e-4)
        assert found["assumed_save_rate_percent"] == want[6]
        assert found["break_even_save_rate_percent"] == pytest.approx(want[7], abs=0.01)
        assert found["expected_saved_customers"] == pytest.approx(want[8], abs=0.1)
        assert found["scenario_retained_value"] == pytest.approx(want[10], rel=1e-4)
        assert found["scenario_net_value"] == pytest.approx(want[11], abs=want[10] * 1e-4)
        assert found["scenario_roi"] == pytest.approx(want[12], abs=2e-3)


def test_published_recommendation(spark):
    grid = campaign.spend_grid(published_targets(spark), CONFIG)
    chosen = campaign.recommendation(grid, CONFIG["capacity_grid_percent"])
    assert [r["capacity_percent"] for r in chosen.collect()] == [5.0]
    rules = quality.recommendation_contracts(grid, chosen, 1_000_000.0, CONFIG["capacity_grid_percent"]).collect()
    assert {r["violations"] for r in rules} == {0}
    wrong = grid.filter("capacity_percent = 30")
    broken = quality.recommendation_contracts(grid, wrong, 1_000_000.0, [1.0]).collect()
    assert {r["rule"] for r in broken if r["violations"]} == {
        "recommendation_affordable",
        "recommendation_is_best",
        "recommendation_on_grid",
    }


def test_published_sensitivity(spark):
    targets = spark.createDataFrame(
        sorted({(float(c), k, mass, value * k) for c, _, k, mass, value, *_ in PUBLISHED_SENSITIVITY}), TARGET
    )
    table = campaign.report(campaign.scenario_table(targets, [0.05, 0.1, 0.2], 30.0, 6)).collect()
    for found, want in zip(table, PUBLISHED_SENSITIVITY, strict=True):
        assert (found["campaign_capacity_percent"], found["assumed_save_rate_percent"]) == want[:2]
        assert found["scenario_net_value"] == pytest.approx(want[5], abs=200)
        assert found["scenario_roi"] == pytest.approx(want[6], abs=2e-3)


def test_first_option_wins_a_tie_and_none_fits_a_tiny_budget(spark):
    grid = spark.createDataFrame(
        [(10.0, True, 5.0), (5.0, True, 5.0), (20.0, False, 9.0)],
        "capacity_percent double, within_budget boolean, scenario_net_value double",
    )
    assert campaign.recommendation(grid, [10.0, 5.0, 20.0]).first()["capacity_percent"] == 10.0
    poor = campaign.spend_grid(published_targets(spark), changed(maximum_campaign_budget=1.0))
    assert campaign.recommendation(poor, CONFIG["capacity_grid_percent"]).count() == 0


def test_free_offer_has_no_return_and_no_value_no_break_even(spark):
    free = campaign.spend_grid(published_targets(spark), changed(offer_cost_per_customer=0.0)).first()
    assert free["scenario_roi"] is None and free["campaign_spend"] == 0.0
    worthless = spark.createDataFrame([(10.0, 10, 2.0, 0.0)], TARGET)
    assert campaign.spend_grid(worthless, CONFIG).first()["break_even_save_rate_percent"] is None
    assert campaign.scenario_table(worthless, [0.1], 0.0, 6).first()["scenario_roi"] is None


@pytest.mark.parametrize(
    "values",
    [
        {"campaign_capacity_percent": 0.0},
        {"campaign_capacity_percent": 101.0},
        {"capacity_grid_percent": [0.0]},
        {"offer_cost_per_customer": -1.0},
        {"maximum_campaign_budget": -1.0},
        {"value_proxy_multiplier": -0.5},
        {"assumed_save_rate": 1.1},
        {"sensitivity_save_rates": [-0.1]},
    ],
)
def test_settings_out_of_range(values):
    with pytest.raises(ValueError):
        campaign.check_scenario(changed(**values))


def test_settings_in_range():
    assert campaign.check_scenario(CONFIG) is CONFIG


@pytest.mark.parametrize("side", ["left", "right"])
def test_duplicate_id_fails_the_merge(spark, side):
    once = spark.createDataFrame([(1, 1.0), (2, 2.0)], "msno long, x double")
    twice = once.unionByName(once.filter("msno = 1"))
    other = once.withColumnRenamed("x", "y")
    left, right = (twice, other) if side == "left" else (once, twice.withColumnRenamed("x", "y"))
    with pytest.raises(Exception, match=f"not unique on the {side} side"):
        campaign.merge_one_to_one(left, right).collect()


def test_merge_keeps_every_left_row(spark):
    left = spark.createDataFrame([(1, 1.0), (2, 2.0)], "msno long, x double")
    right = spark.createDataFrame([(2, 5.0), (3, 6.0)], "msno long, y double")
    assert {tuple(r) for r in campaign.merge_one_to_one(left, right).collect()} == {(1, 1.0, None), (2, 2.0, 5.0)}


def test_merge_checks_cost_no_extra_shuffle(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        left = spark.createDataFrame([(1, 1.0)], "msno long, x double")
        right = spark.createDataFrame([(1, 1.0)], "msno long, y double")
        plan = campaign.merge_one_to_one(left, right)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange hashpartitioning") == 2


def test_value_proxy_falls_back(spark):
    rows = spark.createDataFrame(
        [(7, 3.0), (None, 3.0), (None, None)], "latest_amount_paid long, average_amount_paid double"
    )
    assert [r[0] for r in rows.select(campaign.monthly_value_proxy()).collect()] == [7.0, 3.0, 0.0]
    assert [r[0] for r in rows.select(campaign.monthly_value_proxy(0.5)).collect()] == [3.5, 1.5, 0.0]


def test_both_campaign_paths_agree_on_plateaus(spark):
    """Scenario and spend grid use one total order, so equal capacities retain equal value."""
    rows = [(i, i % 5 == 0, 0.5 if i < 60 else 0.1, float(i % 17)) for i in range(100)]
    valued = spark.createDataFrame(
        [(i, int(y), r, v) for i, y, r, v in rows], "msno long, is_churn int, risk double, monthly_value_proxy double"
    )
    targets = campaign.target_totals(valued, [5.0, 10.0])
    scenario = {
        r["campaign_capacity_percent"]: r["scenario_net_value"]
        for r in campaign.scenario_table(targets, [0.1], 30.0, 6).collect()
    }
    for row in campaign.spend_grid(targets, CONFIG).collect():
        assert row["scenario_net_value"] == pytest.approx(scenario[row["capacity_percent"]])
    listed = campaign.priority_list(valued, 10.0)
    assert "is_churn" not in listed.columns
    assert [r["msno"] for r in listed.orderBy("risk_rank").collect()] == list(range(10))


def test_campaign_curve_marks_the_recommendation(spark):
    grid = campaign.spend_grid(published_targets(spark), CONFIG)
    curve = feeds.campaign_curve(grid, campaign.recommendation(grid, CONFIG["capacity_grid_percent"])).collect()
    assert [r["capacity_percent"] for r in curve if r["recommended"]] == [5.0]
    assert max(r["share_of_best_net_value"] for r in curve) == 1.0
    empty = feeds.campaign_curve(grid, grid.filter(F.lit(False))).collect()
    assert not any(r["recommended"] for r in empty)


def test_nothing_affordable_is_no_violation(spark):
    grid = spark.createDataFrame([(5.0, 100.0, 10.0, False)], "capacity_percent double, campaign_spend double, scenario_net_value double, within_budget boolean")
    none = quality.recommendation_contracts(grid, grid.limit(0), 50.0, [5.0])
    assert {r["violations"] for r in none.collect()} == {0}
    wrong = {r["rule"]: r["violations"] for r in quality.recommendation_contracts(grid, grid, 50.0, [5.0]).collect()}
    assert wrong["recommendation_single"] == 1 and wrong["recommendation_affordable"] == 1
