"""The same results in plain SQL, written independently of the operators.

Each statement is a chain of CTEs over the star-schema tables. Where an operator folds several
steps into one pass, the SQL here takes the long way: separate aggregates, row numbers, joins.
"""

from __future__ import annotations

from keepwell.operators.metrics import BASELINE_RECORD, CALIBRATION_RECORD, TOURNAMENT_RECORD
from keepwell.operators.champion import SELECTION_RULE
from keepwell.sources import fixtures

CUTOFF = "DATE '1997-12-31'"

INT_FEATURES = [
    "transaction_count_to_cutoff",
    "payment_method_count",
    "plan_type_count",
    "total_amount_paid",
    "total_list_price",
    "cancellation_count",
    "days_since_first_transaction",
    "days_since_last_transaction",
    "total_discount_amount",
    "transaction_count_last_31_days",
    "amount_paid_last_31_days",
    "cancellations_last_31_days",
    "transaction_count_last_90_days",
    "latest_list_price",
    "latest_amount_paid",
    "latest_is_auto_renew",
    "latest_is_cancel",
    "age_clean",
    "age_unknown_flag",
    "has_transaction_history_flag",
    "has_member_profile_flag",
    "days_since_registration",
]
DOUBLE_FEATURES = ["average_amount_paid", "auto_renew_rate", "cancellation_rate", "discount_rate"]
NUMERIC = [*INT_FEATURES, *DOUBLE_FEATURES]
# Numeric features that some training customer lacks.
GAPPY = [
    "total_list_price",
    "days_since_first_transaction",
    "days_since_last_transaction",
    "total_discount_amount",
    "latest_list_price",
    "latest_amount_paid",
    "latest_is_auto_renew",
    "latest_is_cancel",
    "age_clean",
    "days_since_registration",
    *DOUBLE_FEATURES,
]
CATEGORY_SOURCES = {
    "city_category": "city",
    "gender_category": "gender_clean",
    "registration_channel_category": "registered_via",
    "latest_payment_method_category": "latest_payment_method_id",
    "latest_plan_days_category": "latest_plan_days",
}
LATEST_SOURCES = {
    "latest_payment_method_id": "payment_method_id",
    "latest_plan_days": "payment_plan_days",
    "latest_list_price": "plan_list_price",
    "latest_amount_paid": "actual_amount_paid",
    "latest_is_auto_renew": "is_auto_renew",
    "latest_is_cancel": "is_cancel",
}


def _r(expr: str, name: str | None = None) -> str:
    return f"ROUND({expr}, 6) AS {name or expr}"


def _join(parts, sep=",\n    ") -> str:
    return sep.join(parts)


def _draw(seed: str, offset: int = 1) -> str:
    return f"('0x'||substr(md5(concat({seed},CAST(msno AS VARCHAR))),{offset},8))::BIGINT"


def _bucket(seed: str, offset: int = 1) -> str:
    return f"{_draw(seed, offset)} % 10000"


def _date(col: str) -> str:
    return (
        f"CASE WHEN length(CAST({col} AS VARCHAR)) = 8 "
        f"THEN CAST(try_strptime(CAST({col} AS VARCHAR), '%Y%m%d') AS DATE) END"
    )


_SEEDS = _join([f"('{model}', '{seed}')" for model, seed in fixtures.MODEL_SEEDS.items()], ", ")
_RISK = (
    "CAST(floor((CASE WHEN is_churn = 1 THEN greatest(b1, b2) ELSE least(b1, b2) END) / 250.0) AS DOUBLE) / 40"
)

CTES: dict[str, tuple[tuple[str, ...], str]] = {
    "transactions": ((), fixtures.TRANSACTIONS_SQL),
    "members": ((), fixtures.MEMBERS_SQL),
    "labels_churn": ((), fixtures.LABELS_SQL),
    "parsed": (
        ("transactions",),
        f"SELECT *, {_date('transaction_date')} AS d, {_date('membership_expire_date')} AS e FROM transactions",
    ),
    "history": (("parsed",), f"SELECT * FROM parsed WHERE d <= {CUTOFF}"),
    "overall": (
        ("history",),
        f"""
SELECT msno, COUNT(*) AS transaction_count_to_cutoff,
    MIN(d) AS first_transaction_date, MAX(d) AS last_transaction_date,
    COUNT(DISTINCT COALESCE(payment_method_id, -1)) AS payment_method_count,
    COUNT(DISTINCT COALESCE(payment_plan_days, -1)) AS plan_type_count,
    CAST(SUM(actual_amount_paid) AS BIGINT) AS total_amount_paid,
    AVG(actual_amount_paid) AS average_amount_paid,
    CAST(SUM(plan_list_price) AS BIGINT) AS total_list_price,
    AVG(is_auto_renew) AS auto_renew_rate,
    CAST(SUM(is_cancel) AS BIGINT) AS cancellation_count,
    AVG(is_cancel) AS cancellation_rate,
    CAST({CUTOFF} - MIN(d) AS INT) AS days_since_first_transaction,
    CAST({CUTOFF} - MAX(d) AS INT) AS days_since_last_transaction,
    CAST(SUM(plan_list_price) - SUM(actual_amount_paid) AS BIGINT) AS total_discount_amount,
    CASE WHEN SUM(plan_list_price) > 0
         THEN CAST(SUM(plan_list_price) - SUM(actual_amount_paid) AS DOUBLE) / CAST(SUM(plan_list_price) AS DOUBLE)
    END AS discount_rate
FROM history GROUP BY msno""",
    ),
    "month": (
        ("history",),
        """
SELECT msno, COUNT(*) AS transaction_count_last_31_days,
    CAST(SUM(actual_amount_paid) AS BIGINT) AS amount_paid_last_31_days,
    CAST(SUM(is_cancel) AS BIGINT) AS cancellations_last_31_days
FROM history WHERE d >= DATE '1997-12-01' GROUP BY msno""",
    ),
    "quarter": (
        ("history",),
        """
SELECT msno, COUNT(*) AS transaction_count_last_90_days
FROM history WHERE d >= DATE '1997-10-03' GROUP BY msno""",
    ),
    "latest": (
        ("history",),
        f"""
SELECT msno, {_join([f'{source} AS {name}' for name, source in LATEST_SOURCES.items()], ', ')}
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY msno ORDER BY d DESC, is_cancel DESC NULLS LAST,
    e DESC NULLS LAST, {_join([f'{source} DESC NULLS LAST' for source in LATEST_SOURCES.values()], ', ')}) AS rn
    FROM history)
WHERE rn = 1""",
    ),
    "validated": (
        ("members",),
        f"""
SELECT *, {_date('registration_init_time')} AS registration_date,
    CASE WHEN bd >= 10 AND bd <= 100 THEN bd END AS age_clean,
    CAST(CASE WHEN bd IS NULL THEN NULL WHEN bd < 10 OR bd > 100 THEN 1 ELSE 0 END AS TINYINT) AS age_unknown_flag,
    COALESCE(gender, 'unknown') AS gender_clean
FROM members""",
    ),
    "profile": (
        ("validated",),
        f"""
SELECT m.msno, k.city, k.age_clean, k.age_unknown_flag, k.gender_clean, k.registered_via, k.registration_date
FROM validated m LEFT JOIN (SELECT * FROM validated WHERE registration_date <= {CUTOFF}) k ON k.msno = m.msno""",
    ),
    "snapshot": (
        ("labels_churn", "overall", "month", "quarter", "latest", "profile"),
        f"""
SELECT l.msno, l.is_churn,
    COALESCE(o.transaction_count_to_cutoff, 0) AS transaction_count_to_cutoff,
    o.first_transaction_date, o.last_transaction_date,
    COALESCE(o.payment_method_count, 0) AS payment_method_count,
    COALESCE(o.plan_type_count, 0) AS plan_type_count,
    COALESCE(o.total_amount_paid, 0) AS total_amount_paid,
    o.average_amount_paid, o.total_list_price, o.auto_renew_rate,
    COALESCE(o.cancellation_count, 0) AS cancellation_count,
    o.cancellation_rate, o.days_since_first_transaction, o.days_since_last_transaction,
    o.total_discount_amount, o.discount_rate,
    COALESCE(m.transaction_count_last_31_days, 0) AS transaction_count_last_31_days,
    COALESCE(m.amount_paid_last_31_days, 0) AS amount_paid_last_31_days,
    COALESCE(m.cancellations_last_31_days, 0) AS cancellations_last_31_days,
    COALESCE(q.transaction_count_last_90_days, 0) AS transaction_count_last_90_days,
    t.latest_payment_method_id, t.latest_plan_days, t.latest_list_price, t.latest_amount_paid,
    t.latest_is_auto_renew, t.latest_is_cancel,
    p.city, p.age_clean, p.age_unknown_flag, p.gender_clean, p.registered_via, p.registration_date,
    CAST(o.msno IS NOT NULL AS TINYINT) AS has_transaction_history_flag,
    CAST(p.city IS NOT NULL AS TINYINT) AS has_member_profile_flag,
    CAST({CUTOFF} - p.registration_date AS INT) AS days_since_registration
FROM labels_churn l
LEFT JOIN overall o ON o.msno = l.msno
LEFT JOIN month m ON m.msno = l.msno
LEFT JOIN quarter q ON q.msno = l.msno
LEFT JOIN latest t ON t.msno = l.msno
LEFT JOIN profile p ON p.msno = l.msno""",
    ),
    "inputs": (
        ("snapshot",),
        f"""
SELECT msno, is_churn, {_join([c for c in NUMERIC if c != 'age_unknown_flag'], ', ')},
    CAST(COALESCE(age_unknown_flag, 1) AS TINYINT) AS age_unknown_flag,
    {_join([f"COALESCE(CAST({source} AS VARCHAR), 'unknown') AS {name}" for name, source in CATEGORY_SOURCES.items()])}
FROM snapshot""",
    ),
    "scored": (
        ("labels_churn",),
        f"""
SELECT msno, is_churn, {_RISK} AS risk
FROM (SELECT msno, is_churn, {_bucket("'42|'")} AS b1, {_bucket("'42|'", 9)} AS b2 FROM labels_churn)""",
    ),
    "scored_models": (
        ("labels_churn",),
        f"""
SELECT model, msno, is_churn, {_RISK} AS risk
FROM (SELECT model, msno, is_churn, {_bucket('seed')} AS b1, {_bucket('seed', 9)} AS b2
      FROM labels_churn, (VALUES {_SEEDS}) seeds(model, seed))""",
    ),
    # Mid-ranks for AUC, row numbers for the contact order.
    "placed_models": (
        ("scored_models",),
        """
SELECT *, COUNT(*) OVER (PARTITION BY model) AS n, SUM(is_churn) OVER (PARTITION BY model) AS p,
    RANK() OVER (PARTITION BY model ORDER BY risk)
      + (COUNT(*) OVER (PARTITION BY model, risk) - 1) / 2.0 AS midrank,
    ROW_NUMBER() OVER (PARTITION BY model ORDER BY risk DESC, msno) AS place,
    COUNT(*) OVER (PARTITION BY model ORDER BY risk DESC) AS contacted,
    SUM(is_churn) OVER (PARTITION BY model ORDER BY risk DESC) AS caught
FROM scored_models""",
    ),
    "measured": (
        ("placed_models",),
        """
SELECT model, COUNT(*) AS test_customers, CAST(SUM(is_churn) AS DOUBLE) / COUNT(*) AS base_churn_rate,
    AVG(CASE WHEN (risk >= 0.5) = (is_churn = 1) THEN 1.0 ELSE 0.0 END) AS accuracy_at_50_percent_risk,
    COALESCE(AVG(is_churn) FILTER (WHERE risk >= 0.5), 0) AS precision_at_50_percent_risk,
    COALESCE(AVG(CASE WHEN risk >= 0.5 THEN 1.0 ELSE 0.0 END) FILTER (WHERE is_churn = 1), 0)
      AS recall_at_50_percent_risk,
    (SUM(midrank) FILTER (WHERE is_churn = 1) - SUM(is_churn) * (SUM(is_churn) + 1) / 2.0)
      / (CAST(SUM(is_churn) AS DOUBLE) * (COUNT(*) - SUM(is_churn))) AS roc_auc,
    AVG(CAST(caught AS DOUBLE) / contacted) FILTER (WHERE is_churn = 1) AS average_precision,
    AVG((risk - is_churn) * (risk - is_churn)) AS brier_score,
    AVG(is_churn) FILTER (WHERE place <= ceil(n * 10 / 100.0)) AS top_10_percent_actual_churn,
    AVG(is_churn) FILTER (WHERE place <= ceil(n * 10 / 100.0)) / AVG(is_churn) AS lift_at_top_10_percent
FROM placed_models GROUP BY model""",
    ),
    "measured_one": (
        ("measured",),
        "SELECT * FROM measured WHERE model = 'boosted_ordinal_isotonic_calibrated'",
    ),
    "winner": (
        ("measured",),
        """
SELECT * FROM measured
ORDER BY lift_at_top_10_percent DESC, brier_score, average_precision DESC, roc_auc DESC, model LIMIT 1""",
    ),
    "roles": (
        ("inputs",),
        f"""
SELECT *, CASE WHEN b < 2000 THEN 'test' WHEN b < 8000 THEN 'train' ELSE 'calibration' END AS role
FROM (SELECT *, {_bucket("'split-42|'")} AS b FROM inputs)""",
    ),
    "train": (("roles",), "SELECT * FROM roles WHERE role = 'train'"),
    "medians": (("train",), f"SELECT {_join([f'MEDIAN({c}) AS {c}' for c in NUMERIC], ', ')} FROM train"),
    "imputed": (
        ("roles", "medians"),
        f"""
SELECT r.msno, r.role,
    {_join([f'CAST(COALESCE(CAST(r.{c} AS DOUBLE), m.{c}) AS DOUBLE) AS {c}' for c in NUMERIC])},
    {_join([f'CAST(r.{c} IS NULL AS INT) AS missingindicator_{c}' for c in GAPPY])}
FROM roles r, medians m""",
    ),
    "levels": (
        ("train",),
        _join(
            [
                f"""SELECT '{c}' AS category, level, CAST(ROW_NUMBER() OVER (ORDER BY level) - 1 AS INT) AS code
FROM (SELECT DISTINCT {c} AS level FROM train)"""
                for c in CATEGORY_SOURCES
            ],
            "\nUNION ALL ",
        ),
    ),
    "coded": (
        ("roles", "levels"),
        f"""
SELECT r.msno, {_join([f'COALESCE(l{i}.code, -1) AS {c}_code' for i, c in enumerate(CATEGORY_SOURCES)], ', ')}
FROM roles r
{_join([f"LEFT JOIN levels l{i} ON l{i}.category = '{c}' AND l{i}.level = r.{c}" for i, c in enumerate(CATEGORY_SOURCES)], chr(10))}""",
    ),
    "split_label": (
        ("labels_churn",),
        f"""
SELECT msno, is_churn, CASE WHEN {_bucket("'split-42|'")} < 2000 THEN 'test' ELSE 'train' END AS split,
    {_bucket("'split-42|'")} AS b, {_draw("'split-42|'")} AS draw
FROM labels_churn""",
    ),
    "valued": (
        ("scored", "snapshot"),
        """
SELECT s.msno, s.is_churn, s.risk, v.latest_amount_paid, v.average_amount_paid,
    CAST(CASE WHEN v.latest_amount_paid IS NOT NULL THEN v.latest_amount_paid
         WHEN v.average_amount_paid IS NOT NULL THEN v.average_amount_paid ELSE 0 END AS DOUBLE) AS monthly_value_proxy
FROM scored s LEFT JOIN snapshot v ON v.msno = s.msno""",
    ),
    "ranked": (
        ("valued",),
        """
SELECT *, ROW_NUMBER() OVER (ORDER BY risk DESC, msno) AS risk_rank, COUNT(*) OVER () AS n FROM valued""",
    ),
    "budget": (
        ("labels_churn",),
        "SELECT floor(COUNT(*) * 0.15) * 30.0 AS budget FROM labels_churn",
    ),
    "grid_targets": (
        ("ranked",),
        """
SELECT c AS capacity_percent, COUNT(*) AS k, CAST(SUM(CAST(risk AS DECIMAL(18,12))) AS DOUBLE) AS mass,
    SUM(monthly_value_proxy) / COUNT(*) AS value
FROM ranked, (VALUES (1.0::DOUBLE), (2.0), (5.0), (10.0), (15.0), (20.0), (25.0), (30.0)) caps(c)
WHERE risk_rank <= ceil(n * c / 100.0) GROUP BY c""",
    ),
    "options": (
        ("grid_targets", "budget"),
        """
SELECT capacity_percent, k AS customers_targeted, CAST(k * 30.0 AS DOUBLE) AS campaign_spend,
    k * 30.0 <= budget AS within_budget, mass / k AS average_calibrated_risk, mass AS expected_churners,
    10.0::DOUBLE AS assumed_save_rate_percent,
    CASE WHEN mass > 0 AND value > 0 THEN k * 30.0::DOUBLE / (mass * (value * 6)) * 100 END
      AS break_even_save_rate_percent,
    mass * 0.1::DOUBLE AS expected_saved_customers, value * 6 AS value_per_saved_customer,
    mass * 0.1::DOUBLE * (value * 6) AS scenario_retained_value,
    mass * 0.1::DOUBLE * (value * 6) - k * 30.0::DOUBLE AS scenario_net_value,
    (mass * 0.1::DOUBLE * (value * 6) - k * 30.0::DOUBLE) / (k * 30.0::DOUBLE) AS scenario_roi
FROM grid_targets, budget""",
    ),
    "recommended": (
        ("options",),
        "SELECT * FROM options WHERE within_budget ORDER BY scenario_net_value DESC, capacity_percent LIMIT 1",
    ),
}

OPTION_COLUMNS = {
    "capacity_percent": False,
    "customers_targeted": False,
    "campaign_spend": True,
    "within_budget": False,
    "average_calibrated_risk": True,
    "expected_churners": True,
    "assumed_save_rate_percent": True,
    "break_even_save_rate_percent": True,
    "expected_saved_customers": True,
    "value_per_saved_customer": True,
    "scenario_retained_value": True,
    "scenario_net_value": True,
    "scenario_roi": True,
}
OPTIONS = _join([_r(c) if rounded else c for c, rounded in OPTION_COLUMNS.items()], ", ")


def _needed(names: tuple[str, ...], seen: dict[str, str]) -> dict[str, str]:
    for name in names:
        if name not in seen:
            parents, body = CTES[name]
            _needed(parents, seen)
            seen[name] = body
    return seen


def statement(select: str, *names: str) -> str:
    """``select`` over the named CTEs and everything they build on."""
    chain = _needed(names, {})
    return "WITH " + ",\n".join(f"{name} AS ({body})" for name, body in chain.items()) + "\n" + select


def _metric_columns(names) -> str:
    plain = {"model", "test_customers"}
    return _join([c if c in plain else _r(c) for c in names], ", ")


def _scenario(rates: str, capacities: str) -> str:
    return f"""
SELECT c AS campaign_capacity_percent, ROUND(r * 100, 6) AS assumed_save_rate_percent, k AS customers_targeted,
    ROUND(mass / k, 6) AS average_calibrated_risk, ROUND(mass, 6) AS expected_churners_from_model,
    ROUND(value, 6) AS average_monthly_value_proxy, 30.0::DOUBLE AS offer_cost_per_customer, 6 AS value_months,
    ROUND(mass * r, 6) AS expected_saved_customers, ROUND(mass * r * value * 6, 6) AS scenario_retained_value,
    CAST(k * 30.0 AS DOUBLE) AS campaign_cost,
    ROUND(mass * r * value * 6 - k * 30.0::DOUBLE, 6) AS scenario_net_value,
    ROUND((mass * r * value * 6 - k * 30.0::DOUBLE) / (k * 30.0::DOUBLE), 6) AS scenario_roi
FROM (SELECT c, COUNT(*) AS k, CAST(SUM(CAST(risk AS DECIMAL(18,12))) AS DOUBLE) AS mass,
          SUM(monthly_value_proxy) / COUNT(*) AS value
      FROM ranked, (VALUES {capacities}) caps(c) WHERE risk_rank <= ceil(n * c / 100.0) GROUP BY c),
     (VALUES {rates}) save(r)"""


# Segment bands as (from, to, label) rows; a missing match means no history.
RECENCY_BANDS = [
    (0, 7, "0-7 days since payment"),
    (8, 30, "8-30 days since payment"),
    (31, 90, "31-90 days since payment"),
    (91, 999999, "over 90 days since payment"),
]
FREQUENCY_BANDS = [
    (1, 3, "1-3 payments"),
    (4, 10, "4-10 payments"),
    (11, 25, "11-25 payments"),
    (26, 999999, "26+ payments"),
]
RENEWAL_BANDS = [(0, 0, "0"), (1, 1, "1")]


def _banded(column: str, bands: list[tuple[int, int, str]], missing: str, driver: str = "") -> str:
    """Customers per band, by a range join with the band rows."""
    rows = _join([f"({low}, {high}, '{label}')" for low, high, label in bands], ", ")
    first = f"'{driver}' AS driver, " if driver else ""
    return f"""
SELECT {first}COALESCE(b.label, '{missing}') AS segment, COUNT(*) AS customers,
    ROUND(100.0 * SUM(s.is_churn) / COUNT(*), 2) AS churn_percent
FROM snapshot s LEFT JOIN (VALUES {rows}) b(low, high, label) ON s.{column} BETWEEN b.low AND b.high
GROUP BY COALESCE(b.label, '{missing}')"""


def _segment(name: str, column: str, bands: list[tuple[int, int, str]], missing: str) -> str:
    return statement(
        f"SELECT segment AS {name}, customers, churn_percent FROM ({_banded(column, bands, missing)})", "snapshot"
    )


DRIVERS = {
    "churn_by_latest_auto_renewal": ("latest_is_auto_renew", RENEWAL_BANDS, "no_history"),
    "churn_by_payment_recency": ("days_since_last_transaction", RECENCY_BANDS, "no safe payment history"),
    "churn_by_transaction_frequency": ("transaction_count_to_cutoff", FREQUENCY_BANDS, "no safe payment history"),
}

SNAPSHOT_SELECT = (
    "SELECT * REPLACE (ROUND(average_amount_paid, 6) AS average_amount_paid, ROUND(auto_renew_rate, 6) AS "
    "auto_renew_rate, ROUND(cancellation_rate, 6) AS cancellation_rate, ROUND(discount_rate, 6) AS discount_rate) "
)
FRIENDLY = {
    "boosted_ordinal_isotonic_calibrated": "Calibrated boosted trees, ordinal",
    "boosted_nominal_deep_isotonic_calibrated": "Calibrated boosted trees, deep",
    "boosted_nominal_isotonic_calibrated": "Calibrated boosted trees, nominal",
}
MODEL_NAME = "CASE model " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in FRIENDLY.items()) + " ELSE model END"


def _largest_remainder(size: str, strata: str = "") -> str:
    """Class quotas of ``size`` rows: whole shares, then the largest fractions."""
    over = f"PARTITION BY {strata}" if strata else ""
    keys = f"{strata}, is_churn" if strata else "is_churn"
    return f"""
SELECT {keys}, whole + CASE WHEN ROW_NUMBER() OVER ({over} ORDER BY frac DESC, is_churn) <= m - SUM(whole) OVER ({over})
    THEN 1 ELSE 0 END AS quota
FROM (SELECT *, CAST(floor(c * m / CAST(t AS DOUBLE)) AS BIGINT) AS whole, (c * m) % t AS frac
      FROM (SELECT *, CAST(least({size}, t) AS BIGINT) AS m
            FROM (SELECT *, CAST(SUM(c) OVER ({over}) AS BIGINT) AS t FROM counted)))"""


PREDICTIONS = statement(
    f"""SELECT msno, is_churn, {_join([
        f"MAX(CASE WHEN s.model = '{m}' THEN ROUND(risk, 6) END) AS "
        f"{m.removesuffix('_isotonic_calibrated')}_calibrated_probability" for m in fixtures.MODEL_SEEDS])},
    MAX(CASE WHEN s.model = (SELECT model FROM winner) THEN ROUND(risk, 6) END) AS champion_calibrated_probability
FROM scored_models s GROUP BY msno, is_churn""",
    "scored_models",
    "winner",
)

# The model input's columns and types, in order.
INPUT_TYPES = {
    "msno": "bigint",
    "is_churn": "int",
    "transaction_count_to_cutoff": "bigint",
    "payment_method_count": "bigint",
    "plan_type_count": "bigint",
    "total_amount_paid": "bigint",
    "average_amount_paid": "double",
    "total_list_price": "bigint",
    "auto_renew_rate": "double",
    "cancellation_count": "bigint",
    "cancellation_rate": "double",
    "days_since_first_transaction": "int",
    "days_since_last_transaction": "int",
    "total_discount_amount": "bigint",
    "discount_rate": "double",
    "transaction_count_last_31_days": "bigint",
    "amount_paid_last_31_days": "bigint",
    "cancellations_last_31_days": "bigint",
    "transaction_count_last_90_days": "bigint",
    "latest_list_price": "bigint",
    "latest_amount_paid": "bigint",
    "latest_is_auto_renew": "int",
    "latest_is_cancel": "int",
    "age_clean": "int",
    "age_unknown_flag": "tinyint",
    "has_transaction_history_flag": "tinyint",
    "has_member_profile_flag": "tinyint",
    "days_since_registration": "int",
    **{name: "string" for name in CATEGORY_SOURCES},
}

ORACLES: dict[str, str] = {
    # scans and sinks
    "source_csv": statement("SELECT * FROM transactions", "transactions"),
    "source_parquet_projection": statement(
        f"SELECT msno, latest_amount_paid, {_r('average_amount_paid')} FROM inputs", "inputs"
    ),
    "source_parquet_view": statement(
        """SELECT plan_type_count, COUNT(*) AS customers, CAST(SUM(is_churn) AS BIGINT) AS churned,
    MAX(total_amount_paid) AS highest_total
FROM snapshot GROUP BY ALL""",
        "snapshot",
    ),
    "source_json_config": statement(
        """SELECT 10.0::DOUBLE AS campaign_capacity_percent, 30.0::DOUBLE AS offer_cost_per_customer,
    0.1::DOUBLE AS assumed_save_rate, 6 AS value_months, 'dataset currency units' AS monetary_unit_label,
    1.0::DOUBLE AS value_proxy_multiplier, CAST(budget AS DOUBLE) AS maximum_campaign_budget, c AS capacity_percent
FROM budget, (VALUES (1.0::DOUBLE), (2.0), (5.0), (10.0), (15.0), (20.0), (25.0), (30.0)) caps(c)""",
        "budget",
    ),
    "sink_parquet_roundtrip": statement(SNAPSHOT_SELECT + "FROM snapshot", "snapshot"),
    "sink_csv_roundtrip": _segment("recency_segment", *DRIVERS["churn_by_payment_recency"]),
    "champion_record_json": statement(
        f"""SELECT model AS selected_model, '{SELECTION_RULE}' AS selection_rule, test_customers, {_r('roc_auc')}
FROM winner""",
        "winner",
    ),
    "rewrite_in_place": PREDICTIONS,
    "schema_report": statement(
        f"""SELECT position, column_name, column_type, (SELECT COUNT(*) FROM inputs) AS row_count
FROM (VALUES {_join([f"({i}, '{name}', '{kind}')" for i, (name, kind) in enumerate(INPUT_TYPES.items(), 1)], ', ')})
  t(position, column_name, column_type)""",
        "inputs",
    ),
    "model_save_load": statement(
        "SELECT COUNT(*) AS customers, 0::BIGINT AS scored_otherwise FROM split_label WHERE split = 'test'",
        "split_label",
    ),
    # point-in-time features
    "parse_compact_date": statement(
        f"""SELECT transaction_date, d AS transaction_date_parsed, COUNT(*) AS transactions,
    {_date('(transaction_date + 1)')} AS next_day_parsed
FROM parsed GROUP BY transaction_date, d""",
        "parsed",
    ),
    "history_as_of": statement(
        """SELECT * EXCLUDE (transaction_date, membership_expire_date, d, e),
    d AS transaction_date_parsed, e AS membership_expire_date_parsed FROM history""",
        "history",
    ),
    "member_profile_as_of": statement("SELECT * FROM profile", "profile"),
    "age_validation": statement("SELECT msno, bd, age_clean, age_unknown_flag FROM validated", "validated"),
    "presence_flags": statement(
        "SELECT msno, has_transaction_history_flag, has_member_profile_flag FROM snapshot", "snapshot"
    ),
    "recency_tenure_days": statement(
        """SELECT msno, days_since_first_transaction, days_since_last_transaction, days_since_registration
FROM snapshot""",
        "snapshot",
    ),
    "discount_features": statement(
        f"""SELECT msno, total_list_price, total_amount_paid, total_discount_amount, {_r('discount_rate')}
FROM snapshot""",
        "snapshot",
    ),
    "tx_features_overall": statement(SNAPSHOT_SELECT + "FROM overall", "overall"),
    "distinct_count_null_aware": statement(
        "SELECT msno, payment_method_count, plan_type_count FROM overall", "overall"
    ),
    "tx_features_31d": statement(
        """SELECT o.msno, COALESCE(transaction_count_last_31_days, 0) AS transaction_count_last_31_days,
    COALESCE(amount_paid_last_31_days, 0) AS amount_paid_last_31_days,
    COALESCE(cancellations_last_31_days, 0) AS cancellations_last_31_days
FROM overall o LEFT JOIN month m ON m.msno = o.msno""",
        "overall",
        "month",
    ),
    "tx_features_90d": statement(
        """SELECT o.msno, COALESCE(transaction_count_last_90_days, 0) AS transaction_count_last_90_days
FROM overall o LEFT JOIN quarter q ON q.msno = o.msno""",
        "overall",
        "quarter",
    ),
    "tx_features_latest": statement("SELECT * FROM latest", "latest"),
    "customer_snapshot": statement(SNAPSHOT_SELECT + "FROM snapshot", "snapshot"),
    "snapshot_summary": statement(
        """SELECT COUNT(*) AS customers, COUNT(DISTINCT msno) AS unique_customers,
    CAST(SUM(has_transaction_history_flag) AS BIGINT) AS customers_with_safe_history,
    CAST(SUM(has_member_profile_flag) AS BIGINT) AS customers_with_profile,
    ROUND(AVG(is_churn), 6) AS churn_rate FROM snapshot""",
        "snapshot",
    ),
    # segments
    "churn_by_latest_auto_renewal": _segment("latest_auto_renewal", *DRIVERS["churn_by_latest_auto_renewal"]),
    "churn_by_payment_recency": _segment("recency_segment", *DRIVERS["churn_by_payment_recency"]),
    "churn_by_transaction_frequency": _segment(
        "payment_frequency_segment", *DRIVERS["churn_by_transaction_frequency"]
    ),
    "churn_by_profile_availability": statement(
        """SELECT CAST(h AS TINYINT) AS has_transaction_history_flag, CAST(p AS TINYINT) AS has_member_profile_flag,
    COUNT(*) AS customers, ROUND(100.0 * SUM(is_churn) / COUNT(*), 2) AS churn_percent
FROM (SELECT is_churn, transaction_count_to_cutoff > 0 AS h, city IS NOT NULL AS p FROM snapshot)
GROUP BY h, p""",
        "snapshot",
    ),
    # model input, splits, preparation
    "model_input": statement(SNAPSHOT_SELECT + "FROM inputs", "inputs"),
    "category_domain": statement(
        _join([f"SELECT '{c}' AS category, {c} AS level FROM inputs" for c in CATEGORY_SOURCES], "\nUNION "),
        "inputs",
    ),
    "stratified_split": statement("SELECT msno, is_churn, split FROM split_label", "split_label"),
    "stratified_split_exact": statement(
        f""", counted AS (SELECT is_churn, COUNT(*) AS c FROM split_label GROUP BY 1),
quotas AS ({_largest_remainder("ceil(t * 0.2::DOUBLE)")})
SELECT s.msno, s.is_churn, CASE WHEN rn <= quota THEN 'test' ELSE 'train' END AS split
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY is_churn ORDER BY b, draw, msno) AS rn FROM split_label) s
JOIN quotas q ON q.is_churn = s.is_churn""",
        "split_label",
    ).replace("\n, counted", ",\ncounted"),
    "train_sample_cap": statement(
        f""", pool AS (SELECT * FROM split_label WHERE split = 'train'),
counted AS (SELECT is_churn, COUNT(*) AS c FROM pool GROUP BY 1),
quotas AS ({_largest_remainder("500")})
SELECT s.msno, s.is_churn, s.split
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY is_churn ORDER BY b, draw, msno) AS rn FROM pool) s
JOIN quotas q ON q.is_churn = s.is_churn WHERE rn <= quota""",
        "split_label",
    ).replace("\n, pool", ",\npool"),
    "split_roles": statement(
        f""", ranged AS (SELECT msno, is_churn, b, draw,
    CASE WHEN b < 2000 THEN 'test' WHEN b < 8000 THEN 'train' ELSE 'calibration' END AS role FROM split_label),
counted AS (SELECT role, is_churn, COUNT(*) AS c FROM ranged GROUP BY 1, 2),
quotas AS ({_largest_remainder("CASE role WHEN 'train' THEN 700 WHEN 'calibration' THEN 200 ELSE t END", "role")})
SELECT s.msno, s.is_churn, CASE WHEN rn <= quota THEN s.role ELSE 'unused' END AS role
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY role, is_churn ORDER BY b, draw, msno) AS rn FROM ranged) s
JOIN quotas q ON q.role = s.role AND q.is_churn = s.is_churn""",
        "split_label",
    ).replace("\n, ranged", ",\nranged"),
    "target_statistics": statement(
        f""", placed AS (SELECT *, {_draw("'statistics'")} AS draw, CASE WHEN role = 'train' THEN is_churn END AS y
FROM roles WHERE role <> 'unused'),
prior AS (SELECT AVG(y) AS p FROM placed)
SELECT msno, role, {_join([_r(f"""CASE WHEN role = 'train'
    THEN (COALESCE(SUM(y) OVER before_{i}, 0) + p) / (COUNT(y) OVER before_{i} + 1)
    ELSE (COALESCE(SUM(y) OVER whole_{i}, 0) + p) / (COUNT(y) OVER whole_{i} + 1) END""", c + "_stat") for i, c in enumerate(CATEGORY_SOURCES)], ", ")}
FROM placed, prior
WINDOW {_join([f"before_{i} AS (PARTITION BY {c} ORDER BY draw, msno ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), whole_{i} AS (PARTITION BY {c})" for i, c in enumerate(CATEGORY_SOURCES)], ", ")}""",
        "roles",
    ).replace("\n, placed", ",\nplaced"),
    "tournament_contracts": statement(
        """SELECT m AS model, COUNT(*) AS test_rows, COUNT(DISTINCT msno) AS test_customers, CAST(0 AS BIGINT) AS without_score,
    CAST(0 AS BIGINT) AS outside, CAST(0 AS BIGINT) AS importances_off
FROM split_label, (VALUES ('boosted_ordinal'), ('boosted_nominal_deep'), ('boosted_nominal')) AS v(m)
WHERE split = 'test' GROUP BY 1""",
        "split_label",
    ),
    "class_weights": statement(
        """SELECT is_churn, c AS customers, ROUND(SUM(c) OVER () / (2.0::DOUBLE * c), 6) AS balanced_weight,
    ROUND(CASE WHEN is_churn = 1 THEN CAST(SUM(CASE WHEN is_churn = 0 THEN c END) OVER () AS DOUBLE) / c
          ELSE 1.0 END, 6) AS boost_weight
FROM (SELECT is_churn, COUNT(*) AS c FROM split_label WHERE split = 'train' GROUP BY 1)""",
        "split_label",
    ),
    "class_ratio": statement(
        """SELECT COUNT(*) FILTER (WHERE is_churn = 0) AS negatives, COUNT(*) FILTER (WHERE is_churn = 1) AS positives,
    ROUND(CAST(COUNT(*) FILTER (WHERE is_churn = 0) AS DOUBLE) / COUNT(*) FILTER (WHERE is_churn = 1), 6)
      AS negative_to_positive_ratio
FROM split_label WHERE split = 'train'""",
        "split_label",
    ),
    "split_alignment_violations": statement(
        f""", stored AS (SELECT msno FROM labels_churn WHERE {_bucket("'split-43|'")} < 2000),
test AS (SELECT msno FROM split_label WHERE split = 'test')
SELECT msno, 'prediction without test row' AS violation FROM (SELECT * FROM stored EXCEPT SELECT * FROM test)
UNION ALL
SELECT msno, 'test row without prediction' AS violation FROM (SELECT * FROM test EXCEPT SELECT * FROM stored)""",
        "split_label",
    ).replace("\n, stored", ",\nstored"),
    "numeric_medians": statement(
        _join(
            [
                f"SELECT '{c}' AS feature, ROUND(CAST(MEDIAN({c}) AS DOUBLE), 6) AS median, "
                f"COUNT(*) - COUNT({c}) AS missing FROM train"
                for c in NUMERIC
            ],
            "\nUNION ALL ",
        ),
        "train",
    ),
    "imputed_features": statement(
        f"""SELECT msno, {_join([_r(c) for c in NUMERIC], ', ')},
    {_join([f'missingindicator_{c}' for c in GAPPY], ', ')} FROM imputed""",
        "imputed",
    ),
    "scaled_features": statement(
        f""", moments AS (SELECT {_join([
            f'AVG({c}) AS avg_{c}, STDDEV_POP({c}) AS dev_{c}'
            for c in [*NUMERIC, *[f'missingindicator_{g}' for g in GAPPY]]], ', ')}
    FROM imputed WHERE role = 'train')
SELECT msno, {_join([
            f'ROUND(({c} - avg_{c}) / CASE WHEN dev_{c} = 0 THEN 1 ELSE dev_{c} END, 6) AS {c}'
            for c in [*NUMERIC, *[f'missingindicator_{g}' for g in GAPPY]]])}
FROM imputed, moments""",
        "imputed",
    ).replace("\n, moments", ",\nmoments"),
    "ordinal_features": statement("SELECT * FROM coded", "coded"),
    "one_hot_features": statement(
        f""", widths AS (SELECT category, COUNT(*) AS w FROM levels GROUP BY 1)
SELECT msno, (SELECT CAST(SUM(w) AS INT) FROM widths) AS width,
    concat_ws(',', {_join([
            f"CASE WHEN {c}_code >= 0 THEN CAST({c}_code" + "".join(
                f" + (SELECT w FROM widths WHERE category = '{prior}')"
                for prior in list(CATEGORY_SOURCES)[:i]) + " AS VARCHAR) END"
            for i, c in enumerate(CATEGORY_SOURCES)])}) AS hot_positions
FROM coded""",
        "coded",
    ).replace("\n, widths", ",\nwidths"),
    # ranking and probability metrics
    "ranking_curve": statement(
        """SELECT DISTINCT risk, COUNT(*) OVER same AS customers, CAST(SUM(is_churn) OVER same AS BIGINT) AS churned,
    CAST(SUM(is_churn) OVER upto AS BIGINT) AS true_positives,
    CAST(SUM(1 - is_churn) OVER upto AS BIGINT) AS false_positives,
    ROUND(AVG(is_churn) OVER upto, 6) AS precision,
    ROUND(CAST(SUM(is_churn) OVER upto AS DOUBLE) / SUM(is_churn) OVER (), 6) AS recall
FROM scored WINDOW same AS (PARTITION BY risk), upto AS (ORDER BY risk DESC)""",
        "scored",
    ),
    "roc_auc": statement(f"SELECT test_customers, {_r('roc_auc')} FROM measured_one", "measured_one"),
    "average_precision": statement(
        f"SELECT test_customers, {_r('average_precision')} FROM measured_one", "measured_one"
    ),
    "brier_score": statement(f"SELECT test_customers, {_r('brier_score')} FROM measured_one", "measured_one"),
    "classification_metrics_at_threshold": statement(
        f"""SELECT test_customers, {_r('accuracy_at_50_percent_risk')}, {_r('precision_at_50_percent_risk')},
    {_r('recall_at_50_percent_risk')} FROM measured_one""",
        "measured_one",
    ),
    "lift_at_top_decile": statement(
        f"""SELECT CAST(ceil(test_customers * 10 / 100.0) AS BIGINT) AS customers_targeted,
    {_r('top_10_percent_actual_churn')}, {_r('lift_at_top_10_percent')} FROM measured_one""",
        "measured_one",
    ),
    "campaign_threshold": statement(
        """SELECT 'top 10 percent of customers by calibrated risk' AS campaign_capacity,
    10.0::DOUBLE AS campaign_capacity_percent, ROUND(MIN(risk), 6) AS calibrated_risk_threshold,
    COUNT(*) AS customers_targeted, ROUND(AVG(is_churn), 6) AS actual_churn_rate_in_targeted_group,
    ROUND((SELECT AVG(is_churn) FROM scored), 6) AS overall_test_churn_rate
FROM ranked WHERE risk_rank <= ceil(n * 10 / 100.0)""",
        "ranked",
    ),
    "model_metrics": statement(
        f"SELECT {_metric_columns([*TOURNAMENT_RECORD, 'base_churn_rate'])} FROM measured", "measured"
    ),
    "baseline_metric_records": statement(
        "SELECT "
        + _join(
            [
                f"{name} AS {shown}" if name in {"model", "test_customers"} else _r(name, shown)
                for name, shown in BASELINE_RECORD.items()
            ],
            ", ",
        )
        + " FROM measured",
        "measured",
    ),
    "calibration_metric_records": statement(f"SELECT {_metric_columns(CALIBRATION_RECORD)} FROM measured", "measured"),
    "calibration_table": statement(
        """SELECT ROUND(lo, 6) AS risk_over, ROUND(hi, 6) AS risk_up_to, COUNT(s.msno) AS customers,
    ROUND(AVG(s.risk), 6) AS average_predicted_risk, ROUND(AVG(s.is_churn), 6) AS actual_churn_rate
FROM (SELECT i * 0.1::DOUBLE AS lo, CASE WHEN i = 9 THEN 1.0::DOUBLE ELSE (i + 1) * 0.1::DOUBLE END AS hi
      FROM range(10) r(i)) b
LEFT JOIN scored s ON (s.risk > lo OR (lo = 0 AND s.risk = 0)) AND s.risk <= hi
GROUP BY lo, hi""",
        "scored",
    ),
    # isotonic: min-max formula on the calibration role, linear in between, clipped outside
    "isotonic_calibration": statement(
        f""", drawn AS (SELECT *, {_bucket("'split-42|'")} AS b FROM scored),
pooled AS (SELECT risk, SUM(is_churn) AS y, COUNT(*) AS w, ROW_NUMBER() OVER (ORDER BY risk) AS i
    FROM drawn WHERE b >= 8000 GROUP BY risk),
means AS (SELECT j.i AS j, k.i AS k, CAST(SUM(m.y) AS DOUBLE) / SUM(m.w) AS mean
    FROM pooled j JOIN pooled k ON j.i <= k.i JOIN pooled m ON m.i BETWEEN j.i AND k.i GROUP BY 1, 2),
lower AS (SELECT i.i, a.j, MIN(a.mean) AS low FROM pooled i JOIN means a ON a.j <= i.i AND a.k >= i.i GROUP BY 1, 2),
fitted AS (SELECT p.i, p.risk, MAX(l.low) AS f FROM pooled p JOIN lower l ON l.i = p.i GROUP BY 1, 2),
levels AS (SELECT DISTINCT risk FROM drawn WHERE b < 2000),
around AS (SELECT t.risk, (SELECT MAX(f.risk) FROM fitted f WHERE f.risk <= t.risk) AS lo,
    (SELECT MIN(f.risk) FROM fitted f WHERE f.risk >= t.risk) AS hi FROM levels t),
mapped AS (SELECT a.risk, CASE WHEN a.lo IS NULL THEN h.f WHEN a.hi IS NULL OR a.lo = a.hi THEN l.f
    ELSE l.f + (h.f - l.f) * (a.risk - a.lo) / (a.hi - a.lo) END AS calibrated
    FROM around a LEFT JOIN fitted l ON l.risk = a.lo LEFT JOIN fitted h ON h.risk = a.hi)
SELECT d.msno, d.is_churn, ROUND(d.risk, 6) AS risk, ROUND(m.calibrated, 6) AS calibrated
FROM drawn d JOIN mapped m ON m.risk = d.risk WHERE d.b < 2000""",
        "scored",
    ).replace("\n, drawn", ",\ndrawn"),
    # champion
    "champion_selection": statement(f"SELECT {_metric_columns(TOURNAMENT_RECORD)} FROM winner", "winner"),
    "champion_scores": statement(
        "SELECT s.* FROM scored_models s JOIN winner w ON w.model = s.model", "scored_models", "winner"
    ),
    "tournament_predictions": PREDICTIONS,
    # campaign
    "scored_with_value": statement(
        f"""SELECT msno, is_churn, {_r('risk')}, latest_amount_paid, {_r('average_amount_paid')}
FROM valued""",
        "valued",
    ),
    "monthly_value_proxy": statement(f"SELECT msno, {_r('monthly_value_proxy')} FROM valued", "valued"),
    "monthly_value_proxy_scaled": statement(
        "SELECT msno, ROUND(monthly_value_proxy * 0.25::DOUBLE, 6) AS monthly_value_proxy FROM valued", "valued"
    ),
    "campaign_priority_list": statement(
        f"""SELECT msno, {_r('risk')}, latest_amount_paid, {_r('average_amount_paid')}, {_r('monthly_value_proxy')},
    risk_rank, 10.0::DOUBLE AS campaign_capacity_percent
FROM ranked WHERE risk_rank <= ceil(n * 10 / 100.0)""",
        "ranked",
    ),
    "campaign_scenario": statement(_scenario("(0.1::DOUBLE)", "(10.0::DOUBLE)"), "ranked"),
    "campaign_sensitivity": statement(
        _scenario("(0.05::DOUBLE), (0.1), (0.2)", "(5.0::DOUBLE), (10.0), (20.0)"), "ranked"
    ),
    "campaign_spend_grid": statement(f"SELECT {OPTIONS} FROM options", "options"),
    "feasible_capacities": statement(f"SELECT {OPTIONS} FROM options WHERE within_budget", "options"),
    "campaign_recommendation": statement(f"SELECT {OPTIONS} FROM recommended", "recommended"),
    # contracts
    "id_set_difference": statement(
        """SELECT msno, 'left' AS only_in FROM (SELECT msno FROM labels_churn EXCEPT SELECT msno FROM members)
UNION ALL
SELECT msno, 'right' AS only_in FROM (SELECT msno FROM members EXCEPT SELECT msno FROM labels_churn)""",
        "labels_churn",
        "members",
    ),
    "dq_contracts": statement(
        f"""SELECT rule, CAST(violations AS BIGINT) AS violations FROM (
SELECT 'snapshot_one_row_per_customer' AS rule, COUNT(*) - COUNT(DISTINCT msno) AS violations FROM snapshot
UNION ALL SELECT 'label_known', COUNT(*) FILTER (WHERE is_churn IS NULL) FROM snapshot
UNION ALL SELECT 'label_zero_or_one', COUNT(*) FILTER (WHERE is_churn NOT IN (0, 1)) FROM snapshot
UNION ALL SELECT 'no_transaction_after_cutoff', COUNT(*) FILTER (WHERE last_transaction_date > {CUTOFF}) FROM snapshot
UNION ALL SELECT 'base_rate_in_band', CASE WHEN AVG(is_churn) > 0.05 AND AVG(is_churn) < 0.2 THEN 0 ELSE 1 END
    FROM snapshot
UNION ALL SELECT 'model_input_one_row_per_customer', COUNT(*) - COUNT(DISTINCT msno) FROM inputs
UNION ALL SELECT 'model_input_row_count_kept', abs((SELECT COUNT(*) FROM inputs) - (SELECT COUNT(*) FROM snapshot))
UNION ALL SELECT 'model_input_ids_kept',
    (SELECT COUNT(*) FROM (SELECT msno FROM inputs EXCEPT SELECT msno FROM snapshot))
    + (SELECT COUNT(*) FROM (SELECT msno FROM snapshot EXCEPT SELECT msno FROM inputs))
UNION ALL SELECT 'model_input_columns', 0
UNION ALL SELECT 'score_one_row_per_customer', COUNT(*) - COUNT(DISTINCT msno) FROM scored
UNION ALL SELECT 'score_known', COUNT(*) FILTER (WHERE risk IS NULL) FROM scored
UNION ALL SELECT 'score_is_probability', COUNT(*) FILTER (WHERE risk < 0 OR risk > 1) FROM scored
UNION ALL SELECT 'score_distinct_values', CASE WHEN COUNT(DISTINCT risk) >= 30 THEN 0 ELSE 1 END FROM scored
UNION ALL SELECT 'champion_follows_rule', CASE WHEN COUNT(*) = 1 THEN 0 ELSE 1 END FROM winner
UNION ALL SELECT 'recommendation_single', CASE WHEN COUNT(*) = 1 THEN 0 ELSE 1 END FROM recommended
UNION ALL SELECT 'recommendation_affordable', CASE WHEN MAX(campaign_spend) <= (SELECT budget FROM budget) THEN 0 ELSE 1 END
    FROM recommended
UNION ALL SELECT 'recommendation_is_best', CASE WHEN MAX(scenario_net_value) =
    (SELECT MAX(scenario_net_value) FROM options WHERE within_budget) THEN 0 ELSE 1 END FROM recommended
UNION ALL SELECT 'recommendation_on_grid', CASE WHEN MAX(capacity_percent) IN (1, 2, 5, 10, 15, 20, 25, 30)
    THEN 0 ELSE 1 END FROM recommended)""",
        "snapshot",
        "inputs",
        "scored",
        "winner",
        "recommended",
    ),
    "dq_contract_violations": statement(
        f"""SELECT rule, CAST(violations AS BIGINT) AS violations FROM (
WITH marked AS (
    SELECT msno, {_bucket("'spoiled'")} AS b, {_bucket("'label'")} AS l, {_bucket("'lost'")} AS o FROM snapshot
), spoiled AS (
    SELECT s.msno, b, CASE WHEN b < 2000 THEN CASE WHEN l < 5000 THEN 2 END ELSE is_churn END AS is_churn,
        CASE WHEN b >= 2000 AND b < 3000 THEN {CUTOFF} + INTERVAL 5 DAY ELSE last_transaction_date END AS latest
    FROM snapshot s JOIN marked USING (msno)
), snapshots AS (
    SELECT * FROM spoiled UNION ALL SELECT * FROM spoiled WHERE b >= 3000 AND b < 4000
), left_in AS (SELECT msno, b FROM inputs JOIN marked USING (msno) WHERE o >= 1000),
doubled AS (SELECT * FROM left_in UNION ALL SELECT * FROM left_in WHERE b >= 3000 AND b < 3500),
rounded AS (
    SELECT msno, {_bucket("'spoiled'")} AS b,
        CASE WHEN {_bucket("'spoiled'")} >= 6000 AND {_bucket("'spoiled'")} < 9000 THEN NULL ELSE ROUND(risk, 1) END AS r
    FROM scored
), lowered AS (SELECT msno, b, CASE WHEN r < 0.3 THEN r - 1 ELSE r END AS r FROM rounded),
scores AS (SELECT * FROM lowered UNION ALL SELECT * FROM lowered WHERE b < 1000),
dear AS (SELECT * FROM options WHERE NOT within_budget)
SELECT 'snapshot_one_row_per_customer' AS rule, COUNT(*) - COUNT(DISTINCT msno) AS violations FROM snapshots
UNION ALL SELECT 'label_known', COUNT(*) FILTER (WHERE is_churn IS NULL) FROM snapshots
UNION ALL SELECT 'label_zero_or_one', COUNT(*) FILTER (WHERE is_churn NOT IN (0, 1)) FROM snapshots
UNION ALL SELECT 'no_transaction_after_cutoff', COUNT(*) FILTER (WHERE latest > {CUTOFF}) FROM snapshots
UNION ALL SELECT 'base_rate_in_band', CASE WHEN AVG(is_churn) > 0.05 AND AVG(is_churn) < 0.2 THEN 0 ELSE 1 END
    FROM snapshots
UNION ALL SELECT 'model_input_one_row_per_customer', COUNT(*) - COUNT(DISTINCT msno) FROM doubled
UNION ALL SELECT 'model_input_row_count_kept', abs((SELECT COUNT(*) FROM doubled) - (SELECT COUNT(*) FROM snapshot))
UNION ALL SELECT 'model_input_ids_kept', COUNT(*) FROM (SELECT msno FROM snapshot EXCEPT SELECT msno FROM doubled)
UNION ALL SELECT 'model_input_columns', 2
UNION ALL SELECT 'score_one_row_per_customer', COUNT(*) - COUNT(DISTINCT msno) FROM scores
UNION ALL SELECT 'score_known', COUNT(*) FILTER (WHERE r IS NULL) FROM scores
UNION ALL SELECT 'score_is_probability', COUNT(*) FILTER (WHERE r < 0 OR r > 1) FROM scores
UNION ALL SELECT 'score_distinct_values', CASE WHEN COUNT(DISTINCT r) >= 30 THEN 0 ELSE 1 END FROM scores
UNION ALL SELECT 'champion_follows_rule', 1
UNION ALL SELECT 'recommendation_single', CASE WHEN COUNT(*) = 1 THEN 0 ELSE 1 END FROM dear
UNION ALL SELECT 'recommendation_affordable', CASE WHEN MAX(campaign_spend) <= (SELECT budget FROM budget) THEN 0 ELSE 1 END
    FROM dear
UNION ALL SELECT 'recommendation_is_best', CASE WHEN MAX(scenario_net_value) =
    (SELECT MAX(scenario_net_value) FROM options WHERE within_budget) THEN 0 ELSE 1 END FROM dear
UNION ALL SELECT 'recommendation_on_grid', 1)""",
        "snapshot",
        "inputs",
        "scored",
        "options",
    ),
    # feeds
    "kpi_feed": statement(
        f"""SELECT (SELECT COUNT(*) FROM snapshot) AS customers,
    ROUND((SELECT AVG(is_churn) FROM snapshot), 6) AS churn_rate, {MODEL_NAME} AS champion,
    {_r('accuracy_at_50_percent_risk', 'champion_accuracy')},
    {_r('top_10_percent_actual_churn', 'top_10_percent_churn')} FROM winner""",
        "snapshot",
        "winner",
    ),
    "driver_feed_labels": statement(
        f"""SELECT *, CASE segment WHEN '0' THEN 'Auto-renewal is off' WHEN '1' THEN 'Auto-renewal is on'
    WHEN 'no_history' THEN 'No recent payment record'
    WHEN 'no safe payment history' THEN 'No recent payment record' ELSE segment END AS display_label
FROM ({_join([_banded(*parts, driver=name) for name, parts in DRIVERS.items()], chr(10) + "UNION ALL ")})""",
        "snapshot",
    ),
    "model_comparison_feed": statement(
        f"""SELECT {MODEL_NAME} AS model_name, {_r('roc_auc')}, {_r('lift_at_top_10_percent', 'lift')},
    {_r('accuracy_at_50_percent_risk', 'accuracy')} FROM measured""",
        "measured",
    ),
    "campaign_curve_feed": statement(
        f"""SELECT o.capacity_percent, o.customers_targeted, {_r('o.campaign_spend', 'campaign_spend')}, o.within_budget,
    {_r('o.scenario_net_value', 'scenario_net_value')},
    ROUND(o.scenario_net_value / (SELECT MAX(scenario_net_value) FROM options), 6) AS share_of_best_net_value,
    o.capacity_percent = (SELECT capacity_percent FROM recommended) AS recommended
FROM options o""",
        "options",
        "recommended",
    ),
    "any_column_search": statement(
        """SELECT * FROM profile
WHERE regexp_matches(CAST(gender_clean AS VARCHAR), '(?i)^FEM.*e$') ORDER BY msno LIMIT 1""",
        "profile",
    ),
    "any_column_search_cases": statement(
        """SELECT 'date' AS search, * FROM
    (SELECT * FROM profile WHERE strftime(registration_date, '%Y-%m') = '1995-07' ORDER BY msno LIMIT 1)
UNION ALL SELECT 'nothing', * FROM (SELECT * FROM profile ORDER BY msno DESC LIMIT 1)""",
        "profile",
    ),
}
