"""From snapshot to model input: categories as text, raw dates and codes dropped."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keepwell.functions.columns import as_text_or

ID = "msno"
TARGET = "is_churn"

CATEGORIES = {
    "city_category": "city",
    "gender_category": "gender_clean",
    "registration_channel_category": "registered_via",
    "latest_payment_method_category": "latest_payment_method_id",
    "latest_plan_days_category": "latest_plan_days",
}
DATES = ["first_transaction_date", "last_transaction_date", "registration_date"]


def model_input(snapshot: DataFrame) -> DataFrame:
    """Numeric gaps stay null here: they are imputed later, from training rows alone."""
    return snapshot.withColumns(
        {
            **{name: as_text_or(source, "unknown") for name, source in CATEGORIES.items()},
            "age_unknown_flag": F.coalesce("age_unknown_flag", F.lit(1)).cast("tinyint"),
        }
    ).drop(*CATEGORIES.values(), *DATES)


def numeric_features(df: DataFrame) -> list[str]:
    """Everything that is neither id, target nor category."""
    return [name for name in df.columns if name not in {ID, TARGET, *CATEGORIES}]


def category_domain(*frames: DataFrame) -> DataFrame:
    """Distinct levels per category over several samples, as (category, level)."""
    pairs = F.array(
        *[
            F.struct(F.lit(name).alias("category"), as_text_or(name, "unknown").alias("level"))
            for name in CATEGORIES
        ]
    )
    combined = None
    for frame in frames:
        part = frame.select(F.inline(pairs))
        combined = part if combined is None else combined.unionByName(part)
    return combined.distinct()
