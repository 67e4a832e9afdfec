"""Feature preparation learned on training rows alone: impute, scale, encode."""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, StringIndexer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keepwell.functions.columns import as_text_or
from keepwell.operators.model_input import CATEGORIES
from keepwell.operators.ranking import rank_rows, running_totals
from keepwell.session import staged



def value_counts(train: DataFrame, features: list[str]) -> DataFrame:
    """(feature, value, n) over the training rows, null values included; written once."""
    pairs = F.array(
        *[F.struct(F.lit(f).alias("feature"), F.col(f).cast("double").alias("value")) for f in features]
    )
    return staged(
        train.select(F.inline(pairs)).groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n")), "values"
    )


def numeric_medians(counted: DataFrame) -> DataFrame:
    """Exact median, missing count and rows per feature of ``value_counts``.

    An exact percentile aggregate would hold all distinct values of a column in one task. Here
    the two middle positions are looked up in running counts. A column without any value has a
    null median.
    """
    curve = running_totals(counted.filter("value IS NOT NULL"), ["feature"], [F.asc("value")], ["n"])
    below = F.col("cum_n") - F.col("n")
    middles = sum(
        ((below < place) & (place <= F.col("cum_n"))).cast("int")
        for place in (F.floor((F.col("total_n") + 1) / 2), F.floor(F.col("total_n") / 2) + 1)
    )
    medians = curve.filter(middles > 0).groupBy("feature").agg((F.sum(F.col("value") * middles) / 2).alias("median"))
    sizes = counted.groupBy("feature").agg(
        F.sum("n").alias("rows"),
        F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("n"))), F.lit(0)).alias("missing"),
    )
    # One row per feature.
    return sizes.join(F.broadcast(medians), "feature", "left")


def numeric_moments(counted: DataFrame, medians: DataFrame) -> DataFrame:
    """Mean and population deviation per feature, gaps filled by the median: weighted sums of counts."""
    # One row per feature on the right of each join.
    filled = counted.join(F.broadcast(medians.select("feature", "median")), "feature").select(
        "feature", "n", F.coalesce("value", "median").alias("x")
    )
    weight = F.sum("n")
    means = filled.groupBy("feature").agg((F.sum(F.col("n") * F.col("x")) / weight).alias("mean"))
    distance = F.col("x") - F.col("mean")
    return (
        filled.join(F.broadcast(means), "feature")
        .groupBy("feature")
        .agg(
            F.first("mean").alias("mean"),
            F.sqrt(F.sum(F.col("n") * distance * distance) / weight).alias("deviation"),
        )
    )


@dataclass
class NumericPreparation:
    """What training rows taught: one number or two per feature, held on the driver."""

    medians: dict[str, float]
    indicators: list[str]
    means: dict[str, float] = field(default_factory=dict)
    deviations: dict[str, float] = field(default_factory=dict)
    dropped: list[str] = field(default_factory=list)

    @property
    def columns(self) -> list[str]:
        return [*self.medians, *[f"missingindicator_{name}" for name in self.indicators]]

    def impute(self, df: DataFrame) -> DataFrame:
        """Medians for gaps, and an indicator for each feature that had gaps in training.

        Features without a single training value are dropped.
        """
        flags = {f"missingindicator_{name}": F.col(name).isNull().cast("int") for name in self.indicators}
        filled = {
            name: F.coalesce(F.col(name).cast("double"), F.lit(median)) for name, median in self.medians.items()
        }
        return df.withColumns({**flags, **filled}).drop(*self.dropped)

    def scale(self, imputed: DataFrame) -> DataFrame:
        """Zero mean and unit population deviation; constants are only centred."""
        return imputed.withColumns(
            {
                name: (F.col(name) - F.lit(self.means[name])) / F.lit(self.deviations[name] or 1.0)
                for name in self.columns
            }
        )


def learn_numeric(train: DataFrame, features: list[str], scale: bool = False) -> NumericPreparation:
    counted = value_counts(train, features)
    medians = staged(numeric_medians(counted), "medians")
    learned = {row["feature"]: row for row in medians.collect()}  # one row per feature
    usable = [f for f in features if learned[f]["median"] is not None]
    preparation = NumericPreparation(
        medians={f: learned[f]["median"] for f in usable},
        indicators=[f for f in usable if learned[f]["missing"] > 0],
        dropped=[f for f in features if f not in usable],
    )
    if scale:
        for row in numeric_moments(counted, medians).collect():  # one row per feature
            preparation.means[row["feature"]] = row["mean"]
            preparation.deviations[row["feature"]] = row["deviation"]
        for name in preparation.indicators:
            share = learned[name]["missing"] / learned[name]["rows"]
            preparation.means[f"missingindicator_{name}"] = share
            preparation.deviations[f"missingindicator_{name}"] = math.sqrt(share * (1 - share))
    return preparation


def ordinal_levels(train: DataFrame) -> DataFrame:
    """(category, level, code) with codes 0, 1, … in the order of the training levels."""
    pairs = F.array(
        *[F.struct(F.lit(c).alias("category"), as_text_or(c, "unknown").alias("level")) for c in CATEGORIES]
    )
    levels = train.select(F.inline(pairs)).distinct()
    ranked = rank_rows(levels, ["category"], [F.asc("level")], "_rank")
    return ranked.select("category", "level", (F.col("_rank") - 1).cast("int").alias("code"))


def ordinal_encode(df: DataFrame, levels: DataFrame) -> DataFrame:
    """Adds ``<category>_code``; levels that training did not have become -1.

    How the level tables are joined is left to the engine, which knows the size of the written table
    and splits hot levels where it shuffles.
    """
    levels = staged(levels, "levels")
    for category in CATEGORIES:
        codes = levels.filter(F.col("category") == category).select(
            F.col("level").alias(category), F.col("code").alias(f"{category}_code")
        )
        df = df.join(codes, category, "left").fillna(-1, subset=[f"{category}_code"])
    return df


def one_hot_stages() -> Pipeline:
    """All training levels kept, alphabetically; an unseen level is all zeros."""
    indexer = StringIndexer(
        inputCols=list(CATEGORIES),
        outputCols=[f"{c}_index" for c in CATEGORIES],
        handleInvalid="keep",
        stringOrderType="alphabetAsc",
    )
    encoder = OneHotEncoder(
        inputCols=indexer.getOutputCols(), outputCols=[f"{c}_onehot" for c in CATEGORIES], dropLast=True
    )
    return Pipeline(stages=[indexer, encoder])


def learn_one_hot(train: DataFrame) -> PipelineModel:
    return one_hot_stages().fit(with_known_categories(train))


def with_known_categories(df: DataFrame) -> DataFrame:
    return df.withColumns({c: as_text_or(c, "unknown") for c in CATEGORIES})
