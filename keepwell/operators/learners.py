"""Churn models on Spark ML: two baselines, three boosted candidates, the tournament."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel, Transformer
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import SQLTransformer, StringIndexer, StringIndexerModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keepwell.functions.hashing import hash_draw
from keepwell.operators import boosting, calibration, champion, encoding, metrics, splitting
from keepwell.operators.model_input import CATEGORIES, ID, TARGET, numeric_features
from keepwell.session import scratch_path, staged

SEED = 42
#: Draws the order of rows that statistics of category levels are taken in.
STAT_SEED = "statistics"


@dataclass(frozen=True)
class Profile:
    """How much training to spend. ``FULL`` has the reported settings, ``QUICK`` is for checks."""

    forest_trees: int = 75
    forest_depth: int = 12
    forest_leaf: int = 75
    logistic_rounds: int = 200
    ordinal_rounds: int = 350
    ordinal_depth: int = 5
    deep_rounds: int = 500
    deep_depth: int = 7
    nominal_rounds: int = 500
    nominal_leaves: int = 31
    train_partitions: int = 32


FULL = Profile()
QUICK = Profile(
    forest_trees=10,
    forest_depth=5,
    forest_leaf=10,
    logistic_rounds=50,
    ordinal_rounds=4,
    ordinal_depth=3,
    deep_rounds=4,
    deep_depth=4,
    nominal_rounds=4,
    nominal_leaves=6,
    train_partitions=4,
)


@dataclass
class Features:
    """Prepared rows of all roles: id, label, role, ``features`` and both weights."""

    rows: DataFrame
    names: list[str]
    #: Fitted stages that make ``features`` out of raw model input.
    stages: list[Transformer] = field(default_factory=list)

    def role(self, name: str) -> DataFrame:
        return self.rows.filter(F.col("role") == name)

    def training(self, profile: Profile) -> DataFrame:
        """The train role, always in the same partitions and order.

        Row sampling draws by partition and position, so this is what makes a seed repeatable.
        """
        return self.role("train").repartition(profile.train_partitions, ID).sortWithinPartitions(ID)


def _weighted(rows: DataFrame) -> DataFrame:
    """Class weights as learned from the train role, put on every row."""
    weights = splitting.class_weights(rows.filter(F.col("role") == "train"))
    # One row per class.
    return rows.join(F.broadcast(weights.drop("customers")), TARGET, "left")


def _assembled(rows: DataFrame, columns: list[str], label: str) -> Features:
    vectors = VectorAssembler(inputCols=columns, outputCol="features").transform(rows)
    attributes = vectors.schema["features"].metadata["ml_attr"]["attrs"]
    named = sorted((a["idx"], a["name"]) for group in attributes.values() for a in group)
    kept = _weighted(vectors.select(ID, TARGET, "role", "features"))
    metadata = vectors.schema["features"].metadata
    stored = staged(kept, label)
    # The attributes tell the trees which inputs are categories.
    return Features(
        stored.withColumn("features", F.col("features").alias("features", metadata=metadata)),
        [name for _, name in named],
    )


def _used(rows: DataFrame) -> DataFrame:
    """Rows beyond the caps of a split that has some (the baselines' has) take no part in training, calibration or test."""
    return rows.filter(F.col("role") != "unused")


def linear_features(rows: DataFrame) -> Features:
    """Imputed, scaled numerics with one-hot categories."""
    rows = _used(rows)
    train = rows.filter(F.col("role") == "train")
    numeric = encoding.learn_numeric(train, _numeric(rows), scale=True)
    one_hot = encoding.learn_one_hot(train)
    prepared = one_hot.transform(encoding.with_known_categories(numeric.scale(numeric.impute(rows))))
    return _assembled(prepared, [*numeric.columns, *[f"{c}_onehot" for c in CATEGORIES]], "linear")


def ordinal_features(rows: DataFrame) -> Features:
    """Imputed numerics with ordinal category codes."""
    rows = _used(rows)
    train = rows.filter(F.col("role") == "train")
    numeric = encoding.learn_numeric(train, _numeric(rows))
    levels = staged(encoding.ordinal_levels(train), "ordinal-levels")
    prepared = encoding.ordinal_encode(numeric.impute(rows), levels)
    made = _assembled(prepared, [*numeric.columns, *[f"{c}_code" for c in CATEGORIES]], "ordinal")
    # The levels of the train role: distinct catalogue codes, not rows.
    held = {c: [] for c in CATEGORIES}
    for row in levels.orderBy("category", "code").collect():
        held[row["category"]].append(row["level"])
    indexer = StringIndexerModel.from_arrays_of_labels(
        list(held.values()), [f"text_{c}" for c in held], [f"index_{c}" for c in held], "keep"
    )
    codes = [f"CASE WHEN index_{c} = {len(held[c])} THEN -1D ELSE index_{c} END AS ready_{c}_code" for c in held]
    made.stages = [*_numeric_stages(numeric), indexer, _selecting(codes), _ready_vector(made.names)]
    return made


def _selecting(columns: list[str]) -> SQLTransformer:
    return SQLTransformer(statement=f"SELECT *, {', '.join(columns)} FROM __THIS__")


def _numeric_stages(numeric: encoding.NumericPreparation) -> list[Transformer]:
    """Gaps filled, indicators, and categories as texts, under names of their own."""
    filled = [f"coalesce(CAST(`{c}` AS DOUBLE), {float(m)!r}D) AS `ready_{c}`" for c, m in numeric.medians.items()]
    flags = [f"CAST(`{c}` IS NULL AS INT) AS `ready_missingindicator_{c}`" for c in numeric.indicators]
    texts = [f"coalesce(CAST(`{c}` AS STRING), 'unknown') AS `text_{c}`" for c in CATEGORIES]
    return [_selecting([*filled, *flags, *texts])]


def _ready_vector(names: list[str]) -> VectorAssembler:
    return VectorAssembler(inputCols=[f"ready_{n}" for n in names], outputCol="features")


def scoring_pipeline(
    features: Features, model: PipelineModel, calibrator: calibration.IsotonicRegressionModel
) -> PipelineModel:
    """Preparation, learner and calibrator as one stored model: raw model input in, ``risk`` and ``calibrated`` out."""
    if not features.stages:
        raise ValueError("These features cannot be made by stored stages.")
    return PipelineModel([*features.stages, *model.stages, calibrator])


def score_raw(pipeline: PipelineModel, rows: DataFrame) -> DataFrame:
    """(msno, risk, calibrated) of raw model input, which needs no label and no role."""
    return pipeline.transform(rows).select(ID, "risk", "calibrated")


def nominal_features(rows: DataFrame) -> Features:
    """Imputed numerics with native categories.

    Levels are learned on the train role; the indexer holds them, distinct catalogue codes, on the
    driver. Levels that training did not have share one more index at every size of the data.
    """
    rows = _used(rows)
    train = rows.filter(F.col("role") == "train")
    numeric = encoding.learn_numeric(train, _numeric(rows))
    known = encoding.with_known_categories(numeric.impute(rows))
    indexer = StringIndexer(
        inputCols=list(CATEGORIES),
        outputCols=[f"{c}_index" for c in CATEGORIES],
        handleInvalid="keep",
        stringOrderType="alphabetAsc",
    ).fit(known.filter(F.col("role") == "train"))
    return _assembled(
        indexer.transform(known), [*numeric.columns, *[f"{c}_index" for c in CATEGORIES]], "nominal"
    )


def statistic_features(rows: DataFrame) -> Features:
    """Imputed numerics with ordered target statistics of the categories; smoothed by the train role's churn rate."""
    rows = _used(rows)
    train = rows.filter(F.col("role") == "train")
    numeric = encoding.learn_numeric(train, _numeric(rows))
    known = encoding.with_known_categories(numeric.impute(rows))
    stats = boosting.ordered_statistics(known, list(CATEGORIES), TARGET, ID, hash_draw(STAT_SEED, ID), churn_rate(train))
    return _assembled(stats, [*numeric.columns, *[f"{c}_stat" for c in CATEGORIES]], "statistic")


def churn_rate(train: DataFrame) -> float:
    return float(train.agg(F.avg(TARGET)).first()[0] or 0.0)


def _numeric(rows: DataFrame) -> list[str]:
    return numeric_features(rows.drop("role"))


def fit_logistic(features: Features, profile: Profile) -> PipelineModel:
    """L2 with unit inverse strength on the summed loss; Spark's loss is the weighted mean."""
    train = features.training(profile)
    total = train.agg(F.sum("balanced_weight").alias("w")).first()["w"]
    learner = LogisticRegression(
        labelCol=TARGET,
        weightCol="balanced_weight",
        regParam=1.0 / total,
        elasticNetParam=0.0,
        standardization=False,
        maxIter=profile.logistic_rounds,
    )
    return _without_summary(Pipeline(stages=[learner]).fit(train))


def _without_summary(model: PipelineModel) -> PipelineModel:
    """The model as it is stored. A training summary holds the session, which Spark sends to the tasks with the
    model, and cannot once the session has observed a table's measures."""
    path = scratch_path(SparkSession.active(), "model")
    model.write().save(path)
    return PipelineModel.load(path)


def fit_forest(features: Features, profile: Profile) -> PipelineModel:
    """Class weights are global: Spark does not re-balance each bootstrap sample."""
    learner = RandomForestClassifier(
        labelCol=TARGET,
        weightCol="balanced_weight",
        numTrees=profile.forest_trees,
        maxDepth=profile.forest_depth,
        minInstancesPerNode=profile.forest_leaf,
        featureSubsetStrategy="sqrt",
        seed=SEED,
    )
    return _without_summary(Pipeline(stages=[learner]).fit(features.training(profile)))


def _boosted(features: Features, profile: Profile, settings: boosting.Settings) -> PipelineModel:
    model = boosting.fit(features.training(profile), features.names, settings, TARGET, "boost_weight", ID)
    return PipelineModel([model])


def fit_boosted_ordinal(features: Features, profile: Profile) -> PipelineModel:
    """Level-wise trees; a child needs a sum of hessians."""
    return _boosted(
        features,
        profile,
        boosting.Settings(
            rounds=profile.ordinal_rounds,
            depth=profile.ordinal_depth,
            min_hessian=20.0,
            row_share=0.8,
            column_share=0.8,
            seed=SEED,
        ),
    )


def fit_boosted_nominal_deep(features: Features, profile: Profile) -> PipelineModel:
    """Symmetric trees on ordered target statistics of the categories."""
    return _boosted(
        features,
        profile,
        boosting.Settings(rounds=profile.deep_rounds, depth=profile.deep_depth, symmetric=True, l2=3.0, seed=SEED),
    )


def fit_boosted_nominal(features: Features, profile: Profile) -> PipelineModel:
    """Best-first trees with splits by category levels; a child needs a number of rows."""
    return _boosted(
        features,
        profile,
        boosting.Settings(
            rounds=profile.nominal_rounds,
            leaves=profile.nominal_leaves,
            min_rows=20,
            column_share=0.8,
            average_start=True,
            seed=SEED,
        ),
    )


BASELINES: dict[str, Callable[[Features, Profile], PipelineModel]] = {
    "logistic_regression": fit_logistic,
    "random_forest": fit_forest,
}
CANDIDATES: dict[str, tuple[Callable[[DataFrame], Features], Callable[[Features, Profile], PipelineModel]]] = {
    "boosted_ordinal": (ordinal_features, fit_boosted_ordinal),
    "boosted_nominal_deep": (statistic_features, fit_boosted_nominal_deep),
    "boosted_nominal": (nominal_features, fit_boosted_nominal),
}


def score(model: PipelineModel, rows: DataFrame) -> DataFrame:
    """(msno, is_churn, risk) with the model's churn probability."""
    return model.transform(rows).select(ID, TARGET, vector_to_array("probability")[1].alias("risk"))


def feature_importance(model: PipelineModel, names: list[str], top: int = 20) -> DataFrame:
    """The ``top`` inputs by importance; one number per input comes from the model."""
    values = model.stages[-1].featureImportances.toArray()
    table = SparkSession.active().createDataFrame(
        [(name, float(value)) for name, value in zip(names, values, strict=True)], "feature string, importance double"
    )
    return table.orderBy(F.desc("importance"), "feature").limit(top)


def baseline_scores(rows: DataFrame, profile: Profile) -> tuple[dict[str, PipelineModel], DataFrame, Features]:
    """Both baselines on one preparation; test scores in long form (model, msno, is_churn, risk)."""
    features = linear_features(rows)
    models = {name: fit(features, profile) for name, fit in BASELINES.items()}
    scores = None
    for name, model in models.items():
        part = score(model, features.role("test")).select(F.lit(name).alias("model"), ID, TARGET, "risk")
        scores = part if scores is None else scores.unionByName(part)
    return models, scores, features


@dataclass
class Tournament:
    scores: DataFrame
    metrics: DataFrame
    winner: DataFrame
    models: dict[str, PipelineModel]
    calibrators: dict[str, object]

    def predictions(self) -> DataFrame:
        return champion.wide_predictions(self.scores, list(self.models), self.winner)


def calibrated_scores(
    name: str, model: PipelineModel, features: Features
) -> tuple[DataFrame, calibration.IsotonicRegressionModel]:
    """Calibrate on the calibration role, score the test role."""
    calibrator = calibration.fit_isotonic(score(model, features.role("calibration")))
    tested = calibration.calibrate(score(model, features.role("test")), calibrator)
    return tested.select(F.lit(name).alias("model"), ID, TARGET, F.col("calibrated").alias("risk")), calibrator


def all_candidates(
    spark: SparkSession, fitted: Callable[[str], tuple[Features, PipelineModel]]
) -> dict[str, tuple[Features, PipelineModel]]:
    """What ``fitted`` gives for each candidate, at the same time: a fit of one block keeps one core busy."""
    with ThreadPoolExecutor(len(CANDIDATES)) as pool:
        started = {name: pool.submit(inheritable_thread_target(spark)(fitted), name) for name in CANDIDATES}
        return {name: running.result() for name, running in started.items()}


def run_tournament(
    rows: DataFrame,
    profile: Profile = FULL,
    fitted: Callable[[str], tuple[Features, PipelineModel]] | None = None,
) -> Tournament:
    """Same split, three candidates, calibrate, score, rank by rule.

    ``rows`` is the model input with its ``role`` column. The models are trained side by side.
    ``fitted`` gives a candidate's features and model where they have been made from the same rows before.
    """

    def made(short: str) -> tuple[Features, PipelineModel]:
        prepare, fit = CANDIDATES[short]
        features = prepare(rows)
        return features, fit(features, profile)

    models, calibrators, scores = {}, {}, None
    for short, (features, model) in all_candidates(rows.sparkSession, fitted or made).items():
        name = f"{short}_isotonic_calibrated"
        models[name] = model
        part, calibrators[name] = calibrated_scores(name, model, features)
        scores = part if scores is None else scores.unionByName(part)
    scores = staged(scores, "tournament")
    test = rows.filter(F.col("role") == "test")
    for name in models:
        splitting.require_aligned(scores.filter(F.col("model") == name), test)
    measured = staged(metrics.tournament_records(metrics.model_metrics(scores)), "records")
    return Tournament(scores, measured, champion.champion(measured), models, calibrators)
