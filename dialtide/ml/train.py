"""Fitting, tuning and choosing churn models with Spark ML."""

from __future__ import annotations

import random
from collections.abc import Callable
from dataclasses import dataclass, field
from functools import partial

from pyspark import SparkContext
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize, side_by_side
from .batch_trees import BLOCK_ROWS, KINDS, cross_validated_auc
from .metrics import evaluate
from .prep import feature_names, numeric_and_categorical, preparation_stages, with_class_weight
from .score import score
from .split import stratified_folds, stratified_split

SEED = 42

#: Which class weight each kind of model trains with.
WEIGHTING = {"logistic": "balanced_weight", "forest": "balanced_weight", "boosted": "positive_weight"}


@dataclass
class TrainedModel:
    """A fitted pipeline with what is needed to score and explain it."""

    kind: str
    pipeline: PipelineModel
    numeric: list[str]
    categorical: list[str]
    params: dict = field(default_factory=dict)
    metrics: dict[str, float] = field(default_factory=dict)

    @property
    def names(self) -> list[str]:
        return feature_names(self.pipeline.stages, self.numeric, self.categorical)

    @property
    def preparation(self) -> PipelineModel:
        return PipelineModel(self.pipeline.stages[:-1])

    @property
    def classifier(self):
        return self.pipeline.stages[-1]


def classifier(kind: str, rows: int, seed: int = SEED, **params):
    """An unfitted classifier; defaults are the pipeline's standard settings."""
    common = {"featuresCol": "features", "labelCol": "churn", "weightCol": "class_weight"}
    if kind == "logistic":
        # ridge strength C: the summed loss is averaged here, over weights that add up to `rows`
        c = params.get("C", 1.0)
        return LogisticRegression(
            regParam=1.0 / (c * rows),
            elasticNetParam=0.0,
            maxIter=params.get("max_iter", 1000),
            tol=1e-8,
            standardization=False,
            **common,
        )
    if kind == "forest":
        return RandomForestClassifier(
            numTrees=params.get("trees", 100),
            maxDepth=params.get("max_depth", 10),
            # Spark has no minimum of rows to split: a node of that many has halves of half as many
            minInstancesPerNode=max(params.get("min_leaf", 2), params.get("min_split", 2) // 2),
            seed=seed,
            **common,
        )
    if kind == "boosted":
        return GBTClassifier(
            maxIter=params.get("trees", 100),
            stepSize=params.get("learning_rate", 0.1),
            maxDepth=params.get("max_depth", 5),
            subsamplingRate=params.get("row_share", 0.8),
            featureSubsetStrategy=str(params.get("column_share", 0.8)),
            minInfoGain=params.get("min_gain", 0.0),
            minInstancesPerNode=params.get("min_leaf", 1),
            seed=seed,
            **common,
        )
    raise ValueError(f"unknown model kind {kind!r}")


@dataclass
class Profile:
    """What fitting must know about its rows beforehand, from one scan."""

    numeric: list[str]
    categorical: list[str]
    rows: int
    positives: int

    def weights(self, kind: str) -> tuple[float, float]:
        """Weights of the negative and positive class; 1 where a class is missing."""
        negatives = self.rows - self.positives
        if not negatives or not self.positives:
            return 1.0, 1.0
        if WEIGHTING[kind] == "positive_weight":
            return 1.0, negatives / self.positives
        return self.rows / (2 * negatives), self.rows / (2 * self.positives)


def profile(train: DataFrame) -> Profile:
    """Feature columns with at least one value, row count and churned rows."""
    numeric, categorical = numeric_and_categorical(train)
    found = train.agg(
        F.count(F.lit(1)).alias("_rows"),
        F.count_if(F.col("churn") == 1).alias("_positives"),
        *[F.count(c).alias(c) for c in [*numeric, *categorical]],
    ).first()
    return Profile(
        [c for c in numeric if found[c]], [c for c in categorical if found[c]], found["_rows"], found["_positives"]
    )


def _without_summary(model):
    """Drop a model's training summary.

    The summary refers to the session and the training data and would travel
    with the model to every scoring task; once the session has used an
    ``Observation`` it does not even serialize.
    """
    if getattr(model, "hasSummary", False):
        model._java_obj.setSummary(SparkContext._active_spark_context._jvm.scala.Option.empty())
    return model


@dataclass
class Prepared:
    """Training rows as stored vectors, with the fitted preparation that made them."""

    profile: Profile
    preparation: PipelineModel
    vectors: DataFrame


def fit_preparation(train: DataFrame) -> tuple[Profile, PipelineModel]:
    """The preparation fitted on ``train``, and what it had to know of the rows.

    ``train`` is scanned once per stage: pass a stored table, not a long plan.
    """
    known = profile(train)
    return known, Pipeline(stages=preparation_stages(known.numeric, known.categorical, known.rows)).fit(train)


def prepare(train: DataFrame) -> Prepared:
    """Fit the preparation on ``train`` once and store its vectors, for any number of classifiers."""
    known, fitted = fit_preparation(train)
    vectors = fitted.transform(train).select("churn", "features")
    return Prepared(known, fitted, materialize(vectors, "vectors"))


def fit_prepared(rows: Prepared, kind: str, seed: int = SEED, **params) -> TrainedModel:
    """Fit a classifier on prepared rows."""
    known = rows.profile
    weighted = with_class_weight(rows.vectors, *known.weights(kind))
    model = _without_summary(classifier(kind, known.rows, seed, **params).fit(weighted))
    pipeline = PipelineModel([*rows.preparation.stages, model])
    return TrainedModel(kind, pipeline, known.numeric, known.categorical, params)


def fit(train: DataFrame, kind: str, seed: int = SEED, **params) -> TrainedModel:
    """Fit preparation and classifier on ``train`` (features and ``churn``)."""
    return fit_prepared(prepare(train), kind, seed, **params)


def train_logistic(train: DataFrame, **params) -> TrainedModel:
    """Ridge logistic regression, C = 1, balanced classes."""
    return fit(train, "logistic", **params)


def train_forest(train: DataFrame, **params) -> TrainedModel:
    """Random forest: 100 trees, depth 10, at least 2 rows a leaf, balanced classes."""
    return fit(train, "forest", **params)


def train_boosted(train: DataFrame, **params) -> TrainedModel:
    """Boosted trees: 100 rounds of 0.1, depth 5, 80 % of rows and columns, positives weighted."""
    return fit(train, "boosted", **params)


def sample_trials(n: int, seed: int = SEED, max_trees: int = 300) -> list[dict]:
    """``n`` seeded random settings out of the tuning space."""
    rng = random.Random(seed)
    trials = []
    for _ in range(n):
        if rng.choice(["boosted", "forest"]) == "boosted":
            trials.append(
                {
                    "kind": "boosted",
                    "trees": rng.randint(min(50, max_trees), max_trees),
                    "max_depth": rng.randint(3, 10),
                    "learning_rate": rng.uniform(0.01, 0.3),
                    "row_share": rng.uniform(0.6, 1.0),
                    "column_share": round(rng.uniform(0.6, 1.0), 3),
                    "min_leaf": rng.randint(1, 10),
                    "min_gain": rng.uniform(0.0, 0.5),
                }
            )
        else:
            trials.append(
                {
                    "kind": "forest",
                    "trees": rng.randint(min(50, max_trees), max_trees),
                    "max_depth": rng.randint(5, 30),
                    "min_split": rng.randint(2, 10),
                    "min_leaf": rng.randint(1, 5),
                }
            )
    return trials


def cross_validate(train: DataFrame, trials: list[dict], folds: int = 5, seed: int = SEED, block_rows: int = BLOCK_ROWS):
    """Mean ROC-AUC of each trial over stratified folds, in trial order.

    Preparation is fitted inside each fold, on the rows outside it. The trees of
    all trials and folds then grow together, see :mod:`.batch_trees`. A fold
    whose held-out rows lack a class does not count.
    """
    split = materialize(stratified_folds(train, folds, seed=seed), "folds")

    def prepared(f: int) -> tuple[DataFrame, dict[str, tuple[float, float]]]:
        known, preparation = fit_preparation(split.filter(F.col("fold") != f).drop("fold"))
        ready = preparation.transform(split).select("customer_id", "churn", (F.col("fold") == f).alias("held"), "features")
        return materialize(ready, "fold-vectors"), {kind: known.weights(kind) for kind in KINDS}

    rows, weights = zip(*side_by_side(train.sparkSession, prepared, range(folds)))
    found = cross_validated_auc(list(rows), list(weights), trials, "customer_id", seed, block_rows)
    means = {r["trial"]: r["auc"] for r in found.groupBy("trial").agg(F.avg("roc_auc").alias("auc")).collect()}
    return [means.get(i) or 0.0 for i in range(len(trials))]


def tune(
    train: DataFrame, trials: list[dict], folds: int = 5, seed: int = SEED, prepared: Prepared | None = None
) -> TrainedModel:
    """Refit the trial with the best cross-validated ROC-AUC on all of ``train``, or on the rows ``prepared`` from it."""
    scores = cross_validate(train, trials, folds, seed)
    best = trials[max(range(len(trials)), key=lambda i: scores[i])]
    return fit_prepared(prepared or prepare(train), best["kind"], seed, **{k: v for k, v in best.items() if k != "kind"})


def model_candidates(models: list[TrainedModel], spark) -> DataFrame:
    """One row per candidate: position, kind and metrics."""
    rows = [(i, m.kind, *[m.metrics[k] for k in ("accuracy", "precision", "recall", "f1", "roc_auc")])
            for i, m in enumerate(models)]
    return spark.createDataFrame(
        rows, "position int, kind string, accuracy double, precision double, recall double, f1 double, roc_auc double"
    )


def select_best(models: list[TrainedModel], metric: str = "f1") -> TrainedModel:
    """The candidate with the highest metric, the first of equals."""
    return max(models, key=lambda m: m.metrics[metric])


def train_candidates(
    training: DataFrame,
    settings: dict[str, dict] | None = None,
    trials: list[dict] | None = None,
    folds: int = 5,
    seed: int = SEED,
) -> tuple[TrainedModel, list[TrainedModel], DataFrame]:
    """Train every kind plus the tuned one; pick on validation, report on test.

    Returns the best model (its metrics taken on the untouched test rows), all
    candidates (metrics on the validation rows) and the test rows.
    """
    settings = {"logistic": {}, "forest": {}, "boosted": {}} if settings is None else settings
    split = materialize(stratified_split(training, seed=seed), "split")
    test = split.filter("is_test").drop("is_test")
    rest = materialize(stratified_split(split.filter("NOT is_test").drop("is_test"), seed=seed + 1), "rest")
    train, valid = rest.filter("NOT is_test").drop("is_test"), rest.filter("is_test").drop("is_test")

    rows = prepare(train)
    fits = [partial(fit_prepared, rows, kind, seed, **params) for kind, params in settings.items()]
    if trials:
        fits.append(partial(tune, train, trials, folds, seed, rows))

    def candidate(fitted: Callable[[], TrainedModel]) -> TrainedModel:
        model = fitted()
        model.metrics = evaluate(score(valid, model.pipeline))
        return model

    models = side_by_side(training.sparkSession, candidate, fits)
    best = select_best(models)
    chosen = TrainedModel(best.kind, best.pipeline, best.numeric, best.categorical, best.params)
    chosen.metrics = evaluate(score(test, best.pipeline))
    return chosen, models, test


def feature_importance(model: TrainedModel, spark) -> DataFrame:
    """Importance of each ``features`` slot, largest first; empty for linear models."""
    values = getattr(model.classifier, "featureImportances", None)
    rows = [] if values is None else [(n, float(v)) for n, v in zip(model.names, values.toArray())]
    return spark.createDataFrame(rows, "feature string, importance double").orderBy(
        F.desc("importance"), "feature"
    )
