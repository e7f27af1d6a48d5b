"""Training job: features and labels → stored best model, metrics and importances."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame

from ..ml.train import SEED, TrainedModel, feature_importance, sample_trials, train_candidates
from ..session import materialize
from ..sources.models import save_model
from ..sources.tables import write_importance

TRIALS = 20


def train_and_store(
    training: DataFrame,
    base: str,
    run: datetime,
    settings: dict[str, dict] | None = None,
    trials: list[dict] | None = None,
    folds: int = 5,
    seed: int = SEED,
) -> tuple[str, TrainedModel]:
    """Train all candidates, store the best and, for trees, its importances.

    ``training`` has customer_id, features and churn; it is stored once, as
    every fit scans it. ``trials`` defaults to 20 seeded random settings; pass
    an empty list to skip tuning.
    """
    stored = materialize(training, "training")
    trials = sample_trials(TRIALS, seed) if trials is None else trials
    best, _, _ = train_candidates(stored, settings, trials, folds, seed)
    spark = training.sparkSession
    path = save_model(spark, best, base, run)
    importance = feature_importance(best, spark)
    if best.kind != "logistic":
        write_importance(importance, f"{path}/feature_importance")
    return path, best
