"""Scoring with a fitted pipeline."""

from __future__ import annotations

import time

from pyspark.ml import PipelineModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import threshold_prediction
from ..operators.snapshot import lookup_one, online_lookup


def positive_probability(column: str = "probability"):
    """The second class's probability out of Spark ML's vector column."""
    return vector_to_array(column)[1]


def score(features: DataFrame, model: PipelineModel) -> DataFrame:
    """``features`` plus churn_probability and churn_prediction (from 0.5 upward)."""
    scored = model.transform(features)
    return scored.select(*features.columns, positive_probability().alias("churn_probability")).withColumn(
        "churn_prediction", threshold_prediction(F.col("churn_probability"))
    )


class FixedLogistic:
    """A logistic model given by its coefficients, with the interface of a fitted pipeline."""

    def __init__(self, coefficients: dict[str, float], intercept: float, means: dict[str, float] | None = None):
        self.coefficients, self.intercept, self.means = coefficients, intercept, means or {}

    def transform(self, df: DataFrame) -> DataFrame:
        """Adds ``probability``; a missing feature counts as its mean, 0 where none is given."""
        filled = {c: F.coalesce(F.col(c), F.lit(float(self.means.get(c, 0)))) for c in self.coefficients}
        scored = logistic_score(df.withColumns(filled), self.coefficients, self.intercept)
        p = F.col("churn_probability")
        return scored.withColumn("probability", array_to_vector(F.array(1 - p, p))).drop(
            "churn_probability", "churn_prediction"
        )


def logistic_score(df: DataFrame, coefficients: dict[str, float], intercept: float) -> DataFrame:
    """Score with given logistic coefficients on the columns of ``df``."""
    margin = F.lit(float(intercept))
    for column, weight in coefficients.items():
        margin = margin + F.col(column) * F.lit(float(weight))
    probability = 1.0 / (1.0 + F.exp(-margin))
    return df.withColumn("churn_probability", probability).withColumn(
        "churn_prediction", threshold_prediction(F.col("churn_probability"))
    )


def batch_score(
    requests: DataFrame,
    snapshots: dict[str, DataFrame],
    refs: list[str],
    model: PipelineModel,
    model_version: str,
    as_of=None,
) -> DataFrame:
    """Look up and score each requested customer, in one plan.

    Customers without stored features are scored on the training means, and
    ``has_features`` says so. The response has the request's columns, the score,
    its time and the version.
    """
    # a list of customers may be one small file: deal it out by the key that the lookups join on, or one task scores all
    dealt = requests.repartition("customer_id")
    found = online_lookup(dealt, snapshots, refs, as_of, mark=True)
    return _response(found, requests.columns, model, model_version)


def _response(found: DataFrame, columns: list[str], model, model_version: str) -> DataFrame:
    return score(found, model).select(
        *columns,
        "has_features",
        "churn_probability",
        "churn_prediction",
        F.current_timestamp().alias("prediction_time"),
        F.lit(model_version).alias("model_version"),
    )


def timed_write(predictions: DataFrame, path: str) -> float:
    """Store a batch of predictions and return the elapsed milliseconds."""
    start = time.perf_counter()
    predictions.write.mode("overwrite").parquet(path)
    return (time.perf_counter() - start) * 1000


def score_one(
    customer_id: str, snapshots: dict[str, DataFrame], refs: list[str], model: PipelineModel, model_version: str,
    as_of=None,
) -> DataFrame:
    """:func:`batch_score` for one customer; the id is a filter on the stored features."""
    found = lookup_one(customer_id, snapshots, refs, as_of, mark=True)
    return _response(found, ["customer_id"], model, model_version)
