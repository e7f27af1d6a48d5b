"""Top lists of models, features and explanations."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def rank_models(models: DataFrame, metric: str = "f1") -> DataFrame:
    """The model with the highest metric; the earliest of equals."""
    return models.orderBy(F.desc_nulls_last(metric), "position").limit(1)


def top_importance(importance: DataFrame, n: int = 15) -> DataFrame:
    """The ``n`` most important features."""
    return importance.orderBy(F.desc_nulls_last("importance"), "feature").limit(n)


def importance_names(names: DataFrame, importances: DataFrame) -> DataFrame:
    """Pair two one-row arrays (``names``, ``importances``) up to the shorter one."""
    left = names.select(F.posexplode("names").alias("position", "feature"))
    right = importances.select(F.posexplode("importances").alias("position", "importance"))
    return left.join(right, "position")


def _per_row(row_key: list[str], *order):
    # a row has one contribution per feature, so a window holds a handful
    return Window.partitionBy(*row_key).orderBy(*order, "feature")


def top_abs(contributions: DataFrame, row_key: list[str], n: int = 10) -> DataFrame:
    """Per explained row, the ``n`` contributions largest in absolute value (1 to 50)."""
    if not 1 <= n <= 50:
        raise ValueError("n must be between 1 and 50")
    order = _per_row(row_key, F.desc(F.abs("contribution")))
    return contributions.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= n)


def positive_negative_factors(contributions: DataFrame, row_key: list[str], n: int = 3) -> DataFrame:
    """Per explained row, the ``n`` strongest factors raising and lowering the score."""
    value = F.col("contribution")
    up = F.row_number().over(_per_row(row_key, F.desc("contribution")))
    down = F.row_number().over(_per_row(row_key, F.asc("contribution")))
    return (
        contributions.withColumn("direction", F.when(value > 0, "increases").when(value < 0, "decreases"))
        .withColumn("rank", F.when(value > 0, up).otherwise(down))
        .filter(F.col("direction").isNotNull() & (F.col("rank") <= n))
    )
