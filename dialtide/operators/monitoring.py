"""Monitoring of scores and model metrics over time."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def prediction_histogram(scores: DataFrame, time: str = "event_timestamp", bins: int = 10) -> DataFrame:
    """Scores per day in ``bins`` equal bins over [0, 1]; 1 belongs to the last."""
    index = F.least(F.floor(F.col("churn_probability") * bins), F.lit(bins - 1)).cast("int")
    return scores.groupBy(F.to_date(time).alias("date"), index.alias("bin")).agg(F.count(F.lit(1)).alias("n"))


def metric_drop_alert(history: DataFrame, metrics: list[str], drop: float = 0.05) -> DataFrame:
    """Each metric of each run against the run before; alert on a drop beyond ``drop``.

    One row per run and metric, so each window holds one metric's runs.
    """
    long = history.unpivot(["timestamp"], metrics, "metric", "value")
    previous = F.lag("value").over(Window.partitionBy("metric").orderBy("timestamp"))
    return long.withColumn("previous", previous).withColumn(
        "alert", F.coalesce(F.col("previous") - F.col("value") > drop, F.lit(False))
    )
