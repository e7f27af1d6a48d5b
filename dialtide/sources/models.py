"""Stored models, their metrics and their history.

A run is stored under its timestamp, so the latest model is the one with the
greatest name and a reader never sees a half-replaced one.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import METRICS_JSON, MODEL_METRICS

STAMP = "%Y%m%d_%H%M%S"
INFO = "model_type string, numeric array<string>, categorical array<string>, names array<string>"


def write_metrics(spark: SparkSession, metrics: dict[str, float], base: str, run: datetime) -> str:
    """Store one run's metrics as ``metrics_<timestamp>.json``."""
    path = f"{base.rstrip('/')}/metrics_{run.strftime(STAMP)}.json"
    rows = [tuple(None if metrics.get(m) is None else float(metrics[m]) for m in MODEL_METRICS)]
    spark.createDataFrame(rows, METRICS_JSON).coalesce(1).write.mode("overwrite").json(path)
    return path


def read_metrics_history(spark: SparkSession, base: str) -> DataFrame:
    """One row per run, oldest first; a metric the file lacks is 0."""
    files = spark.read.schema(METRICS_JSON).json(f"{base.rstrip('/')}/metrics_*.json")
    stamp = F.regexp_extract(F.col("_metadata.file_path"), r"metrics_(\d{8}_\d{6})\.json", 1)
    return files.select(
        F.to_timestamp(stamp, "yyyyMMdd_HHmmss").alias("timestamp"),
        *[F.coalesce(F.col(m), F.lit(0.0)).alias(m) for m in MODEL_METRICS],
    ).orderBy("timestamp")


def latest_metrics(history: DataFrame) -> DataFrame:
    """The newest run's metrics."""
    return history.orderBy(F.desc("timestamp")).limit(1)


def save_model(spark: SparkSession, model, base: str, run: datetime) -> str:
    """Store a trained model with its preparation, names and metrics."""
    stamp = run.strftime(STAMP)
    path = f"{base.rstrip('/')}/model_{stamp}"
    model.pipeline.write().overwrite().save(f"{path}/pipeline")
    info = [(model.kind, model.numeric, model.categorical, model.names)]
    spark.createDataFrame(info, INFO).coalesce(1).write.mode("overwrite").json(f"{path}/info")
    write_metrics(spark, model.metrics, base, run)
    return path


def _runs(spark: SparkSession, base: str) -> DataFrame:
    info = spark.read.schema(INFO).json(f"{base.rstrip('/')}/model_*/info")
    stamp = F.regexp_extract(F.col("_metadata.file_path"), r"model_(\d{8}_\d{6})/", 1)
    return info.withColumn("stamp", stamp)


def load_model(spark: SparkSession, base: str, stamp: str | None = None):
    """The pipeline, and its version, of the given or the latest run."""
    if stamp is None:
        stamp = _runs(spark, base).agg(F.max("stamp").alias("stamp")).first()["stamp"]
    return PipelineModel.load(f"{base.rstrip('/')}/model_{stamp}/pipeline"), stamp


def model_info(spark: SparkSession, base: str, importance: DataFrame | None = None) -> DataFrame:
    """The latest model as one row: version, type, date, metrics and importances as maps."""
    latest = _runs(spark, base).orderBy(F.desc("stamp")).limit(1)
    metrics = latest_metrics(read_metrics_history(spark, base))
    trained = F.to_timestamp("stamp", "yyyyMMdd_HHmmss")
    figures = F.create_map(*[x for m in MODEL_METRICS for x in (F.lit(m), F.col(m))])
    info = latest.join(metrics, trained == metrics["timestamp"]).select(
        F.date_format(trained, "yyyy-MM-dd HH:mm:ss").alias("model_version"),
        "model_type",
        F.date_format(trained, "yyyy-MM-dd HH:mm:ss").alias("training_date"),
        figures.alias("metrics"),
    )
    if importance is None:
        return info.withColumn("feature_importance", F.lit(None).cast("map<string,double>"))
    # one entry per model feature
    pairs = importance.agg(F.collect_list(F.struct("feature", "importance")).alias("p")).scalar()
    return info.withColumn("feature_importance", F.map_from_entries(pairs))
