"""Session settings the jobs rely on, and the shared scratch folder."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

#: Runtime settings every job expects. Time zone: dates and hours are UTC.
#: Inference off: a partition value such as ``customer_id=001`` stays text.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply :data:`SETTINGS` to a session the caller already has."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def build_session(app_name: str = "dialtide", master: str | None = None, **extra: str) -> SparkSession:
    """A session with :data:`SETTINGS`; ``extra`` uses ``__`` for dots in names."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in extra.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder named by ``spark.checkpoint.dir``.

    Where that is unset, a folder of the warehouse serves: executors reach both.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts the lineage of a frame that is used many times (each fit of a training
    stage scans it), and survives the loss of any executor.
    """
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    stored = df.sparkSession.read.schema(df.schema).parquet(path)
    stored._stored_at = path
    return stored


def release(*stored: DataFrame) -> None:
    """Empty the tables behind frames of :func:`materialize`; nothing may read these any more."""
    for df in stored:
        spark = df.sparkSession
        spark.range(0).coalesce(1).write.mode("overwrite").parquet(df._stored_at)


def side_by_side(spark: SparkSession, work: Callable, items: Sequence) -> list:
    """``work`` of every item, in their order, each in a thread of its own.

    Jobs of different items then share the cluster: what the short jobs of one
    leave idle is used by the others. For a handful of items, such as folds.
    """
    if not items:
        return []
    with ThreadPool(len(items)) as pool:
        return pool.map(inheritable_thread_target(spark)(work), items, chunksize=1)
