"""Daily features that late records amend.

Per customer and day a stream keeps sums, counts and the set of promotion codes.
Each micro-batch adds its records to the days they belong to, also to a day that
was seen before, and writes these days alone; the open day is readable at any
time. Records of a day that was closed, by more than the delay, before their
batch came are not added: they are kept apart and counted.

A batch leaves its traces below its own number, the state last, so a batch that is
repeated after a failure counts once.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.daily import day_state, features_of_state, merged_state
from ..session import materialize
from ..sources.snapshots import expire_snapshots, read_snapshot, snapshot_versions, update_snapshot

#: Days come first in the key, so that a batch touches the ranges of its days.
_ID = "day_key"
_PROGRESS = "batch bigint, records bigint, late bigint, newest timestamp"


def _path(base: str, part: str, batch: int | None = None) -> str:
    return f"{base.rstrip('/')}/{part}" + ("" if batch is None else f"/batch={batch}")


def _keyed(state: DataFrame) -> DataFrame:
    unknown = F.coalesce(F.col("customer_id"), F.lit(""))
    return state.withColumn(_ID, F.concat_ws("|", F.coalesce(F.col("event_date").cast("string"), F.lit("")), F.col("customer_id").isNull().cast("string"), unknown))


def stream_progress(spark: SparkSession, base: str) -> DataFrame:
    """Per batch: its records, how many of them came late, and the newest time up to it."""
    try:
        return spark.read.schema(_PROGRESS).parquet(_path(base, "progress"))
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], _PROGRESS)


def add_batch(cdr: DataFrame, base: str, batch: int, delay: str = "1 hour", keep: int = 8) -> None:
    """Add a batch of cleaned call records to the days below ``base``; again it does nothing."""
    spark = cdr.sparkSession
    state_path = _path(base, "state")
    done = snapshot_versions(spark, state_path)
    if done and done[-1] >= batch:
        return
    records = materialize(cdr.withColumn("call_time", F.col("call_time").cast("timestamp")), "stream-batch")
    before = stream_progress(spark, base).filter(F.col("batch") < batch).agg(F.max("newest")).first()[0]
    closed = F.to_date("call_time") + F.expr("INTERVAL 1 DAY") <= F.lit(before) - F.expr(f"INTERVAL {delay}")
    late = F.coalesce(closed, F.lit(False)) if before is not None else F.lit(False)
    records.filter(late).write.mode("overwrite").parquet(_path(base, "late", batch))
    figures = records.agg(
        F.lit(batch).cast("bigint").alias("batch"),
        F.count(F.lit(1)).alias("records"),
        F.count_if(late).alias("late"),
        F.greatest(F.max("call_time"), F.lit(before).cast("timestamp")).alias("newest"),
    )
    figures.drop("batch").coalesce(1).write.mode("overwrite").parquet(_path(base, "progress", batch))

    def combine(new: DataFrame, stored: DataFrame) -> DataFrame:
        old = stored.join(new.select(_ID), _ID, "left_semi")
        return _keyed(merged_state(new.drop(_ID).unionByName(old.drop(_ID))))

    update_snapshot(_keyed(day_state(records.filter(~late))), state_path, combine, _ID, batch)
    expire_snapshots(spark, state_path, keep)


def stream_day_state(stream: DataFrame, base: str, checkpoint: str, delay: str = "1 hour", keep: int = 8) -> None:
    """Add everything that has arrived to the days below ``base`` and stop; ``base`` goes with the checkpoint."""
    query = (
        stream.writeStream.foreachBatch(lambda batch, number: add_batch(batch, base, number, delay, keep))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def read_day_features(spark: SparkSession, base: str, delay: str = "1 hour") -> DataFrame:
    """Daily features of all days so far, with ``closed``: whether records of the day would now come too late."""
    newest = stream_progress(spark, base).agg(F.max("newest").alias("t")).scalar()
    state = read_snapshot(spark, _path(base, "state"), key=_ID).drop(_ID)
    closed = F.col("event_date") + F.expr("INTERVAL 1 DAY") <= newest - F.expr(f"INTERVAL {delay}")
    return features_of_state(state).withColumn("closed", F.coalesce(closed, F.lit(False)))


def late_records(spark: SparkSession, base: str) -> DataFrame:
    """The records that came too late for their day, with the ``batch`` they came in."""
    found = spark.read.parquet(_path(base, "late"))
    return found.withColumn("batch", F.col("batch").cast("bigint"))
