"""File-stream ingest, de-duplication, daily features and pushed snapshots.

The transformations are the batch ones wherever streaming allows. Checkpoints
and outputs belong in the shared folder: a restarted query continues there.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.clean import add_date_parts, clean_cdr
from ..operators.daily import usage_metrics
from ..sources.cdr_csv import CSV_OPTIONS, text_schema, typed_records
from ..sources.tables import expire_snapshots, merge_snapshot, read_snapshot


def stream_ingest(
    spark: SparkSession,
    folder: str,
    schema: T.StructType | None = None,
    file_format: str = "csv",
    max_files: int | None = None,
    name_filter: str | None = None,
) -> DataFrame:
    """New files of a folder as a stream of well-formed call records.

    The checkpoint of the query that reads it remembers the files already seen.
    With ``schema`` the files are read as they are, without CSV conversion.
    """
    reader = spark.readStream
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if name_filter:
        reader = reader.option("pathGlobFilter", name_filter)
    if schema is not None:
        return reader.schema(schema).format(file_format).load(folder)
    raw = (
        reader.schema(text_schema())
        .options(**CSV_OPTIONS)
        .csv(folder)
    )
    return typed_records(raw)


def stream_clean(cdr: DataFrame) -> DataFrame:
    """The batch cleaning and date columns on a stream."""
    return add_date_parts(clean_cdr(cdr))


def _with_watermark(cdr: DataFrame, delay: str) -> DataFrame:
    # watermarks need a zoned timestamp
    return cdr.withColumn("call_time", F.col("call_time").cast("timestamp")).withWatermark("call_time", delay)


def stream_dedupe(cdr: DataFrame, delay: str = "1 day") -> DataFrame:
    """Drop repeats of a call id that arrive within ``delay`` of the first."""
    return _with_watermark(cdr, delay).dropDuplicatesWithinWatermark(["call_id"])


def stream_daily_features(cdr: DataFrame, delay: str = "1 hour") -> DataFrame:
    """Daily features per customer, emitted once the watermark passes the day.

    Streams have no distinct count; the codes a customer used in a day are
    collected instead, a set no larger than the list of promotions.
    """
    aggs = usage_metrics() | {"active_promotions_count": F.size(F.collect_set("promotion_code")).cast("bigint")}
    day = F.window("call_time", "1 day")
    return (
        _with_watermark(cdr, delay)
        .groupBy("customer_id", day)
        .agg(*[c.alias(n) for n, c in aggs.items()])
        .withColumn("event_date", F.to_date("window.start"))
        .withColumn("avg_daily_charge", F.col("daily_charges"))
        .drop("window")
    )


def run_available(stream: DataFrame, path: str, checkpoint: str, mode: str = "append") -> None:
    """Process everything that has arrived into Parquet at ``path`` and stop."""
    query = (
        stream.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode(mode)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def push_latest(stream: DataFrame, path: str, checkpoint: str, keep: int = 8) -> None:
    """Merge each batch's newest feature row per customer into the stored snapshot.

    A batch writes the customers it changes, not the snapshot. Merging is
    repeatable: a replayed batch, also one under a new checkpoint, changes no
    value, and a lookup reads one row per customer, not all pushes. The newest
    ``keep`` versions stay readable.
    """

    def push(batch: DataFrame, batch_id: int) -> None:
        merge_snapshot(batch, path)
        expire_snapshots(batch.sparkSession, path, keep)

    query = (
        stream.writeStream.foreachBatch(push)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def read_pushed(spark: SparkSession, path: str) -> DataFrame:
    """The newest row per customer over all pushed batches."""
    return read_snapshot(spark, path)
