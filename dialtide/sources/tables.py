"""Parquet, CSV and file-listing sources and sinks."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..schemas import BENCHMARK_ROWS, CHURN_LABELS, CHURN_TABLE
from ..session import materialize
from .snapshots import expire_snapshots, merge_snapshot, read_snapshot, snapshot_versions, write_snapshot

__all__ = [
    "expire_snapshots",
    "list_new_files",
    "mark_processed",
    "merge_snapshot",
    "publish_run",
    "published_runs",
    "read_churn_table",
    "read_features",
    "read_importance",
    "read_labels_csv",
    "read_silver",
    "read_snapshot",
    "read_training_parquet",
    "snapshot_versions",
    "write_benchmark_results",
    "write_features",
    "write_importance",
    "write_silver",
    "write_snapshot",
]

PARTITIONS = ["year", "month", "day"]
RUN = "run"
#: Below a silver folder: for each run that is published its files, and the runs it takes the place of.
PUBLISHED = "_published"
_MARK = "path string, replaces string"


def write_silver(df: DataFrame, path: str, files_per_day: int = 16, run: str | None = None) -> int:
    """Write cleaned records by day and return their number, counted on the way.

    Rows are gathered by day and customer hash, so a day becomes about
    ``files_per_day`` files and a customer sits in one of them, sorted. The
    rebalance hint lets adaptive execution split a day or customer that is too
    big for one task. Only the days present are replaced; with ``run`` only what
    this run wrote to them before.
    """
    parts = PARTITIONS if run is None else [*PARTITIONS, RUN]
    if run is not None:
        df = df.withColumn(RUN, F.lit(run))
    seen = Observation("silver")
    bucket = F.pmod(F.xxhash64("customer_id"), F.lit(files_per_day))
    (
        df.observe(seen, F.count(F.lit(1)).alias("rows"))
        .withColumn("_file", bucket)
        .hint("rebalance", *[F.col(c) for c in (*PARTITIONS, "_file")])
        .drop("_file")
        .sortWithinPartitions(*PARTITIONS, "customer_id", "call_time")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "snappy")
        .partitionBy(*parts)
        .parquet(path)
    )
    return seen.get["rows"]


def read_silver(
    spark: SparkSession, path: str, start: str | None = None, end: str | None = None, ledger: DataFrame | None = None
) -> DataFrame:
    """Cleaned records; ``start`` and ``end`` (ISO dates, inclusive) prune day folders.

    Of rows that were written by runs, those of published runs count, see
    :func:`publish_run`, and with ``ledger`` only those of runs recorded there;
    so a run that broke off is not seen. Rows written without runs all count.

    Partition values are read as text and cast, so ids that look like numbers
    are never retyped by inference.
    """
    df = spark.read.parquet(path)
    parts = {c: F.col(c).cast("int") for c in PARTITIONS if c in df.columns}
    as_number = parts["year"] * 10000 + parts["month"] * 100 + parts["day"]
    if start:
        df = df.filter(as_number >= int(start.replace("-", "")))
    if end:
        df = df.filter(as_number <= int(end.replace("-", "")))
    if RUN in df.columns:
        visible = published_runs(spark, path) if ledger is None else ledger.select(RUN).distinct()
        df = df.join(visible, RUN, "left_semi")
    return df.withColumns(parts).drop(RUN)


def _marks(spark: SparkSession, path: str) -> DataFrame:
    """The files and replaced runs of each published run: run, path, replaces."""
    try:
        return spark.read.schema(f"{_MARK}, {RUN} string").parquet(f"{path.rstrip('/')}/{PUBLISHED}")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], f"{_MARK}, {RUN} string")


def published_runs(spark: SparkSession, path: str) -> DataFrame:
    """The runs whose rows count: published, and no later run has taken their place."""
    marks = _marks(spark, path)
    replaced = marks.filter("replaces IS NOT NULL").select(F.col("replaces").alias(RUN))
    return marks.select(RUN).distinct().join(replaced, RUN, "left_anti")


def publish_run(files: DataFrame, path: str, run: str, ledger: DataFrame | None = None) -> None:
    """Make what a run wrote below ``path`` visible, by one small file written last.

    ``files`` (path) are those the run has read. A run published before with
    no file beyond these, and not recorded in the ``ledger``, broke off between
    publishing and recording: this run read its files again and takes its place.
    """
    spark = files.sparkSession
    earlier = _marks(spark, path).filter((F.col(RUN) != run) & F.col("path").isNotNull()).select(RUN, "path")
    if ledger is not None:
        earlier = earlier.join(ledger.select(RUN).distinct(), RUN, "left_anti")
    again = F.col("again").isNotNull()
    read = files.select("path", F.lit(True).alias("again")).distinct()
    replaced = earlier.join(read, "path", "left").groupBy(RUN).agg(F.every(again).alias("all")).filter("all")
    rows = files.select("path", F.lit(None).cast("string").alias("replaces")).union(
        replaced.select(F.lit(None).cast("string"), RUN)
    )
    # written aside first: the mark of a run that is repeated is among what was read
    rows = materialize(rows, "published")
    rows.coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(f"{path.rstrip('/')}/{PUBLISHED}/{RUN}={run}")


FEATURE_FILES = {"cdr_statistics": "cdr_features", "billing": "billing_features", "promotion": "promotion_features"}


def write_features(tables: dict[str, DataFrame], base: str, replace_all: bool = False) -> dict[str, str]:
    """Write each feature table by event date; returns its path by name.

    Only the days that the tables hold are replaced, so a daily run adds its
    day; ``replace_all`` first drops the days written before.
    """
    paths = {}
    for name, df in tables.items():
        paths[name] = f"{base.rstrip('/')}/{FEATURE_FILES.get(name, name)}.parquet"
        (
            df.withColumn("dt", F.to_date("event_timestamp"))
            .hint("rebalance", F.col("dt"))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "static" if replace_all else "dynamic")
            .partitionBy("dt")
            .parquet(paths[name])
        )
    return paths


def read_features(spark: SparkSession, path: str) -> DataFrame:
    """A feature table written by :func:`write_features`."""
    return spark.read.parquet(path).drop("dt")


def read_labels_csv(spark: SparkSession, path: str) -> DataFrame:
    """Churn labels with a fixed schema."""
    return spark.read.schema(CHURN_LABELS).csv(path, header=True)


def read_churn_table(spark: SparkSession, path: str) -> DataFrame:
    """The churn sample CSV: churn first, then ten usage columns."""
    return spark.read.schema(CHURN_TABLE).csv(path, header=True)


def read_training_parquet(spark: SparkSession, path: str) -> DataFrame:
    """A prepared feature table used instead of the feature views."""
    return spark.read.parquet(path)


def write_importance(importance: DataFrame, path: str) -> None:
    """Feature importances as header CSV."""
    importance.write.mode("overwrite").csv(path, header=True)


def read_importance(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("feature string, importance double").csv(path, header=True)


def write_benchmark_results(rows: DataFrame, path: str) -> None:
    """Benchmark rows as header CSV."""
    rows.select(*BENCHMARK_ROWS.names).write.mode("overwrite").csv(path, header=True)


def list_new_files(spark: SparkSession, base: str, date: str, ledger: DataFrame | None = None) -> DataFrame:
    """Files below the day's raw folder not in the ledger: path, length, modified.

    Only file metadata is read. A day without a folder gives no rows.
    """
    schema = "path string, length bigint, modified timestamp"
    try:
        found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(
            f"{base.rstrip('/')}/cdr/{date}"
        )
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)
    files = found.select("path", "length", F.col("modificationTime").alias("modified"))
    return files if ledger is None else files.join(ledger.select("path"), "path", "left_anti")


def mark_processed(files: DataFrame, ledger_path: str, run: str = "") -> None:
    """Append the files of a finished run to the ledger."""
    stamped = files.select("path", F.current_timestamp().alias("processed_at"), F.lit(run).alias(RUN))
    stamped.write.mode("append").parquet(ledger_path)
