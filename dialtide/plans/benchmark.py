"""Timing of the ingest job over generated call records."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession

from ..schemas import BENCHMARK_ROWS
from ..session import scratch_dir
from ..sources.cdr_csv import write_cdr_csv
from ..sources.generate import generate_cdr
from ..sources.tables import write_benchmark_results
from .ingest import clean_to_silver


def benchmark_once(spark: SparkSession, rows: int, repetition: int) -> tuple:
    """Generate raw files, then time reading, cleaning and writing them."""
    raw, silver = scratch_dir(spark, "bench-raw"), scratch_dir(spark, "bench-silver")
    write_cdr_csv(generate_cdr(spark, rows, seed=repetition), raw)
    start = time.perf_counter()
    written = clean_to_silver(spark, raw, silver)
    seconds = time.perf_counter() - start
    executors = len(spark.sparkContext._jsc.sc().statusTracker().getExecutorInfos())
    return rows, repetition, seconds, None, written, written / seconds, executors


def run_benchmark(
    spark: SparkSession, row_counts: list[int], repetitions: int = 3, path: str | None = None
) -> DataFrame:
    """One row per run; memory is left null, as executors' memory is not the driver's to sample."""
    runs = [benchmark_once(spark, n, r) for n in row_counts for r in range(1, repetitions + 1)]
    results = spark.createDataFrame(runs, BENCHMARK_ROWS)
    if path:
        write_benchmark_results(results, path)
    return results
