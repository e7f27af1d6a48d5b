"""Daily ingest: new raw files → checked, cleaned, partitioned records."""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from ..operators.clean import add_date_parts, clean_cdr
from ..operators.quality import require_gate, run_suite
from ..session import materialize
from ..sources.cdr_csv import quarantine_rows, read_cdr_csv, silver_path
from ..sources.tables import list_new_files, mark_processed, publish_run, write_silver


@dataclass
class IngestResult:
    """What a run did: files read, rows written, where, and the run's name."""

    files: int
    rows: int
    path: str | None
    run: str | None = None


def clean_to_silver(spark: SparkSession, raw: str | list[str], silver: str) -> int:
    """Read, clean and write raw files, replacing the days they hold; returns the rows written."""
    return write_silver(add_date_parts(clean_cdr(read_cdr_csv(spark, raw))), silver)


def run_name(files: DataFrame) -> str:
    """A name fixed by the files of a run, from a sum over hashes of their paths: no list of them is gathered."""
    row = files.selectExpr("count(*) AS n", "sum(CAST(xxhash64(path) AS DECIMAL(38, 0))) AS s").first()
    return hashlib.md5(f"{row['n']}:{row['s']}".encode()).hexdigest()[:12]


def ingest_day(
    spark: SparkSession,
    raw_base: str,
    silver_base: str,
    date: str,
    ledger_path: str | None = None,
    quarantine: str | None = None,
) -> IngestResult:
    """One day's run: list new files, clean and check them, then publish and record them.

    The batch is checked where it is staged, so a refused batch is never
    readable. A run writes below its own name, ``run=…``, and leaves what
    earlier runs of the day published; a run that is repeated after a failure
    replaces its own rows, also if it meets more files than before. Malformed
    rows go to ``quarantine`` in the same way, at the price of a second read of
    the files. A run's rows are visible once it is published, by a mark written
    last; files are recorded, with the run, after that.
    """
    ledger = _read(spark, ledger_path) if ledger_path else None
    files = materialize(list_new_files(spark, raw_base, date, ledger), "new-files")
    count = files.count()
    if not count:
        return IngestResult(0, 0, None)
    run, out = run_name(files), silver_path(silver_base, date)
    # Spark takes the paths to read from the driver: the files of one day, not their records
    paths = [r["path"] for r in files.select("path").toLocalIterator()]
    staged = materialize(add_date_parts(clean_cdr(read_cdr_csv(spark, paths))), "staged")
    require_gate(run_suite(staged))
    rows = write_silver(staged, out, run=run)
    if quarantine:
        quarantine_rows(spark, paths).write.mode("overwrite").parquet(f"{quarantine.rstrip('/')}/run={run}")
    publish_run(files, out, run, ledger)
    if ledger_path:
        mark_processed(files, ledger_path, run)
    return IngestResult(count, rows, out, run)


def _read(spark: SparkSession, path: str) -> DataFrame | None:
    """The table at ``path``; None if there is nothing there."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
