"""Ingest: readers, writers, cleaning, file lists."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import fixtures as fx
from ..operators import clean, daily, quality, rolling
from ..operators.snapshot import unprocessed_files
from ..plans.features import build_daily_tables
from ..session import scratch_dir
from ..sources import cdr_csv, tables
from .quality import _suite_sql as quality_sql
from .base import query
from .features import METRICS

RAW = "call_id, customer_id, call_time, call_duration_seconds, call_type, destination_number, network_type, " \
    "cell_tower_id, call_result, call_charge, promotion_code"


def _as_local(df):
    """Zoned times back to local ones, which is what the oracle has."""
    return df.withColumn("call_time", F.col("call_time").cast("timestamp_ntz"))


def _csv_copy(spark, sf_dir):
    """The call records as raw CSV files; in some lines the duration or time does not parse."""
    path = scratch_dir(spark, "raw")
    seq = F.substring("call_id", 2, 9).cast("bigint")
    broken = fx.cdr(spark, sf_dir).withColumns(
        {
            "call_duration_seconds": F.when(seq % 17 == 0, "n/a").otherwise(
                F.col("call_duration_seconds").cast("string")
            ),
            "call_time": F.when(seq % 19 == 0, "yesterday").otherwise(F.col("call_time").cast("string")),
        }
    )
    cdr_csv.write_cdr_csv(broken, path)
    return path


@query(
    "read_cdr_csv",
    f"SELECT {RAW} FROM (SELECT * REPLACE (CAST(call_charge AS FLOAT) AS call_charge) FROM cdr_numbered "
    "WHERE event_id % 17 <> 0 AND event_id % 19 <> 0)",
    ("cdr_numbered",),
    ("call_charge",),
)
def read_cdr_csv(spark, sf_dir):
    return _as_local(cdr_csv.read_cdr_csv(spark, _csv_copy(spark, sf_dir)))


@query(
    "quarantine_rows",
    """
SELECT call_id, customer_id, CASE WHEN event_id % 19 = 0 THEN 'call_time' ELSE 'call_duration_seconds' END AS reason
FROM cdr_numbered WHERE event_id % 17 = 0 OR event_id % 19 = 0""",
    ("cdr_numbered",),
)
def quarantine_rows(spark, sf_dir):
    return cdr_csv.quarantine_rows(spark, _csv_copy(spark, sf_dir)).select("call_id", "customer_id", "reason")


@query("clean_cdr", "SELECT * FROM clean", ("clean",), ("call_charge",))
def clean_cdr(spark, sf_dir):
    return clean.clean_cdr(fx.cdr(spark, sf_dir))


@query(
    "rejected_cdr",
    f"""
SELECT {RAW}, CASE WHEN customer_id IS NULL THEN 'missing_customer' WHEN call_time IS NULL THEN 'missing_time'
                   WHEN call_duration_seconds IS NULL THEN 'missing_duration' ELSE 'non_positive_duration' END AS reason
FROM cdr_dirty WHERE customer_id IS NULL OR call_time IS NULL OR call_duration_seconds IS NULL
                  OR call_duration_seconds <= 0""",
    ("cdr_dirty",),
    ("call_charge",),
)
def rejected_cdr(spark, sf_dir):
    return _as_local(clean.rejected_cdr(fx.cdr_dirty(spark, sf_dir)))


@query("add_date_parts", "SELECT * FROM dated", ("dated",), ("call_charge",))
def add_date_parts(spark, sf_dir):
    return clean.add_date_parts(clean.clean_cdr(fx.cdr(spark, sf_dir)))


def _silver(spark, sf_dir):
    path = scratch_dir(spark, "silver")
    rows = tables.write_silver(add_date_parts(spark, sf_dir), path)
    return path, rows


@query("write_silver", "SELECT * FROM dated", ("dated",), ("call_charge",))
def write_silver(spark, sf_dir):
    return tables.read_silver(spark, _silver(spark, sf_dir)[0])


@query(
    "read_silver",
    "SELECT * FROM dated WHERE call_date BETWEEN DATE '2024-01-08' AND DATE '2024-01-21'",
    ("dated",),
    ("call_charge",),
)
def read_silver(spark, sf_dir):
    return tables.read_silver(spark, _silver(spark, sf_dir)[0], "2024-01-08", "2024-01-21")


@query("processed_count", "SELECT count(*) AS rows FROM clean", ("clean",))
def processed_count(spark, sf_dir):
    rows = _silver(spark, sf_dir)[1]
    return spark.range(1).select(F.lit(rows).cast("bigint").alias("rows"))


def _days(spark, sf_dir):
    return fx.cdr(spark, sf_dir).select(F.to_date("call_time").alias("call_date")).distinct()


@query(
    "daily_path",
    """
SELECT DISTINCT CAST(call_time AS DATE) AS call_date,
       concat('raw/cdr/', strftime(call_time, '%Y-%m-%d'), '/') AS raw_path,
       concat('silver/cdr/dt=', strftime(call_time, '%Y-%m-%d'), '/') AS silver_path
FROM cdr""",
    ("cdr",),
)
def daily_path(spark, sf_dir):
    return clean.daily_paths(_days(spark, sf_dir), "raw", "silver")


@query(
    "list_new_files",
    "SELECT DISTINCT CAST(call_time AS DATE) AS call_date FROM cdr WHERE call_time >= DATE '2024-01-16'",
    ("cdr",),
)
def list_new_files(spark, sf_dir):
    base = scratch_dir(spark, "landing")
    records = fx.cdr(spark, sf_dir).withColumn("day", F.to_date("call_time"))
    records.hint("rebalance", F.col("day")).write.partitionBy("day").csv(f"{base}/cdr", header=True)
    day = F.regexp_extract("path", r"day=(\d{4}-\d{2}-\d{2})/", 1).cast("date")
    files = tables.list_new_files(spark, base, "")
    ledger = files.filter(day < "2024-01-16")
    return tables.list_new_files(spark, base, "", ledger).select(day.alias("call_date")).distinct()


@query(
    "unprocessed_files",
    """
SELECT DISTINCT CAST(call_time AS DATE) AS call_date, concat('raw/cdr/', strftime(call_time, '%Y-%m-%d'), '/') AS path
FROM cdr WHERE call_time >= DATE '2024-01-16'""",
    ("cdr",),
)
def unprocessed(spark, sf_dir):
    paths = daily_path(spark, sf_dir).select("call_date", F.col("raw_path").alias("path"))
    return unprocessed_files(paths, paths.filter("call_date < DATE '2024-01-16'")).select("call_date", "path")


WRITTEN = [*daily.STATISTICS, *daily.BILLING, *daily.PROMOTION]


@query(
    "write_features",
    f"SELECT customer_id, event_date, event_timestamp, created_timestamp, {', '.join(WRITTEN)} FROM daily",
    ("daily",),
    tuple(m for m in WRITTEN if METRICS[m]),
)
def write_features(spark, sf_dir):
    paths = build_daily_tables(clean_cdr(spark, sf_dir), scratch_dir(spark, "gold"))
    stats, billing, promotion = (
        tables.read_features(spark, paths[n]) for n in ("cdr_statistics", "billing", "promotion")
    )
    key = ["customer_id", "event_date"]
    both = stats.join(billing.drop("event_timestamp", "created_timestamp"), key)
    return both.join(promotion.drop("event_timestamp", "created_timestamp"), key)


@query("read_labels_csv", "SELECT * FROM churn_labels", ("churn_labels",))
def read_labels_csv(spark, sf_dir):
    path = scratch_dir(spark, "labels")
    fx.churn_labels(spark, sf_dir).write.csv(path, header=True)
    return tables.read_labels_csv(spark, path)


CHURN_COLUMNS = (
    "churn, account_weeks, contract_renewal, data_plan, data_usage, cust_serv_calls, day_mins, day_calls, "
    "monthly_charge, overage_fee, roam_mins"
)
CHURN_DOUBLES = ("data_usage", "day_mins", "monthly_charge", "overage_fee", "roam_mins")


@query("read_churn_table", f"SELECT {CHURN_COLUMNS} FROM churn_table", ("churn_table",), CHURN_DOUBLES)
def read_churn_table(spark, sf_dir):
    path = scratch_dir(spark, "churn")
    fx.churn_table(spark, sf_dir).select(*CHURN_COLUMNS.split(", ")).write.csv(path, header=True)
    return tables.read_churn_table(spark, path)


@query("read_training_parquet", "SELECT * FROM churn_table", ("churn_table",), CHURN_DOUBLES)
def read_training_parquet(spark, sf_dir):
    path = scratch_dir(spark, "training")
    fx.churn_table(spark, sf_dir).write.parquet(path)
    return tables.read_training_parquet(spark, path)


@query(
    "tenure_days",
    """
SELECT customer_id, CAST(date_diff('day', CAST(min(call_time) AS DATE), DATE '2024-01-31') AS INTEGER) AS tenure_days
FROM clean GROUP BY customer_id""",
    ("clean",),
)
def tenure_days(spark, sf_dir):
    return rolling.tenure_days(clean_cdr(spark, sf_dir), "2024-01-31")


BY_DAY = quality_sql("cdr_dirty", by="CAST(call_time AS DATE)")


@query(
    "quality_gate_by_day",
    f"SELECT count(*) AS checks, count(*) FILTER (WHERE NOT success) AS failed, bool_and(success) AS passed FROM ({BY_DAY})",
    ("cdr_dirty",),
)
def quality_gate_by_day(spark, sf_dir):
    records = fx.cdr_dirty(spark, sf_dir).withColumn("call_date", F.to_date("call_time"))
    return quality.quality_gate(quality.run_suite(records, by=["call_date"]))
