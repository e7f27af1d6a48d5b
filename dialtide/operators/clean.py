"""Cleaning of raw call records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import call_date_parts


def _valid() -> Column:
    return (
        (F.col("call_duration_seconds") > 0)
        & F.col("customer_id").isNotNull()
        & F.col("call_time").isNotNull()
    )


def clean_cdr(cdr: DataFrame) -> DataFrame:
    """Keep records with a positive duration, a customer and a time."""
    return cdr.filter(_valid())


def rejected_cdr(cdr: DataFrame) -> DataFrame:
    """The records :func:`clean_cdr` drops, with the first reason that applies."""
    duration = F.col("call_duration_seconds")
    reason = (
        F.when(F.col("customer_id").isNull(), "missing_customer")
        .when(F.col("call_time").isNull(), "missing_time")
        .when(duration.isNull(), "missing_duration")
        .otherwise("non_positive_duration")
    )
    return cdr.filter(~F.coalesce(_valid(), F.lit(False))).withColumn("reason", reason)


def add_date_parts(cdr: DataFrame) -> DataFrame:
    """Add call_date, year, month, day and hour."""
    return cdr.withColumns(call_date_parts(F.col("call_time")))


def daily_paths(days: DataFrame, raw_base: str, silver_base: str, date: str = "call_date") -> DataFrame:
    """Raw and cleaned locations of each day in ``days``."""
    text = F.date_format(date, "yyyy-MM-dd")
    return days.select(
        date,
        F.concat(F.lit(f"{raw_base}/cdr/"), text, F.lit("/")).alias("raw_path"),
        F.concat(F.lit(f"{silver_base}/cdr/dt="), text, F.lit("/")).alias("silver_path"),
    )
