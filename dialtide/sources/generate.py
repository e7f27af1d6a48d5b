"""Synthetic call records, made on the executors and fixed by the seed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import hash_uniform
from ..schemas import CALL_RESULTS, CALL_TYPES, CUSTOMER_SERVICE, NETWORK_TYPES, PROMOTION_CODES

SERVICE_SHARE = 0.02


def generate_cdr(spark: SparkSession, rows: int, seed: int = 42, last_day: str = "2024-01-31") -> DataFrame:
    """``rows`` records of max(100, rows / 100) customers over 31 days.

    Every value is a function of the row number and the seed, so a retried task
    makes the same rows. All values of every domain occur.
    """

    def draw(what: str) -> Column:
        return hash_uniform(F.col("id"), F.lit(what), F.lit(seed))

    def whole(what: str, low: int, high: int) -> Column:
        return (F.lit(low) + F.floor(draw(what) * (high - low + 1))).cast("bigint")

    def pick(what: str, values: list[str]) -> Column:
        return F.element_at(F.array(*map(F.lit, values)), whole(what, 1, len(values)).cast("int"))

    customers = max(100, rows // 100)
    start = F.unix_seconds(F.lit(f"{last_day} 23:59:00").cast("timestamp"))
    minutes_back = whole("day", 0, 30) * 1440 + whole("hour", 0, 23) * 60 + whole("minute", 0, 59)
    number = F.concat(F.lit("+1"), whole("number", 2_000_000_000, 9_999_999_999).cast("string"))
    return spark.range(rows).select(
        F.md5(F.concat(F.col("id").cast("string"), F.lit(f":{seed}"))).alias("call_id"),
        F.format_string("CUST%06d", whole("customer", 0, customers - 1)).alias("customer_id"),
        F.timestamp_seconds(start - minutes_back * 60).alias("call_time"),
        whole("duration", 5, 1800).cast("int").alias("call_duration_seconds"),
        pick("type", CALL_TYPES).alias("call_type"),
        F.when(draw("service") < SERVICE_SHARE, CUSTOMER_SERVICE).otherwise(number).alias("destination_number"),
        pick("network", NETWORK_TYPES).alias("network_type"),
        F.format_string("TOWER%04d", whole("tower", 1, 1000)).alias("cell_tower_id"),
        pick("result", CALL_RESULTS).alias("call_result"),
        F.round(0.01 + draw("charge") * 14.99, 2).cast("float").alias("call_charge"),
        pick("promotion", PROMOTION_CODES).alias("promotion_code"),
    )
