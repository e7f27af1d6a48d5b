"""Per customer and day features, all from one pass over the call records.

The statistics, billing and promotion tables share their grouping key, so one
aggregate computes every column and each table is a projection of it; Catalyst
drops the aggregates a projection does not use.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import created_timestamp, is_international, is_promo, peak_flag, weekend_flag

KEY = ["customer_id", "event_date"]

STATISTICS = [
    "daily_total_minutes",
    "daily_total_calls",
    "daily_total_sms",
    "daily_total_data_mb",
    "avg_call_duration",
    "peak_hour_usage_pct",
    "weekend_usage_pct",
    "dropped_calls_pct",
    "customer_service_calls",
]
BILLING = ["daily_charges", "avg_daily_charge"]
PROMOTION = ["active_promotions_count", "promo_usage_pct"]


def _percent(part: Column, whole: Column) -> Column:
    return part / whole * 100


def usage_metrics() -> dict[str, Column]:
    """Aggregates over one group of call records that also work on a stream."""
    kind, seconds = F.col("call_type"), F.col("call_duration_seconds").cast("double")
    rows = F.count(F.lit(1))
    voice = F.count_if(kind == "VOICE")
    dropped = F.count_if(F.col("call_result") == "DROPPED")
    return {
        "event_timestamp": F.max("call_time"),
        "daily_total_minutes": F.sum(F.when(kind == "VOICE", seconds / 60).otherwise(0.0)),
        "daily_total_calls": voice,
        "daily_total_sms": F.count_if(kind == "SMS"),
        "daily_total_data_mb": F.sum(F.when(kind == "DATA", seconds * 0.001).otherwise(0.0)),
        "avg_call_duration": F.avg(F.when(kind == "VOICE", seconds)),
        "peak_hour_usage_pct": _percent(F.count_if(peak_flag(F.col("call_time"))), rows),
        "weekend_usage_pct": _percent(F.count_if(weekend_flag(F.col("call_time"))), rows),
        "dropped_calls_pct": _percent(dropped, F.nullif(voice, F.lit(0))),
        "customer_service_calls": F.count_if(F.col("destination_number") == "CUSTOMER_SERVICE"),
        "international_calls_count": F.count_if(is_international(kind, F.col("destination_number"))),
        "daily_charges": F.sum("call_charge"),
        "promo_usage_pct": _percent(F.count_if(is_promo(F.col("promotion_code"))), rows),
        "promo_rows": F.count_if(is_promo(F.col("promotion_code"))),
        "total_rows": rows,
    }


def daily_features(cdr: DataFrame) -> DataFrame:
    """Every daily metric, keyed by customer and date.

    The distinct promotion count is exact. Spark first combines rows by (key,
    code) and then by key, so a very active customer is reduced map-side.
    ``avg_daily_charge`` at this grain spans one date and equals the day's sum.
    """
    aggs = usage_metrics() | {"active_promotions_count": F.count_distinct("promotion_code")}
    return (
        cdr.groupBy("customer_id", F.to_date("call_time").alias("event_date"))
        .agg(*[c.alias(n) for n, c in aggs.items()])
        .withColumn("avg_daily_charge", F.col("daily_charges"))
        .withColumn("created_timestamp", created_timestamp(F.col("event_timestamp")))
    )


def day_state(cdr: DataFrame) -> DataFrame:
    """What :func:`daily_features` needs of each customer and day, in parts that add up over batches of records.

    The codes of a day are kept as a set, no larger than the list of promotions.
    """
    kind, seconds = F.col("call_type"), F.col("call_duration_seconds").cast("double")
    counts = {
        "voice": kind == "VOICE",
        "sms": kind == "SMS",
        "dropped": F.col("call_result") == "DROPPED",
        "peak": peak_flag(F.col("call_time")),
        "weekend": weekend_flag(F.col("call_time")),
        "service": F.col("destination_number") == "CUSTOMER_SERVICE",
        "international": is_international(kind, F.col("destination_number")),
        "promo": is_promo(F.col("promotion_code")),
    }
    return cdr.groupBy("customer_id", F.to_date("call_time").alias("event_date")).agg(
        F.max("call_time").alias("event_timestamp"),
        F.count(F.lit(1)).alias("records"),
        *[F.count_if(c).alias(n) for n, c in counts.items()],
        F.sum(F.when(kind == "VOICE", seconds / 60).otherwise(0.0)).alias("minutes"),
        F.sum(F.when(kind == "VOICE", seconds)).alias("voice_seconds"),
        F.sum(F.when(kind == "DATA", seconds * 0.001).otherwise(0.0)).alias("data_mb"),
        F.sum("call_charge").alias("charges"),
        F.collect_set("promotion_code").alias("codes"),
    )


def merged_state(states: DataFrame) -> DataFrame:
    """One :func:`day_state` per customer and day out of several."""
    summed = [c for c in states.columns if c not in (*KEY, "event_timestamp", "codes")]
    return states.groupBy(*KEY).agg(
        F.max("event_timestamp").alias("event_timestamp"),
        *[F.sum(c).alias(c) for c in summed],
        F.array_distinct(F.flatten(F.collect_list("codes"))).alias("codes"),
    )


def features_of_state(state: DataFrame) -> DataFrame:
    """The columns of :func:`daily_features` out of :func:`day_state`."""
    percent = lambda c: F.col(c) / F.col("records") * 100
    return state.select(
        *KEY,
        "event_timestamp",
        F.col("minutes").alias("daily_total_minutes"),
        F.col("voice").alias("daily_total_calls"),
        F.col("sms").alias("daily_total_sms"),
        F.col("data_mb").alias("daily_total_data_mb"),
        F.try_divide("voice_seconds", "voice").alias("avg_call_duration"),
        percent("peak").alias("peak_hour_usage_pct"),
        percent("weekend").alias("weekend_usage_pct"),
        (F.try_divide("dropped", "voice") * 100).alias("dropped_calls_pct"),
        F.col("service").alias("customer_service_calls"),
        F.col("international").alias("international_calls_count"),
        F.col("charges").alias("daily_charges"),
        percent("promo").alias("promo_usage_pct"),
        F.col("promo").alias("promo_rows"),
        F.col("records").alias("total_rows"),
        F.size("codes").cast("bigint").alias("active_promotions_count"),
        F.col("charges").alias("avg_daily_charge"),
        created_timestamp(F.col("event_timestamp")).alias("created_timestamp"),
    )


def _table(daily: DataFrame, metrics: list[str]) -> DataFrame:
    return daily.select(*KEY, "event_timestamp", *metrics, "created_timestamp")


def cdr_statistics(daily: DataFrame) -> DataFrame:
    """Call statistics table out of :func:`daily_features`."""
    return _table(daily, STATISTICS)


def billing_daily(daily: DataFrame) -> DataFrame:
    """Daily charges table out of :func:`daily_features`."""
    return _table(daily, BILLING)


def promotion_daily(daily: DataFrame) -> DataFrame:
    """Daily promotion table out of :func:`daily_features`."""
    return _table(daily, PROMOTION)


def customer_charges(daily: DataFrame) -> DataFrame:
    """Charges per customer over all days, where the daily average has meaning."""
    return daily.groupBy("customer_id").agg(
        F.sum("daily_charges").alias("total_charges"),
        F.count("event_date").alias("active_days"),
        (F.sum("daily_charges") / F.count("event_date")).alias("avg_daily_charge"),
    )
