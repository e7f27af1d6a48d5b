"""Daily, monthly and trailing features."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import fixtures as fx
from ..functions import is_international, is_promo, peak_flag, weekend_flag
from ..operators import clean, daily, rolling
from .base import month_of, query, register, sql

#: Daily metrics; True marks a fractional one.
METRICS = {
    "event_timestamp": False,
    "daily_total_minutes": True,
    "daily_total_calls": False,
    "daily_total_sms": False,
    "daily_total_data_mb": True,
    "avg_call_duration": True,
    "peak_hour_usage_pct": True,
    "weekend_usage_pct": True,
    "dropped_calls_pct": True,
    "customer_service_calls": False,
    "international_calls_count": False,
    "daily_charges": True,
    "avg_daily_charge": True,
    "active_promotions_count": False,
    "promo_usage_pct": True,
    "created_timestamp": False,
}


def daily_frame(spark, sf_dir):
    return daily.daily_features(clean.clean_cdr(fx.cdr(spark, sf_dir)))


def _fractional(names):
    return tuple(n for n in names if METRICS.get(n))


def _register_metric(name: str) -> None:
    register(
        name,
        lambda spark, sf_dir: daily_frame(spark, sf_dir).select(*daily.KEY, name),
        sql(f"SELECT customer_id, event_date, {name} FROM daily", ("daily",), _fractional([name])),
    )


for _name in METRICS:
    _register_metric(_name)


def _register_table(name: str, project, metrics: list[str]) -> None:
    columns = [*daily.KEY, "event_timestamp", *metrics, "created_timestamp"]
    register(
        name,
        lambda spark, sf_dir: project(daily_frame(spark, sf_dir)),
        sql(f"SELECT {', '.join(columns)} FROM daily", ("daily",), _fractional(metrics)),
    )


_register_table("cdr_statistics", daily.cdr_statistics, daily.STATISTICS)
_register_table("billing_daily", daily.billing_daily, daily.BILLING)
_register_table("promotion_daily", daily.promotion_daily, daily.PROMOTION)


@query("daily_features", "SELECT * FROM daily", ("daily",), _fractional(METRICS))
def daily_features(spark, sf_dir):
    return daily_frame(spark, sf_dir)


@query(
    "customer_charges",
    """
SELECT customer_id, sum(call_charge) AS total_charges, count(DISTINCT CAST(call_time AS DATE)) AS active_days,
       sum(call_charge) / count(DISTINCT CAST(call_time AS DATE)) AS avg_daily_charge
FROM clean GROUP BY customer_id""",
    ("clean",),
    ("total_charges", "avg_daily_charge"),
)
def customer_charges(spark, sf_dir):
    return daily.customer_charges(daily_frame(spark, sf_dir))


def _flag(spark, sf_dir, column, name):
    return fx.cdr(spark, sf_dir).select("call_id", column.alias(name))


@query(
    "peak_flag",
    "SELECT call_id, hour(call_time) IN (17, 18, 19, 20, 21) AS peak FROM cdr",
    ("cdr",),
)
def peak(spark, sf_dir):
    return _flag(spark, sf_dir, peak_flag(F.col("call_time")), "peak")


@query(
    "weekend_flag",
    "SELECT call_id, isodow(call_time) >= 6 AS weekend FROM cdr",
    ("cdr",),
)
def weekend(spark, sf_dir):
    return _flag(spark, sf_dir, weekend_flag(F.col("call_time")), "weekend")


@query(
    "conditional_pick",
    """
SELECT call_id, CASE WHEN call_type = 'VOICE' THEN call_duration_seconds ELSE 0 END AS voice_seconds,
       CASE WHEN call_type = 'VOICE' THEN call_duration_seconds END AS voice_seconds_or_null,
       call_type = 'VOICE' AND destination_number LIKE '+%' AND destination_number NOT LIKE '+1%' AS international,
       promotion_code <> 'NONE' AS promo
FROM cdr""",
    ("cdr",),
)
def conditional_pick(spark, sf_dir):
    voice, seconds = F.col("call_type") == "VOICE", F.col("call_duration_seconds")
    return fx.cdr(spark, sf_dir).select(
        "call_id",
        F.when(voice, seconds).otherwise(0).alias("voice_seconds"),
        F.when(voice, seconds).alias("voice_seconds_or_null"),
        is_international(F.col("call_type"), F.col("destination_number")).alias("international"),
        is_promo(F.col("promotion_code")).alias("promo"),
    )


def _bills(spark, sf_dir):
    return rolling.monthly_bill_amount(fx.charges(spark, sf_dir))


@query("monthly_bill_amount", "SELECT * FROM bills", ("bills",), ("monthly_bill_amount",))
def monthly_bill_amount(spark, sf_dir):
    return _bills(spark, sf_dir)


@query(
    "bill_fluctuation",
    "SELECT customer_id, month_index, monthly_bill_amount, bill_fluctuation FROM bill_windows",
    ("bill_windows",),
    ("monthly_bill_amount", "bill_fluctuation"),
)
def bill_fluctuation(spark, sf_dir):
    return rolling.bill_fluctuation(_bills(spark, sf_dir))


@query(
    "total_charges_3m",
    "SELECT customer_id, month_index, monthly_bill_amount, total_charges_3m FROM bill_windows",
    ("bill_windows",),
    ("monthly_bill_amount", "total_charges_3m"),
)
def total_charges_3m(spark, sf_dir):
    return rolling.total_charges_3m(_bills(spark, sf_dir))


@query("payment_delay_days", "SELECT * FROM delays", ("delays",), ("payment_delay_days",))
def payment_delay_days(spark, sf_dir):
    return rolling.payment_delays(fx.payments(spark, sf_dir))


@query("overdue_payments_3m", "SELECT * FROM delay_windows", ("delay_windows",), ("payment_delay_days",))
def overdue_payments_3m(spark, sf_dir):
    return rolling.overdue_payments_3m(payment_delay_days(spark, sf_dir))


BILLING_DOUBLES = ("monthly_bill_amount", "bill_fluctuation", "total_charges_3m", "payment_delay_days")


def billing_frame(spark, sf_dir):
    return rolling.billing_features(fx.charges(spark, sf_dir), fx.payments(spark, sf_dir))


def promotion_frame(spark, sf_dir):
    return rolling.promotion_features(daily_frame(spark, sf_dir), fx.discounts(spark, sf_dir))


@query("billing_features", "SELECT * FROM billing_features", ("billing_features",), BILLING_DOUBLES)
def billing_features(spark, sf_dir):
    return billing_frame(spark, sf_dir)


@query(
    "promo_response_rate",
    "SELECT customer_id, event_date, promo_response_rate FROM promo_windows",
    ("promo_windows",),
    ("promo_response_rate",),
)
def promo_response_rate(spark, sf_dir):
    rated = rolling.promo_response_rate(daily_frame(spark, sf_dir))
    return rated.select(*daily.KEY, "promo_response_rate")


@query(
    "days_since_last_promo",
    "SELECT customer_id, event_date, CAST(since AS INTEGER) AS days_since_last_promo FROM promo_windows",
    ("promo_windows",),
)
def days_since_last_promo(spark, sf_dir):
    return rolling.days_since_last_promo(daily_frame(spark, sf_dir)).select(*daily.KEY, "days_since_last_promo")


@query("promo_discount_amount", "SELECT * FROM discount_months", ("discount_months",), ("promo_discount_amount",))
def promo_discount_amount(spark, sf_dir):
    return rolling.promo_discount_amount(fx.discounts(spark, sf_dir))


@query(
    "promotion_features",
    "SELECT * FROM promotion_features",
    ("promotion_features",),
    ("promo_response_rate", "promo_discount_amount"),
)
def promotion_features(spark, sf_dir):
    return promotion_frame(spark, sf_dir)


PROFILE_DOUBLES = ("monthly_charges", "total_charges")


@query("customer_profile", "SELECT * FROM customer_profile", ("customer_profile",), PROFILE_DOUBLES)
def customer_profile(spark, sf_dir):
    return fx.customer_profile(spark, sf_dir)


@query(
    "month_index",
    f"SELECT o_orderkey, {month_of('order_time')} AS month_index FROM history",
    ("history",),
)
def month_index(spark, sf_dir):
    from ..functions import month_index as index

    return fx.history(spark, sf_dir).select("o_orderkey", index(F.col("order_time")).alias("month_index"))
