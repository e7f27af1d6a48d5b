from datetime import datetime

import pytest
from helpers import calls, rows_of
from pyspark.sql import functions as F

from dialtide.operators import clean, daily, rolling


def at(hour, minute=0, day=3):
    return datetime(2024, 1, day, hour, minute)


def one(spark, *rows):
    return daily.daily_features(calls(spark, *rows)).first()


def test_peak_includes_both_end_hours(spark):
    got = one(spark, *[{"call_time": at(h, m)} for h, m in ((16, 59), (17, 0), (21, 59), (22, 0))])
    assert got["peak_hour_usage_pct"] == 50.0


@pytest.mark.parametrize("day,share", [(5, 0.0), (6, 100.0), (7, 100.0), (8, 0.0)])  # Fri, Sat, Sun, Mon
def test_weekend(spark, day, share):
    assert one(spark, {"call_time": at(10, day=day)})["weekend_usage_pct"] == share


def test_voice_metrics_are_null_or_zero_without_voice(spark):
    got = one(spark, {"call_type": "SMS", "call_result": "DROPPED"})
    assert got["avg_call_duration"] is None and got["dropped_calls_pct"] is None
    assert got["daily_total_minutes"] == 0.0 and got["daily_total_calls"] == 0


def test_dropped_share_counts_all_types_over_voice(spark):
    got = one(spark, {}, {"call_type": "DATA", "call_result": "DROPPED"}, {"call_type": "SMS", "call_result": "DROPPED"})
    assert got["dropped_calls_pct"] == 200.0


def test_promotions(spark):
    codes = ["NONE", "FRIENDS", "FRIENDS", None]
    got = one(spark, *[{"promotion_code": c} for c in codes])
    assert got["active_promotions_count"] == 2  # NONE counts, null does not
    assert got["promo_usage_pct"] == 50.0  # null is in the denominator only


def test_units_and_international(spark):
    got = one(
        spark,
        {"call_duration_seconds": 90},
        {"call_type": "DATA", "call_duration_seconds": 500, "destination_number": "+44123"},
        {"destination_number": "+44123"},
        {"destination_number": "CUSTOMER_SERVICE"},
    )
    assert got["daily_total_minutes"] == pytest.approx(3.5)
    assert got["daily_total_data_mb"] == pytest.approx(0.5)
    assert got["international_calls_count"] == 1 and got["customer_service_calls"] == 1


def test_groups_split_at_midnight(spark):
    df = daily.daily_features(calls(spark, {"call_time": at(23, 59)}, {"call_time": at(0, 0, day=4)}))
    assert df.count() == 2


def test_clean_and_rejected_cover_the_input(spark):
    df = calls(
        spark,
        {},
        {"call_duration_seconds": 0},
        {"call_duration_seconds": -1},
        {"call_duration_seconds": None},
        {"customer_id": None},
        {"call_time": None},
    )
    kept, dropped = clean.clean_cdr(df), clean.rejected_cdr(df)
    assert kept.count() == 1 and kept.count() + dropped.count() == df.count()
    assert rows_of(dropped, "reason") == [
        ("missing_customer",),
        ("missing_duration",),
        ("missing_time",),
        ("non_positive_duration",),
        ("non_positive_duration",),
    ]


def test_empty_input(spark):
    assert daily.daily_features(calls(spark, {}).filter("false")).count() == 0


def test_bill_windows_use_calendar_months(spark):
    charges = spark.createDataFrame(
        [("a", datetime(2023, 11, 5), 1.0), ("a", datetime(2023, 12, 5), 2.0), ("a", datetime(2024, 1, 5), 4.0),
         ("a", datetime(2024, 4, 5), 8.0)],
        "customer_id string, charge_time timestamp_ntz, amount double",
    )
    bills = rolling.total_charges_3m(rolling.bill_fluctuation(rolling.monthly_bill_amount(charges)))
    assert [r for _, *r in rows_of(bills, "month_index", "bill_fluctuation", "total_charges_3m")] == [
        [None, 1.0], [1.0, 3.0], [2.0, 7.0], [4.0, 8.0]
    ]


def test_billing_month_is_dated_after_it_closed(spark):
    charges = spark.createDataFrame(
        [("a", datetime(2023, 12, 31), 1.0)], "customer_id string, charge_time timestamp_ntz, amount double"
    )
    payments = spark.createDataFrame([], "customer_id string, order_id bigint, due_date date, paid_date date")
    got = rolling.billing_features(charges, payments).first()
    assert got["event_timestamp"] == datetime(2024, 1, 1) and got["overdue_payments_3m"] is None


def test_trailing_promotion_window(spark):
    rows = [("a", datetime(2024, 1, 1), 1, 1), ("a", datetime(2024, 1, 30), 0, 1), ("a", datetime(2024, 1, 31), 0, 2)]
    days = spark.createDataFrame(rows, "customer_id string, t timestamp_ntz, promo_rows bigint, total_rows bigint")
    days = days.withColumn("event_date", F.to_date("t"))
    got = rolling.days_since_last_promo(rolling.promo_response_rate(days))
    assert rows_of(got, "event_date", "promo_response_rate", "days_since_last_promo") == [
        (datetime(2024, 1, 1).date(), 1.0, 0),
        (datetime(2024, 1, 30).date(), 0.5, 29),
        (datetime(2024, 1, 31).date(), 0.0, 30),
    ]
