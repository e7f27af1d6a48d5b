"""The training frame asks for one instant and few features, and does no work for others."""

from datetime import datetime, timedelta

from helpers import plan_text, rows_of

from dialtide import fixtures as fx
from dialtide.catalog.store import tables
from dialtide.ml.score import FixedLogistic, batch_score
from dialtide.operators.asof import feature_service_join, features_at
from dialtide.operators.rolling import billing_features, billing_reads_from, promotion_features
from dialtide.plans.features import daily_columns, payments_from, training_frame
from dialtide.schemas import CHURN_SERVICE, MODEL_FEATURES
from pyspark.sql import functions as F

AS_OF = datetime(2024, 1, 31)


def test_plan_has_no_timeline_and_no_discounts(spark, sf_dir):
    frame = training_frame(fx.churn_labels(spark, sf_dir), tables(spark, sf_dir, MODEL_FEATURES, AS_OF), AS_OF)
    plan = plan_text(frame)
    assert "_slice" not in plan and "l_discount" not in plan
    assert "partial_max_by" in plan


def test_one_instant_is_the_timeline_join(spark, sf_dir):
    views = tables(spark, sf_dir)
    asked = views["customer_profile"].select("customer_id").union(spark.createDataFrame([("nobody",), (None,)], "customer_id string"))
    for at in (AS_OF, datetime(2024, 1, 12, 8, 30), datetime(2001, 5, 1)):
        entities = asked.withColumn("event_timestamp", F.lit(at).cast("timestamp_ntz"))
        one, every = (f(entities, views, CHURN_SERVICE, *more) for f, more in ((features_at, [at]), (feature_service_join, [])))
        assert one.columns == every.columns
        assert one.exceptAll(every).isEmpty() and every.exceptAll(one).isEmpty()


def test_left_out_columns_change_no_others(spark, sf_dir):
    charges, payments = fx.charges(spark, sf_dir), fx.payments(spark, sf_dir)
    whole = billing_features(charges, payments)
    since = datetime(2023, 11, 2)
    late = whole.filter(F.col("event_timestamp") >= F.lit(since).cast("timestamp_ntz"))
    for columns in (["total_charges_3m", "overdue_payments_3m"], ["bill_fluctuation"]):
        kept = ["customer_id", "month_index", *columns, "event_timestamp"]
        part = billing_features(charges, payments, columns, since)
        assert rows_of(part.select([F.col(c).cast("string") for c in kept]), *kept) == rows_of(late.select([F.col(c).cast("string") for c in kept]), *kept)
    daily = tables(spark, sf_dir)["cdr_statistics"]
    refs = ["promotion_features:promo_response_rate", "promotion_features:days_since_last_promo"]
    part = promotion_features(daily.select(*daily_columns(refs)), None, ["days_since_last_promo", "promo_response_rate"])
    whole = promotion_features(daily, fx.discounts(spark, sf_dir)).select(part.columns)
    assert part.exceptAll(whole).isEmpty() and whole.exceptAll(part).isEmpty()


def test_lines_shipped_too_early_are_dropped_before_they_are_counted_together(spark, sf_dir):
    frame = training_frame(fx.churn_labels(spark, sf_dir), tables(spark, sf_dir, MODEL_FEATURES, AS_OF), AS_OF)
    optimized = frame._jdf.queryExecution().optimizedPlan().toString()
    below = optimized[optimized.index("Aggregate [l_orderkey") :].splitlines()[1:4]
    assert any("Filter" in line and "date_add" in line and "l_shipdate" in line for line in below)
    for since in (AS_OF.date(), datetime(2023, 8, 1).date(), datetime(1990, 1, 1).date(), datetime(2030, 1, 1).date()):
        part, whole = fx.payments(spark, sf_dir, since), fx.payments(spark, sf_dir).filter(F.col("paid_date") >= F.lit(since))
        assert part.exceptAll(whole).isEmpty() and whole.exceptAll(part).isEmpty()


def test_the_first_day_that_counts_is_two_months_before_the_oldest_month(spark):
    assert billing_reads_from(["total_charges_3m"], datetime(2023, 11, 2)) == datetime(2023, 8, 1).date()
    assert billing_reads_from(["total_charges_3m"], datetime(2024, 3, 31, 5)) == datetime(2023, 12, 1).date()
    assert billing_reads_from(["total_charges_3m"], datetime(2024, 4, 1)) == datetime(2024, 1, 1).date()
    assert billing_reads_from(["monthly_bill_amount", "bill_fluctuation"], datetime(2024, 4, 1)) is None
    assert payments_from(MODEL_FEATURES, AS_OF) is not None and payments_from(CHURN_SERVICE, AS_OF) is None


def test_one_row_per_label(spark, sf_dir):
    labels = spark.createDataFrame([("a", 1), ("a", 1), (None, 0), ("b", 0)], "customer_id string, churn int")
    stats = spark.createDataFrame(
        [("a", AS_OF - timedelta(days=90), 1.0), ("a", AS_OF + timedelta(seconds=1), 2.0), ("b", AS_OF - timedelta(days=91), 3.0)],
        "customer_id string, event_timestamp timestamp_ntz, daily_total_minutes double",
    )
    frame = training_frame(labels, {"cdr_statistics": stats}, AS_OF, ["cdr_statistics:daily_total_minutes"])
    assert frame.columns == ["customer_id", "event_timestamp", "daily_total_minutes", "churn"]
    got = sorted(tuple(r) for r in frame.fillna(-1.0).collect())
    assert got == [("a", AS_OF, 1.0, 1), ("a", AS_OF, 1.0, 1), ("b", AS_OF, -1.0, 0)]


def test_requests_of_one_file_are_scored_by_many_tasks(spark):
    requests = spark.range(2000).selectExpr("concat('c', id) AS customer_id", "id AS position").coalesce(1)
    stored = requests.selectExpr("customer_id", "CAST(position AS DOUBLE) AS monthly_charges")
    scored = batch_score(requests, {"customer_profile": stored}, ["customer_profile:monthly_charges"], FixedLogistic({"monthly_charges": 0.1}, 0.0), "v")
    assert scored.columns[:2] == ["customer_id", "position"] and scored.filter("has_features").count() == 2000
    plan = plan_text(scored)  # the requests' own shuffle, whichever way the lookup joins
    assert "REPARTITION_BY_COL" in plan


def test_discounts_that_no_day_shows_do_not_reach_the_join(spark, sf_dir):
    daily, discounts = tables(spark, sf_dir)["cdr_statistics"], fx.discounts(spark, sf_dir)
    rows = promotion_features(daily, discounts, ["promo_discount_amount"])
    shown = rows.filter("promo_discount_amount IS NOT NULL").count()
    assert shown > 0
    optimized = rows._jdf.queryExecution().optimizedPlan().toString()
    join = optimized[optimized.index("Join Inner") :]
    assert "add_months" in join  # the filter is below the join of lines and orders


def test_discounts_at_the_edge_are_kept(spark):
    daily = spark.createDataFrame(
        [("a", datetime(2024, 3, 1).date(), datetime(2024, 3, 1), datetime(2024, 3, 1))],
        "customer_id string, event_date date, event_timestamp timestamp_ntz, created_timestamp timestamp_ntz",
    )
    times = [datetime(2024, 1, 31, 23), datetime(2024, 2, 1), datetime(2024, 2, 29, 23), datetime(2024, 3, 1)]
    discounts = spark.createDataFrame([("a", t, float(10**i)) for i, t in enumerate(times)], "customer_id string, discount_time timestamp_ntz, discount double")
    for days in (daily, daily.limit(0)):
        got = [r["promo_discount_amount"] for r in promotion_features(days, discounts, ["promo_discount_amount"]).collect()]
        assert got == ([110.0] if days is daily else [])
