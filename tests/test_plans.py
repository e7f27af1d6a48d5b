"""What the physical plans must and must not contain."""

from helpers import exchanges, plan_text

import __spark_entry__ as entry
from dialtide import fixtures as fx
from dialtide.operators import analytics, clean, daily, quality, rolling, snapshot

QUERIES = entry.queries()


def test_daily_statistics_shuffle_once(spark, sf_dir):
    records = clean.clean_cdr(fx.cdr(spark, sf_dir))
    assert exchanges(daily.cdr_statistics(daily.daily_features(records))) == 1
    assert plan_text(daily.daily_features(records)).count("Scan parquet") == 1


def test_unused_columns_are_not_read(spark, sf_dir):
    records = clean.clean_cdr(fx.cdr(spark, sf_dir))
    plan = plan_text(daily.billing_daily(daily.daily_features(records)))
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,value:double>" in plan


def test_filters_reach_the_scan(spark, sf_dir):
    plan = plan_text(fx.table(spark, sf_dir, "events").filter("user_id = 5").select("value"))
    assert "PushedFilters: [IsNotNull(user_id), EqualTo(user_id,5)]" in plan


def test_snapshot_combines_before_the_shuffle(spark, sf_dir):
    plan = plan_text(snapshot.latest_snapshot(fx.customer_profile(spark, sf_dir)))
    assert "partial_max_by" in plan


def test_suite_is_one_aggregate(spark, sf_dir):
    plan = plan_text(quality.run_suite(fx.cdr_dirty(spark, sf_dir)))
    assert plan.count("Scan parquet") == 1 and plan.count("Exchange") == 1


def test_correlations_are_one_aggregate(spark, sf_dir):
    table = fx.churn_table(spark, sf_dir)
    one = plan_text(analytics.group_means(table)).count("Scan parquet")
    assert plan_text(analytics.correlation_matrix(table)).count("Scan parquet") == one


def test_month_windows_reuse_the_customer_partitioning(spark, sf_dir):
    bills = rolling.monthly_bill_amount(fx.charges(spark, sf_dir))
    both = rolling.total_charges_3m(rolling.bill_fluctuation(bills))
    assert exchanges(both) == 2  # by month for the sums, by customer for both windows


def test_billing_view_shuffles_twice(spark, sf_dir):
    orders, paid = fx.charges(spark, sf_dir), fx.payments(spark, sf_dir)
    own = exchanges(orders) + exchanges(paid)
    assert exchanges(rolling.billing_features(orders, paid)) - own == 2


def test_asof_join_reads_one_shuffle_for_both_branches(spark, sf_dir):
    df = QUERIES["pit_join"](spark, sf_dir)
    df.collect()
    # at the outermost mark: a subquery's own plans are indented
    final = plan_text(df).split("\n+- == Initial Plan ==")[0]
    assert "ReusedExchange" in final
    made = [line for line in final.split("\n") if "Exchange hashpartitioning" in line and "ReusedExchange" not in line]
    assert len(made) <= 6
