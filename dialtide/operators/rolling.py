"""Monthly and trailing-window customer features.

Every window here runs over rows already reduced to one per customer and month
or day, so a partition holds at most the customer's months or days, however
many records they came from.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import month_index

MONTH_KEY = ["customer_id", "month_index"]
BILLING_COLUMNS = ["monthly_bill_amount", "payment_delay_days", "bill_fluctuation", "total_charges_3m", "overdue_payments_3m"]
PROMOTION_COLUMNS = ["promo_response_rate", "active_promotions_count", "days_since_last_promo", "promo_discount_amount"]


def _by_month():
    return Window.partitionBy("customer_id").orderBy("month_index")


def _three_months():
    return _by_month().rangeBetween(-2, 0)


def _following_month(index: str):
    """First day of the month after a month index (year * 12 + month, months from 1)."""
    month = F.col(index)
    return F.make_date(F.floor(month / 12).cast("int"), (month % 12 + 1).cast("int"), F.lit(1))


def monthly_bill_amount(charges: DataFrame) -> DataFrame:
    """Sum of charges per customer and calendar month."""
    return charges.groupBy("customer_id", month_index(F.col("charge_time")).alias("month_index")).agg(
        F.sum("amount").alias("monthly_bill_amount")
    )


def bill_fluctuation(bills: DataFrame) -> DataFrame:
    """This month's bill minus the previous billed month's; null in the first."""
    earlier = _by_month().rowsBetween(Window.unboundedPreceding, -1)
    previous = F.last("monthly_bill_amount", ignorenulls=True).over(earlier)
    return bills.withColumn("bill_fluctuation", F.col("monthly_bill_amount") - previous)


def total_charges_3m(bills: DataFrame) -> DataFrame:
    """Bills of this and the two preceding calendar months, for billed months."""
    total = F.sum("monthly_bill_amount").over(_three_months())
    return bills.withColumn("total_charges_3m", F.when(F.col("monthly_bill_amount").isNotNull(), total))


def _delay():
    return F.greatest(F.datediff("paid_date", "due_date"), F.lit(0))


def payment_delays(payments: DataFrame) -> DataFrame:
    """Mean days late and number of late payments, by the month they were paid in."""
    return payments.groupBy("customer_id", month_index(F.col("paid_date")).alias("month_index")).agg(
        F.avg(_delay()).alias("payment_delay_days"),
        F.count_if(_delay() > 0).alias("overdue_payments"),
    )


def overdue_payments_3m(delays: DataFrame) -> DataFrame:
    """Late payments of this and the two preceding calendar months, for months with payments."""
    total = F.sum("overdue_payments").over(_three_months())
    return delays.withColumn("overdue_payments_3m", F.when(F.col("overdue_payments").isNotNull(), total))


def billing_reads_from(columns: list[str], seen_from: datetime) -> date | None:
    """The first day whose charges and payments :func:`billing_features` counts for these columns; None if all are."""
    if "bill_fluctuation" in columns:  # it looks back to the last bill, however old; nothing else further than two months
        return None
    month = seen_from.year * 12 + seen_from.month - 1 - 3
    return date(month // 12, month % 12 + 1, 1)


def billing_features(charges: DataFrame, payments: DataFrame, columns: list[str] | None = None, seen_from: datetime | None = None) -> DataFrame:
    """The monthly billing view, dated when the month closes.

    ``columns`` leaves out the features that are not among them; ``seen_from`` the
    months that closed before it, and then charges and payments that no later
    month counts are dropped where they are read.

    Charges and payments are combined by one aggregate instead of a full join,
    and all windows share the customer's partition: two shuffles in all. A
    month enters with its first instant after the end, so a point-in-time join
    never sees a charge or payment that had not happened yet.
    """
    wanted = BILLING_COLUMNS if columns is None else [c for c in BILLING_COLUMNS if c in columns]
    oldest = None if seen_from is None else billing_reads_from(wanted, seen_from)
    if oldest is not None:
        charges, payments = charges.filter(F.col("charge_time") >= F.lit(oldest)), payments.filter(F.col("paid_date") >= F.lit(oldest))
    billed = charges.select("customer_id", month_index(F.col("charge_time")).alias("month_index"), "amount")
    paid = payments.select(
        "customer_id", month_index(F.col("paid_date")).alias("month_index"), _delay().alias("delay")
    )
    months = billed.unionByName(paid, allowMissingColumns=True).groupBy(*MONTH_KEY).agg(
        F.sum("amount").alias("monthly_bill_amount"),
        F.avg("delay").alias("payment_delay_days"),
        F.when(F.count("delay") > 0, F.count_if(F.col("delay") > 0)).alias("overdue_payments"),
    )
    closes = _following_month("month_index").cast("timestamp_ntz")
    rows = overdue_payments_3m(total_charges_3m(bill_fluctuation(months)))
    rows = rows.withColumns({"event_timestamp": closes, "created_timestamp": closes})
    if seen_from is not None:
        rows = rows.filter(F.col("event_timestamp") >= F.lit(seen_from).cast("timestamp_ntz"))
    return rows.select(*MONTH_KEY, *wanted, "event_timestamp", "created_timestamp")


def _by_date():
    # as a number: range frames over dates do not take day counts
    return Window.partitionBy("customer_id").orderBy(F.unix_date("event_date"))


def promo_response_rate(daily: DataFrame, days: int = 30) -> DataFrame:
    """Share of records with a promotion in the trailing ``days`` days (0 to 1)."""
    frame = _by_date().rangeBetween(-(days - 1), 0)
    return daily.withColumn(
        "promo_response_rate",
        F.sum("promo_rows").over(frame) / F.nullif(F.sum("total_rows").over(frame), F.lit(0)),
    )


def days_since_last_promo(daily: DataFrame) -> DataFrame:
    """Days back to the newest day with a promotion, the day itself included."""
    upto = _by_date().rangeBetween(Window.unboundedPreceding, Window.currentRow)
    last = F.max(F.when(F.col("promo_rows") > 0, F.col("event_date"))).over(upto)
    return daily.withColumn("days_since_last_promo", F.datediff("event_date", last))


def promo_discount_amount(discounts: DataFrame) -> DataFrame:
    """Sum of promotion discounts per customer and calendar month."""
    return discounts.groupBy("customer_id", month_index(F.col("discount_time")).alias("month_index")).agg(
        F.sum("discount").alias("promo_discount_amount")
    )


def promotion_features(daily: DataFrame, discounts: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """The daily promotion view, with the discount of the last closed month.

    ``columns`` leaves out the features that are not among them; discounts are
    read for theirs alone, and ``daily`` needs the columns behind the others.

    Each month's discount joins the customer's days as one more row, dated the
    day after the month closed, and the windows carry it over the month: daily
    rows are shuffled once, by customer.
    """
    wanted = PROMOTION_COLUMNS if columns is None else [c for c in PROMOTION_COLUMNS if c in columns]
    rows = daily.withColumn("is_day", F.lit(True))
    upto = _by_date().rangeBetween(Window.unboundedPreceding, Window.currentRow)
    if "promo_discount_amount" in wanted:
        # a day shows the month before its own: older discounts are dropped where they are read
        first = F.trunc(daily.agg(F.min("event_date")).scalar(), "month")
        closed = promo_discount_amount(discounts.filter(F.col("discount_time") >= F.add_months(first, -1))).select(
            "customer_id",
            _following_month("month_index").alias("event_date"),
            F.struct((F.col("month_index") + 1).alias("valid"), "promo_discount_amount").alias("discount"),
        )
        rows = rows.unionByName(closed, allowMissingColumns=True)
        rows = rows.withColumn("latest", F.last("discount", ignorenulls=True).over(upto))
    if "promo_response_rate" in wanted:
        rows = promo_response_rate(rows)
    if "days_since_last_promo" in wanted:
        rows = days_since_last_promo(rows)
    if "promo_discount_amount" in wanted:
        this_month = F.col("latest.valid") == month_index(F.col("event_date"))
        rows = rows.withColumn("promo_discount_amount", F.when(this_month, F.col("latest.promo_discount_amount")))
    return rows.filter("is_day").select("customer_id", "event_date", "event_timestamp", *wanted, "created_timestamp")


def tenure_days(activity: DataFrame, run_date: str, time: str = "call_time") -> DataFrame:
    """Days from each customer's first activity to ``run_date``."""
    return activity.groupBy("customer_id").agg(
        F.datediff(F.lit(run_date).cast("date"), F.min(time)).alias("tenure_days")
    )
