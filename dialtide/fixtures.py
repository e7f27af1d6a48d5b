"""Call-record, billing and churn tables derived from the supplied test tables.

Orders end in 2001 and call records start in 2024; ``history`` moves the orders
forward by whole days so that both lie on one time axis and feature lifetimes
matter in joins across them.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

AXIS_END = "2024-01-31"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def padded(number: F.Column, width: int) -> F.Column:
    """Digits with leading zeros up to ``width``; longer numbers stay whole."""
    digits = number.cast("string")
    return F.lpad(digits, F.greatest(F.length(digits), F.lit(width)), F.lit("0"))


def customer_key(col: str) -> F.Column:
    return F.concat(F.lit("CUST"), padded(F.col(col), 6))


def events_to_cdr(events: DataFrame) -> DataFrame:
    """Call records from event rows; every domain value but BUNDLE occurs."""
    eid, kind = F.col("event_id"), F.col("event_type")
    digits = padded(eid, 10)
    return events.select(
        F.concat(F.lit("C"), padded(eid, 9)).alias("call_id"),
        customer_key("user_id").alias("customer_id"),
        F.col("ts").alias("call_time"),
        F.floor(F.col("value") * 10).cast("int").alias("call_duration_seconds"),
        F.when(kind.isin("click", "view", "error"), "VOICE")
        .when(kind == "signup", "SMS")
        .otherwise("DATA")
        .alias("call_type"),
        F.when(eid % 20 == 0, "CUSTOMER_SERVICE")
        .when(eid % 15 == 0, F.concat(F.lit("+44"), digits))
        .otherwise(F.concat(F.lit("+1"), digits))
        .alias("destination_number"),
        F.element_at(
            F.array(*[F.lit(n) for n in ("2G", "3G", "4G", "5G", "WIFI", "ROAMING", "4G", None)]),
            (eid % 8 + 1).cast("int"),
        ).alias("network_type"),
        F.concat(F.lit("TOWER"), padded(eid % 1000 + 1, 4)).alias("cell_tower_id"),
        F.when(kind == "error", "DROPPED")
        .when(eid % 10 == 0, "BUSY")
        .when(eid % 10 == 1, "NO_ANSWER")
        .when(eid % 10 == 2, "FAILED")
        .otherwise("COMPLETED")
        .alias("call_result"),
        (F.col("value") / 16).alias("call_charge"),
        F.element_at(
            F.array(*[F.lit(n) for n in ("SPRING10", "FRIENDS", "NIGHTS", "NONE", None)]),
            (eid % 5 + 1).cast("int"),
        ).alias("promotion_code"),
    )


def cdr(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events_to_cdr(table(spark, sf_dir, "events"))


def cdr_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Call records with out-of-range, unknown and missing values, in the raw types."""
    events = table(spark, sf_dir, "events")
    seq = F.expr("substring(call_id, 2)").cast("bigint")
    return (
        events_to_cdr(events.withColumn("value", F.col("value") * 10))
        .withColumn("network_type", F.when(seq % 20 == 1, "SAT").otherwise(F.col("network_type")))
        .withColumn("customer_id", F.when(seq % 50 != 3, F.col("customer_id")))
        .withColumn("call_charge", (F.col("call_charge") / 10).cast("float"))
        .withColumn("call_time", F.col("call_time").cast("timestamp"))
    )


def churn_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per customer with orders: usage figures and a churn flag.

    A customer churned when the last order is over 365 days before the newest.
    """
    orders = table(spark, sf_dir, "orders")
    customers = table(spark, sf_dir, "customer")
    last = orders.agg(F.max("o_orderdate").alias("last")).scalar()
    has_plan = F.col("c_nationkey") % 3 == 0
    per_customer = orders.groupBy("o_custkey").agg(
        F.min("o_orderdate").alias("first_order"),
        F.max("o_orderdate").alias("last_order"),
        F.avg("o_totalprice").alias("avg_price"),
        F.min("o_totalprice").alias("min_price"),
        F.count_if(F.col("o_orderpriority") == "1-URGENT").alias("urgent"),
        F.count_if(F.col("o_orderstatus") == "P").alias("pending"),
        F.count("*").alias("n_orders"),
    )
    return customers.join(per_customer, customers.c_custkey == per_customer.o_custkey).select(
        customer_key("c_custkey").alias("customer_id"),
        (F.datediff(last, "last_order") > 365).cast("int").alias("churn"),
        F.floor(F.datediff(last, "first_order") / 7).cast("int").alias("account_weeks"),
        (F.col("c_custkey") % 10 != 0).cast("int").alias("contract_renewal"),
        has_plan.cast("int").alias("data_plan"),
        F.when(has_plan, F.col("avg_price") / 100000).otherwise(0.0).alias("data_usage"),
        F.col("urgent").cast("int").alias("cust_serv_calls"),
        (F.col("avg_price") / 1000).alias("day_mins"),
        F.col("n_orders").cast("int").alias("day_calls"),
        (F.col("c_acctbal") / 100).alias("monthly_charge"),
        (F.col("min_price") / 10000).alias("overage_fee"),
        F.col("pending").cast("double").alias("roam_mins"),
    )


def churn_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Churn flag, and the date a churned customer had been silent for 365 days."""
    orders = history(spark, sf_dir)
    last = F.lit(AXIS_END).cast("date")
    silent = F.datediff(last, F.max("order_time")) > 365
    return orders.groupBy("customer_id").agg(
        silent.cast("int").alias("churn"),
        F.when(silent, F.date_add(F.max("order_time").cast("date"), 365)).alias("churn_date"),
    )


def history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders moved forward so that the newest falls on :data:`AXIS_END`."""
    orders = table(spark, sf_dir, "orders")
    last = orders.agg(F.max("o_orderdate").alias("last")).scalar()
    shift = F.datediff(F.lit(AXIS_END).cast("date"), last)
    return orders.select(
        "o_orderkey",
        customer_key("o_custkey").alias("customer_id"),
        F.date_add(F.col("o_orderdate").cast("date"), shift).cast("timestamp_ntz").alias("order_time"),
        F.col("o_totalprice").alias("amount"),
    )


def charges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Billed amounts: customer_id, charge_time, amount."""
    return history(spark, sf_dir).select("customer_id", F.col("order_time").alias("charge_time"), "amount")


def payments(spark: SparkSession, sf_dir: str, paid_from: date | None = None) -> DataFrame:
    """One payment per order: due 60 days after it, paid on its last ship date.

    With ``paid_from`` only those paid since. An order has a line shipped since
    just when its last one was: older lines are dropped before lines are counted together.
    """
    orders = history(spark, sf_dir)
    raw = table(spark, sf_dir, "orders").agg(F.max("o_orderdate").alias("last")).scalar()
    shift = F.datediff(F.lit(AXIS_END).cast("date"), raw)
    lines = table(spark, sf_dir, "lineitem")
    if paid_from is not None:
        lines = lines.filter(F.date_add(F.col("l_shipdate").cast("date"), shift) >= F.lit(paid_from))
    shipped = lines.groupBy("l_orderkey").agg(F.max("l_shipdate").alias("ship"))
    return orders.join(shipped, orders.o_orderkey == shipped.l_orderkey).select(
        "customer_id",
        F.col("o_orderkey").alias("order_id"),
        F.date_add(F.col("order_time").cast("date"), 60).alias("due_date"),
        F.date_add(F.col("ship").cast("date"), shift).alias("paid_date"),
    )


def discounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Promotion discounts: customer_id, discount_time, discount."""
    orders = history(spark, sf_dir)
    lines = table(spark, sf_dir, "lineitem")
    return lines.join(orders, lines.l_orderkey == orders.o_orderkey).select(
        "customer_id",
        F.col("order_time").alias("discount_time"),
        (F.col("l_extendedprice") * F.col("l_discount")).alias("discount"),
    )


def customer_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Demographic and contract columns of every customer with orders.

    The row is dated at the customer's newest order: totals hold no later one.
    """
    customers = table(spark, sf_dir, "customer")
    spent = history(spark, sf_dir).groupBy("customer_id").agg(
        F.min("order_time").alias("first_order"),
        F.max("order_time").alias("event_timestamp"),
        F.sum("amount").alias("spent"),
    )
    key, segment = F.col("c_custkey"), F.col("c_mktsegment")

    def pick(*names: str) -> F.Column:
        return F.element_at(F.array(*map(F.lit, names)), (key % len(names) + 1).cast("int"))

    def yes_if(flag: F.Column) -> F.Column:
        return F.when(flag, "Yes").otherwise("No")

    return (
        customers.withColumn("customer_id", customer_key("c_custkey"))
        .join(spent, "customer_id")
        .select(
            "customer_id",
            "event_timestamp",
            F.datediff(F.lit(AXIS_END).cast("date"), "first_order").alias("tenure_days"),
            pick("Month-to-month", "One year", "Two year").alias("contract_type"),
            pick("Bank transfer", "Credit card", "Electronic check", "Mailed check").alias("payment_method"),
            (F.col("c_acctbal") / 100).alias("monthly_charges"),
            F.col("spent").alias("total_charges"),
            pick("Female", "Male").alias("gender"),
            (key % 5 == 0).cast("int").alias("senior_citizen"),
            yes_if(segment == "HOUSEHOLD").alias("partner"),
            yes_if(segment.isin("HOUSEHOLD", "FURNITURE")).alias("dependents"),
            yes_if(segment != "MACHINERY").alias("paperless_billing"),
        )
    )


def entity_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One (customer, instant) per order: a day of January 2024 by order key."""
    return table(spark, sf_dir, "orders").select(
        customer_key("o_custkey").alias("customer_id"),
        F.date_add(F.lit("2024-01-01").cast("date"), (F.col("o_orderkey") % 31).cast("int"))
        .cast("timestamp_ntz")
        .alias("event_timestamp"),
    )
