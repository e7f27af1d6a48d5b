"""Registry, and the shared tables written a second time in DuckDB SQL.

The SQL below is independent of the Spark fixtures: it is the check on them.
Doubles are snapped to 1e-6 on both engines, because sums differ in their last
bits with the order of addition. The boundary is set slightly off the half, as
money and ratios often end in exactly five.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import configure

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

HALF = 0.50037


def snap(df: DataFrame) -> DataFrame:
    """Every double and float column as a multiple of 1e-6.

    NaN, infinities and values whose multiple does not fit a bigint stay as they are.
    """
    fractional = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]

    def snapped(c: str):
        value = F.col(c).cast("double")
        return F.when(F.abs(value) < 1e12, F.floor(value * 1e6 + HALF).cast("double") / 1e6).otherwise(value)

    return df.withColumns({c: snapped(c) for c in fractional})


def register(name: str, make: Callable[[SparkSession, str], DataFrame], sql: str | None = None) -> None:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return snap(make(configure(spark), sf_dir))

    if name in QUERIES:
        raise ValueError(f"query {name} registered twice")
    QUERIES[name] = run
    if sql:
        ORACLES[name] = sql


def query(name: str, body: str | None = None, uses: tuple[str, ...] = (), doubles: tuple[str, ...] = ()):
    """Register the decorated function; ``body`` is its SQL over the ``uses`` tables."""

    def wrap(make):
        register(name, make, sql(body, uses, doubles) if body else None)
        return make

    return wrap


def _needed(names: tuple[str, ...], seen: list[str]) -> list[str]:
    for name in names:
        if name not in seen:
            _needed(TABLES[name][0], seen)
            seen.append(name)
    return seen


def sql(body: str, uses: tuple[str, ...] = (), doubles: tuple[str, ...] = ()) -> str:
    """``body`` with the common table expressions it needs; ``doubles`` are snapped."""
    parts = [f"{n} AS ({TABLES[n][1].strip()})" for n in _needed(uses, [])]
    parts.append(f"result AS ({body.strip()})")
    snapped = ", ".join(f"floor({c} * 1e6 + {HALF}) / 1e6 AS {c}" for c in doubles)
    star = f"* REPLACE ({snapped})" if snapped else "*"
    return f"WITH {', '.join(parts)} SELECT {star} FROM result"


def _cdr_sql(value: str) -> str:
    return f"""
SELECT concat('C', lpad(CAST(event_id AS VARCHAR), CAST(greatest(9, length(CAST(event_id AS VARCHAR))) AS INTEGER), '0')) AS call_id,
       concat('CUST', lpad(CAST(user_id AS VARCHAR), CAST(greatest(6, length(CAST(user_id AS VARCHAR))) AS INTEGER), '0')) AS customer_id,
       ts AS call_time,
       CAST(floor(({value}) * 10) AS INTEGER) AS call_duration_seconds,
       CASE WHEN event_type IN ('click', 'view', 'error') THEN 'VOICE'
            WHEN event_type = 'signup' THEN 'SMS' ELSE 'DATA' END AS call_type,
       CASE WHEN event_id % 20 = 0 THEN 'CUSTOMER_SERVICE'
            WHEN event_id % 15 = 0 THEN concat('+44', lpad(CAST(event_id AS VARCHAR), CAST(greatest(10, length(CAST(event_id AS VARCHAR))) AS INTEGER), '0'))
            ELSE concat('+1', lpad(CAST(event_id AS VARCHAR), CAST(greatest(10, length(CAST(event_id AS VARCHAR))) AS INTEGER), '0')) END AS destination_number,
       CASE event_id % 8 WHEN 0 THEN '2G' WHEN 1 THEN '3G' WHEN 2 THEN '4G' WHEN 3 THEN '5G'
            WHEN 4 THEN 'WIFI' WHEN 5 THEN 'ROAMING' WHEN 6 THEN '4G' END AS network_type,
       concat('TOWER', lpad(CAST(event_id % 1000 + 1 AS VARCHAR), CAST(greatest(4, length(CAST(event_id % 1000 + 1 AS VARCHAR))) AS INTEGER), '0')) AS cell_tower_id,
       CASE WHEN event_type = 'error' THEN 'DROPPED' WHEN event_id % 10 = 0 THEN 'BUSY'
            WHEN event_id % 10 = 1 THEN 'NO_ANSWER' WHEN event_id % 10 = 2 THEN 'FAILED'
            ELSE 'COMPLETED' END AS call_result,
       ({value}) / 16 AS call_charge,
       CASE event_id % 5 WHEN 0 THEN 'SPRING10' WHEN 1 THEN 'FRIENDS' WHEN 2 THEN 'NIGHTS'
            WHEN 3 THEN 'NONE' END AS promotion_code,
       event_id
FROM events"""


SHIFT = "date_diff('day', (SELECT CAST(max(o_orderdate) AS DATE) FROM orders), DATE '2024-01-31')"


def month_of(time: str) -> str:
    return f"CAST(year({time}) * 12 + month({time}) AS INTEGER)"


#: name → (tables it needs, SQL)
TABLES: dict[str, tuple[tuple[str, ...], str]] = {
    "cdr_numbered": ((), _cdr_sql("value")),
    "cdr": (("cdr_numbered",), "SELECT * EXCLUDE (event_id) FROM cdr_numbered"),
    "cdr_dirty_numbered": ((), _cdr_sql("value * 10")),
    "cdr_dirty": (
        ("cdr_dirty_numbered",),
        """
SELECT * EXCLUDE (event_id) REPLACE (
         CASE WHEN event_id % 20 = 1 THEN 'SAT' ELSE network_type END AS network_type,
         CASE WHEN event_id % 50 <> 3 THEN customer_id END AS customer_id,
         CAST(call_charge / 10 AS FLOAT) AS call_charge)
FROM cdr_dirty_numbered""",
    ),
    "cdr_broken": (
        ("cdr_dirty",),
        "SELECT * EXCLUDE (network_type) REPLACE (CAST(call_duration_seconds AS BIGINT) AS call_duration_seconds) FROM cdr_dirty",
    ),
    "clean": (
        ("cdr",),
        "SELECT * FROM cdr WHERE call_duration_seconds > 0 AND customer_id IS NOT NULL AND call_time IS NOT NULL",
    ),
    "dated": (
        ("clean",),
        """
SELECT *, CAST(call_time AS DATE) AS call_date, CAST(year(call_time) AS INTEGER) AS year,
       CAST(month(call_time) AS INTEGER) AS month, CAST(day(call_time) AS INTEGER) AS day,
       CAST(hour(call_time) AS INTEGER) AS hour
FROM clean""",
    ),
    "daily": (
        ("clean",),
        """
SELECT customer_id, CAST(call_time AS DATE) AS event_date, max(call_time) AS event_timestamp,
       sum(CASE WHEN call_type = 'VOICE' THEN call_duration_seconds / CAST(60 AS DOUBLE) ELSE 0 END)
         AS daily_total_minutes,
       CAST(sum(CASE WHEN call_type = 'VOICE' THEN 1 ELSE 0 END) AS BIGINT) AS daily_total_calls,
       CAST(sum(CASE WHEN call_type = 'SMS' THEN 1 ELSE 0 END) AS BIGINT) AS daily_total_sms,
       sum(CASE WHEN call_type = 'DATA' THEN call_duration_seconds * CAST(0.001 AS DOUBLE) ELSE 0 END)
         AS daily_total_data_mb,
       avg(CASE WHEN call_type = 'VOICE' THEN call_duration_seconds END) AS avg_call_duration,
       sum(CASE WHEN hour(call_time) BETWEEN 17 AND 21 THEN 1 ELSE 0 END) / count(*) * 100 AS peak_hour_usage_pct,
       sum(CASE WHEN dayofweek(call_time) IN (0, 6) THEN 1 ELSE 0 END) / count(*) * 100 AS weekend_usage_pct,
       sum(CASE WHEN call_result = 'DROPPED' THEN 1 ELSE 0 END)
         / nullif(sum(CASE WHEN call_type = 'VOICE' THEN 1 ELSE 0 END), 0) * 100 AS dropped_calls_pct,
       CAST(sum(CASE WHEN destination_number = 'CUSTOMER_SERVICE' THEN 1 ELSE 0 END) AS BIGINT)
         AS customer_service_calls,
       CAST(sum(CASE WHEN call_type = 'VOICE' AND destination_number LIKE '+%'
                      AND destination_number NOT LIKE '+1%' THEN 1 ELSE 0 END) AS BIGINT)
         AS international_calls_count,
       sum(call_charge) AS daily_charges,
       sum(call_charge) / count(DISTINCT CAST(call_time AS DATE)) AS avg_daily_charge,
       count(DISTINCT promotion_code) AS active_promotions_count,
       sum(CASE WHEN promotion_code <> 'NONE' THEN 1 ELSE 0 END) / count(*) * 100 AS promo_usage_pct,
       CAST(sum(CASE WHEN promotion_code <> 'NONE' THEN 1 ELSE 0 END) AS BIGINT) AS promo_rows,
       count(*) AS total_rows,
       max(call_time) AS created_timestamp
FROM clean GROUP BY customer_id, CAST(call_time AS DATE)""",
    ),
    "history": (
        (),
        f"""
SELECT o_orderkey, concat('CUST', lpad(CAST(o_custkey AS VARCHAR), CAST(greatest(6, length(CAST(o_custkey AS VARCHAR))) AS INTEGER), '0')) AS customer_id,
       CAST(CAST(o_orderdate AS DATE) + CAST({SHIFT} AS INTEGER) AS TIMESTAMP) AS order_time,
       o_totalprice AS amount
FROM orders""",
    ),
    "bills": (
        ("history",),
        f"""
SELECT customer_id, {month_of('order_time')} AS month_index, sum(amount) AS monthly_bill_amount
FROM history GROUP BY ALL""",
    ),
    "bill_windows": (
        ("bills",),
        """
SELECT *, monthly_bill_amount - lag(monthly_bill_amount) OVER c AS bill_fluctuation,
       sum(monthly_bill_amount) OVER (c RANGE BETWEEN 2 PRECEDING AND CURRENT ROW) AS total_charges_3m
FROM bills WINDOW c AS (PARTITION BY customer_id ORDER BY month_index)""",
    ),
    "payments": (
        ("history",),
        f"""
SELECT h.customer_id, h.o_orderkey AS order_id, CAST(h.order_time AS DATE) + 60 AS due_date,
       CAST(s.ship AS DATE) + CAST({SHIFT} AS INTEGER) AS paid_date
FROM history h JOIN (SELECT l_orderkey, max(l_shipdate) AS ship FROM lineitem GROUP BY 1) s
  ON h.o_orderkey = s.l_orderkey""",
    ),
    "delays": (
        ("payments",),
        f"""
SELECT customer_id, {month_of('paid_date')} AS month_index,
       avg(greatest(date_diff('day', due_date, paid_date), 0)) AS payment_delay_days,
       count(*) FILTER (WHERE paid_date > due_date) AS overdue_payments
FROM payments GROUP BY ALL""",
    ),
    "delay_windows": (
        ("delays",),
        """
SELECT *, CAST(sum(overdue_payments) OVER (PARTITION BY customer_id ORDER BY month_index
                                           RANGE BETWEEN 2 PRECEDING AND CURRENT ROW) AS BIGINT)
         AS overdue_payments_3m
FROM delays""",
    ),
    "billing_features": (
        ("bill_windows", "delay_windows"),
        """
SELECT coalesce(b.customer_id, d.customer_id) AS customer_id,
       coalesce(b.month_index, d.month_index) AS month_index,
       monthly_bill_amount, bill_fluctuation, total_charges_3m, payment_delay_days, overdue_payments_3m,
       CAST(make_date(coalesce(b.month_index, d.month_index) // 12,
                      coalesce(b.month_index, d.month_index) % 12 + 1, 1) AS TIMESTAMP) AS event_timestamp,
       CAST(make_date(coalesce(b.month_index, d.month_index) // 12,
                      coalesce(b.month_index, d.month_index) % 12 + 1, 1) AS TIMESTAMP) AS created_timestamp
FROM bill_windows b FULL JOIN delay_windows d
  ON b.customer_id = d.customer_id AND b.month_index = d.month_index""",
    ),
    "promo_windows": (
        ("daily",),
        """
SELECT *, sum(promo_rows) OVER t / sum(total_rows) OVER t AS promo_response_rate,
       date_diff('day', max(CASE WHEN promo_rows > 0 THEN event_date END)
                        OVER (PARTITION BY customer_id ORDER BY event_date), event_date) AS since
FROM daily WINDOW t AS (PARTITION BY customer_id ORDER BY event_date
                        RANGE BETWEEN INTERVAL 29 DAYS PRECEDING AND CURRENT ROW)""",
    ),
    "discount_months": (
        ("history",),
        f"""
SELECT customer_id, {month_of('order_time')} AS month_index, sum(l_extendedprice * l_discount) AS promo_discount_amount
FROM lineitem JOIN history ON l_orderkey = o_orderkey GROUP BY ALL""",
    ),
    "promotion_features": (
        ("promo_windows", "discount_months"),
        f"""
SELECT p.customer_id, event_date, event_timestamp, promo_response_rate, active_promotions_count,
       CAST(since AS INTEGER) AS days_since_last_promo, promo_discount_amount, created_timestamp
FROM promo_windows p LEFT JOIN discount_months d
  ON p.customer_id = d.customer_id AND {month_of('event_date')} = d.month_index + 1""",
    ),
    "customer_profile": (
        ("history",),
        """
SELECT concat('CUST', lpad(CAST(c_custkey AS VARCHAR), CAST(greatest(6, length(CAST(c_custkey AS VARCHAR))) AS INTEGER), '0')) AS customer_id, event_timestamp,
       CAST(date_diff('day', CAST(first_order AS DATE), DATE '2024-01-31') AS INTEGER) AS tenure_days,
       CASE c_custkey % 3 WHEN 0 THEN 'Month-to-month' WHEN 1 THEN 'One year' ELSE 'Two year' END AS contract_type,
       CASE c_custkey % 4 WHEN 0 THEN 'Bank transfer' WHEN 1 THEN 'Credit card'
                          WHEN 2 THEN 'Electronic check' ELSE 'Mailed check' END AS payment_method,
       c_acctbal / 100 AS monthly_charges, spent AS total_charges,
       CASE c_custkey % 2 WHEN 0 THEN 'Female' ELSE 'Male' END AS gender,
       CASE WHEN c_custkey % 5 = 0 THEN 1 ELSE 0 END AS senior_citizen,
       CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN 'Yes' ELSE 'No' END AS partner,
       CASE WHEN c_mktsegment IN ('HOUSEHOLD', 'FURNITURE') THEN 'Yes' ELSE 'No' END AS dependents,
       CASE WHEN c_mktsegment <> 'MACHINERY' THEN 'Yes' ELSE 'No' END AS paperless_billing
FROM customer JOIN (SELECT customer_id, min(order_time) AS first_order, max(order_time) AS event_timestamp,
                           sum(amount) AS spent FROM history GROUP BY 1) h
  ON h.customer_id = concat('CUST', lpad(CAST(c_custkey AS VARCHAR), CAST(greatest(6, length(CAST(c_custkey AS VARCHAR))) AS INTEGER), '0'))""",
    ),
    "churn_table": (
        (),
        """
SELECT concat('CUST', lpad(CAST(c_custkey AS VARCHAR), CAST(greatest(6, length(CAST(c_custkey AS VARCHAR))) AS INTEGER), '0')) AS customer_id,
       CASE WHEN date_diff('day', max(o_orderdate), (SELECT max(o_orderdate) FROM orders)) > 365 THEN 1 ELSE 0 END
         AS churn,
       CAST(floor(date_diff('day', min(o_orderdate), (SELECT max(o_orderdate) FROM orders)) / 7) AS INTEGER)
         AS account_weeks,
       CASE WHEN c_custkey % 10 = 0 THEN 0 ELSE 1 END AS contract_renewal,
       CASE WHEN c_nationkey % 3 = 0 THEN 1 ELSE 0 END AS data_plan,
       CASE WHEN c_nationkey % 3 = 0 THEN avg(o_totalprice) / 100000 ELSE 0 END AS data_usage,
       CAST(count(*) FILTER (WHERE o_orderpriority = '1-URGENT') AS INTEGER) AS cust_serv_calls,
       avg(o_totalprice) / 1000 AS day_mins,
       CAST(count(*) AS INTEGER) AS day_calls,
       max(c_acctbal) / 100 AS monthly_charge,
       min(o_totalprice) / 10000 AS overage_fee,
       CAST(count(*) FILTER (WHERE o_orderstatus = 'P') AS DOUBLE) AS roam_mins
FROM customer JOIN orders ON c_custkey = o_custkey GROUP BY c_custkey, c_nationkey""",
    ),
    "churn_labels": (
        ("history",),
        """
SELECT customer_id,
       CASE WHEN date_diff('day', CAST(max(order_time) AS DATE), DATE '2024-01-31') > 365 THEN 1 ELSE 0 END AS churn,
       CASE WHEN date_diff('day', CAST(max(order_time) AS DATE), DATE '2024-01-31') > 365
            THEN CAST(max(order_time) AS DATE) + 365 END AS churn_date
FROM history GROUP BY customer_id""",
    ),
    "entity_frame": (
        (),
        """
SELECT concat('CUST', lpad(CAST(o_custkey AS VARCHAR), CAST(greatest(6, length(CAST(o_custkey AS VARCHAR))) AS INTEGER), '0')) AS customer_id,
       CAST(DATE '2024-01-01' + CAST(o_orderkey % 31 AS INTEGER) AS TIMESTAMP) AS event_timestamp
FROM orders""",
    ),
}
