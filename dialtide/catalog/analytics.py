"""Churn analytics over the churn table."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import fixtures as fx
from ..functions import hash_bucket, tenure_band
from ..operators import analytics as ops
from ..schemas import CHURN_METRICS, RAW_CDR
from .base import query, register, sql
from .ingest import CHURN_DOUBLES

USES = ("churn_table",)
FEATURES = ["churn", *CHURN_METRICS]
SEGMENT = """CASE WHEN account_weeks > 100 AND cust_serv_calls <= 1 AND data_plan = 1 THEN 'Low Risk'
     WHEN cust_serv_calls >= 4 OR (day_mins > 250 AND data_plan = 0) THEN 'High Risk' ELSE 'Medium Risk' END"""


def long_sql(columns: list[str], extra: str = "customer_id") -> str:
    return " UNION ALL ".join(
        f"SELECT {extra}, '{c}' AS feature, CAST({c} AS DOUBLE) AS value FROM churn_table" for c in columns
    )


@query("churn_table", "SELECT * FROM churn_table", USES, CHURN_DOUBLES)
def churn_table(spark, sf_dir):
    return fx.churn_table(spark, sf_dir)


@query("churn_labels", "SELECT * FROM churn_labels", ("churn_labels",))
def churn_labels(spark, sf_dir):
    return fx.churn_labels(spark, sf_dir)


@query(
    "churn_kpis",
    """
SELECT avg(churn) AS churn_rate, count(*) AS customers, count(*) FILTER (WHERE data_plan = 1) AS data_plan_customers,
       count(*) FILTER (WHERE data_plan = 1) / count(*) * 100 AS data_plan_pct,
       avg(monthly_charge) AS avg_monthly_charge, avg(contract_renewal) AS renewal_rate,
       avg(account_weeks) AS avg_account_weeks, 11 AS features
FROM churn_table""",
    USES,
    ("churn_rate", "data_plan_pct", "avg_monthly_charge", "renewal_rate", "avg_account_weeks"),
)
def churn_kpis(spark, sf_dir):
    return ops.churn_kpis(churn_table(spark, sf_dir))


@query(
    "missing_report",
    " UNION ALL ".join(
        f"SELECT * FROM (SELECT '{c}' AS \"column\", count(*) - count({c}) AS missing FROM cdr_dirty) WHERE missing > 0"
        for c in RAW_CDR.names
    ),
    ("cdr_dirty",),
)
def missing_report(spark, sf_dir):
    return ops.missing_report(fx.cdr_dirty(spark, sf_dir))


@query(
    "group_means",
    f"SELECT churn, {', '.join(f'avg({c}) AS {c}' for c in CHURN_METRICS)} FROM churn_table GROUP BY churn",
    USES,
    tuple(CHURN_METRICS),
)
def group_means(spark, sf_dir):
    return ops.group_means(churn_table(spark, sf_dir))


@query(
    "percent_difference",
    f"""
SELECT feature, (c - s) / s * 100 AS percent_difference
FROM (SELECT feature, avg(value) FILTER (WHERE churn = 1) AS c, avg(value) FILTER (WHERE churn = 0) AS s
      FROM ({long_sql(CHURN_METRICS, 'churn')}) GROUP BY feature)
WHERE s > 0 AND c IS NOT NULL""",
    USES,
    ("percent_difference",),
)
def percent_difference(spark, sf_dir):
    return ops.percent_difference(churn_table(spark, sf_dir))


@query(
    "service_calls_by_churn",
    "SELECT churn, avg(cust_serv_calls) AS avg_cust_serv_calls FROM churn_table GROUP BY churn",
    USES,
    ("avg_cust_serv_calls",),
)
def service_calls_by_churn(spark, sf_dir):
    return ops.service_calls_by_churn(churn_table(spark, sf_dir))


@query(
    "churn_by_data_plan",
    "SELECT data_plan, avg(churn) AS churn_rate, count(*) AS customers FROM churn_table GROUP BY data_plan",
    USES,
    ("churn_rate",),
)
def churn_by_data_plan(spark, sf_dir):
    return ops.churn_by_data_plan(churn_table(spark, sf_dir))


@query(
    "churn_by_tenure",
    """
SELECT CASE WHEN account_weeks <= 52 THEN 'new' ELSE 'old' END AS tenure_band, avg(churn) AS churn_rate,
       count(*) AS customers FROM churn_table GROUP BY 1""",
    USES,
    ("churn_rate",),
)
def churn_by_tenure(spark, sf_dir):
    return ops.churn_by_tenure(churn_table(spark, sf_dir))


@query(
    "tenure_band",
    "SELECT customer_id, CASE WHEN account_weeks <= 52 THEN 'new' ELSE 'old' END AS tenure_band FROM churn_table",
    USES,
)
def tenure(spark, sf_dir):
    return churn_table(spark, sf_dir).select("customer_id", tenure_band(F.col("account_weeks")).alias("tenure_band"))


@query("data_plan_filter", "SELECT * FROM churn_table WHERE data_plan = 1", USES, CHURN_DOUBLES)
def data_plan_filter(spark, sf_dir):
    return ops.data_plan_filter(churn_table(spark, sf_dir), True)


@query("churn_segment", f"SELECT customer_id, {SEGMENT} AS segment FROM churn_table", USES)
def churn_segment(spark, sf_dir):
    return ops.with_segment(churn_table(spark, sf_dir)).select("customer_id", "segment")


@query(
    "segment_summary",
    f"""
SELECT segment, count(*) AS customers, count(*) / sum(count(*)) OVER () * 100 AS percentage
FROM (SELECT {SEGMENT} AS segment FROM churn_table) GROUP BY segment""",
    USES,
    ("percentage",),
)
def segment_summary(spark, sf_dir):
    return ops.segment_summary(churn_table(spark, sf_dir))


TREND = """
SELECT date, (SELECT count(*) FROM churn_labels) AS total_customers,
       (SELECT count(*) FROM churn_labels l WHERE l.churn = 1 AND l.churn_date <= d.date) AS churned_customers,
       (SELECT count(*) FROM churn_labels l WHERE l.churn = 1 AND l.churn_date <= d.date)
         / (SELECT count(*) FROM churn_labels) AS churn_rate
FROM (SELECT CAST(unnest(generate_series(DATE '2024-01-31' - 90, DATE '2024-01-31', INTERVAL 1 DAY)) AS DATE) AS date) d"""


@query("churn_trend", TREND, ("churn_labels",), ("churn_rate",))
def churn_trend(spark, sf_dir):
    return ops.churn_trend(churn_labels(spark, sf_dir), fx.AXIS_END)


@query(
    "churn_delta",
    f"""
SELECT date, churn_rate, churn_rate - before AS delta
FROM (SELECT date, churn_rate, lag(churn_rate) OVER (ORDER BY date) AS before FROM ({TREND}))
ORDER BY date DESC LIMIT 1""",
    ("churn_labels",),
    ("churn_rate", "delta"),
)
def churn_delta(spark, sf_dir):
    return ops.churn_delta(churn_trend(spark, sf_dir))


@query(
    "box_summary",
    f"""
SELECT v.churn, v.feature AS metric, n, "min", q1, median, q3, "max",
       min(value) AS lower_whisker, max(value) AS upper_whisker
FROM ({long_sql(ops.BOX_METRICS, 'churn')}) v
JOIN (SELECT churn, feature, count(*) AS n, min(value) AS "min", quantile_cont(value, 0.25) AS q1,
             quantile_cont(value, 0.5) AS median, quantile_cont(value, 0.75) AS q3, max(value) AS "max"
      FROM ({long_sql(ops.BOX_METRICS, 'churn')}) GROUP BY ALL) q
  ON v.churn = q.churn AND v.feature = q.feature
WHERE value BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)
GROUP BY ALL""",
    USES,
    ('"min"', "q1", "median", "q3", '"max"', "lower_whisker", "upper_whisker"),
)
def box_summary(spark, sf_dir):
    return ops.box_summary(churn_table(spark, sf_dir))


@query(
    "histogram_by_churn",
    f"""
SELECT feature, churn, CAST(bin AS INTEGER) AS bin, lo + bin * width AS bin_start, lo + (bin + 1) * width AS bin_end,
       count(*) AS n
FROM (SELECT feature, churn, lo, width,
             CASE WHEN width > 0 THEN least(floor((value - lo) / width), 19) ELSE 0 END AS bin
      FROM (SELECT *, min(value) OVER f AS lo, (max(value) OVER f - min(value) OVER f) / 20 AS width
            FROM ({long_sql(ops.HISTOGRAM_METRICS, 'churn')}) WINDOW f AS (PARTITION BY feature)))
GROUP BY feature, churn, bin, lo, width""",
    USES,
    ("bin_start", "bin_end"),
)
def histogram_by_churn(spark, sf_dir):
    return ops.histogram_by_churn(churn_table(spark, sf_dir))


@query(
    "correlation_matrix",
    f"""
SELECT a.feature AS feature_a, b.feature AS feature_b, corr(a.value, b.value) AS correlation
FROM ({long_sql(FEATURES)}) a JOIN ({long_sql(FEATURES)}) b ON a.customer_id = b.customer_id GROUP BY 1, 2""",
    USES,
    ("correlation",),
)
def correlation_matrix(spark, sf_dir):
    return ops.correlation_matrix(churn_table(spark, sf_dir))


CHURN_CORRELATION = f"""
SELECT b.feature, corr(a.churn, b.value) AS importance
FROM churn_table a JOIN ({long_sql(CHURN_METRICS)}) b ON a.customer_id = b.customer_id GROUP BY 1"""


@query("churn_correlation", CHURN_CORRELATION, USES, ("importance",))
def churn_correlation(spark, sf_dir):
    return ops.churn_correlation(churn_table(spark, sf_dir))


@query("sample_rows", "SELECT * FROM churn_table ORDER BY customer_id LIMIT 10", USES, CHURN_DOUBLES)
def sample_rows(spark, sf_dir):
    return ops.sample_rows(churn_table(spark, sf_dir))


def _hash_sql(buckets: int) -> str:
    words = [f"CAST(concat('0x', substr(h, {i * 8 + 1}, 8)) AS HUGEINT)" for i in range(4)]
    number = words[0]
    for word in words[1:]:
        number = f"((({number}) % {buckets}) * 4294967296 + {word})"
    return f"CAST({number} % {buckets} AS INTEGER)"


register(
    "hash_bucket",
    lambda spark, sf_dir: churn_table(spark, sf_dir).select(
        "customer_id", hash_bucket(F.col("customer_id"), 100).alias("bucket")
    ),
    sql(f"SELECT customer_id, {_hash_sql(100)} AS bucket FROM (SELECT customer_id, md5(customer_id) AS h FROM churn_table)", USES),
)
