"""Feature store: point-in-time joins, snapshots, lookups, label joins."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import functions as F

from .. import fixtures as fx
from ..operators import daily as ops
from ..operators import snapshot
from ..operators.asof import AsOfSource, feature_service_join, pit_join, select_features
from ..plans.features import daily_columns, payments_from, store_snapshots, stored_snapshots, training_frame, view_tables
from ..schemas import CHURN_SERVICE, MODEL_FEATURES, VIEWS, parse_refs
from ..session import materialize, scratch_dir
from .base import query
from .features import METRICS, PROFILE_DOUBLES, daily_frame

VIEW_TABLES = {
    "cdr_statistics": "daily",
    "billing_features": "billing_features",
    "promotion_features": "promotion_features",
    "customer_profile": "customer_profile",
}
FRACTIONAL = {
    *[m for m, f in METRICS.items() if f],
    "monthly_bill_amount",
    "payment_delay_days",
    "bill_fluctuation",
    "total_charges_3m",
    "promo_response_rate",
    "promo_discount_amount",
    *PROFILE_DOUBLES,
}


def names(refs: list[str]) -> list[str]:
    return [r.partition(":")[2] for r in refs]


def fractional(refs: list[str]) -> tuple[str, ...]:
    return tuple(n for n in names(refs) if n in FRACTIONAL)


def asof_sql(entities: str, refs: list[str], ttl: float | None = None) -> str:
    """ASOF LEFT JOINs of ``entities`` to the views of ``refs``."""
    joins, columns = [], []
    for view, cols in parse_refs(refs).items():
        days = VIEWS[view].ttl_days if ttl is None else ttl
        joins.append(
            f"ASOF LEFT JOIN {VIEW_TABLES[view]} AS v_{view} ON e.customer_id = v_{view}.customer_id "
            f"AND e.event_timestamp >= v_{view}.event_timestamp"
        )
        alive = f"v_{view}.event_timestamp >= e.event_timestamp - INTERVAL {days} DAY"
        columns += [f"CASE WHEN {alive} THEN v_{view}.{c} END AS {c}" for c in cols]
    return f"SELECT e.*, {', '.join(columns)} FROM {entities} e {' '.join(joins)}"


def tables(spark, sf_dir, refs=None, as_of=None):
    # two views read the daily table: store it once
    daily = daily_frame(spark, sf_dir)
    stored = materialize(daily if refs is None else daily.select(*daily_columns(refs)), "daily")
    return view_tables(
        stored,
        fx.charges(spark, sf_dir),
        fx.payments(spark, sf_dir, None if refs is None or as_of is None else payments_from(refs, as_of)),
        fx.discounts(spark, sf_dir),
        fx.customer_profile(spark, sf_dir),
        refs,
        as_of,
    )


PIT_REFS = [f"cdr_statistics:{c}" for c in ops.STATISTICS]


@query("pit_join", asof_sql("entity_frame", PIT_REFS, 3), ("entity_frame", "daily"), fractional(PIT_REFS))
def pit(spark, sf_dir):
    return pit_join(fx.entity_frame(spark, sf_dir), [AsOfSource(daily_frame(spark, sf_dir), 3, ops.STATISTICS)])


@query(
    "feature_service_join",
    asof_sql("entity_frame", CHURN_SERVICE),
    ("entity_frame", *VIEW_TABLES.values()),
    fractional(CHURN_SERVICE),
)
def service_join(spark, sf_dir):
    return feature_service_join(fx.entity_frame(spark, sf_dir), tables(spark, sf_dir), CHURN_SERVICE)


SELECTED = ["promotion_features:promo_response_rate", "promotion_features:days_since_last_promo"]


@query(
    "select_features",
    "SELECT customer_id, event_timestamp, promo_response_rate, days_since_last_promo FROM promotion_features",
    ("promotion_features",),
    ("promo_response_rate",),
)
def selected(spark, sf_dir):
    return select_features(tables(spark, sf_dir), SELECTED)["promotion_features"]


@query(
    "latest_snapshot",
    """
SELECT * FROM daily WHERE event_timestamp BETWEEN TIMESTAMP '2024-01-05' AND TIMESTAMP '2024-01-25'
QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY event_timestamp DESC, created_timestamp DESC) = 1""",
    ("daily",),
    tuple(m for m, f in METRICS.items() if f),
)
def latest(spark, sf_dir):
    return snapshot.latest_snapshot(daily_frame(spark, sf_dir), datetime(2024, 1, 5), datetime(2024, 1, 25))


LOOKUP_REFS = [
    "cdr_statistics:daily_total_minutes",
    "cdr_statistics:customer_service_calls",
    "customer_profile:contract_type",
    "customer_profile:monthly_charges",
]
LOOKUP_AT = datetime(2024, 4, 20)


def requests(spark, sf_dir):
    return fx.table(spark, sf_dir, "customer").select(
        fx.customer_key("c_custkey").alias("customer_id"), F.col("c_custkey").alias("position")
    )


@query(
    "online_lookup",
    """
SELECT concat('CUST', lpad(CAST(c_custkey AS VARCHAR), CAST(greatest(6, length(CAST(c_custkey AS VARCHAR))) AS INTEGER), '0')) AS customer_id, c_custkey AS position,
       daily_total_minutes, customer_service_calls, contract_type, monthly_charges
FROM customer
LEFT JOIN (SELECT * FROM daily QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY event_timestamp DESC) = 1) s
  ON s.customer_id = concat('CUST', lpad(CAST(c_custkey AS VARCHAR), CAST(greatest(6, length(CAST(c_custkey AS VARCHAR))) AS INTEGER), '0'))
     AND s.event_timestamp >= TIMESTAMP '2024-04-20' - INTERVAL 90 DAY
LEFT JOIN customer_profile p
  ON p.customer_id = concat('CUST', lpad(CAST(c_custkey AS VARCHAR), CAST(greatest(6, length(CAST(c_custkey AS VARCHAR))) AS INTEGER), '0'))
     AND p.event_timestamp >= TIMESTAMP '2024-04-20' - INTERVAL 365 DAY""",
    ("daily", "customer_profile"),
    ("daily_total_minutes", "monthly_charges"),
)
def lookup(spark, sf_dir):
    snapshots = {
        "cdr_statistics": snapshot.latest_snapshot(daily_frame(spark, sf_dir)),
        "customer_profile": snapshot.latest_snapshot(fx.customer_profile(spark, sf_dir)),
    }
    return snapshot.online_lookup(requests(spark, sf_dir), snapshots, LOOKUP_REFS, LOOKUP_AT)


def _view_sql(view: str) -> str:
    """Numeric columns of a view's newest rows, one row per value, in the declared types."""
    parts = [
        f"SELECT '{view}' AS view, customer_id, event_timestamp, '{c}' AS feature, "
        + (f"CAST(CAST({c} AS FLOAT) AS DOUBLE)" if t == "float" else f"CAST(trunc({c}) AS DOUBLE)")
        + " AS value FROM newest"
        for c, t in VIEWS[view].fields.items()
        if t != "string"
    ]
    return f"""
SELECT * FROM (WITH newest AS (
  SELECT * FROM {VIEW_TABLES[view]} WHERE event_timestamp BETWEEN TIMESTAMP '2023-11-02' AND TIMESTAMP '2024-01-31'
  QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY event_timestamp DESC) = 1)
{' UNION ALL '.join(parts)})"""


@query("materialize_views", " UNION ALL ".join(map(_view_sql, VIEW_TABLES)), tuple(VIEW_TABLES.values()), ("value",))
def materialize_views(spark, sf_dir):
    paths = store_snapshots(tables(spark, sf_dir), scratch_dir(spark, "views"), datetime(2024, 1, 31), 90)
    parts = []
    for view, rows in stored_snapshots(spark, paths).items():
        numeric = [c for c, t in VIEWS[view].fields.items() if t != "string"]
        values = rows.select("customer_id", "event_timestamp", *[F.col(c).cast("double").alias(c) for c in numeric])
        long = values.unpivot(["customer_id", "event_timestamp"], numeric, "feature", "value")
        parts.append(long.withColumn("view", F.lit(view)))
    return reduce(lambda a, b: a.unionByName(b), parts)


@query(
    "join_labels",
    "SELECT d.*, l.churn FROM daily d JOIN churn_labels l ON d.customer_id = l.customer_id",
    ("daily", "churn_labels"),
    tuple(m for m, f in METRICS.items() if f),
)
def join_labels(spark, sf_dir):
    return snapshot.join_labels(daily_frame(spark, sf_dir), fx.churn_labels(spark, sf_dir))


@query(
    "feature_target_split",
    "SELECT d.* EXCLUDE (event_timestamp) FROM daily d JOIN churn_labels l ON d.customer_id = l.customer_id",
    ("daily", "churn_labels"),
    tuple(m for m, f in METRICS.items() if f),
)
def feature_target_split(spark, sf_dir):
    return snapshot.feature_target_split(join_labels(spark, sf_dir))[0]


TRAINING_SQL = asof_sql(
    "(SELECT customer_id, TIMESTAMP '2024-01-31' AS event_timestamp, churn FROM churn_labels)", MODEL_FEATURES
)
TRAINING_USES = ("churn_labels", *VIEW_TABLES.values())


@query("training_frame", TRAINING_SQL, TRAINING_USES, fractional(MODEL_FEATURES))
def training(spark, sf_dir):
    as_of = datetime(2024, 1, 31)
    return training_frame(fx.churn_labels(spark, sf_dir), tables(spark, sf_dir, MODEL_FEATURES, as_of), as_of)
