"""Feature jobs: daily tables, the views' tables, snapshots and training frames."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.asof import features_at
from ..operators.daily import billing_daily, cdr_statistics, daily_features, promotion_daily
from ..operators.rolling import billing_features, billing_reads_from, promotion_features
from ..operators.snapshot import latest_snapshot
from ..schemas import MODEL_FEATURES, VIEWS, parse_refs
from ..session import materialize
from ..sources.tables import merge_snapshot, read_snapshot, write_features


def build_daily_tables(cdr: DataFrame, base: str) -> dict[str, str]:
    """Compute every daily metric once and write the three feature tables from it.

    The aggregate is stored first, so the call records are scanned and shuffled
    once rather than per table.
    """
    daily = materialize(daily_features(cdr), "daily")
    return write_features(
        {"cdr_statistics": cdr_statistics(daily), "billing": billing_daily(daily), "promotion": promotion_daily(daily)},
        base,
    )


def view_tables(
    daily: DataFrame,
    charges: DataFrame,
    payments: DataFrame,
    discounts: DataFrame,
    profiles: DataFrame,
    refs: list[str] | None = None,
    as_of: datetime | None = None,
) -> dict[str, DataFrame]:
    """The table behind each feature view. Pass a stored ``daily``: two views read it.

    With ``refs`` only the features named there are computed, and with ``as_of``
    no months that are beyond their lifetime by then.
    """
    wanted = None if refs is None else parse_refs(refs)
    of = lambda view: None if wanted is None else wanted.get(view, [])
    seen_from = None if as_of is None else billing_seen_from(as_of)
    return {
        "cdr_statistics": daily,
        "billing_features": billing_features(charges, payments, of("billing_features"), seen_from),
        "promotion_features": promotion_features(daily, discounts, of("promotion_features")),
        "customer_profile": profiles,
    }


def billing_seen_from(as_of: datetime) -> datetime:
    """The close of the oldest month of the billing view that is alive at ``as_of``."""
    return as_of - timedelta(days=VIEWS["billing_features"].ttl_days)


def payments_from(refs: list[str], as_of: datetime) -> date | None:
    """The first day whose payments :func:`view_tables` needs for these features; None if it needs all."""
    return billing_reads_from(parse_refs(refs).get("billing_features", []), billing_seen_from(as_of))


def daily_columns(refs: list[str]) -> list[str]:
    """What :func:`view_tables` needs of the daily table for these features."""
    wanted = parse_refs(refs)
    own, promotion = wanted.get("cdr_statistics", []), wanted.get("promotion_features", [])
    behind = {"promo_response_rate": ["promo_rows", "total_rows"], "days_since_last_promo": ["promo_rows"]}
    behind["active_promotions_count"] = ["active_promotions_count"]
    needed = [*own, *[c for f in promotion for c in behind.get(f, [])]]
    return ["customer_id", "event_date", "event_timestamp", *dict.fromkeys(needed), "created_timestamp"]


def materialize_snapshots(
    tables: dict[str, DataFrame], end: datetime, days: int = 90
) -> dict[str, DataFrame]:
    """The newest row per customer of each view over the last ``days`` days."""
    start = end - timedelta(days=days)
    return {name: latest_snapshot(t, start, end) for name, t in tables.items()}


def store_snapshots(
    tables: dict[str, DataFrame], base: str, end: datetime, days: int = 90
) -> dict[str, str]:
    """Merge each view's newest rows, in their declared types, into its stored snapshot; returns the paths by view."""
    paths = {}
    for name, rows in materialize_snapshots(tables, end, days).items():
        paths[name] = f"{base.rstrip('/')}/{name}"
        # dealing rows out by ranges of the key reads them twice: one row a customer is stored, not made again
        merge_snapshot(materialize(declared(rows, name), "newest"), paths[name])
    return paths


def stored_snapshots(spark: SparkSession, paths: dict[str, str]) -> dict[str, DataFrame]:
    """The views that :func:`store_snapshots` wrote, for lookups."""
    return {name: read_snapshot(spark, path) for name, path in paths.items()}


def declared(rows: DataFrame, view: str) -> DataFrame:
    """``rows`` with the view's columns in their declared types; a missing column is an error."""
    fields = VIEWS[view].fields
    if lacking := [c for c in fields if c not in rows.columns]:
        raise ValueError(f"the rows of {view} lack {', '.join(lacking)}")
    return rows.withColumns({c: F.col(c).cast(t) for c, t in fields.items()})


def training_frame(
    labels: DataFrame, tables: dict[str, DataFrame], as_of: datetime, refs: list[str] | None = None
) -> DataFrame:
    """Point-in-time features of every labelled customer at ``as_of``, with the label."""
    entities = labels.select("customer_id", "churn").filter("customer_id IS NOT NULL")
    entities = entities.withColumn("event_timestamp", F.lit(as_of).cast("timestamp_ntz"))
    features = features_at(entities, tables, refs or MODEL_FEATURES, as_of)
    return features.select("customer_id", "event_timestamp", *[c for c in features.columns if c not in entities.columns], "churn")
