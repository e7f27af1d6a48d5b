"""Latest values per customer, and lookups into them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import VIEWS, parse_refs


def latest_snapshot(
    rows: DataFrame, start=None, end=None, key: str = "customer_id", created: str = "created_timestamp"
) -> DataFrame:
    """Newest row per key with event_timestamp in [start, end].

    Ties go to the newest creation time. An aggregate, not a window: each task
    first keeps one row per key, so busy customers shrink before the shuffle.
    """
    time = F.col("event_timestamp")
    if start is not None:
        rows = rows.filter(time >= F.lit(start))
    if end is not None:
        rows = rows.filter(time <= F.lit(end))
    order = [time] + ([F.col(created)] if created in rows.columns else [])
    others = [c for c in rows.columns if c != key]
    newest = rows.groupBy(key).agg(F.max_by(F.struct(*others), F.struct(*order)).alias("row"))
    return newest.select(*[F.col(key) if c == key else F.col("row")[c].alias(c) for c in rows.columns])


def online_lookup(
    requests: DataFrame,
    snapshots: dict[str, DataFrame],
    refs: list[str],
    as_of=None,
    key: str = "customer_id",
    mark: bool = False,
) -> DataFrame:
    """Stored features of each requested key; unknown or expired ones are null.

    ``requests`` keeps its columns (such as a position) and duplicates. A value
    expires when it is older than its view's lifetime at ``as_of``. ``mark``
    adds ``has_features``: whether any view knows the key.
    """

    def one_view(view: str, cols: list[str]) -> DataFrame:
        stored = snapshots[view]
        if as_of is not None:
            oldest = F.lit(as_of) - F.expr(f"INTERVAL {VIEWS[view].ttl_days} DAYS")
            stored = stored.filter(F.col("event_timestamp") >= oldest)
        stored = stored.select(key, *cols, F.lit(True).alias(f"_has_{view}"))
        # few requests are broadcast and cut the stored side down where it is read; many join on the same key anyway
        return stored.join(wanted, key, "left_semi")

    wanted = requests.select(key).distinct()
    refs_by_view = parse_refs(refs)
    views = [one_view(v, cols) for v, cols in refs_by_view.items()]
    found = reduce(lambda left, right: left.join(right, key, "left"), views, requests)
    flags = [F.coalesce(F.col(f"_has_{v}"), F.lit(False)) for v in refs_by_view]
    extra = [reduce(lambda a, b: a | b, flags).alias("has_features")] if mark else []
    return found.select(*requests.columns, *[r.partition(":")[2] for r in refs], *extra)


def lookup_one(
    value: str, snapshots: dict[str, DataFrame], refs: list[str], as_of=None, key: str = "customer_id", mark: bool = False
) -> DataFrame:
    """:func:`online_lookup` of one key, which goes into the scan of the stored side as a filter."""
    request = next(iter(snapshots.values())).sparkSession.createDataFrame([(value,)], f"{key} string")
    one = {view: stored.filter(F.col(key) == value) for view, stored in snapshots.items()}
    return online_lookup(request, one, refs, as_of, key, mark)


def join_labels(features: DataFrame, labels: DataFrame, key: str = "customer_id") -> DataFrame:
    """Features of labelled customers with their churn flag; repeats multiply."""
    return features.join(labels.select(key, "churn"), key)


def feature_target_split(training: DataFrame, target: str = "churn") -> tuple[DataFrame, DataFrame]:
    """The features (no target, no timestamp) and the target, both with the key."""
    return training.drop(target, "event_timestamp"), training.select("customer_id", target)


def unprocessed_files(files: DataFrame, ledger: DataFrame, key: str = "path") -> DataFrame:
    """Files whose path is not in the ledger of processed ones."""
    return files.join(ledger.select(key), key, "left_anti")
