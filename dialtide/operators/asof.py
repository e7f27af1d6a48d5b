"""Point-in-time joins: the newest feature row at or before each request.

Spark has no as-of join. A range-condition join would pair each request with
every earlier feature row of its customer, and one window per customer would
put a customer with a third of all rows into one task. Instead:

1. requests are reduced to distinct (customer, instant);
2. requests and feature rows of *all* views form one timeline, split by
   customer and time slice, and a running ``last`` finds the pick inside the
   slice — one shuffle, and a busy customer spreads over its slices;
3. the newest row of each slice is carried forward over the slices of a
   customer: one row per slice there, whatever the slice held;
4. picks older than the view's lifetime become null, and the result joins back
   to the entity frame (adaptive execution splits repeated requests).
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..schemas import VIEWS, parse_refs
from .snapshot import latest_snapshot

DAY = 86400
#: Feature rows are daily or coarser, so a slice holds many of them and one is carried.
SLICE = 30 * DAY


@dataclass(frozen=True)
class AsOfSource:
    """A feature table to look up: its rows, lifetime and wanted columns."""

    rows: DataFrame
    ttl_days: float | None
    columns: list[str]
    prefix: str = ""
    created: str = "created_timestamp"


def _micros(ts: Column) -> Column:
    return F.unix_micros(ts.cast("timestamp"))


def pit_join(
    entities: DataFrame,
    sources: list[AsOfSource],
    key: str = "customer_id",
    time: str = "event_timestamp",
    slice_seconds: int = SLICE,
    only_requested: bool = False,
) -> DataFrame:
    """``entities`` plus, per source, its newest row not after ``time``.

    Ties on the instant go to the newest creation time. A row exactly
    ``ttl_days`` old still counts; an older one yields nulls, as does no match.
    Feature rows after the newest request, or too old for the oldest one, never
    enter the shuffle. ``only_requested`` also keeps rows of other keys out, by
    a semi-join: right when few of many keys are asked for.
    """
    width = slice_seconds * 1_000_000
    requests = entities.filter(F.col(key).isNotNull() & F.col(time).isNotNull()).select(key, time).distinct()
    picks = [f"_pick{i}" for i in range(len(sources))]
    types = [F.struct(F.col(time).alias("_ts"), *s.columns) for s in sources]

    def timeline_part(rows: DataFrame, created: Column, own: int | None) -> DataFrame:
        return rows.select(
            key,
            F.col(time).alias("_at"),
            F.floor(_micros(F.col(time)) / width).cast("bigint").alias("_slice"),
            F.lit(1 if own is None else 0).alias("_request"),
            created.alias("_created"),
            *[types[i].alias(p) for i, p in enumerate(picks) if i == own],
        )

    timeline = timeline_part(requests, F.lit(None).cast("bigint"), None)
    # one row, read by every source as a scalar subquery
    span = requests.agg(
        F.struct(F.min(_micros(F.col(time))).alias("low"), F.max(_micros(F.col(time))).alias("high")).alias("span")
    )
    for i, source in enumerate(sources):
        at, asked = _micros(F.col(time)), span.scalar()
        rows = source.rows.filter(F.col(key).isNotNull() & (at <= asked["high"]))
        if source.ttl_days is not None:
            rows = rows.filter(at >= asked["low"] - int(source.ttl_days * DAY * 1_000_000))
        if only_requested:
            rows = rows.join(requests.select(key).distinct(), key, "left_semi")
        created = _micros(F.col(source.created)) if source.created in rows.columns else F.lit(None).cast("bigint")
        timeline = timeline.unionByName(timeline_part(rows, created, i), allowMissingColumns=True)

    order = Window.partitionBy(key, "_slice").orderBy("_at", "_request", "_created")
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    running = timeline.select(
        key,
        "_at",
        "_slice",
        "_request",
        F.lead(F.lit(False), 1, True).over(order).alias("_last"),
        *[F.last(p, ignorenulls=True).over(upto).alias(p) for p in picks],
    )
    found = running.filter(F.col("_request") == 1)
    # the running pick of a slice's last row is the newest of the slice; both
    # branches need the same columns, so they read one shuffle
    newest = running.filter("_last")
    before = Window.partitionBy(key).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    carried = newest.select(
        key, "_slice", *[F.last(p, ignorenulls=True).over(before).alias(f"{p}_carried") for p in picks]
    )

    def alive(pick: str, ttl_days: float | None) -> Column:
        value = F.coalesce(F.col(pick), F.col(f"{pick}_carried"))
        if ttl_days is None:
            return value
        oldest = _micros(F.col("_at")) - int(ttl_days * DAY * 1_000_000)
        return F.when(_micros(value["_ts"]) >= oldest, value)

    picked = found.join(carried, [key, "_slice"], "left").select(
        key, F.col("_at").alias(time), *[alive(p, s.ttl_days).alias(p) for p, s in zip(picks, sources)]
    )
    wanted = [
        F.col(p)[c].alias(f"{s.prefix}{c}") for p, s in zip(picks, sources) for c in s.columns
    ]
    return entities.join(picked, [key, time], "left").select(*[F.col(c) for c in entities.columns], *wanted)


def feature_service_join(
    entities: DataFrame, tables: dict[str, DataFrame], refs: list[str], slice_seconds: int = SLICE
) -> DataFrame:
    """One wide row per entity row out of several views, in the order of ``refs``.

    Lifetimes come from the views; all views share the shuffles of one
    :func:`pit_join`.
    """
    wanted = parse_refs(refs)
    sources = [AsOfSource(tables[v], VIEWS[v].ttl_days, cols) for v, cols in wanted.items()]
    joined = pit_join(entities, sources, slice_seconds=slice_seconds)
    return joined.select(*entities.columns, *[r.partition(":")[2] for r in refs])


def features_at(entities: DataFrame, tables: dict[str, DataFrame], refs: list[str], at: datetime, key: str = "customer_id") -> DataFrame:
    """:func:`feature_service_join` where every entity row asks for the same instant.

    Then there is no timeline: the pick of a key is its newest row that is alive,
    an aggregate that combines rows before the shuffle.
    """
    found = entities
    for view, columns in parse_refs(refs).items():
        rows = tables[view]
        keep = [key, "event_timestamp", *columns, *(["created_timestamp"] if "created_timestamp" in rows.columns else [])]
        # instants as the tables have them: without a zone
        time = F.col("event_timestamp").cast("timestamp_ntz")
        end, start = (F.lit(t).cast("timestamp_ntz") for t in (at, at - timedelta(days=VIEWS[view].ttl_days)))
        alive = rows.select(*keep).filter(F.col(key).isNotNull() & (time >= start) & (time <= end))
        found = found.join(latest_snapshot(alive, key=key).select(key, *columns), key, "left")
    return found.select(*entities.columns, *[r.partition(":")[2] for r in refs])


def select_features(tables: dict[str, DataFrame], refs: list[str]) -> dict[str, DataFrame]:
    """The key, time and referenced columns of each view named in ``refs``."""
    return {
        view: tables[view].select("customer_id", "event_timestamp", *cols)
        for view, cols in parse_refs(refs).items()
    }
