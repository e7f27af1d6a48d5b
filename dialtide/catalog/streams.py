"""Streaming jobs run until they have caught up; each must equal its batch form."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import fixtures as fx
from .. import streaming
from ..session import scratch_dir
from .base import ORACLES, query, register
from .features import METRICS, daily_frame
from .ingest import _as_local, _csv_copy


def _event_stream(spark, sf_dir):
    schema = fx.table(spark, sf_dir, "events").schema
    events = streaming.stream_ingest(spark, sf_dir, schema, "parquet", name_filter="events.parquet")
    return fx.events_to_cdr(events)


def _run(spark, stream, name):
    path = scratch_dir(spark, name)
    streaming.run_available(stream, f"{path}/table", f"{path}/checkpoint")
    return spark.read.parquet(f"{path}/table")


def stream_ingest(spark, sf_dir):
    source = _csv_copy(spark, sf_dir)
    path = scratch_dir(spark, "stream-ingest")
    for _ in range(2):  # the second run finds no new files
        streaming.run_available(streaming.stream_ingest(spark, source), f"{path}/table", f"{path}/checkpoint")
    return _as_local(spark.read.parquet(f"{path}/table"))


register("stream_ingest", stream_ingest, ORACLES["read_cdr_csv"])


def stream_clean(spark, sf_dir):
    return _run(spark, streaming.stream_clean(_event_stream(spark, sf_dir)), "stream-clean")


register("stream_clean", stream_clean, ORACLES["add_date_parts"])


@query("stream_dedupe", "SELECT * FROM cdr", ("cdr",), ("call_charge",))
def stream_dedupe(spark, sf_dir):
    source = scratch_dir(spark, "replayed")
    records = fx.cdr(spark, sf_dir)
    for _ in range(2):
        records.write.mode("append").parquet(source)
    stream = streaming.stream_ingest(spark, source, records.schema, "parquet")
    return _as_local(_run(spark, streaming.stream_dedupe(stream, "31 days"), "stream-dedupe"))


STREAMED = [m for m in METRICS if m != "created_timestamp"]


@query(
    "stream_daily_features",
    f"""
SELECT customer_id, event_date, {', '.join(STREAMED)} FROM daily
WHERE event_date + INTERVAL 1 DAY <= (SELECT max(call_time) FROM clean) - INTERVAL 1 HOUR""",
    ("daily", "clean"),
    tuple(m for m in STREAMED if METRICS[m]),
)
def stream_daily_features(spark, sf_dir):
    stream = streaming.stream_daily_features(streaming.stream_clean(_event_stream(spark, sf_dir)))
    closed = _run(spark, stream, "stream-daily")
    return closed.withColumn("event_timestamp", F.col("event_timestamp").cast("timestamp_ntz")).select(
        "customer_id", "event_date", *STREAMED
    )


@query(
    "push_latest",
    "SELECT * FROM daily QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY event_timestamp DESC) = 1",
    ("daily",),
    tuple(m for m, f in METRICS.items() if f),
)
def push_latest(spark, sf_dir):
    source, path = scratch_dir(spark, "feature-rows"), scratch_dir(spark, "pushed")
    daily = daily_frame(spark, sf_dir)
    daily.repartition(3, "event_date").write.parquet(source)
    stream = streaming.stream_ingest(spark, source, daily.schema, "parquet", max_files=1)
    streaming.push_latest(stream, f"{path}/table", f"{path}/checkpoint")
    return streaming.read_pushed(spark, f"{path}/table").select(*daily.columns)


#: The first days' records arrive last, all others in the order of their days: the day of a cut is open in both parts.
LATE_UNTIL = "(SELECT min(call_date) + 3 FROM (SELECT CAST(call_time AS DATE) AS call_date FROM clean))"


def _day_states(spark, sf_dir):
    """The base of a stream that got the events in three runs: to the middle, the rest, and last the first three days."""
    base, source = scratch_dir(spark, "day-state"), scratch_dir(spark, "arriving")
    records = fx.cdr(spark, sf_dir)
    first, last = records.filter("call_duration_seconds > 0").agg(F.min("call_time"), F.max("call_time")).first()
    middle, late = F.lit(first + (last - first) / 2), F.date_add(F.to_date(F.lit(first)), 3)
    came_late = F.to_date("call_time") < late
    for part in (~came_late & (F.col("call_time") < middle), ~came_late & (F.col("call_time") >= middle), came_late):
        records.filter(part).write.mode("append").parquet(source)
        stream = streaming.stream_ingest(spark, source, records.schema, "parquet")
        streaming.stream_day_state(streaming.stream_clean(stream), base, f"{base}/checkpoint", "1 hour")
    return base


STATE_COLUMNS = [m for m in METRICS if m != "created_timestamp"]


@query(
    "stream_day_state",
    f"""
SELECT customer_id, event_date, {', '.join(STATE_COLUMNS)},
       event_date + INTERVAL 1 DAY <= (SELECT max(call_time) FROM clean) - INTERVAL 1 HOUR AS closed
FROM daily WHERE event_date >= {LATE_UNTIL}""",
    ("daily", "clean"),
    tuple(m for m in STATE_COLUMNS if METRICS[m]),
)
def stream_day_state(spark, sf_dir):
    days = streaming.read_day_features(spark, _day_states(spark, sf_dir))
    return days.withColumn("event_timestamp", F.col("event_timestamp").cast("timestamp_ntz")).select(
        "customer_id", "event_date", *STATE_COLUMNS, "closed"
    )


@query(
    "stream_late_records",
    f"""
SELECT CAST(call_time AS DATE) AS event_date, customer_id, count(*) AS records, CAST(2 AS BIGINT) AS batch
FROM clean WHERE CAST(call_time AS DATE) < {LATE_UNTIL} GROUP BY ALL""",
    ("clean",),
)
def stream_late_records(spark, sf_dir):
    late = streaming.late_records(spark, _day_states(spark, sf_dir))
    return late.groupBy(F.to_date("call_time").alias("event_date"), "customer_id", "batch").agg(F.count("*").alias("records"))
