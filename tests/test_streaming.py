from datetime import datetime

import pytest
from helpers import calls, rows_of

from dialtide import streaming
from dialtide.operators import daily
from dialtide.schemas import RAW_CDR
from dialtide.sources.cdr_csv import read_cdr_csv, write_cdr_csv


@pytest.fixture
def dirs(tmp_path):
    return {n: str(tmp_path / n) for n in ("in", "out", "check")}


def run(stream, dirs):
    streaming.run_available(stream, dirs["out"], dirs["check"])


def test_ingest_reads_each_file_once(spark, dirs):
    write_cdr_csv(calls(spark, {"call_id": "a"}, {"call_id": "b", "customer_id": "007"}), dirs["in"])
    run(streaming.stream_ingest(spark, dirs["in"]), dirs)
    run(streaming.stream_ingest(spark, dirs["in"]), dirs)
    calls(spark, {"call_id": "c"}).selectExpr(
        *[f"string({f.name})" for f in RAW_CDR.fields]
    ).write.mode("append").csv(dirs["in"], header=True)
    run(streaming.stream_ingest(spark, dirs["in"]), dirs)
    got = spark.read.parquet(dirs["out"])
    assert rows_of(got, "call_id", "customer_id") == rows_of(read_cdr_csv(spark, dirs["in"]), "call_id", "customer_id")
    assert got.count() == 3


def test_replayed_file_is_dropped_across_runs(spark, dirs):
    batch = calls(spark, {"call_id": "a"}, {"call_id": "b"})
    for _ in range(2):
        batch.write.mode("append").parquet(dirs["in"])
        run(streaming.stream_dedupe(streaming.stream_ingest(spark, dirs["in"], RAW_CDR, "parquet"), "1 day"), dirs)
    assert rows_of(spark.read.parquet(dirs["out"]), "call_id") == [("a",), ("b",)]


def test_daily_features_of_closed_days_equal_the_batch(spark, dirs):
    batch = calls(
        spark,
        {"call_time": datetime(2024, 1, 1, 10)},
        {"call_time": datetime(2024, 1, 1, 18), "call_type": "SMS", "promotion_code": "FRIENDS"},
        {"call_time": datetime(2024, 1, 2, 10), "customer_id": "x"},
        {"call_time": datetime(2024, 1, 3, 10)},
    )
    batch.write.parquet(dirs["in"])
    stream = streaming.stream_ingest(spark, dirs["in"], RAW_CDR, "parquet")
    run(streaming.stream_daily_features(stream), dirs)
    columns = ["customer_id", "event_date", *daily.STATISTICS, *daily.BILLING, *daily.PROMOTION]
    closed = daily.daily_features(batch).filter("event_date < DATE '2024-01-03'")
    assert rows_of(spark.read.parquet(dirs["out"]), *columns) == rows_of(closed, *columns)


def test_pushes_are_idempotent(spark, dirs):
    schema = "customer_id string, event_timestamp timestamp, created_timestamp timestamp, v int"
    day = [datetime(2024, 1, d) for d in range(1, 5)]
    for rows in ([("a", day[2], day[2], 3)], [("a", day[1], day[1], 2), ("b", day[0], day[0], 1)]):
        df = spark.createDataFrame(rows, schema)
        df.write.mode("append").parquet(dirs["in"])
        stream = streaming.stream_ingest(spark, dirs["in"], df.schema, "parquet")
        streaming.push_latest(stream, dirs["out"], dirs["check"])
    expected = [("a", 3), ("b", 1)]
    assert rows_of(streaming.read_pushed(spark, dirs["out"]), "customer_id", "v") == expected
    # the same input under a new checkpoint rewrites the batch folders
    streaming.push_latest(streaming.stream_ingest(spark, dirs["in"], df.schema, "parquet"), dirs["out"], dirs["check"] + "2")
    assert rows_of(streaming.read_pushed(spark, dirs["out"]), "customer_id", "v") == expected
