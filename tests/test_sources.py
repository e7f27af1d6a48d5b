import os
from datetime import datetime

import pytest
from helpers import calls, rows_of
from pyspark.sql import functions as F

from dialtide.operators import clean
from dialtide.operators.quality import QualityError
from dialtide.plans.ingest import ingest_day
from dialtide.session import scratch_dir
from dialtide.sources import cdr_csv, generate, models, tables

HEADER = (
    "call_id,customer_id,call_time,call_duration_seconds,call_type,destination_number,network_type,"
    "cell_tower_id,call_result,call_charge,promotion_code"
)
GOOD = "c1,001,2024-01-03 12:00:00,60,VOICE,+1555,4G,TOWER0001,COMPLETED,1.25,NONE"


def put(path, *lines, name="part.csv"):
    path.mkdir(parents=True, exist_ok=True)
    (path / name).write_text("\n".join([HEADER, *lines]) + "\n")
    return str(path)


@pytest.fixture
def messy(tmp_path):
    return put(
        tmp_path / "in",
        GOOD,
        "c2,002,2024-01-03 12:00:00,abc,VOICE,+1555,4G,T,COMPLETED,1.25,NONE",
        "c3,003,not a time,60,VOICE,+1555,4G,T,COMPLETED,1.25,NONE",
        "c4,004,2024-01-03 12:00:00,60",
        "c5,,2024-01-03 12:00:00,60,VOICE,+1555,4G,T,COMPLETED,1.25,",
        "c6,006,2024-01-03 12:00:00,6.5,VOICE,+1555,4G,T,COMPLETED,1.25,NONE",
        "c7,007,2024-01-03 12:00:00,99999999999,VOICE,+1555,4G,T,COMPLETED,1.25,NONE",
        'c8,"00,8",2024-01-03 12:00:00,,SMS,+1555,4G,T,COMPLETED,x,NONE',
        'c9,"00,9",2024-01-03 12:00:00,,SMS,+1555,4G,T,COMPLETED,,NONE',
        "c10,010,2024-01-03 12:00:00,60,VOICE,+1555,4G,T,COMPLETED,1.25,NONE,extra",
    )


def test_malformed_rows_are_split_off(spark, messy):
    good, bad = cdr_csv.read_cdr_csv(spark, messy), cdr_csv.quarantine_rows(spark, messy)
    assert rows_of(good, "call_id") == [("c1",), ("c5",), ("c9",)]
    assert rows_of(bad, "call_id", "reason") == [
        ("c10", "field_count"),
        ("c2", "call_duration_seconds"),
        ("c3", "call_time"),
        ("c4", "field_count"),
        ("c6", "call_duration_seconds"),
        ("c7", "call_duration_seconds"),
        ("c8", "call_charge"),
    ]


def test_result_does_not_depend_on_the_columns_read(spark, messy):
    good = cdr_csv.read_cdr_csv(spark, messy)
    assert good.count() == 3
    assert good.select("call_id").count() == 3
    assert len(good.select("call_charge").collect()) == 3
    assert good.filter("call_duration_seconds > 0").count() == 2
    assert cdr_csv.quarantine_rows(spark, messy).count() == 7


def test_ids_stay_text(spark, messy):
    assert cdr_csv.read_cdr_csv(spark, messy).filter("call_id = 'c1'").first()["customer_id"] == "001"


def test_silver_round_trip_replaces_only_its_days(spark, tmp_path):
    path = str(tmp_path / "silver")

    def records(*days):
        return clean.add_date_parts(calls(spark, *[{"customer_id": "007", "call_time": datetime(2024, 1, d, 9)} for d in days]))

    assert tables.write_silver(records(1, 1, 2), path) == 3
    assert tables.write_silver(records(2, 2, 3), path) == 3
    got = tables.read_silver(spark, path)
    assert rows_of(got, "customer_id", "year", "month", "day") == [("007", 2024, 1, d) for d in (1, 1, 2, 2, 3)]
    assert tables.read_silver(spark, path, "2024-01-02", "2024-01-02").count() == 2
    assert not any("customer_id=" in d for d, _, _ in os.walk(path))


def test_day_filter_prunes_partitions(spark, tmp_path):
    path = str(tmp_path / "silver")
    records = calls(spark, *[{"call_time": datetime(2024, 1, d, 9)} for d in (1, 2, 3)])
    tables.write_silver(clean.add_date_parts(records), path)
    day = tables.read_silver(spark, path, "2024-01-02", "2024-01-02").select("call_id")
    plan = day._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "PartitionFilters: []" not in plan
    assert len(day.inputFiles()) >= 1 and day.count() == 1


def test_ingest_day(spark, tmp_path):
    raw, silver, ledger = tmp_path / "raw", str(tmp_path / "silver"), str(tmp_path / "ledger")
    bad = "c2,002,2024-01-03 12:00:00,abc,VOICE,+1555,4G,T,COMPLETED,1.25,NONE"
    put(raw / "cdr" / "2024-01-03", GOOD, bad)
    first = ingest_day(spark, str(raw), silver, "2024-01-03", ledger, str(tmp_path / "bad"))
    assert (first.files, first.rows) == (1, 1)
    assert tables.read_silver(spark, first.path).first()["customer_id"] == "001"
    assert spark.read.parquet(str(tmp_path / "bad")).count() == 1
    again = ingest_day(spark, str(raw), silver, "2024-01-03", ledger)
    assert (again.files, again.rows) == (0, 0)
    assert ingest_day(spark, str(raw), silver, "2024-01-04", ledger).files == 0


def test_a_late_file_adds_to_its_day(spark, tmp_path):
    raw, silver, ledger, bad = tmp_path / "raw", str(tmp_path / "silver"), str(tmp_path / "ledger"), str(tmp_path / "bad")
    broken = "c2,002,2024-01-03 12:00:00,abc,VOICE,+1555,4G,T,COMPLETED,1.25,NONE"
    day = raw / "cdr" / "2024-01-03"
    put(day, *[GOOD.replace("c1", f"a{i}") for i in range(5)], broken)
    first = ingest_day(spark, str(raw), silver, "2024-01-03", ledger, bad)
    os.makedirs(day / "late")
    put(day / "late", *[GOOD.replace("c1", f"b{i}") for i in range(3)], broken)
    second = ingest_day(spark, str(raw), silver, "2024-01-03", ledger, bad)
    assert (first.rows, second.rows) == (5, 3) and first.run != second.run
    assert tables.read_silver(spark, first.path).count() == 8
    assert spark.read.parquet(bad).count() == 2
    recorded = spark.read.parquet(ledger)
    assert tables.read_silver(spark, first.path, ledger=recorded).count() == 8
    # a run that broke off before it was recorded is not seen, and a repeat replaces it
    only_first = recorded.filter(recorded.run == first.run)
    assert tables.read_silver(spark, first.path, ledger=only_first).count() == 5
    only_first.write.parquet(f"{ledger}-before")
    again = ingest_day(spark, str(raw), silver, "2024-01-03", f"{ledger}-before", bad)
    assert again.run == second.run and tables.read_silver(spark, first.path).count() == 8


def test_a_run_is_visible_once_it_is_published(spark, tmp_path, monkeypatch):
    from dialtide.plans import ingest

    raw, silver, ledger = tmp_path / "raw", str(tmp_path / "silver"), str(tmp_path / "ledger")
    day = raw / "cdr" / "2024-01-03"
    put(day, GOOD)
    first = ingest_day(spark, str(raw), silver, "2024-01-03", ledger)
    os.makedirs(day / "late")
    put(day / "late", *[GOOD.replace("c1", f"b{i}") for i in range(2)])
    with monkeypatch.context() as m:  # breaks off after its rows are written
        m.setattr(ingest, "publish_run", lambda *_: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            ingest_day(spark, str(raw), silver, "2024-01-03", ledger)
    assert tables.read_silver(spark, first.path).count() == 1
    with monkeypatch.context() as m:  # breaks off after publishing, before it is recorded
        m.setattr(ingest, "mark_processed", lambda *_: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            ingest_day(spark, str(raw), silver, "2024-01-03", ledger)
    assert tables.read_silver(spark, first.path).count() == 3
    os.makedirs(day / "later")
    put(day / "later", GOOD.replace("c1", "d0"))
    again = ingest_day(spark, str(raw), silver, "2024-01-03", ledger)  # meets one more file: another run
    assert again.files == 2 and tables.read_silver(spark, first.path).count() == 4
    assert ingest_day(spark, str(raw), silver, "2024-01-03", ledger).files == 0


def test_ingest_stops_on_bad_quality(spark, tmp_path):
    raw, silver, ledger = tmp_path / "raw", str(tmp_path / "silver"), str(tmp_path / "ledger")
    put(raw / "cdr" / "2024-01-03", GOOD.replace("VOICE", "FAX"))
    with pytest.raises(QualityError):
        ingest_day(spark, str(raw), silver, "2024-01-03", ledger)
    assert not os.path.exists(ledger) and not os.path.exists(silver)


def test_ids_longer_than_their_padding_stay_apart(spark):
    from dialtide.fixtures import customer_key

    keys = [r[0] for r in spark.range(999_998, 1_000_012).select(customer_key("id")).collect()]
    assert keys[0] == "CUST999998" and keys[-1] == "CUST1000011" and len(set(keys)) == 14


def test_snapshots_merge_and_prune_by_key(spark, tmp_path):
    base, schema = str(tmp_path / "snap"), "customer_id string, event_timestamp timestamp, v int"
    day = [datetime(2024, 1, d) for d in range(1, 5)]
    assert tables.merge_snapshot(spark.createDataFrame([("a", day[2], 3), ("b", day[0], 1)], schema), base) == 0
    newer = spark.createDataFrame([("a", day[1], 2), ("b", day[3], 4), ("c", day[0], 5)], schema)
    assert tables.merge_snapshot(newer, base) == 1 and tables.merge_snapshot(newer, base) == 2
    assert rows_of(tables.read_snapshot(spark, base), "customer_id", "v") == [("a", 3), ("b", 4), ("c", 5)]
    assert rows_of(tables.read_snapshot(spark, base, 0), "customer_id", "v") == [("a", 3), ("b", 1)]
    plan = tables.read_snapshot(spark, base).filter("customer_id = 'a'")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(customer_id,a)" in plan


def test_features_of_a_new_day_leave_the_others(spark, tmp_path):
    schema, base = "customer_id string, event_timestamp timestamp, v int", str(tmp_path)
    for d in (1, 2, 2):
        path = tables.write_features({"t": spark.createDataFrame([("a", datetime(2024, 1, d), d)], schema)}, base)["t"]
    assert rows_of(tables.read_features(spark, path), "v") == [(1,), (2,)]
    tables.write_features({"t": spark.createDataFrame([("a", datetime(2024, 1, 3), 3)], schema)}, base, replace_all=True)
    assert rows_of(tables.read_features(spark, path), "v") == [(3,)]


def test_paths():
    assert cdr_csv.raw_path("s3a://raw/", "2024-01-03") == "s3a://raw/cdr/2024-01-03/"
    assert cdr_csv.silver_path("s3a://silver", "2024-01-03") == "s3a://silver/cdr/dt=2024-01-03/"


def test_generator(spark):
    df = generate.generate_cdr(spark, 20000)
    got = df.agg(
        F.count("*"), F.count_distinct("call_id"), F.count_distinct("customer_id"),
        F.min("call_duration_seconds"), F.max("call_duration_seconds"), F.min("call_charge"), F.max("call_charge"),
        F.count_distinct("call_type"), F.count_distinct("network_type"), F.count_distinct("call_result"),
        F.count_distinct("promotion_code"), F.count_distinct(F.to_date("call_time")),
    ).first()
    assert got[0] == got[1] == 20000 and got[2] == 200
    assert got[3] >= 5 and got[4] <= 1800 and got[5] >= 0.01 - 1e-6 and got[6] <= 15.0
    assert got[7:11] == (3, 6, 5, 5) and got[11] in (31, 32)
    assert df.filter("destination_number = 'CUSTOMER_SERVICE'").count() > 0
    again = generate.generate_cdr(spark, 20000).repartition(5)
    assert df.exceptAll(again).count() == 0
    assert df.exceptAll(generate.generate_cdr(spark, 20000, seed=1)).count() == 20000


def test_metrics_history(spark, tmp_path):
    base = str(tmp_path)
    models.write_metrics(spark, {"f1": 0.5}, base, datetime(2024, 1, 2, 3, 4, 5))
    models.write_metrics(spark, {"f1": 0.7, "roc_auc": 0.9}, base, datetime(2024, 1, 1))
    history = models.read_metrics_history(spark, base)
    assert [(r["timestamp"], r["f1"], r["roc_auc"], r["accuracy"]) for r in history.collect()] == [
        (datetime(2024, 1, 1), 0.7, 0.9, 0.0),
        (datetime(2024, 1, 2, 3, 4, 5), 0.5, 0.0, 0.0),
    ]
    assert models.latest_metrics(history).first()["f1"] == 0.5


def test_benchmark_rows(spark, tmp_path):
    from dialtide.operators.analytics import benchmark_summary
    from dialtide.schemas import BENCHMARK_ROWS

    rows = [(10, 1, 2.0, 1.0, 10, 5.0, 1), (10, 2, 4.0, 3.0, 10, 2.5, 1)]
    df = spark.createDataFrame(rows, BENCHMARK_ROWS)
    tables.write_benchmark_results(df, str(tmp_path / "b"))
    back = spark.read.schema(BENCHMARK_ROWS).csv(str(tmp_path / "b"), header=True)
    assert tuple(benchmark_summary(back).first()) == (10, 3.0, 2.0, 3.75)


def test_scratch_is_below_the_shared_folder(spark):
    path = scratch_dir(spark, "x")
    assert path.startswith(spark.conf.get("spark.checkpoint.dir")) and path != scratch_dir(spark, "x")


def test_benchmark_job(spark, tmp_path):
    from dialtide.plans.benchmark import run_benchmark

    got = run_benchmark(spark, [500], 2, str(tmp_path / "results")).collect()
    assert [(r["row_count"], r["repetition"], r["record_count"]) for r in got] == [(500, 1, 500), (500, 2, 500)]
    assert all(r["records_per_second"] > 0 and r["spark_executors"] >= 1 for r in got)
