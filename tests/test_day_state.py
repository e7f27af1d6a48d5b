"""Daily features of a stream that late records amend."""

import random
from datetime import datetime, timedelta

import pytest
from helpers import calls, rows_of

from dialtide import streaming
from dialtide.operators import clean, daily
from dialtide.schemas import RAW_CDR
from dialtide.sources.snapshots import snapshot_versions

def some_calls(spark, n, seed):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        rows.append(
            {
                "call_id": f"c{seed}.{i}",
                "customer_id": f"u{rnd.randrange(6)}",
                "call_time": datetime(2024, 1, 1) + timedelta(minutes=rnd.randrange(4 * 24 * 60)),
                "call_duration_seconds": rnd.randrange(1, 400),
                "call_type": rnd.choice(["VOICE", "SMS", "DATA"]),
                "call_result": rnd.choice(["COMPLETED", "DROPPED"]),
                "destination_number": rnd.choice(["+15550001", "+44123", "CUSTOMER_SERVICE"]),
                "promotion_code": rnd.choice(["NONE", "FRIENDS", "DATA10", None]),
            }
        )
    return calls(spark, *rows)


def test_state_adds_up_to_the_daily_features(spark):
    records = some_calls(spark, 300, 1)
    parts = [records.filter(f"substring(call_id, -1) IN ({','.join(map(repr, d))})") for d in ("0123", "456", "789")]
    states = [daily.day_state(p) for p in parts]
    merged = daily.merged_state(states[0].union(states[1]).union(states[2]))
    every = [*daily.daily_features(records).columns]
    got = {(r["customer_id"], r["event_date"]): r for r in daily.features_of_state(merged).collect()}
    for r in daily.daily_features(records).collect():
        other = got.pop((r["customer_id"], r["event_date"]))
        for c in every:
            assert other[c] == (pytest.approx(r[c]) if isinstance(r[c], float) else r[c]), c
    assert not got


def test_late_records_inside_the_delay_amend_and_others_are_kept_apart(spark, tmp_path):
    base, source = str(tmp_path / "days"), str(tmp_path / "in")
    records = some_calls(spark, 400, 2).cache()
    day = lambda n: f"call_time >= '2024-01-0{n}' AND call_time < '2024-01-0{n + 1}'"
    even = "pmod(xxhash64(call_id), 2) = 0"
    # half of day 1 and day 2; the rest of day 1, still within two days; days 3 and 4; the rest of day 2, too late
    runs = [f"({day(1)} AND {even}) OR ({day(2)} AND {even})", f"{day(1)} AND NOT {even}", f"{day(3)} OR {day(4)}", f"{day(2)} AND NOT {even}"]
    for i, condition in enumerate(runs):
        records.filter(condition).write.mode("append").parquet(source)
        stream = streaming.stream_clean(streaming.stream_ingest(spark, source, RAW_CDR, "parquet"))
        delay = "1 day"
        streaming.stream_day_state(stream, base, str(tmp_path / "check"), delay)
        if i == 0:  # open days are readable
            first = daily.daily_features(clean.clean_cdr(records.filter(condition)))
            assert streaming.read_day_features(spark, base, delay).count() == first.count()
            assert not any(r["closed"] for r in streaming.read_day_features(spark, base, delay).collect())
    kept = records.filter(" OR ".join(f"({r})" for r in runs[:3]))
    want = {(r["customer_id"], r["event_date"]): r for r in daily.daily_features(clean.clean_cdr(kept)).collect()}
    found = streaming.read_day_features(spark, base, delay).collect()
    assert len(found) == len(want)
    for r in found:
        other = want[r["customer_id"], r["event_date"]]
        assert r["total_rows"] == other["total_rows"] and r["active_promotions_count"] == other["active_promotions_count"]
        assert r["daily_charges"] == pytest.approx(other["daily_charges"]) and r["avg_call_duration"] == (
            None if other["avg_call_duration"] is None else pytest.approx(other["avg_call_duration"])
        )
        assert r["closed"] == (r["event_date"].day <= 2)
    late = streaming.late_records(spark, base)
    assert rows_of(late, "call_id") == rows_of(clean.clean_cdr(records.filter(runs[3])), "call_id")
    progress = {r["batch"]: (r["records"], r["late"]) for r in streaming.stream_progress(spark, base).collect()}
    assert progress[3] == (late.count(), late.count()) and all(progress[b][1] == 0 for b in (0, 1, 2))
    records.unpersist()


def test_a_repeated_batch_counts_once(spark, tmp_path):
    base = str(tmp_path)
    batches = [clean.add_date_parts(clean.clean_cdr(some_calls(spark, 60, s))) for s in (3, 4)]
    for number in (0, 0, 1, 0, 1):
        streaming.add_batch(batches[number], base, number, "30 days")
    found = streaming.read_day_features(spark, base)
    both = daily.daily_features(batches[0].unionByName(batches[1]))
    assert rows_of(found, "customer_id", "event_date", "total_rows") == rows_of(both, "customer_id", "event_date", "total_rows")
    assert snapshot_versions(spark, f"{base}/state") == [0, 1]


def test_a_batch_that_broke_off_is_added_once(spark, tmp_path, monkeypatch):
    from dialtide.streaming import day_state

    base = str(tmp_path)
    batch = clean.add_date_parts(clean.clean_cdr(some_calls(spark, 40, 5)))
    with monkeypatch.context() as m:
        m.setattr(day_state, "update_snapshot", lambda *_: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            streaming.add_batch(batch, base, 0)
    streaming.add_batch(batch, base, 0)
    assert streaming.stream_progress(spark, base).count() == 1
    got = streaming.read_day_features(spark, base).agg({"total_rows": "sum"}).first()[0]
    assert got == batch.count()


def test_no_records(spark, tmp_path):
    base = str(tmp_path)
    empty = clean.add_date_parts(clean.clean_cdr(some_calls(spark, 5, 6))).limit(0)
    streaming.add_batch(empty, base, 0)
    assert streaming.read_day_features(spark, base).count() == 0
    assert streaming.late_records(spark, base).count() == 0
