"""Stored snapshots: deltas, compaction, versions that are there whole or not, expiry."""

import os
import random
from datetime import datetime, timedelta

import pytest
from helpers import plan_text, rows_of

from dialtide.sources import snapshots
from dialtide.sources.snapshots import expire_snapshots, merge_snapshot, read_manifest, read_snapshot, snapshot_versions

SCHEMA = "customer_id string, event_timestamp timestamp, created_timestamp timestamp, v int"
DAY = datetime(2024, 1, 1)


def rows(spark, values):
    """(key, day, v) rows; created a day later."""
    return spark.createDataFrame([(k, DAY + timedelta(days=d), DAY + timedelta(days=d + 1), v) for k, d, v in values], SCHEMA)


def files(base):
    return {os.path.join(d, f): os.path.getsize(os.path.join(d, f)) for d, _, names in os.walk(f"{base}/segments") for f in names if f.endswith(".parquet")}


def stored(spark, base, version=None):
    return rows_of(read_snapshot(spark, base, version), "customer_id", "v")


def test_a_batch_writes_its_own_keys_only(spark, tmp_path):
    base = str(tmp_path)
    assert merge_snapshot(rows(spark, [(f"c{i:04d}", 1, i) for i in range(2000)]), base) == 0
    before = files(base)
    changed = [(f"c{i:04d}", 2, -i) for i in range(0, 2000, 200)]
    assert merge_snapshot(rows(spark, changed), base) == 1
    new = {f: n for f, n in files(base).items() if f not in before}
    assert set(before) <= set(files(base)) and len(new) <= 10
    assert sum(spark.read.parquet(f).count() for f in new) == 10
    assert len(stored(spark, base)) == 2000 and {(k, v) for k, _, v in changed} <= set(stored(spark, base))
    assert stored(spark, base, 0) == [(f"c{i:04d}", i) for i in range(2000)]


def test_a_replay_and_older_rows_change_nothing(spark, tmp_path):
    base = str(tmp_path)
    merge_snapshot(rows(spark, [("a", 3, 3), ("b", 1, 1)]), base)
    for late in ([("a", 3, 3)], [("a", 2, 9), ("b", 1, 7)], []):
        before = files(base)
        merge_snapshot(rows(spark, late), base)
        assert files(base) == before and stored(spark, base) == [("a", 3), ("b", 1)]
    assert snapshot_versions(spark, base) == [0, 1, 2, 3]


def test_random_merges_equal_the_newest_rows(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(snapshots, "RANGES", 5)
    rnd, base, newest = random.Random(7), str(tmp_path), {}
    segments = set()
    for step in range(9):
        batch = {f"k{rnd.randrange(300 if step < 4 else 1500)}": (rnd.randrange(9), step * 1000 + i) for i in range(60)}
        merge_snapshot(rows(spark, [(k, d, v) for k, (d, v) in batch.items()]), base)
        for k, (d, v) in batch.items():
            if k not in newest or newest[k][0] < d:
                newest[k] = (d, v)
        parts = read_manifest(spark, base, snapshot_versions(spark, base)[-1])
        segments |= {p.segment for p in parts if p.place == 0}
        assert max(p.place for p in parts) < snapshots.DELTAS
        assert stored(spark, base) == sorted((k, v) for k, (_, v) in newest.items())
    assert len(segments) > 1  # ranges were put together on the way


def test_ranges_are_cut_anew_when_outgrown(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(snapshots, "RANGES", 4)
    base = str(tmp_path)
    merge_snapshot(rows(spark, [(f"a{i}", 1, i) for i in range(8)]), base)
    merge_snapshot(rows(spark, [(f"b{i:03d}", 1, i) for i in range(100)]), base)
    parts = read_manifest(spark, base, 1)
    assert all(p.place == 0 and p.laid_out == 108 for p in parts) and len(parts) == 4
    assert len(stored(spark, base)) == 108


def test_an_unfinished_version_is_not_read(spark, tmp_path, monkeypatch):
    base = str(tmp_path)
    merge_snapshot(rows(spark, [("a", 1, 1)]), base)
    monkeypatch.setattr(snapshots, "_write_manifest", lambda *_: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        merge_snapshot(rows(spark, [("a", 2, 2)]), base)
    monkeypatch.undo()
    assert snapshot_versions(spark, base) == [0] and stored(spark, base) == [("a", 1)]
    # a commit under way has its file below a hidden folder
    hidden = f"{base}/manifests/version={1:012d}/_temporary/0"
    os.makedirs(hidden)
    open(f"{hidden}/part-0.parquet", "wb").close()
    assert snapshot_versions(spark, base) == [0]
    assert merge_snapshot(rows(spark, [("a", 2, 2)]), base) == 1 and stored(spark, base) == [("a", 2)]


def test_old_versions_expire(spark, tmp_path):
    base = str(tmp_path)
    for step in range(7):
        merge_snapshot(rows(spark, [("a", step, step), (f"b{step}", 1, step)]), base)
    size = sum(files(base).values())
    assert expire_snapshots(spark, base, 2) == [5, 6] == snapshot_versions(spark, base)
    assert sum(files(base).values()) < size
    assert stored(spark, base) == sorted([("a", 6)] + [(f"b{s}", s) for s in range(7)])
    assert dict(stored(spark, base, 5))["a"] == 5


def test_empty_snapshots_null_keys_and_filters(spark, tmp_path):
    base = str(tmp_path / "x")
    assert snapshot_versions(spark, base) == []
    merge_snapshot(rows(spark, []), base)
    assert stored(spark, base) == [] and read_snapshot(spark, base).columns == ["customer_id", "event_timestamp", "created_timestamp", "v"]
    merge_snapshot(rows(spark, [(None, 1, 5), ("a", 1, 6)]), base)
    merge_snapshot(rows(spark, [(None, 2, 7), ("b", 1, 8)]), base)
    assert {(r[0], r[1]) for r in read_snapshot(spark, base).select("customer_id", "v").collect()} == {(None, 7), ("a", 6), ("b", 8)}
    assert "EqualTo(customer_id,a)" in plan_text(read_snapshot(spark, base).filter("customer_id = 'a'"))
