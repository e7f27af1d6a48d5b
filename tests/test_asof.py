"""Point-in-time joins against a plain Python search."""

import random
from datetime import datetime, timedelta

import pytest

from dialtide.operators.asof import AsOfSource, feature_service_join, pit_join
from dialtide.operators.snapshot import latest_snapshot, online_lookup

T0 = datetime(2024, 1, 1)
FEATURES = "customer_id string, event_timestamp timestamp_ntz, created_timestamp timestamp_ntz, v int"
ENTITIES = "customer_id string, event_timestamp timestamp_ntz, tag int"


def search(features, key, at, ttl):
    found = [f for f in features if f[0] == key and f[1] is not None and f[1] <= at]
    if not found:
        return None
    best = max(found, key=lambda f: (f[1], f[2]))
    return best[3] if ttl is None or best[1] >= at - timedelta(days=ttl) else None


def random_case(seed, n_features, n_entities, hot=0.4):
    rng = random.Random(seed)

    def key():
        return "hot" if rng.random() < hot else f"k{rng.randint(0, 5)}"

    def instant():
        return T0 + timedelta(hours=rng.randint(0, 24 * 20))

    features = [(key(), instant(), T0 + timedelta(seconds=i), i) for i in range(n_features)]
    entities = [(key(), instant(), i) for i in range(n_entities)]
    return features, entities


@pytest.mark.parametrize("slice_seconds", [3600, 86400, 30 * 86400])
@pytest.mark.parametrize("ttl", [None, 2])
def test_matches_search(spark, slice_seconds, ttl):
    features, entities = random_case(7, 200, 300)
    source = AsOfSource(spark.createDataFrame(features, FEATURES), ttl, ["v"])
    got = pit_join(spark.createDataFrame(entities, ENTITIES), [source], slice_seconds=slice_seconds)
    expected = {(k, t, tag): search(features, k, t, ttl) for k, t, tag in entities}
    rows = {(r["customer_id"], r["event_timestamp"], r["tag"]): r["v"] for r in got.collect()}
    assert rows == expected


def test_several_sources_share_one_join(spark):
    first, entities = random_case(1, 100, 200)
    second, _ = random_case(2, 30, 1)
    sources = [
        AsOfSource(spark.createDataFrame(first, FEATURES), 3, ["v"], "a_"),
        AsOfSource(spark.createDataFrame(second, FEATURES), 10, ["v"], "b_"),
    ]
    got = pit_join(spark.createDataFrame(entities, ENTITIES), sources)
    for r in got.collect():
        assert r["a_v"] == search(first, r["customer_id"], r["event_timestamp"], 3)
        assert r["b_v"] == search(second, r["customer_id"], r["event_timestamp"], 10)


def test_lifetime_boundary_ties_and_nulls(spark):
    day = timedelta(days=1)
    features = [("a", T0, T0, 1), ("a", T0, T0 + day, 2), ("b", T0, T0, 3), (None, T0, T0, 4), ("c", None, T0, 5)]
    entities = [
        ("a", T0 + 2 * day, 0),
        ("b", T0 + 2 * day + timedelta(microseconds=1), 1),
        (None, T0, 2),
        ("a", None, 3),
        ("c", T0, 4),
        ("a", T0, 5),
        ("a", T0 - timedelta(microseconds=1), 6),
        ("a", T0, 7),
    ]
    source = AsOfSource(spark.createDataFrame(features, FEATURES), 2, ["v"])
    got = {r["tag"]: r["v"] for r in pit_join(spark.createDataFrame(entities, ENTITIES), [source]).collect()}
    assert got == {0: 2, 1: None, 2: None, 3: None, 4: None, 5: 2, 6: None, 7: 2}


def test_null_feature_values_do_not_fall_back_to_older_rows(spark):
    features = [("a", T0, T0, 1), ("a", T0 + timedelta(hours=1), T0, None)]
    source = AsOfSource(spark.createDataFrame(features, FEATURES), None, ["v"])
    entities = spark.createDataFrame([("a", T0 + timedelta(hours=2), 0), ("a", T0 + timedelta(days=2), 1)], ENTITIES)
    assert [r["v"] for r in pit_join(entities, [source]).collect()] == [None, None]


def test_before_the_epoch(spark):
    early = datetime(1969, 12, 31, 23, 0)
    source = AsOfSource(spark.createDataFrame([("a", early, early, 1)], FEATURES), None, ["v"])
    entities = spark.createDataFrame([("a", datetime(1970, 1, 1), 0), ("a", early - timedelta(hours=1), 1)], ENTITIES)
    assert {r["tag"]: r["v"] for r in pit_join(entities, [source]).collect()} == {0: 1, 1: None}


def test_service_join_keeps_reference_order(spark):
    stats = spark.createDataFrame(
        [("a", T0, T0, 3, 1.5)],
        "customer_id string, event_timestamp timestamp_ntz, created_timestamp timestamp_ntz, "
        "daily_total_calls bigint, daily_total_minutes double",
    )
    refs = ["cdr_statistics:daily_total_calls", "cdr_statistics:daily_total_minutes"]
    got = feature_service_join(spark.createDataFrame([("a", T0, 0)], ENTITIES), {"cdr_statistics": stats}, refs)
    assert got.columns == ["customer_id", "event_timestamp", "tag", "daily_total_calls", "daily_total_minutes"]
    assert tuple(got.first())[3:] == (3, 1.5)


def test_bad_reference_is_refused(spark):
    with pytest.raises(ValueError):
        feature_service_join(spark.createDataFrame([("a", T0, 0)], ENTITIES), {}, ["no_colon"])


def test_latest_snapshot(spark):
    hour = timedelta(hours=1)
    rows = [("a", T0, T0, 1), ("a", T0, T0 + hour, 2), ("a", T0 + hour, T0, 3), ("b", T0 + 2 * hour, T0, 4)]
    df = spark.createDataFrame(rows, FEATURES)
    assert {r["customer_id"]: r["v"] for r in latest_snapshot(df, T0, T0).collect()} == {"a": 2}
    assert {r["customer_id"]: r["v"] for r in latest_snapshot(df).collect()} == {"a": 3, "b": 4}


def test_online_lookup_unknown_expired_repeated(spark):
    schema = "customer_id string, event_timestamp timestamp_ntz, daily_total_calls bigint"
    stored = spark.createDataFrame([("a", T0, 1), ("old", T0 - timedelta(days=91), 2)], schema)
    requests = spark.createDataFrame([("a", 0), ("old", 1), ("nobody", 2), ("a", 3)], "customer_id string, position int")
    got = online_lookup(requests, {"cdr_statistics": stored}, ["cdr_statistics:daily_total_calls"], T0)
    assert [r["daily_total_calls"] for r in got.orderBy("position").collect()] == [1, None, None, 1]
