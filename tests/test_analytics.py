from datetime import date

import numpy as np
import pytest
from pyspark.sql import functions as F

from dialtide.functions import churn_segment, gauge_band, hash_bucket, risk_level, tenure_band
from dialtide.operators import analytics, monitoring, ranking


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(1)
    rows = [
        (f"c{i}", int(rng.random() < 0.3), int(rng.integers(1, 200)), int(rng.integers(0, 2)), int(rng.integers(0, 2)),
         float(rng.random() * 4), int(rng.integers(0, 7)), float(rng.random() * 400), float(rng.random() * 100), 7.0)
        for i in range(300)
    ]
    return spark.createDataFrame(
        rows,
        "customer_id string, churn int, account_weeks int, contract_renewal int, data_plan int, data_usage double, "
        "cust_serv_calls int, day_mins double, monthly_charge double, same double",
    )


def test_segments(spark):
    cases = [
        (4, 0.0, 1, 200, "High Risk"),
        (0, 250.1, 0, 10, "High Risk"),
        (0, 250.0, 0, 10, "Medium Risk"),
        (1, 0.0, 1, 101, "Low Risk"),
        (1, 0.0, 1, 100, "Medium Risk"),
        (None, None, None, None, "Medium Risk"),
        (None, 300.0, 0, 10, "High Risk"),
    ]
    df = spark.createDataFrame(cases, "s int, m double, p int, w int, expected string")
    got = df.select("expected", churn_segment(F.col("s"), F.col("m"), F.col("p"), F.col("w")).alias("got")).collect()
    assert [r["got"] for r in got] == [r["expected"] for r in got]


def test_bands(spark):
    df = spark.createDataFrame([(0.2999, 52), (0.3, 53), (0.7, 1), (None, None)], "p double, w int")
    got = df.select(risk_level(F.col("p")), gauge_band(F.col("p") * 100), tenure_band(F.col("w"))).collect()
    assert [tuple(r) for r in got] == [
        ("Low Risk", "Low Risk", "new"),
        ("Medium Risk", "Medium Risk", "old"),
        ("High Risk", "High Risk", "new"),
        (None, None, None),
    ]


def test_hash_bucket_is_the_128_bit_remainder(spark):
    import hashlib

    ids = ["CUST123456", "CUST789012", "", "é"]
    df = spark.createDataFrame([(i,) for i in ids], "id string")
    for n in (7, 100, 1000, 999_983):
        got = [r[0] for r in df.select(hash_bucket(F.col("id"), n)).collect()]
        assert got == [int(hashlib.md5(i.encode()).hexdigest(), 16) % n for i in ids]


def test_correlations(table):
    pdf = table.drop("customer_id").toPandas()
    expected = pdf.corr()
    for r in analytics.correlation_matrix(table).collect():
        want = expected.loc[r["feature_a"], r["feature_b"]]
        assert r["correlation"] is None if np.isnan(want) else r["correlation"] == pytest.approx(want, abs=1e-9)
    ordered = [r["importance"] for r in analytics.churn_correlation(table).collect() if r["importance"] is not None]
    assert ordered == sorted(ordered, reverse=True)


def test_correlation_with_nulls_uses_complete_pairs(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, None), (3.0, 1.0), (4.0, 5.0), (None, 9.0)], "a double, b double")
    got = {(r[0], r[1]): r[2] for r in analytics.correlation_matrix(df).collect()}
    assert got[("a", "b")] == pytest.approx(np.corrcoef([1, 3, 4], [2, 1, 5])[0, 1])


def test_box_whiskers_end_inside_the_reach(spark):
    values = [1.0, 2.0, 3.0, 4.0, 5.0, 100.0]
    df = spark.createDataFrame([(0, v) for v in values], "churn int, m double")
    (r,) = analytics.box_summary(df, metrics=["m"]).collect()
    assert (r["min"], r["median"], r["max"]) == (1.0, 3.5, 100.0)
    assert (r["lower_whisker"], r["upper_whisker"]) == (1.0, 5.0)


def test_histogram_counts_everything_once(table):
    got = analytics.histogram_by_churn(table, metrics=["day_mins", "same"])
    assert got.groupBy("feature").agg(F.sum("n").alias("n")).filter("n <> 300").count() == 0
    assert got.filter("feature = 'same'").select("bin").distinct().count() == 1
    assert got.agg(F.max("bin")).first()[0] == 19


def test_percent_difference_skips_zero_means(spark):
    df = spark.createDataFrame([(0, 0.0, 2.0), (1, 5.0, 3.0)], "churn int, a double, b double")
    assert [tuple(r) for r in analytics.percent_difference(df).collect()] == [("b", 50.0)]


def test_trend_accumulates_and_counts_earlier_churn(spark):
    rows = [("a", 1, date(2023, 1, 1)), ("b", 1, date(2024, 1, 30)), ("c", 1, date(2024, 2, 5)), ("d", 0, None)]
    labels = spark.createDataFrame(rows, "customer_id string, churn int, churn_date date")
    trend = analytics.churn_trend(labels, "2024-01-31", 3)
    got = [(r["date"].day, r["churned_customers"], r["churn_rate"]) for r in trend.orderBy("date").collect()]
    assert got == [(28, 1, 0.25), (29, 1, 0.25), (30, 2, 0.5), (31, 2, 0.5)]
    assert analytics.churn_delta(trend).first()["delta"] == 0.0


def test_segment_summary_order(table):
    got = analytics.segment_summary(table).collect()
    assert [r["segment"] for r in got] == ["Low Risk", "Medium Risk", "High Risk"]
    assert sum(r["percentage"] for r in got) == pytest.approx(100)


def test_missing_report(spark):
    df = spark.createDataFrame([(1, None, "x"), (2, None, None)], "a int, b int, c string")
    assert {tuple(r) for r in analytics.missing_report(df).collect()} == {("b", 2), ("c", 1)}


def test_rank_models_takes_the_first_of_equals(spark):
    df = spark.createDataFrame([(0, 0.5), (1, 0.7), (2, 0.7)], "position int, f1 double")
    assert ranking.rank_models(df).first()["position"] == 1


def test_importance_names_stop_at_the_shorter(spark):
    names = spark.createDataFrame([(["a", "b", "c"],)], "names array<string>")
    values = spark.createDataFrame([([0.1, 0.2],)], "importances array<double>")
    assert [tuple(r)[1:] for r in ranking.importance_names(names, values).orderBy("position").collect()] == [
        ("a", 0.1), ("b", 0.2)
    ]


def test_factors(spark):
    rows = [("x", f, v) for f, v in zip("abcdefg", (0.5, 0.1, -0.2, 0.0, 0.3, 0.2, -0.4))]
    df = spark.createDataFrame(rows, "customer_id string, feature string, contribution double")
    got = ranking.positive_negative_factors(df, ["customer_id"]).collect()
    assert sorted((r["direction"], r["rank"], r["feature"]) for r in got) == [
        ("decreases", 1, "g"), ("decreases", 2, "c"),
        ("increases", 1, "a"), ("increases", 2, "e"), ("increases", 3, "f"),
    ]
    assert [r["feature"] for r in ranking.top_abs(df, ["customer_id"], 2).orderBy("rank").collect()] == ["a", "g"]
    with pytest.raises(ValueError):
        ranking.top_abs(df, ["customer_id"], 51)


def test_monitoring(spark):
    scores = spark.createDataFrame([("2024-01-01 10:00:00", 1.0), ("2024-01-01 11:00:00", 0.95)], "t string, churn_probability double")
    got = monitoring.prediction_histogram(scores.withColumn("event_timestamp", F.col("t").cast("timestamp")))
    assert [tuple(r)[1:] for r in got.collect()] == [(9, 2)]
    history = spark.createDataFrame([(1, 0.9), (2, 0.8), (3, 0.79)], "timestamp int, f1 double")
    alerts = monitoring.metric_drop_alert(history, ["f1"]).orderBy("timestamp").collect()
    assert [r["alert"] for r in alerts] == [False, True, False]
