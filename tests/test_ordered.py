"""Bucketed ranks, sums and quantiles against direct computation."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from dialtide.ml.metrics import roc_auc
from dialtide.ml.split import stratified_folds, stratified_split
from dialtide.operators.ordered import exact_quantiles, hashed_ranks, running_sums, value_buckets

PROBS = [0.0, 0.1, 0.25, 0.5, 0.75, 0.99, 1.0]


@pytest.mark.parametrize("kind", ["normal", "ties", "heavy", "single"])
def test_quantiles(spark, kind):
    rng = np.random.default_rng(3)
    values = {
        "normal": rng.normal(size=501),
        "ties": rng.integers(0, 4, size=400).astype(float),
        "heavy": np.concatenate([np.zeros(300), np.exp(rng.normal(size=100) * 5)]),
        "single": np.array([2.5]),
    }[kind]
    rows = [("a", float(v)) for v in values] + [("b", float(-v)) for v in values] + [("a", None)]
    got = exact_quantiles(spark.createDataFrame(rows, "g string, v double"), ["g"], "v", PROBS)
    for r in got.collect():
        sign = 1 if r["g"] == "a" else -1
        assert r["n"] == len(values)
        assert [r[f"q{i}"] for i in range(len(PROBS))] == pytest.approx(list(np.quantile(sign * values, PROBS)))


def test_running_sums(spark):
    rng = random.Random(5)
    rows = [("x", float(v), rng.randint(1, 9)) for v in rng.sample(range(10000), 500)]
    freq = spark.createDataFrame(rows, "g string, v double, n bigint")
    got = running_sums(value_buckets(freq, ["g"], "v", 8), ["g"], "_bucket", ["v"], ["n"])
    before, total = {}, 0
    for _, v, n in sorted(rows):
        before[v], total = total, total + n
    for r in got.collect():
        assert r["n_before"] == before[r["v"]] and r["n_total"] == total


@pytest.mark.parametrize("digits", [2, 6])
def test_roc_auc(spark, digits):
    rng = random.Random(11)
    rows = [(int(rng.random() < 0.3), round(rng.random(), digits)) for _ in range(600)]
    df = spark.createDataFrame(rows, "churn int, churn_probability double")
    pos, neg = [p for c, p in rows if c], [p for c, p in rows if not c]
    wins = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    assert roc_auc(df).first()["roc_auc"] == pytest.approx(wins)
    steeper = df.withColumn("churn_probability", F.pow("churn_probability", F.lit(3.0)))
    assert roc_auc(steeper).first()["roc_auc"] == pytest.approx(wins)


def test_roc_auc_needs_both_classes(spark):
    df = spark.createDataFrame([(1, 0.5), (1, 0.7)], "churn int, churn_probability double")
    assert roc_auc(df).first()["roc_auc"] is None


def keyed(spark, n=400):
    return spark.range(n).select(
        F.format_string("CUST%06d", "id").alias("customer_id"), (F.col("id") % 4 == 0).cast("int").alias("churn")
    )


def test_split_shares_and_stability(spark):
    df = keyed(spark)
    split = stratified_split(df)
    shares = {r["churn"]: (r["t"], r["n"]) for r in split.groupBy("churn").agg(
        F.count_if("is_test").alias("t"), F.count("*").alias("n")).collect()}
    assert shares == {0: (60, 300), 1: (20, 100)}
    again = stratified_split(df.repartition(7).orderBy(F.desc("customer_id")))
    assert {tuple(r) for r in split.select("customer_id", "is_test").collect()} == {
        tuple(r) for r in again.select("customer_id", "is_test").collect()
    }
    other = stratified_split(df, seed=1)
    assert split.join(other, "customer_id").filter(split.is_test != other.is_test).count() > 0


def test_folds_are_even_per_class(spark):
    counts = stratified_folds(keyed(spark), 5).groupBy("churn", "fold").count().collect()
    assert {(r["churn"], r["count"]) for r in counts} == {(0, 60), (1, 20)}


def test_a_repeated_key_stays_together(spark):
    rows = [("hot", 0)] * 300 + [(f"k{i}", 0) for i in range(300)]
    df = spark.createDataFrame(rows, "customer_id string, churn int")
    sides = stratified_split(df).groupBy("customer_id").agg(F.count_distinct("is_test").alias("sides"))
    assert sides.agg(F.max("sides")).first()[0] == 1
    assert stratified_split(df).count() == 600
    ranks = {r["customer_id"]: r["rank"] for r in hashed_ranks(df, "churn", "customer_id").collect()}
    assert len(ranks) == 301 and max(ranks.values()) <= 599
