"""Exact Shapley values of trees, against the definition."""

import math
from itertools import combinations

import numpy as np
import pytest
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from dialtide.ml import tree_shapley
from dialtide.ml.tree_shapley import explain_trees

NAMES = ["a", "b", "c", "flag"]


@pytest.fixture(scope="module")
def frame(spark):
    from pyspark.ml.feature import OneHotEncoder

    rnd = np.random.default_rng(2)
    x = rnd.normal(size=(120, 3)).round(2)
    flag = rnd.integers(0, 2, 120)
    y = ((x[:, 0] + x[:, 1] * flag + 0.3 * rnd.normal(size=120)) > 0.2).astype(int)
    rows = [(f"c{i}", int(y[i]), *map(float, x[i]), float(flag[i])) for i in range(120)]
    df = spark.createDataFrame(rows, ["customer_id", "churn", "a", "b", "c", "level"])
    hot = OneHotEncoder(inputCols=["level"], outputCols=["flag"], dropLast=True).fit(df).transform(df)  # a nominal slot
    ready = VectorAssembler(inputCols=["a", "b", "c", "flag"], outputCol="features").transform(hot)
    return ready.select("customer_id", "churn", "features").cache()


def by_definition(score, x, background):
    """Weighted differences over all subsets of features, the mean over the background."""
    d = x.shape[1]
    out = np.zeros(x.shape)
    value = {}
    for size in range(d + 1):
        for subset in combinations(range(d), size):
            mixed = np.repeat(background[None], len(x), 0)
            for j in subset:
                mixed[:, :, j] = x[:, None, j]
            value[frozenset(subset)] = score(mixed.reshape(-1, d)).reshape(len(x), -1).mean(axis=1)
    for s, v in value.items():
        for j in set(range(d)) - s:
            w = math.factorial(len(s)) * math.factorial(d - len(s) - 1) / math.factorial(d)
            out[:, j] += w * (value[s | {j}] - v)
    return out


def scorer(spark, model, forest):
    from pyspark.ml.functions import array_to_vector

    def score(x):
        rows = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], "i int, x array<double>")
        column = "probability" if forest else "rawPrediction"
        scored = model.transform(rows.select("i", array_to_vector("x").alias("features")))
        found = scored.select("i", vector_to_array(column)[1].alias("p")).toPandas().sort_values("i")["p"].to_numpy()
        return found

    return score


@pytest.mark.parametrize("kind", ["forest", "boosted"])
def test_values_are_the_definition(spark, frame, kind):
    common = {"labelCol": "churn", "seed": 3}
    forest = kind == "forest"
    unfitted = RandomForestClassifier(numTrees=4, maxDepth=4, **common) if forest else GBTClassifier(maxIter=4, maxDepth=3, **common)
    model = unfitted.fit(frame)
    some, background = frame.orderBy("customer_id").limit(6), frame.orderBy("customer_id").limit(9)
    found = explain_trees(some, background, model, NAMES).collect()
    got = {(r["customer_id"], r["feature"]): r["contribution"] for r in found}
    x, base = (np.array([r[0] for r in f.orderBy("customer_id").select(vector_to_array("features")).collect()]) for f in (some, background))
    expected = by_definition(scorer(spark, model, forest), x, base)
    keys = [r[0] for r in some.orderBy("customer_id").select("customer_id").collect()]
    assert len(found) == 24 and np.abs(expected).max() > 0.01
    for i, k in enumerate(keys):
        assert [got[k, n] for n in NAMES] == pytest.approx(list(expected[i]), abs=1e-9)


def test_values_add_up_against_all_rows(frame, monkeypatch):
    model = RandomForestClassifier(numTrees=10, maxDepth=6, labelCol="churn", seed=1).fit(frame)
    monkeypatch.setattr(tree_shapley, "SLICE_ROWS", 7)
    found = explain_trees(frame.repartition(3), frame, model, NAMES).groupBy("customer_id").agg(F.sum("contribution").alias("t"))
    scores = model.transform(frame).select("customer_id", vector_to_array("probability")[1].alias("p")).toPandas().set_index("customer_id")["p"]
    totals = found.toPandas().set_index("customer_id")["t"]
    assert (scores - scores.mean() - totals).abs().max() < 1e-9


def test_odd_tables(frame):
    model = RandomForestClassifier(numTrees=2, maxDepth=2, labelCol="churn", seed=1).fit(frame)
    assert explain_trees(frame.limit(0), frame, model, NAMES).count() == 0
    assert explain_trees(frame, frame.limit(0), model, NAMES).count() == 0
    one = frame.limit(1)
    assert explain_trees(one.union(one), frame, model, NAMES).count() == 8
    only_roots = RandomForestClassifier(numTrees=2, maxDepth=2, minInstancesPerNode=1000, labelCol="churn").fit(frame)
    assert {r["contribution"] for r in explain_trees(frame, frame, only_roots, NAMES).collect()} == {0.0}


def test_sampled_values_from_leaves_equal_those_from_scores(spark):
    from pyspark.ml.classification import RandomForestClassifier
    from pyspark.ml.linalg import Vectors

    from dialtide.ml import explain

    rnd = np.random.default_rng(12)
    x = rnd.integers(0, 5, (90, 4)).astype(float)
    rows = [(f"c{i % 80}", int(r[0] + r[1] * r[2] > 6), Vectors.dense(r)) for i, r in enumerate(x)]
    df = spark.createDataFrame(rows, ["customer_id", "churn", "features"]).cache()
    model = RandomForestClassifier(featuresCol="features", labelCol="churn", numTrees=7, maxDepth=4, seed=3).fit(df)
    names = ["a", "b", "c", "d"]
    plan = explain._orderings(df, "customer_id", 4, 16, 42)
    by = lambda out: {(r["customer_id"], r["feature"]): r["contribution"] for r in out.collect()}
    by_scores = by(explain._shapley_by_scores(df, plan, model, names, "customer_id", 16))
    found = explain.explain_shapley(df, df, model, names)
    assert by(found) == pytest.approx(by_scores, abs=1e-12) and len(by_scores) == 320
    # no step of an ordering is scored, whose 17 times 5 copies of a row made this slow
    assert "place" not in found._jdf.queryExecution().optimizedPlan().toString()


def test_coded_answers_are_the_leaves_own():
    rnd = np.random.default_rng(5)
    limits = rnd.normal(size=(30, 6)).round(1)
    leaves = [tree_shapley.Leaf(1.0, (), (), ())]
    for size in (1, 3, 16, 20):
        for _ in range(20):
            features = tuple(rnd.choice(30, size, replace=False).tolist())
            ends = np.sort([[rnd.choice([*limits[j], -math.inf]), rnd.choice([*limits[j], math.inf])] for j in features], axis=1)
            leaves.append(tree_shapley.Leaf(1.0, features, tuple(ends[:, 0].tolist()), tuple(ends[:, 1].tolist())))
    x = np.concatenate([rnd.normal(size=(30, 200)).round(1), limits], axis=1)  # many values are limits
    coded = tree_shapley.Coded(leaves)
    codes = coded.codes(x)
    assert all(c.dtype == np.uint8 for c in codes.values())
    for i, leaf in enumerate(leaves):
        if leaf.features:
            assert (coded.answers(i, codes) == leaf.answers(x)).all()


def test_batches_are_answered_together():
    import pyarrow as pa

    def batch(n):
        return pa.record_batch([pa.array([[1.0, 2.0]] * n, pa.list_(pa.float64())), pa.array(["k"] * n)], names=["x", "key"])

    sizes = [len(keys) for _, keys in tree_shapley._rows(iter([batch(5), batch(0), batch(tree_shapley.SLICE_ROWS), batch(7)]))]
    assert sizes == [tree_shapley.SLICE_ROWS, 12]


def test_local_linear_of_a_forest_is_that_of_scored_copies(spark, frame, monkeypatch):
    from dialtide.ml import explain

    forest = RandomForestClassifier(labelCol="churn", numTrees=7, maxDepth=5, seed=3).fit(frame)
    forest._java_obj.setSummary(spark._jvm.scala.Option.empty())  # as training does
    rows = frame.limit(40).union(spark.createDataFrame([(None, 0, frame.first()["features"])], frame.schema))
    find = lambda: explain.explain_local_linear(rows, frame, forest, NAMES, samples=50)
    here = find()
    assert "Generate explode" not in here._jdf.queryExecution().executedPlan().toString()
    here = {(r[0], r[1]): r[2] for r in here.collect()}

    def refuse(*_):
        raise ValueError

    monkeypatch.setattr(explain, "ForestScorer", refuse)
    by_spark = {(r[0], r[1]): r[2] for r in find().collect()}
    assert len(here) == 41 * 4 and here.keys() == by_spark.keys()
    assert max(abs(here[k] - by_spark[k]) for k in here) < 1e-9
    assert max(map(abs, here.values())) > 0.01


def test_normals_are_the_columns_own(spark):
    from dialtide.functions import hash_normal, normals_of

    rows = spark.createDataFrame([("a",), ("CUST000007",), (None,)], "k string")
    ints = [F.lit(-3), F.lit(199), F.lit(42)]
    got = rows.select(F.xxhash64("k").alias("h"), hash_normal(F.col("k"), *ints).alias("z")).toPandas()
    assert np.allclose(normals_of(got["h"].to_numpy(), np.array(-3), np.array(199), np.array(42)), got["z"], rtol=1e-13)
