from datetime import datetime

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from dialtide.ml import explain, metrics, prep, train
from dialtide.ml.score import batch_score, positive_probability, score, score_one
from dialtide.plans.features import training_frame
from dialtide.session import materialize
from dialtide.sources import models

RNG = np.random.default_rng(4)
N = 300


@pytest.fixture(scope="module")
def data(spark):
    x = RNG.normal(size=(N, 2))
    plan = RNG.choice(["basic", "plus", None], size=N, p=[0.5, 0.4, 0.1])
    chance = 1 / (1 + np.exp(-(1.5 * x[:, 0] - x[:, 1] + (plan == "plus") - 1)))
    churn = (RNG.random(N) < chance).astype(int)
    rows = [(f"c{i:04d}", int(churn[i]), float(x[i, 0]), float(x[i, 1]), plan[i]) for i in range(N)]
    df = spark.createDataFrame(rows, "customer_id string, churn int, a double, b double, plan string")
    return materialize(df, "ml-test")


@pytest.fixture(scope="module")
def logistic(data):
    return train.train_logistic(data)


@pytest.fixture(scope="module")
def forest(data):
    return train.train_forest(data, trees=10, max_depth=4)


def prepared_arrays(model, data):
    rows = model.preparation.transform(data).select("churn", vector_to_array("features").alias("x")).collect()
    return np.array([r["x"] for r in rows]), np.array([r["churn"] for r in rows])


def test_names_and_scaling(data, logistic):
    assert logistic.names == ["a", "b", "plan___null__", "plan_basic", "plan_plus"]
    x, _ = prepared_arrays(logistic, data)
    assert x[:, :2].mean(axis=0) == pytest.approx([0, 0], abs=1e-9)
    assert x[:, :2].std(axis=0) == pytest.approx([1, 1], abs=1e-9)  # population deviation
    assert (x[:, 2:].sum(axis=1) == 1).all()


def test_unknown_category_is_all_zeros(spark, logistic):
    row = spark.createDataFrame([("z", 0.0, 0.0, "never seen")], "customer_id string, a double, b double, plan string")
    x = logistic.preparation.transform(row).select(vector_to_array("features")).first()[0]
    assert list(x)[2:] == [0.0, 0.0, 0.0]


def test_logistic_equals_newton(data, logistic):
    """Minimise ½‖w‖² + Σ sᵢ·loss with balanced sᵢ by Newton's method."""
    x, y = prepared_arrays(logistic, data)
    s = np.where(y == 1, N / (2 * y.sum()), N / (2 * (N - y.sum())))
    design = np.hstack([x, np.ones((N, 1))])
    penalty = np.diag([1.0] * x.shape[1] + [0.0])
    w = np.zeros(design.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-design @ w))
        gradient = design.T @ (s * (p - y)) + penalty @ w
        hessian = (design * (s * p * (1 - p))[:, None]).T @ design + penalty
        w -= np.linalg.solve(hessian, gradient)
    fitted = logistic.classifier
    assert list(fitted.coefficients.toArray()) == pytest.approx(list(w[:-1]), abs=1e-4)
    assert fitted.intercept == pytest.approx(w[-1], abs=1e-4)


def test_class_weights(data):
    got = {r["churn"]: r for r in prep.class_weights(data).collect()}
    n0, n1 = got[0]["n"], got[1]["n"]
    assert got[0]["balanced_weight"] * n0 == pytest.approx(got[1]["balanced_weight"] * n1)
    assert got[1]["positive_weight"] == pytest.approx(n0 / n1) and got[0]["positive_weight"] == 1.0


def test_metrics_agree_with_counts(spark):
    rows = [(1, True, 0.9), (1, False, 0.4), (0, True, 0.6), (0, False, 0.1), (0, False, 0.2)]
    scored = spark.createDataFrame(rows, "churn int, churn_prediction boolean, churn_probability double")
    got = metrics.evaluate(scored)
    assert got == pytest.approx({"accuracy": 0.6, "precision": 0.5, "recall": 0.5, "f1": 0.5, "roc_auc": 5 / 6})
    none = metrics.binary_metrics(scored.withColumn("churn_prediction", F.lit(False))).first()
    assert (none["precision"], none["f1"]) == (0.0, 0.0)


def test_models_learn(data, logistic, forest):
    boosted = train.train_boosted(data, trees=5, max_depth=3)
    for model in (logistic, forest, boosted):
        assert metrics.evaluate(score(data, model.pipeline))["roc_auc"] > 0.75


def test_a_column_without_values_is_left_out(data):
    model = train.train_forest(data.withColumn("empty", F.lit(None).cast("double")), trees=2, max_depth=2)
    assert "empty" not in model.names


def test_trials_are_seeded_and_in_range():
    trials = train.sample_trials(20, 1)
    assert trials == train.sample_trials(20, 1) != train.sample_trials(20, 2)
    assert {t["kind"] for t in trials} == {"boosted", "forest"}
    for t in trials:
        assert 50 <= t["trees"] <= 300
        assert (3 <= t["max_depth"] <= 10) if t["kind"] == "boosted" else (5 <= t["max_depth"] <= 30)


def test_registered_tuning_is_the_whole_job(monkeypatch):
    from dialtide.catalog import ml
    from dialtide.plans.training import TRIALS

    assert TRIALS == 20 and ml.TRIALS == train.sample_trials(20) and {t["kind"] for t in ml.TRIALS} == {"forest", "boosted"}
    seen = []
    monkeypatch.setattr(ml, "model_table", lambda *_: None)
    monkeypatch.setattr(ml.train, "train_candidates", lambda table, trials, folds: seen.append((trials, folds)) or (None, [], None))
    monkeypatch.setattr(ml.train, "model_candidates", lambda candidates, spark: None)
    monkeypatch.setattr(ml.ranking, "rank_models", lambda found: None)
    ml.select_best(None, None)
    assert seen == [(ml.TRIALS, 5)] and ml.FOLDS == 5


def test_tune_and_select(data):
    trials = [{"kind": "forest", "trees": 1, "max_depth": 1}, {"kind": "forest", "trees": 10, "max_depth": 4}]
    scores = train.cross_validate(data, trials, folds=2)
    assert len(scores) == 2 and scores[1] > scores[0]
    best, candidates, test = train.train_candidates(data, {"logistic": {}}, trials, folds=2)
    assert len(candidates) == 2 and set(best.metrics) == {"accuracy", "precision", "recall", "f1", "roc_auc"}
    assert best.kind == max(candidates, key=lambda m: m.metrics["f1"]).kind
    assert test.count() == pytest.approx(N * 0.2, abs=2)


def test_shapley_values_add_up(data, forest):
    prepared = forest.preparation.transform(data)
    values = explain.explain_shapley(prepared, prepared, forest.classifier, forest.names, orderings=6)
    totals = {r["customer_id"]: r["t"] for r in values.groupBy("customer_id").agg(F.sum("contribution").alias("t")).collect()}
    scores = {r["customer_id"]: r["p"] for r in forest.classifier.transform(prepared).select(
        "customer_id", positive_probability().alias("p")).collect()}
    offsets = [scores[c] - totals[c] for c in scores]
    assert len(totals) == N and max(offsets) - min(offsets) < 1e-9  # the same base value for every row
    again = explain.explain_shapley(prepared.repartition(3), prepared, forest.classifier, forest.names, orderings=6)
    assert {(r[0], r[1]): round(r[2], 9) for r in again.collect()} == {
        (r[0], r[1]): round(r[2], 9) for r in values.collect()
    }


def test_repeated_keys_do_not_multiply_contributions(data, forest):
    prepared = forest.preparation.transform(data.orderBy("customer_id").limit(20))
    once = explain.explain_shapley(prepared, prepared, forest.classifier, forest.names, orderings=4)
    twice = explain.explain_shapley(prepared.union(prepared), prepared, forest.classifier, forest.names, orderings=4)
    assert {(r[0], r[1]): round(r[2], 9) for r in once.collect()} == {(r[0], r[1]): round(r[2], 9) for r in twice.collect()}


def test_splits_keep_rows_without_label_or_key(spark):
    rows = [("a", 1), ("b", 0), (None, 1), ("c", None), (None, None), ("d", 0)]
    df = spark.createDataFrame(rows, "customer_id string, churn int")
    from dialtide.ml.split import stratified_folds, stratified_split

    assert sorted(map(str, stratified_split(df).select("customer_id", "churn").collect())) == sorted(map(str, df.collect()))
    assert stratified_folds(df, 2).count() == len(rows)


def test_linear_explanation_is_exact(data, logistic):
    prepared = logistic.preparation.transform(data)
    values = explain.explain_linear_model(prepared, "customer_id", logistic.classifier, logistic.names)
    x, _ = prepared_arrays(logistic, data)
    margins = x @ logistic.classifier.coefficients.toArray()
    totals = sorted(r["t"] for r in values.groupBy("customer_id").agg(F.sum("contribution").alias("t")).collect())
    assert totals == pytest.approx(sorted(margins - margins.mean()), abs=1e-9)


def test_local_linear_finds_the_signs(data, logistic):
    prepared = logistic.preparation.transform(data)
    values = explain.explain_local_linear(prepared, prepared, logistic.classifier, logistic.names, samples=100)
    mean = {r["feature"]: r["m"] for r in values.groupBy("feature").agg(F.avg("contribution").alias("m")).collect()}
    assert mean["a"] > 0 > mean["b"] and values.count() == N * 5
    top = explain.explain_top(values, n=2).first()["feature_importance"]
    assert len(top) == 2 and abs(list(top.values())[0]) >= abs(list(top.values())[1])


def test_save_load_score(spark, data, logistic, forest, tmp_path):
    base = str(tmp_path)
    logistic.metrics, forest.metrics = {"f1": 0.4}, {"f1": 0.6}
    models.save_model(spark, logistic, base, datetime(2024, 1, 2))
    models.save_model(spark, forest, base, datetime(2024, 1, 1))
    pipeline, version = models.load_model(spark, base)
    assert version == "20240102_000000"
    before = {r[0]: r[1] for r in score(data, logistic.pipeline).select("customer_id", "churn_probability").collect()}
    after = {r[0]: r[1] for r in score(data, pipeline).select("customer_id", "churn_probability").collect()}
    assert before == after
    info = models.model_info(spark, base, train.feature_importance(forest, spark)).first()
    assert info["model_type"] == "logistic" and info["metrics"]["f1"] == 0.4
    assert sum(info["feature_importance"].values()) == pytest.approx(1)
    assert train.feature_importance(logistic, spark).count() == 0

    views = {"customer_profile": data.drop("churn").withColumn("event_timestamp", F.lit(datetime(2024, 1, 1)))}
    refs = [f"customer_profile:{c}" for c in ("a", "b", "plan")]
    requests = spark.createDataFrame([("c0001", 0), ("nobody", 1), ("c0001", 2)], "customer_id string, position int")
    got = batch_score(requests, views, refs, pipeline, version).orderBy("position").collect()
    assert got[0]["churn_probability"] == got[2]["churn_probability"] == before["c0001"]
    assert 0 < got[1]["churn_probability"] < 1 and got[0]["model_version"] == version
    assert [r["has_features"] for r in got] == [True, False, True]
    assert score_one("c0001", views, refs, pipeline, version).first()["churn_probability"] == before["c0001"]


def test_scoring_after_an_observed_write(spark, data, logistic, tmp_path):
    """A session that used an Observation must still ship the model to its tasks."""
    from pyspark.sql import Observation

    seen = Observation("rows")
    data.observe(seen, F.count(F.lit(1)).alias("n")).write.parquet(str(tmp_path / "out"))
    assert seen.get["n"] == N
    fresh = train.train_logistic(data, max_iter=5)
    assert score(data, fresh.pipeline).agg(F.avg("churn_probability")).first()[0] > 0


def test_training_frame_multiplies_repeated_labels(spark):
    at = datetime(2024, 1, 1)
    stats = spark.createDataFrame(
        [("a", at, at, 5)],
        "customer_id string, event_timestamp timestamp_ntz, created_timestamp timestamp_ntz, daily_total_calls bigint",
    )
    labels = spark.createDataFrame([("a", 1), ("b", 0)], "customer_id string, churn int")
    got = training_frame(labels, {"cdr_statistics": stats}, datetime(2024, 1, 2), ["cdr_statistics:daily_total_calls"])
    assert {(r["customer_id"], r["daily_total_calls"], r["churn"]) for r in got.collect()} == {("a", 5, 1), ("b", None, 0)}


def test_train_and_store(spark, data, tmp_path):
    from dialtide.plans.training import train_and_store
    from dialtide.sources.tables import read_importance

    settings = {"forest": {"trees": 3, "max_depth": 3}}
    path, best = train_and_store(data, str(tmp_path), datetime(2024, 1, 1), settings, trials=[])
    assert best.kind == "forest" and 0 <= best.metrics["f1"] <= 1
    assert read_importance(spark, f"{path}/feature_importance").count() == len(best.names)
    assert models.read_metrics_history(spark, str(tmp_path)).first()["f1"] == pytest.approx(best.metrics["f1"])


def test_folds_store_no_vectors_that_nobody_reads(data, monkeypatch):
    names, plain = [], train.materialize
    monkeypatch.setattr(train, "materialize", lambda df, name: names.append(name) or plain(df, name))
    train.cross_validate(data, [{"kind": "forest", "trees": 1, "max_depth": 2}], folds=2)
    assert sorted(names) == ["fold-vectors", "fold-vectors", "folds"]


def test_side_by_side_keeps_the_order_and_tells_of_failures(spark):
    from dialtide.session import side_by_side

    assert side_by_side(spark, lambda n: spark.range(n).count(), [30, 1, 7]) == [30, 1, 7]
    assert side_by_side(spark, lambda n: n, []) == []
    with pytest.raises(ZeroDivisionError):
        side_by_side(spark, lambda n: 1 // n, [1, 0])
