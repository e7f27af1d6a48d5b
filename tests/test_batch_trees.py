"""All trials and folds at once: the same as one by one, block by block, and as Spark's own boosting."""

import numpy as np
import pytest
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from dialtide.ml import batch_trees
from dialtide.ml.batch_trees import Fit, Trees, best_splits, cross_validated_auc
from dialtide.ml.prep import with_class_weight

ROWS = 400


@pytest.fixture(scope="module")
def folds(spark):
    rnd = np.random.default_rng(4)
    x = rnd.integers(0, 6, (ROWS, 5))
    y = (x[:, 0] * 2 + x[:, 1] * x[:, 2] + rnd.normal(0, 4, ROWS) > 11).astype(int)
    rows = [(f"c{i}", int(y[i]), i % 2, Vectors.dense(x[i].astype(float))) for i in range(ROWS)]
    df = spark.createDataFrame(rows, ["customer_id", "churn", "part", "features"])
    df = df.cache()
    yield [df.withColumn("held", F.col("part") == f).drop("part") for f in (0, 1)]
    df.unpersist()


WEIGHTS = [{"boosted": (1.0, 2.0), "forest": (0.8, 1.4)}] * 2
TRIALS = [
    {"kind": "boosted", "trees": 6, "max_depth": 3, "learning_rate": 0.2, "row_share": 0.7, "column_share": 0.6, "min_leaf": 2, "min_gain": 0.01},
    {"kind": "forest", "trees": 5, "max_depth": 4, "min_leaf": 2, "min_split": 6},
    {"kind": "boosted", "trees": 3, "max_depth": 2, "learning_rate": 0.1, "row_share": 1.0, "column_share": 1.0, "min_leaf": 1, "min_gain": 0.0},
]


def scores(found):
    return {(r["trial"], r["fold"]): r["roc_auc"] for r in found.collect()}


def test_together_equals_one_by_one_and_block_by_block(folds):
    together = scores(cross_validated_auc(folds, WEIGHTS, TRIALS))
    assert len(together) == 6
    by_levels = scores(cross_validated_auc(folds, WEIGHTS, TRIALS, block_rows=64))
    assert by_levels == pytest.approx(together, abs=1e-12)
    # a fold by itself has the same splits, as draws hang on the number of the fit
    alone = scores(cross_validated_auc(folds[:1], WEIGHTS[:1], TRIALS[:1]))
    assert alone[0, 0] == pytest.approx(together[0, 0], abs=1e-12)


def test_boosting_equals_the_librarys_without_sampling(folds):
    trial = {"kind": "boosted", "trees": 8, "max_depth": 3, "learning_rate": 0.3, "row_share": 1.0, "column_share": 1.0, "min_leaf": 3, "min_gain": 0.0}
    ours = scores(cross_validated_auc(folds[:1], WEIGHTS[:1], [trial]))[0, 0]
    train = with_class_weight(folds[0].filter("NOT held"), *WEIGHTS[0]["boosted"])
    model = GBTClassifier(
        featuresCol="features", labelCol="churn", weightCol="class_weight", maxIter=8, maxDepth=3, stepSize=0.3, minInstancesPerNode=3, seed=1
    ).fit(train)
    held = model.transform(folds[0].filter("held")).select("churn", "rawPrediction").collect()
    raw = np.array([r["rawPrediction"][1] for r in held])
    y = np.array([r["churn"] for r in held])
    above = (raw[y == 1][:, None] > raw[y == 0]).mean() + 0.5 * (raw[y == 1][:, None] == raw[y == 0]).mean()
    assert ours == pytest.approx(above, abs=0.02)


def plain_tree(bins, weight, target, depth, least):
    """The best tree by trying every split, as nested tuples."""
    mean = np.average(target, weights=weight)
    best = (1e-12, None)
    for j in range(bins.shape[1]) if depth else ():
        for cut in range(bins[:, j].max()):
            left = bins[:, j] <= cut
            if min(left.sum(), (~left).sum()) < least:
                continue
            var = lambda m: np.average((target[m] - np.average(target[m], weights=weight[m])) ** 2, weights=weight[m]) * weight[m].sum()
            gain = (var(np.ones(len(bins), bool)) - var(left) - var(~left)) / weight.sum()
            if gain > best[0] + 1e-9:
                best = (gain, (j, cut, left))
    if best[1] is None:
        return mean
    j, cut, left = best[1]
    return (j, cut, *[plain_tree(bins[m], weight[m], target[m], depth - 1, least) for m in (left, ~left)])


def test_a_tree_has_the_best_splits():
    rnd = np.random.default_rng(9)
    bins, weight = rnd.integers(0, 7, (120, 4)).astype(np.uint8), rnd.choice([1.0, 2.5], 120)
    target = bins[:, 0] * 1.3 - (bins[:, 2] > 3) * bins[:, 1] + rnd.normal(0, 1, 120)
    fit = Fit(0, {"kind": "boosted", "trees": 1, "max_depth": 3, "column_share": 1.0, "min_leaf": 4}, (1, 1), 4, 1)
    trees = Trees(range(1))
    for _ in range(3):
        sums = trees.histogram(fit, trees.places(bins, 1), bins, np.ones((1, 120)), weight, target)
        trees.grow(best_splits(fit, trees.tree[trees.open], trees.path[trees.open], sums))

    def predict(tree, row):
        while isinstance(tree, tuple):
            tree = tree[2] if row[tree[0]] <= tree[1] else tree[3]
        return tree

    expected = [predict(plain_tree(bins, weight, target, 3, 4), row) for row in bins]
    assert trees.value[trees.places(bins, 1)[0]] == pytest.approx(expected)


def test_draws_hang_on_nothing_but_row_trial_and_tree():
    uid = np.arange(20_000) * 7919
    fit = Fit(3, {"kind": "forest", "trees": 4}, (1, 1), 9, 42)
    counts = fit.drawn(uid, 1)
    assert (fit.drawn(uid[::-1], 1)[::-1] == counts).all() and (fit.drawn(uid, 2) != counts).any()
    assert counts.mean() == pytest.approx(1, abs=0.03) and counts.var() == pytest.approx(1, abs=0.05)
    chosen = fit.chosen(np.zeros(50, int), np.arange(50))
    assert chosen.shape == (50, 3) and all(len(set(r)) == 3 for r in chosen.tolist())
    assert batch_trees.BINS == 32


def test_a_fold_without_a_class_has_no_area(spark, folds):
    one_class = folds[0].filter("NOT held OR churn = 0")
    assert scores(cross_validated_auc([one_class], WEIGHTS[:1], TRIALS[1:2])) == {(0, 0): None}


def test_growing_alone_equals_growing_by_whole_histograms():
    rnd = np.random.default_rng(5)
    bins = rnd.integers(0, 32, (3000, 6)).astype(np.uint8)
    y = (bins[:, 0] + bins[:, 1] + rnd.normal(0, 9, 3000) > 31).astype(float)
    block = batch_trees.Block(np.arange(3000) * 31, y, np.arange(3000) % 4 == 0, bins, np.zeros((0, 3000)))
    for trial in (
        {"kind": "boosted", "trees": 1, "max_depth": 4, "row_share": 0.8, "column_share": 0.7, "min_leaf": 3},
        {"kind": "forest", "trees": 3, "max_depth": 6, "min_leaf": 5},
    ):
        fit = Fit(2, trial, (0.7, 1.9), 6, 42)
        numbers = fit.trees(0)
        trees, count = Trees(numbers), block.sample(fit, numbers)
        for _ in range(trial["max_depth"]):
            at = trees.places(bins, len(numbers))
            sums = trees.histogram(fit, at, bins, count, block.weight(fit), fit.target(y, np.zeros(3000), 0))
            trees.grow(best_splits(fit, trees.tree[trees.open], trees.path[trees.open], sums))
        expected = fit.tree_weight(0) * trees.value[trees.places(bins, len(numbers))].sum(axis=0)
        assert batch_trees._grown_alone(fit, block)[block.held] == pytest.approx(expected[block.held], abs=1e-9)


def test_a_fold_of_70000_rows_is_not_grown_level_by_level(spark, monkeypatch):
    rows = spark.range(70_000).selectExpr("concat('c', id) AS customer_id", "CAST(id % 10 > 6 OR id % 101 = 0 AS INT) AS churn", "id % 3 = 0 AS held", "array(CAST(id % 10 AS DOUBLE), CAST(id % 7 AS DOUBLE)) AS x")
    from pyspark.ml.functions import array_to_vector

    monkeypatch.setattr(batch_trees, "_scores_by_levels", None)
    found = scores(cross_validated_auc([rows.withColumn("features", array_to_vector("x"))], WEIGHTS[:1], TRIALS[:2]))
    assert found[0, 0] > 0.98 and found[1, 0] > 0.9


def test_nodes_without_spread_are_not_added_up(monkeypatch):
    from dialtide.ml import batch_trees

    rng = np.random.default_rng(5)
    bins = rng.integers(0, 32, (400, 3)).astype(np.uint8)
    sign = np.where(bins[:, 0] > 15, 1.0, -1.0)
    held = np.arange(400) % 5 == 0
    block = batch_trees.Block(np.arange(400), (sign + 1) / 2, held, bins, np.zeros((0, 400)))
    calls, plain = [], batch_trees._boosted_sums
    monkeypatch.setattr(batch_trees, "_boosted_sums", lambda *a: calls.append(1) or plain(*a))
    trial = {"kind": "boosted", "trees": 8, "max_depth": 3, "min_gain": 0.3, "row_share": 1.0, "column_share": 1.0}
    margin = batch_trees._grown_alone(Fit(0, trial, (1.0, 1.0), 3, 42), block)
    # the first tree parts the classes; after it the target spreads less than a split has to gain
    assert len(calls) == 1
    plainly = sign.copy()
    for _ in range(7):
        plainly += 0.1 * (4 * sign / (1 + np.exp(2 * sign * plainly)))[~held].mean()
    assert np.allclose(margin, plainly, rtol=1e-9)


def test_no_spread_does_not_exceed_its_bound():
    from dialtide.ml.batch_trees import _boosted_sums, _spread

    rng = np.random.default_rng(6)
    bins, y = rng.integers(0, 32, (3, 500)).astype(np.uint8), rng.integers(0, 2, 500)
    fit = Fit(0, {"kind": "boosted", "trees": 1, "max_depth": 3, "column_share": 1.0}, (1.0, 3.0), 3, 42)
    own = np.where(y > 0, 3.0, 1.0) * rng.normal(size=500)
    place, node = rng.integers(0, 4, 500), np.arange(4)
    mean, bound = _spread(fit, place, y, own, 4)
    sums = _boosted_sums(fit, 2 * bins, fit.chosen(node * 0, node), place, y, own)
    left, total = np.cumsum(sums, axis=3)[..., :-1], sums[:, :, 0].sum(axis=2)
    right = total[:, :, None, None] - left
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = left[2] ** 2 / left[1] + right[2] ** 2 / right[1] - (total[2] ** 2 / total[1])[:, None, None]
    assert np.allclose(mean, total[2] / total[1])
    gain = np.where((left[0] >= 1) & (right[0] >= 1), gain, 0.0)
    assert (gain.max(axis=(1, 2)) / total[1] <= bound).all()


@pytest.mark.parametrize("kind", ["boosted", "forest"])
def test_a_fit_holds_less_than_90_bytes_a_row(kind):
    import tracemalloc

    rng, n = np.random.default_rng(7), 400_000
    bins = rng.integers(0, 32, (n, 25)).astype(np.uint8)
    y = (bins[:, 0] + bins[:, 1] + rng.normal(0, 9, n) > 31).astype(float)
    block = batch_trees.Block(np.arange(n) * 31, y, np.arange(n) % 5 == 0, bins, np.zeros((0, n)))
    trial = {"kind": kind, "trees": 2, "max_depth": 6, "row_share": 0.9, "min_leaf": 2}
    tracemalloc.start()
    batch_trees._grown_alone(Fit(0, trial, (0.7, 1.9), 25, 42), block)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak / n < 90


def test_a_task_reads_the_blocks_of_its_fold(folds, monkeypatch):
    together = scores(cross_validated_auc(folds, WEIGHTS, TRIALS))
    made, tasks = [], []
    store, alone = batch_trees.materialize, batch_trees._scores_alone
    monkeypatch.setattr(batch_trees, "PIECE_ROWS", 50)
    monkeypatch.setattr(batch_trees, "_scores_by_levels", None)
    monkeypatch.setattr(batch_trees, "materialize", lambda df, name: made.append((name, store(df, name))) or made[-1][1])
    monkeypatch.setattr(batch_trees, "_scores_alone", lambda *a: tasks.append(alone(*a)) or tasks[-1])
    assert scores(cross_validated_auc(folds, WEIGHTS, TRIALS)) == pytest.approx(together, abs=1e-12)
    sizes = [[len(r["y"]) for r in df.collect()] for name, df in made if name == "fold-blocks"]
    assert len(sizes) == 2 and all(sum(s) == ROWS and max(s) <= 50 for s in sizes)
    assert tasks[0].rdd.getNumPartitions() >= len(folds) * len(TRIALS)


def test_deep_levels_are_added_up_in_parts(monkeypatch):
    rng = np.random.default_rng(8)
    bins = rng.integers(0, 32, (3000, 6)).astype(np.uint8)
    y = (bins[:, 0] + bins[:, 1] + rng.normal(0, 9, 3000) > 31).astype(float)
    block = batch_trees.Block(np.arange(3000) * 31, y, np.arange(3000) % 4 == 0, bins, np.zeros((0, 3000)))
    # small nodes of boosting have splits of equal gain, which the order of its sums would part
    for trial in ({"kind": "boosted", "trees": 3, "max_depth": 6, "min_leaf": 30}, {"kind": "forest", "trees": 3, "max_depth": 12}):
        fit = Fit(2, trial, (0.7, 1.9), 6, 42)
        monkeypatch.undo()
        whole = batch_trees._grown_alone(fit, block)
        monkeypatch.setattr(batch_trees, "NODE_CELLS", 400)
        monkeypatch.setattr(batch_trees, "SLICE_ROWS", 100)
        parts = [batch_trees.Block(*[x[i : i + 700] for x in (block.uid, block.y, block.held, block.bins)], np.zeros((0, 700))) for i in range(0, 3000, 700)]
        assert np.allclose(batch_trees._grown_alone(fit, *parts), whole, rtol=1e-12, atol=1e-12)


def test_levels_are_added_up_by_parts_of_their_nodes(folds, monkeypatch):
    trials = TRIALS[:2]
    together = scores(cross_validated_auc(folds, WEIGHTS, trials))
    monkeypatch.setattr(batch_trees, "NODE_CELLS", 100)
    sizes, plain = [], Trees.histogram
    monkeypatch.setattr(batch_trees, "_scores_alone", None)
    assert scores(cross_validated_auc(folds, WEIGHTS, trials, block_rows=64)) == pytest.approx(together, abs=1e-12)
    # the same for one block at a time, where the parts can be seen
    grown = Trees(range(1))
    monkeypatch.setattr(Trees, "histogram", lambda self, *a: sizes.append(len(self.open)) or plain(self, *a))
    grown.grow(np.array([[0.0], [0], [2], [0.1], [0.2]]))
    taken = {}

    class Blocks:
        def mapInArrow(self, cells, schema):  # noqa: N802
            taken["cells"] = cells
            raise StopIteration

    fit = Fit(0, trials[1], (0.8, 1.4), 5, 42, 1)
    with pytest.raises(StopIteration):
        batch_trees._level(Blocks(), {(0, 0): fit}, {0: grown}, 0, 5)
    stored = batch_trees.fold_blocks(folds[0], 0, batch_trees.bin_edges(folds[0]), "customer_id", ROWS, ROWS).collect()[0].asDict()
    stored["margin"] = np.zeros((1, ROWS)).tobytes()
    import pyarrow as pa

    list(taken["cells"]([pa.RecordBatch.from_pylist([stored])]))
    assert sizes and max(sizes) == 1
