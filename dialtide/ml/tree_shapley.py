"""Exact Shapley values of tree ensembles.

A stored ensemble is a table of nodes. Each of its leaves asks, for every
feature on the way to it, whether the value lies in an interval; a row answers
with one bit a feature. Of a row and a background row only these bits matter:
features where only the row fits the leaf must be the row's, those where only
the background row fits must be the background's, and if for one neither fits the
leaf is out of reach. The Shapley value of that game has a closed form in the two
counts, so neither feature orderings nor subsets are gone through.

The background therefore counts only by leaf and bits: one aggregate over all its
rows. A task looks up the distinct bits of its rows, leaf by leaf.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_dir

#: Rows that a task answers for at a time.
SLICE_ROWS = 1 << 14
#: Answers of rows to leaves that a task gives, about, and the most rows that it gives them for.
ANSWERS_PER_TASK, ROWS_PER_TASK = 250_000_000, 10_000
#: Features on a way up to which answers are counted by an array.
ARRAY_BITS = 16


@dataclass(frozen=True)
class Leaf:
    """A leaf: what it adds to the score, and the interval low < x <= high of each feature on the way."""

    value: float
    features: tuple[int, ...]
    low: tuple[float, ...]
    high: tuple[float, ...]

    def answers(self, x: np.ndarray) -> np.ndarray:
        """One bit a feature for each row of ``x``, which has a feature a row."""
        out = np.zeros(x.shape[1], np.int64)
        for bit, (j, low, high) in enumerate(zip(self.features, self.low, self.high)):
            fits = x[j] <= high
            if low > -math.inf:
                fits &= x[j] > low
            out |= fits.astype(np.int64) << bit
        return out


def _sides(split: dict) -> tuple[tuple[float, float], tuple[float, float]]:
    """The intervals on the left and on the right of a split."""
    if split["numCategories"] < 0:
        (threshold,) = split["leftCategoriesOrThreshold"]
        return (-math.inf, threshold), (threshold, math.inf)
    if split["numCategories"] != 2:
        raise ValueError("only numbers and 0/1 features are explained")
    # a flag: its categories are the values 0 and 1
    zero, one = (-math.inf, 0.5), (0.5, math.inf)
    return (zero, one) if 0.0 in split["leftCategoriesOrThreshold"] else (one, zero)


def _stored_nodes(classifier, spark, name: str) -> dict[int, dict[int, dict]]:
    """The nodes of a fitted ensemble by tree and number, out of its stored form."""
    path = scratch_dir(spark, name)
    classifier.write().overwrite().save(path)
    nodes: dict[int, dict[int, dict]] = {}
    for row in spark.read.parquet(f"{path}/data").collect():  # as large as the model, which the driver holds anyway
        nodes.setdefault(row["treeID"], {})[row["nodeData"]["id"]] = row["nodeData"].asDict(recursive=True)
    return nodes


class ForestScorer:
    """The churn probability of a forest for many rows at a time, a tree and a level after the other.

    A flag's split asks whether the value is one of its two categories; any other value goes to the right.
    """

    def __init__(self, classifier, spark):
        self.features, flags = classifier.numFeatures, {}
        self.trees = []
        for _, nodes in sorted(_stored_nodes(classifier, spark, "scored-model").items()):
            feature, limit, left, value, order, depth = [], [], [], [], [(nodes[0], 0)], 0
            for node, level in order:  # grows while it is gone through: children stand side by side
                depth, stats = max(depth, level), node["impurityStats"]
                if node["leftChild"] < 0:
                    feature, limit, left = [*feature, 0], [*limit, math.inf], [*left, len(left)]
                else:
                    j, (asked, *more) = node["split"]["featureIndex"], node["split"]["leftCategoriesOrThreshold"]
                    if node["split"]["numCategories"] >= 0:
                        if more or node["split"]["numCategories"] != 2:
                            raise ValueError("only numbers and 0/1 features are scored")
                        j, asked = self.features + flags.setdefault((j, asked), len(flags)), 0.5
                    feature, limit, left = [*feature, j], [*limit, asked], [*left, len(order)]
                    order += [(nodes[node["leftChild"]], level + 1), (nodes[node["rightChild"]], level + 1)]
                value.append(stats[1] / sum(stats))
            self.trees.append((np.array(feature), np.array(limit), np.array(left), np.array(value), depth))
        self.flags = list(flags)

    def __call__(self, x: np.ndarray) -> np.ndarray:
        """Of ``x`` with a feature a row."""
        others = [(x[j] != category).astype(float) for j, category in self.flags]
        flat, rows, n = np.concatenate([x, *others], axis=None), np.arange(x.shape[1]), x.shape[1]
        total = np.zeros(n)
        for feature, limit, left, value, depth in self.trees:
            at, start = np.zeros(n, np.int64), feature * n
            for _ in range(depth):
                own = np.take(flat, np.take(start, at, mode="clip") + rows, mode="clip")
                at = np.take(left, at, mode="clip") + (own > np.take(limit, at, mode="clip"))
            total += np.take(value, at, mode="clip")
        return total / len(self.trees)


def leaves_of(classifier, spark, name: str = "explained-model") -> list[Leaf]:
    """The leaves of a fitted forest, in shares of the churn probability, or of a boosted model, in parts of its margin.

    They are read from the model's stored form: a table with a row for each node.
    """
    nodes = _stored_nodes(classifier, spark, name)
    weights = list(classifier.treeWeights)
    forest = hasattr(classifier, "numClasses") and type(classifier).__name__.startswith("RandomForest")
    out: list[Leaf] = []

    def walk(tree: int, node: dict, way: dict[int, tuple[float, float]]) -> None:
        if node["leftChild"] < 0:
            stats = node["impurityStats"]
            value = stats[1] / sum(stats) / len(weights) if forest else weights[tree] * node["prediction"]
            out.append(Leaf(value, tuple(way), *(tuple(w[k] for w in way.values()) for k in (0, 1))))
            return
        j = node["split"]["featureIndex"]
        old = way.get(j, (-math.inf, math.inf))
        for child, (low, high) in zip((node["leftChild"], node["rightChild"]), _sides(node["split"])):
            walk(tree, nodes[tree][child], way | {j: (max(old[0], low), min(old[1], high))})

    for tree in sorted(nodes):
        walk(tree, nodes[tree][0], {})
    return out


class Coded:
    """The leaves' questions by the rank of a value among the limits that any leaf has for its feature: small whole numbers."""

    def __init__(self, leaves: list[Leaf]):
        limits: dict[int, set[float]] = {}
        for leaf in leaves:
            for j, low, high in zip(leaf.features, leaf.low, leaf.high):
                limits.setdefault(j, set()).update(t for t in (low, high) if math.isfinite(t))
        self.limits = {j: np.array(sorted(found)) for j, found in limits.items()}
        self.type = np.min_scalar_type(max(map(len, self.limits.values()), default=0))
        #: of each leaf the feature, the least rank that fits and how many more do
        self.asked = []
        for leaf in leaves:
            first = [0 if low == -math.inf else self._rank(j, low) + 1 for j, low in zip(leaf.features, leaf.low)]
            last = [len(self.limits[j]) if high == math.inf else self._rank(j, high) for j, high in zip(leaf.features, leaf.high)]
            self.asked.append([(j, self.type.type(a), b - a) for j, a, b in zip(leaf.features, first, last)])

    def _rank(self, j: int, limit: float) -> int:
        return int(np.searchsorted(self.limits[j], limit))

    def codes(self, x: np.ndarray) -> dict[int, np.ndarray]:
        """Of each feature how many limits are below the values of ``x``, which has a feature a row."""
        return {j: np.searchsorted(limits, x[j]).astype(self.type) for j, limits in self.limits.items()}

    def answers(self, number: int, codes: dict[int, np.ndarray]) -> np.ndarray:
        """:meth:`Leaf.answers` of a leaf."""
        asked = self.asked[number]
        out = np.zeros(len(codes[asked[0][0]]), np.uint16 if len(asked) <= ARRAY_BITS else np.int64)
        for j, first, more in reversed(asked):
            out <<= 1
            if more >= 0:  # no value is in an empty interval
                out |= codes[j] - first <= more  # ranks below the first wrap around
        return out.astype(np.int64)


def spread_rows(rows: DataFrame, work: int, per_task: int) -> DataFrame:
    """Cut the rows into tasks of about ``per_task`` units, where each row makes ``work`` of them.

    The input's partitions are sized for reading it. A fixed number, so that
    they are not merged again for being small in bytes.
    """
    return rows.repartition(max(1, math.ceil(rows.count() * work / per_task)))


def spread_answers(rows: DataFrame, leaves: list[Leaf]) -> DataFrame:
    """:func:`spread_rows` by the answers to the leaves."""
    return spread_rows(rows, max(len(leaves), ANSWERS_PER_TASK // ROWS_PER_TASK), ANSWERS_PER_TASK)


def _answered(leaves: list[Leaf]):
    """(leaf, answer, n) of the rows of a task."""
    coded = Coded(leaves)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x, _ in _rows(batches):
            codes, found = coded.codes(x), []
            for number, leaf in enumerate(leaves):
                if not leaf.features:
                    found.append((np.zeros(1, np.int64), np.array([x.shape[1]])))
                elif len(leaf.features) > ARRAY_BITS:
                    found.append(np.unique(coded.answers(number, codes), return_counts=True))
                else:
                    n = np.bincount(coded.answers(number, codes))
                    own = np.flatnonzero(n)
                    found.append((own, n[own]))
            number = np.repeat(np.arange(len(leaves), dtype=np.int32), [len(a) for a, _ in found])
            columns = [number, *(np.concatenate([f[i] for f in found]) for i in (0, 1))]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["leaf", "answer", "n"])

    return run


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, pa.Array | None]]:
    """Features by rows, and the keys, of up to :data:`SLICE_ROWS` rows, which may come from several batches."""
    waiting, size = [], 0

    def one() -> tuple[np.ndarray, pa.Array | None]:
        x = np.concatenate([np.asarray(p.column("x").flatten()).reshape(p.num_rows, -1) for p in waiting])
        keys = pa.concat_arrays([p.column("key") for p in waiting]) if "key" in waiting[0].schema.names else None
        return np.ascontiguousarray(x.T), keys

    for batch in batches:
        at = 0
        while at < batch.num_rows:
            part = batch.slice(at, SLICE_ROWS - size)
            waiting.append(part)
            at, size = at + part.num_rows, size + part.num_rows
            if size == SLICE_ROWS:
                yield one()
                waiting, size = [], 0
    if waiting:
        yield one()


def _added(total: np.ndarray, leaf: Leaf, parts: np.ndarray, place: np.ndarray, own: np.ndarray) -> None:
    """Adds to ``total`` [feature, row] the parts [answer, feature of the leaf] of each row's answer; ``own`` is scratch."""
    for j, part in zip(leaf.features, np.ascontiguousarray(parts.T)):
        total[j] += np.take(part, place, out=own, mode="clip")


def _weights(size: int) -> np.ndarray:
    """[a, b]: the share of orderings in which one of ``a`` comes last of them and before all ``b``."""
    f = [math.factorial(i) for i in range(2 * size + 1)]
    return np.array([[f[a - 1] * f[b] / f[a + b] if a else 0.0 for b in range(size + 1)] for a in range(size + 1)])


def contributions_of(leaf: Leaf, answers: np.ndarray, seen: np.ndarray, share: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """[answer, feature of the leaf]: contributions against background rows with the answers ``seen`` in these shares."""
    every, bits = (1 << len(leaf.features)) - 1, np.arange(len(leaf.features))
    # few pairs are within reach; there the background's own features are those that the row fails
    row, base = np.nonzero((answers[:, None] | seen[None, :]) == every)
    mine, other = np.bitwise_count(answers[row] & ~seen[base]), np.bitwise_count(every & ~answers)[row]
    worth = share[base] * leaf.value
    gain = np.zeros((len(answers), len(seen)))
    gain[row, base] = weights[mine, other] * worth
    loss = np.bincount(row, weights[other, mine] * worth, len(answers))
    fits = (answers[:, None] >> bits & 1).astype(bool)
    return np.where(fits, gain @ (1.0 - (seen[:, None] >> bits & 1)), -loss[:, None])


def _distinct(answers: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct answers, and the place of each row's among them."""
    if bits > ARRAY_BITS:
        return np.unique(answers, return_inverse=True)
    found = np.flatnonzero(np.bincount(answers, minlength=1 << bits))
    place = np.zeros(1 << bits, np.int64)
    place[found] = np.arange(len(found))
    return found, place[answers]


def explain_trees(
    prepared: DataFrame, background: DataFrame, classifier, names: list[str], key: str = "customer_id"
) -> DataFrame:
    """Exact Shapley values of a forest or a boosted model: key, feature, contribution.

    Contributions are against all rows of ``background`` and, per row, add up to
    its score minus the mean score of these: the churn probability of a forest,
    the margin (half the log-odds) of a boosted model. Both frames carry a
    ``features`` vector; features that no tree asks for contribute 0. A key that
    comes more than once gets a set of contributions for each of its rows.
    Without background rows, or rows, the result is empty.
    """
    spark, d = prepared.sparkSession, len(names)
    leaves = leaves_of(classifier, spark)
    x = vector_to_array("features").alias("x")
    counts = spread_answers(background.select(x), leaves).mapInArrow(_answered(leaves), "leaf int, answer long, n long").groupBy("leaf", "answer")
    # at most 2 ** (features on a way) answers a leaf, whatever the background
    found = counts.agg(F.sum("n").alias("n")).orderBy("leaf", "answer").toArrow()
    number, answer, n = (found.column(c).to_numpy() for c in ("leaf", "answer", "n"))
    if not len(number):
        return prepared.select(key, F.lit("").alias("feature"), F.lit(0.0).alias("contribution")).limit(0)
    cuts = np.searchsorted(number, np.arange(len(leaves) + 1))
    rows = n[cuts[0] : cuts[1]].sum()
    seen = [(answer[a:b], n[a:b] / rows) for a, b in zip(cuts[:-1], cuts[1:])]
    weights = _weights(max(len(leaf.features) for leaf in leaves) + 1)
    key_type = prepared.schema[key].dataType.simpleString()
    coded = Coded(leaves)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for values, keys in _rows(batches):
            codes, total, scratch = coded.codes(values), np.zeros((d, values.shape[1])), np.empty(values.shape[1])
            for number, (leaf, (own, share)) in enumerate(zip(leaves, seen)):
                if not leaf.features:
                    continue
                answers, place = _distinct(coded.answers(number, codes), len(leaf.features))
                _added(total, leaf, contributions_of(leaf, answers, own, share, weights), place, scratch)
            repeated = keys.take(pa.array(np.repeat(np.arange(len(keys)), d)))
            features = pa.array(names, pa.string()).take(pa.array(np.tile(np.arange(d), len(keys))))
            yield pa.RecordBatch.from_arrays([repeated, features, pa.array(total.T.reshape(-1))], names=["key", "feature", "contribution"])

    out = spread_answers(prepared.select(F.col(key).alias("key"), x), leaves).mapInArrow(run, f"key {key_type}, feature string, contribution double")
    return out.withColumnRenamed("key", key)


def _sampled_contributions(leaf: Leaf, answers: np.ndarray, seen: np.ndarray, place: np.ndarray) -> np.ndarray:
    """[answer, feature of the leaf]: mean change when a background row becomes the row feature by feature.

    ``seen`` are the answers of an ordering's background row, ``place`` [ordering,
    feature of the leaf] when a feature changes. The leaf holds from the change of
    the last feature that only the row fits to that of the first one that only
    the background row fits.
    """
    bits = np.arange(len(leaf.features))
    own, theirs = ((a[:, None] >> bits & 1).astype(bool) for a in (answers, seen))
    own, theirs = own[:, None], theirs[None]
    mine, other = own & ~theirs, ~own & theirs
    begin = np.where(mine, place, 0).max(axis=2)
    end = np.where(other, place, np.iinfo(place.dtype).max).min(axis=2)
    holds = ((own | theirs).all(axis=2) & (begin < end))[:, :, None]
    gain = (mine & (place == begin[:, :, None]) & holds).sum(axis=1)
    loss = (other & (place == end[:, :, None]) & holds).sum(axis=1)
    return (gain - loss) * (leaf.value / len(seen))


def explain_forest_sampled(prepared: DataFrame, leaves: list[Leaf], base: np.ndarray, place: np.ndarray, names: list[str], key: str) -> DataFrame:
    """Shapley values of a forest by orderings: key, feature, contribution.

    ``base`` has the background row of each ordering, ``place`` when each
    feature changes in it. No copy of a row is scored: of a row only its answers
    to the leaves matter. A key that comes more than once gets the mean over its rows.
    """
    d = len(names)
    seen = [leaf.answers(base.T) for leaf in leaves]
    coded = Coded(leaves)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for values, keys in _rows(batches):
            codes, total, scratch = coded.codes(values), np.zeros((d, values.shape[1])), np.empty(values.shape[1])
            for number, (leaf, theirs) in enumerate(zip(leaves, seen)):
                if not leaf.features:
                    continue
                answers, at = _distinct(coded.answers(number, codes), len(leaf.features))
                _added(total, leaf, _sampled_contributions(leaf, answers, theirs, place[:, leaf.features]), at, scratch)
            lists = pa.ListArray.from_arrays(np.arange(0, total.size + 1, d, dtype=np.int32), pa.array(total.T.reshape(-1)))
            yield pa.RecordBatch.from_arrays([keys, lists], names=["key", "c"])

    x = vector_to_array("features").alias("x")
    key_type = prepared.schema[key].dataType.simpleString()
    rows = prepared.select(F.col(key).alias("key"), x).mapInArrow(run, f"key {key_type}, c array<double>")
    means = rows.groupBy("key").agg(F.array(*[F.avg(F.col("c")[j]) for j in range(d)]).alias("c"))
    return means.select(F.col("key").alias(key), F.posexplode("c").alias("j", "contribution")).select(
        key, F.element_at(F.array(*map(F.lit, names)), F.col("j") + 1).alias("feature"), "contribution"
    )
