"""Cross-validation of many tree ensembles at once, by histograms.

Fitting every trial on every fold by itself takes a job for each level of each
tree: tens of thousands. Here the rows of a fold are stored once, with their
features cut into bins, in blocks. A *step* adds trees to all fits: one round to
a boosted ensemble, a wave of trees to a forest. Its trees grow level by level,
and a level of all trees of all fits is one aggregate: a block adds up weight,
target and rows by (fit, node, feature, bin), the sums of all blocks give each
node its best split, and only the splits go back to the driver.

Where a task can hold the rows of a fold there is nothing to add up across
tasks. Then a task takes one (trial, fold), reads the blocks of the fold and goes
through the same steps, so that fits and not levels are dealt out. It holds some
65 bytes a row at 25 features and makes everything else slice by slice.

Random draws are hashes of row, trial and tree, the same on both ways.
"""

from __future__ import annotations

from collections.abc import Iterator
from copy import copy
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.ordered import running_sums, value_buckets
from ..session import materialize, side_by_side

BINS = 32
#: Rows of a fold that a task holds, a byte a feature and some 40 beside; a fold with more is grown by aggregates over its blocks.
BLOCK_ROWS = 1 << 23
#: Rows that are stored as one block, at most.
PIECE_ROWS = 1 << 16
#: Cells of a histogram that a task of its own fit keeps at a time.
NODE_CELLS = 1 << 18
#: Rows that it goes through at a time.
SLICE_ROWS = 1 << 15
#: Trees that a forest grows in a step.
WAVE = 16
KINDS = ("boosted", "forest")

_U = np.uint64
_BLOCK = "fold int, uid binary, y binary, held binary, bins binary, margin binary"


def _mix(x: np.ndarray) -> np.ndarray:
    """Mixes the bits of ``x``, which it overwrites."""
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x ^= x >> _U(shift)
        x *= _U(factor)
    x ^= x >> _U(31)
    return x


def _uniform(seed: int, *parts: np.ndarray) -> np.ndarray:
    """Numbers in [0, 1) that depend on nothing but the seed and the parts."""
    x = _mix(np.asarray([seed], np.int64).view(_U) + _U(0x9E3779B97F4A7C15))
    for p in parts:
        x = _mix(x * _U(3) + np.asarray(p, np.int64).view(_U))
    return (x >> _U(11)).astype(float) * 2.0**-53


@dataclass(frozen=True)
class Fit:
    """What growing needs to know of a trial on a fold."""

    number: int
    trial: dict
    weights: tuple[float, float]  #: of the negative and the positive class
    features: int
    seed: int
    wave: int = WAVE

    @property
    def boosted(self) -> bool:
        return self.trial["kind"] == "boosted"

    def trees(self, step: int) -> range:
        """The trees that a step adds, by their numbers."""
        width = 1 if self.boosted else self.wave
        return range(min(step * width, self.trial["trees"]), min((step + 1) * width, self.trial["trees"]))

    @property
    def steps(self) -> int:
        return self.trial["trees"] if self.boosted else -(-self.trial["trees"] // self.wave)

    @property
    def least_rows(self) -> int:
        return max(self.trial.get("min_leaf", 1), self.trial.get("min_split", 2) // 2)

    @property
    def columns(self) -> int:
        """Features that a node chooses from."""
        share = self.trial.get("column_share", 0.8) * self.features if self.boosted else np.sqrt(self.features)
        return min(self.features, max(1, int(np.ceil(share))))

    def tree_weight(self, step: int) -> float:
        if not self.boosted:
            return 1.0 / self.trial["trees"]
        return 1.0 if step == 0 else self.trial.get("learning_rate", 0.1)

    def drawn(self, uid: np.ndarray, tree: int) -> np.ndarray:
        """How often each row is in the sample of a tree."""
        u = _uniform(self.seed, np.array([self.number]), np.array([tree]), uid)
        if self.boosted:
            share = self.trial.get("row_share", 0.8)
            return (u < share).astype(float) if share < 1 else np.ones(len(uid))
        count = reduce(np.add, [(u >= p).view(np.uint8) for p in _POISSON[:3]])
        many = np.flatnonzero(count == 3)
        count[many] = np.searchsorted(_POISSON, u[many], "right")
        return count.astype(float)

    def target(self, y: np.ndarray, margin: np.ndarray, step: int) -> np.ndarray:
        """What the trees of a step learn: the class, or what the margin so far leaves of it (logistic loss)."""
        if not self.boosted:
            return y
        sign = 2 * y - 1
        return sign if step == 0 else 4 * sign / (1 + np.exp(2 * sign * margin))

    def chosen(self, tree: np.ndarray, path: np.ndarray) -> np.ndarray:
        """For each node the features it chooses from, rising."""
        order = np.arange(self.features)
        if self.columns == self.features:
            return np.tile(order, (len(path), 1))
        u = _uniform(self.seed + 1, np.full(1, self.number), tree[:, None], path[:, None], order)
        return np.sort(np.argpartition(u, self.columns - 1, axis=1)[:, : self.columns], axis=1)


_POISSON = np.cumsum(np.exp(-1.0) / np.cumprod([1, *range(1, 12)]))


class Trees:
    """Trees that grow side by side; node i of the first level is the root of tree i."""

    def __init__(self, numbers: range):
        n = len(numbers)
        #: of each node its tree, and the way to it: 1, then twice the parent's, plus 1 on the right
        self.tree, self.path = np.array(numbers), np.ones(n, int)
        self.feature, self.cut, self.left = np.full(n, -1), np.zeros(n, int), np.zeros(n, int)
        self.value, self.open = np.zeros(n), np.arange(n)

    def index(self) -> np.ndarray:
        """For each node its place among the open ones; -1: none."""
        index = np.full(len(self.feature), -1)
        index[self.open] = np.arange(len(self.open))
        return index

    def places(self, bins: np.ndarray, roots: int) -> np.ndarray:
        """[tree, row]: the node in which a row is."""
        at = np.tile(np.arange(roots)[:, None], (1, len(bins)))
        rows = np.arange(len(bins))
        while True:
            feature = self.feature[at]
            inner = feature >= 0
            if not inner.any():
                return at
            at = np.where(inner, self.left[at] + (bins[rows, np.maximum(feature, 0)] > self.cut[at]), at)

    def histogram(self, fit: Fit, at: np.ndarray, bins: np.ndarray, count: np.ndarray, weight: np.ndarray, target: np.ndarray) -> np.ndarray:
        """[sum, open node, feature, bin]: rows, weight and weighted target."""
        place = np.where(count > 0, self.index()[at], -1)
        tree, row = np.nonzero(place >= 0)
        place, count = place[tree, row], count[tree, row]
        features = fit.chosen(self.tree[self.open], self.path[self.open])
        cell = (place[:, None] * fit.columns + np.arange(fit.columns)) * BINS + bins[row[:, None], features[place]]
        size = len(self.open) * fit.columns * BINS
        w = weight[row] * count
        sums = [np.bincount(cell.reshape(-1), np.repeat(x, fit.columns), size) for x in (count, w, w * target[row])]
        return np.stack(sums).reshape(3, len(self.open), fit.columns, BINS)

    def grow(self, found: np.ndarray) -> None:
        """Takes :func:`best_splits` of the open nodes; the children of those that split are open next."""
        mean, feature, cut, left, right = found
        self.value[self.open] = np.where(np.isnan(mean), self.value[self.open], mean)
        split = np.flatnonzero(feature >= 0)
        node = self.open[split]
        self.feature[node], self.cut[node] = feature[split].astype(int), cut[split].astype(int)
        first = len(self.feature) + 2 * np.arange(len(node))
        self.left[node] = first
        self.tree = np.append(self.tree, np.repeat(self.tree[node], 2))
        self.path = np.append(self.path, (2 * self.path[node][:, None] + np.arange(2)).reshape(-1))
        for name, empty in (("feature", -1), ("cut", 0), ("left", 0)):
            setattr(self, name, np.append(getattr(self, name), np.full(2 * len(node), empty)))
        self.value = np.append(self.value, np.stack([left[split], right[split]], 1).reshape(-1))
        self.open = np.stack([first, first + 1], 1).reshape(-1)


def best_splits(fit: Fit, tree: np.ndarray, path: np.ndarray, sums: np.ndarray) -> np.ndarray:
    """Of nodes with their histograms: mean target, feature (-1: none), cut, and the mean on either side of it."""
    total = sums[:, :, 0].sum(axis=2)
    left = np.cumsum(sums, axis=3)[..., :-1]
    right = total[:, :, None, None] - left
    with np.errstate(divide="ignore", invalid="ignore"):
        mean = total[2] / total[1]
        gain = left[2] ** 2 / left[1] + right[2] ** 2 / right[1] - (total[2] * mean)[:, None, None]
        gain = gain / total[1][:, None, None]
        fits = (left[0] >= fit.least_rows) & (right[0] >= fit.least_rows) & (gain > 1e-12)
        gain = np.where(fits & (gain >= fit.trial.get("min_gain", 0.0)), gain, -1.0).reshape(len(path), -1)
        rows = np.arange(len(path))
        best = gain.argmax(axis=1)
        splits = gain[rows, best] > 0
        feature = np.where(splits, fit.chosen(tree, path)[rows, best // (BINS - 1)], -1)
        own = left.reshape(3, len(path), -1)[:, rows, best]
        rest = total - own
        return np.stack([mean, feature, best % (BINS - 1), own[2] / own[1], rest[2] / rest[1]])


@dataclass
class Block:
    """Rows of a fold as arrays."""

    uid: np.ndarray
    y: np.ndarray
    held: np.ndarray
    bins: np.ndarray
    margin: np.ndarray  #: [fit of the fold, row]

    @classmethod
    def read(cls, row: dict, features: int) -> Block:
        get = lambda c, t: np.frombuffer(row[c], t)
        y = get("y", np.uint8).astype(float)
        margin = get("margin", np.float64).reshape(-1, len(y)) if row["margin"] else np.zeros((0, len(y)))
        return cls(get("uid", np.int64), y, get("held", bool), get("bins", np.uint8).reshape(-1, features), margin)

    def sample(self, fit: Fit, trees: range) -> np.ndarray:
        return np.stack([fit.drawn(self.uid, t) for t in trees]) * ~self.held

    def weight(self, fit: Fit) -> np.ndarray:
        return np.where(self.y > 0, fit.weights[1], fit.weights[0])


def _class_sums(cell: np.ndarray, size: int, times: np.ndarray | None) -> np.ndarray:
    """[cell, class]: rows, each as often as it counts, from 2 * cell + class."""
    return np.bincount(cell, times, 2 * size).reshape(size, 2)


def _forest_sums(fit: Fit, doubled: np.ndarray, features: np.ndarray, place: np.ndarray, row: np.ndarray, y: np.ndarray, times: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """:meth:`Trees.histogram` of some nodes of one tree: weight and target are those of the class, so counts by class do.

    ``counts`` ([feature, node, bin, class]) holds those of earlier slices of the rows, and takes up those of these.
    """
    nodes, chosen = features.shape
    flat, first, base = doubled.reshape(-1), features * doubled.shape[1], place * (2 * BINS) + y
    for k in range(chosen):
        cell = row + (first[0, k] if nodes == 1 else np.take(first[:, k], place, mode="clip"))
        cell = np.add(base, np.take(flat, cell, mode="clip"), out=cell)
        counts[k] += _class_sums(cell, nodes * BINS, times).reshape(nodes, BINS, 2)
    target = fit.weights[1] * counts[..., 1]
    return np.stack([counts.sum(axis=3), fit.weights[0] * counts[..., 0] + target, target]).transpose(0, 2, 1, 3)


def _boosted_sums(fit: Fit, doubled: np.ndarray, features: np.ndarray, place: np.ndarray, y: np.ndarray, wanted: np.ndarray, sums: np.ndarray | None = None) -> np.ndarray:
    """:meth:`Trees.histogram` of the nodes of one tree, from twice the bins by feature; most features are chosen, so all are added up.

    ``sums`` ([count or target, feature, cell, class]) holds those of earlier slices of the rows, and takes up those of these.
    """
    nodes, size = len(features), len(features) * BINS
    count, target = np.zeros((2, fit.features, size, 2)) if sums is None else sums
    width = max(SLICE_ROWS, 2 * size)
    cell = np.empty(min(width, len(place)), np.int64)
    for first in range(0, len(place), width):  # slices stay in the cache while the features go by
        some = slice(first, first + width)
        base, own = place[some] * (2 * BINS) + y[some], wanted[some]
        for j, bins in enumerate(doubled):
            at = np.add(base, bins[some], out=cell[: len(base)])
            count[j] += _class_sums(at, size, None)
            target[j] += np.bincount(at, own, 2 * size).reshape(size, 2)
    weight = count @ np.array(fit.weights)
    found = np.stack([count.sum(axis=2), weight, target.sum(axis=2)]).reshape(3, fit.features, nodes, BINS)
    return found[:, features, np.arange(nodes)[:, None]]


def _ways(trees: Trees, doubled: np.ndarray) -> tuple[np.ndarray, ...]:
    """What :func:`_below` reads: all bins, and of each node where those of its feature begin, its cut and its left child."""
    return doubled.reshape(-1), trees.feature * doubled.shape[1], 2 * trees.cut, trees.left


def _below(ways: tuple[np.ndarray, ...], row: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The children to which rows go on from nodes that are split."""
    take = lambda a, i: np.take(a, i, mode="clip")
    flat, first, cut, left = ways
    return take(left, at) + (take(flat, row + take(first, at)) > take(cut, at))


def _spread(fit: Fit, place: np.ndarray, y: np.ndarray, own: np.ndarray, nodes: int, sums: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The mean target of nodes, and an upper bound of the gain of their splits: the variance of the target, which no split exceeds.

    ``sums`` holds what earlier slices of the rows add, and takes up what these do.
    """
    weight, sums = np.array(fit.weights), np.zeros((4, nodes)) if sums is None else sums
    square = own * own * np.take(1 / weight, y)
    if nodes == 1:
        ones = np.count_nonzero(y)
        sums += np.array([[len(y) - ones], [ones], [own.sum()], [square.sum()]])
    else:
        sums[:2] += np.bincount(2 * place + y, minlength=2 * nodes).reshape(nodes, 2).T
        sums[2] += np.bincount(place, own, nodes)
        sums[3] += np.bincount(place, square, nodes)
    rows = sums[:2].T @ weight
    with np.errstate(divide="ignore", invalid="ignore"):
        mean, square = sums[2] / rows, sums[3] / rows
    # the difference loses digits: what is lost is given back
    return mean, square - mean**2 + 1e-9 * square


def _slices(n: int, cells: int = 0, times: int = 1) -> Iterator[slice]:
    """Slices of ``n`` rows, wide enough to be worth sums of that many cells, or some times as wide."""
    width = times * max(SLICE_ROWS, cells)
    return (slice(first, min(first + width, n)) for first in range(0, n, width))


@dataclass
class Sample:
    """The rows drawn for a tree that still go down in it."""

    row: np.ndarray
    at: np.ndarray  #: the node in which they are
    times: np.ndarray  #: how often they were drawn

    @classmethod
    def drawn(cls, fit: Fit, number: int, known: Known) -> Sample:
        rows, times = [known.row[:0]], [np.empty(0, np.uint8)]
        for some in _slices(len(known.row)):
            count = fit.drawn(known.uid[some], number).astype(np.uint8)
            in_sample = np.flatnonzero(count)
            rows.append(known.row[some][in_sample])
            times.append(count[in_sample])
        row = np.concatenate(rows)
        return cls(row, np.zeros(len(row), np.int32), np.concatenate(times))

    def keep(self, which: np.ndarray) -> None:
        """Drops rows, or brings them into another order."""
        self.row, self.at, self.times = self.row[which], self.at[which], self.times[which]


def _able(fit: Fit, trees: Trees, known: Known, sample: Sample, wanted: np.ndarray | None) -> np.ndarray:
    """Which open nodes may split: by their rows, for being of two classes or, in boosting, by the spread of their target."""
    nodes, root, index = len(trees.open), trees.path[trees.open[0]] == 1, trees.index()
    if root and not fit.boosted:
        return np.array([len(sample.row) > 0])
    count, sums, spread = np.zeros((nodes, 2)), np.zeros((4, nodes)), np.zeros(nodes)
    for some in _slices(len(sample.row), 2 * nodes):
        row = sample.row[some].astype(np.int64)
        place, y = index[:1] if root else np.take(index, sample.at[some]), np.take(known.y, row)
        if fit.boosted:
            mean, spread = _spread(fit, place, y, np.take(wanted, row), nodes, sums)
            if root:
                trees.value[0] = mean[0]
        else:
            count += _class_sums(2 * place + y, nodes, sample.times[some])
    if fit.boosted:
        return (sums[:2].sum(axis=0) >= (1 if root else 2 * fit.least_rows)) & ~(spread < fit.trial.get("min_gain", 0.0))
    return (count.sum(axis=1) >= 2 * fit.least_rows) & (count > 0).all(axis=1)


def _level_sums(fit: Fit, trees: Trees, node: np.ndarray, index: np.ndarray, known: Known, sample: Sample, rows: slice, wanted: np.ndarray | None) -> np.ndarray:
    """:meth:`Trees.histogram` of some open nodes, whose rows are the given ones of the sample; ``index`` is that of the trees."""
    features, size = fit.chosen(trees.tree[node], trees.path[node]), len(node) * BINS
    sums = np.zeros((2, fit.features, size, 2) if fit.boosted else (fit.columns, len(node), BINS, 2))
    for some in _slices(rows.stop - rows.start, 2 * size, 4):
        some = slice(rows.start + some.start, rows.start + some.stop)
        row = sample.row[some].astype(np.int64)
        place, y = np.take(index, sample.at[some]) - index[node[0]], np.take(known.y, row)
        if fit.boosted:
            found = _boosted_sums(fit, np.take(known.doubled, row, axis=1), features, place, y, np.take(wanted, row), sums)
        else:
            found = _forest_sums(fit, known.doubled, features, place, row, y, sample.times[some].astype(float), sums)
    return found


def _tree_alone(fit: Fit, number: int, known: Known, wanted: np.ndarray | None, asked: np.ndarray, factor: float, out: np.ndarray) -> None:
    """Adds to ``out`` the values, times a factor, that a tree grown on all blocks of a fold gives to the ``asked`` rows.

    Rows go down level by level and leave the work in a leaf. Nodes that cannot
    split are not looked at. ``wanted`` is the weighted target of boosting.
    """
    trees, sample = Trees(range(number, number + 1)), Sample.drawn(fit, number, known)
    trees.value[0] = np.nan
    for _ in range(fit.trial["max_depth"]):
        able = _able(fit, trees, known, sample, wanted)
        if not able.all():
            trees.open = trees.open[able]
            stays = np.zeros(len(trees.feature), bool)
            stays[trees.open] = True
            sample.keep(stays[sample.at])
        if not len(trees.open):
            break
        step = max(1, NODE_CELLS // (fit.columns * BINS))  # bounds the memory of deep levels
        index, ends = trees.index(), np.array([0, len(sample.row)])
        if len(trees.open) > step:  # the rows of such nodes come together, in the order they have
            part = index[sample.at] // step
            ends = np.append(0, np.cumsum(np.bincount(part, minlength=-(-len(trees.open) // step))))
            sample.keep(np.argsort(part.astype(np.uint16) if len(ends) < 1 << 16 else part, kind="stable"))
        found = []
        for k, first in enumerate(range(0, len(trees.open), step)):
            node = trees.open[first : first + step]
            sums = _level_sums(fit, trees, node, index, known, sample, slice(ends[k], ends[k + 1]), wanted)
            found.append(best_splits(fit, trees.tree[node], trees.path[node], sums))
        trees.grow(np.concatenate(found, axis=1))
        if not len(trees.open):
            break
        goes = trees.feature >= 0
        if not goes[sample.at].all():
            sample.keep(goes[sample.at])
        ways = _ways(trees, known.doubled)
        for some in _slices(len(sample.row)):
            sample.at[some] = _below(ways, sample.row[some].astype(np.int64), sample.at[some])
    # a leaf leads back to itself
    leaf = np.flatnonzero(trees.feature < 0)
    trees.feature[leaf], trees.cut[leaf], trees.left[leaf] = 0, BINS, leaf
    value, levels, ways = factor * np.nan_to_num(trees.value), int(np.log2(trees.path.max())), _ways(trees, known.doubled)
    if not levels:
        out += value[0]
        return
    for some in _slices(len(asked)):
        row, at = asked[some].astype(np.int64), np.zeros(some.stop - some.start, np.int64)
        for _ in range(levels):
            at = _below(ways, row, at)
        out[some] += np.take(value, at)


@dataclass
class Known:
    """A fold as all trees of a fit use it."""

    doubled: np.ndarray  #: [feature, row]: twice the bins
    y: np.ndarray
    held: np.ndarray
    row: np.ndarray  #: the rows that are not held
    uid: np.ndarray  #: of those

    @classmethod
    def of(cls, blocks: Iterator[Block], n: int, features: int) -> Known:
        """From blocks with ``n`` rows together, none of which is kept."""
        doubled, y, held, uid, at = np.empty((features, n), np.uint8), np.empty(n, np.uint8), np.empty(n, bool), [], 0
        for block in blocks:
            some = slice(at, at := at + len(block.y))
            doubled[:, some] = block.bins.T << 1
            y[some], held[some] = block.y, block.held
            uid.append(block.uid[~block.held])
        row = np.flatnonzero(~held)
        return cls(doubled, y, held, row.astype(np.int32 if n < 1 << 31 else np.int64), np.concatenate(uid))


def _grown_alone(fit: Fit, *blocks: Block) -> np.ndarray:
    """The margins of the rows of all blocks of a fold, after all steps; of a forest those of the held ones."""
    return _margins(fit, Known.of(iter(blocks), sum(len(b.y) for b in blocks), fit.features))


def _margins(fit: Fit, known: Known) -> np.ndarray:
    margin = np.zeros(len(known.y))
    asked = np.arange(len(known.y), dtype=known.row.dtype) if fit.boosted else np.flatnonzero(known.held)
    wanted = np.empty(len(known.y)) if fit.boosted else None
    added = None if fit.boosted else np.empty(len(asked))
    for step in range(fit.steps):
        if fit.boosted:
            for some in _slices(len(known.y)):
                y = known.y[some].astype(float)
                wanted[some] = np.where(y > 0, fit.weights[1], fit.weights[0]) * fit.target(y, margin[some], step)
            _tree_alone(fit, step, known, wanted, asked, fit.tree_weight(step), margin)
        else:
            added[:] = 0
            for number in fit.trees(step):
                _tree_alone(fit, number, known, None, asked, 1.0, added)
            margin[asked] += fit.tree_weight(step) * added
    return margin


def _held_scores(trial: int, fold: int, y: np.ndarray, held: np.ndarray, margin: np.ndarray) -> pa.RecordBatch:
    """The held-out rows counted by class and score, as far as they are here."""
    parts = []
    for churn in (0, 1):
        score, rows = np.unique(margin[held & (y == churn)], return_counts=True)
        parts.append([np.full(len(score), x, np.int32) for x in (trial, fold, churn)] + [score, rows.astype(np.int64)])
    columns = [np.concatenate(c) for c in zip(*parts)]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["trial", "fold", "churn", "score", "rows"])


_SCORES = "trial int, fold int, churn int, score double, rows bigint"


def _work(trial: dict) -> float:
    """About how long a trial takes, to begin with the longest."""
    columns = trial.get("column_share", 0.2) * trial.get("row_share", 0.6)
    return trial["trees"] * trial["max_depth"] * columns


def _scores_alone(blocks: list[DataFrame], fits: dict[tuple[int, int], Fit], features: int) -> DataFrame:
    trials = sorted({t for t, _ in fits}, key=lambda t: -_work(next(f.trial for (i, _), f in fits.items() if i == t)))

    def grown(key: tuple[int, int], rows: list[dict]) -> pa.RecordBatch:
        rows.sort(key=lambda r: np.frombuffer(r["uid"], np.int64, 1)[0], reverse=True)  # the same order in whatever order they were read
        n = sum(r["y"].size for r in rows)
        known = Known.of((Block.read(rows.pop(), features) for _ in range(len(rows))), n, features)
        return _held_scores(*key, known.y, known.held, _margins(fits[key], known))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, last = [], None
        for batch in batches:
            for i in range(batch.num_rows):
                key = batch.column("trial")[i].as_py(), batch.column("fold")[i].as_py()
                if rows and key != last:
                    yield grown(last, rows)
                last = key
                # views into the batch, no copies
                rows.append({c: batch.column(c)[i].as_buffer() for c in ("uid", "y", "held", "bins")} | {"margin": None})
        if rows:
            yield grown(last, rows)

    # each trial reads the stored blocks of a fold by itself, in one task; none is shuffled
    each = [block.coalesce(1).withColumn("trial", F.lit(t)) for t in trials for block in blocks]
    # frames of one partition each would be united into one partition; with one that is not, they stay apart
    apart = blocks[0].filter("fold < 0").withColumn("trial", F.lit(-1))
    return reduce(DataFrame.union, [*each, apart]).mapInArrow(run, _SCORES)


_CELLS = "fit int, node int, cell int, n double, w double, t double"
_CELL_SCHEMA = pa.schema([*[(c, pa.int32()) for c in ("fit", "node", "cell")], *[(c, pa.float64()) for c in ("n", "w", "t")]])
_SPLITS = "fit int, node int, mean double, feature double, cut double, left double, right double"


def _level(blocks: DataFrame, fits: dict[tuple[int, int], Fit], grown: dict[int, Trees], step: int, features: int) -> None:
    """Grows one level of all trees: sums of all blocks by (fit, node, feature, bin), added up per node."""
    order = sorted({t for t, _ in fits})

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                block = Block.read(row, features)
                for i, trial in enumerate(order):
                    fit = fits[trial, row["fold"]]
                    trees = grown.get(fit.number)
                    if trees is None or not len(trees.open):
                        continue
                    numbers = fit.trees(step)
                    at, count = trees.places(block.bins, len(numbers)), block.sample(fit, numbers)
                    target, weight = fit.target(block.y, block.margin[i], step), block.weight(fit)
                    here, some = np.intersect1d(at[count > 0], trees.open), copy(trees)
                    size = max(1, NODE_CELLS // (fit.columns * BINS))
                    for first in range(0, len(here), size):
                        some.open = here[first : first + size]
                        sums = some.histogram(fit, at, block.bins, count, weight, target).reshape(3, len(some.open), -1)
                        node, cell = np.nonzero(sums[0])
                        fit_number = np.full(len(node), fit.number, np.int32)
                        columns = [fit_number, some.open[node].astype(np.int32), cell.astype(np.int32), *sums[:, node, cell]]
                        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["fit", "node", "cell", "n", "w", "t"])

    by_number = {f.number: f for f in fits.values()}

    def splits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = pa.Table.from_batches([], _CELL_SCHEMA)
        for batch in batches:  # in order of nodes: the last one may go on in the next batch
            table = pa.concat_tables([rest, pa.Table.from_batches([batch], _CELL_SCHEMA)])
            fit_numbers, nodes = table.column("fit").to_numpy(), table.column("node").to_numpy()
            last = np.flatnonzero((fit_numbers != fit_numbers[-1:]) | (nodes != nodes[-1:]))
            whole = last[-1] + 1 if len(last) else 0
            yield from split(table.slice(0, whole))
            rest = table.slice(whole)
        yield from split(rest)

    def split(table: pa.Table) -> Iterator[pa.RecordBatch]:
        fit_numbers = table.column("fit").to_numpy()
        for number in np.unique(fit_numbers).tolist():
            fit, own = by_number[number], np.flatnonzero(fit_numbers == number)
            get = lambda c, own=own: table.column(c).to_numpy()[own]
            node, at = np.unique(get("node"), return_inverse=True)
            sums = np.zeros((3, len(node), fit.columns * BINS))
            for i, c in enumerate(("n", "w", "t")):
                sums[i, at, get("cell")] = get(c)
            found = best_splits(fit, grown[number].tree[node], grown[number].path[node], sums.reshape(3, len(node), fit.columns, BINS))
            columns = [np.full(len(node), number, np.int32), node.astype(np.int32), *found]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=[c.split()[0] for c in _SPLITS.split(", ")])

    added = blocks.mapInArrow(cells, _CELLS).groupBy("fit", "node", "cell").agg(*[F.sum(c).alias(c) for c in ("n", "w", "t")])
    # batches of whole nodes: a task holds the sums of a batch, not of all nodes that it gets
    added = added.repartition("fit", "node").sortWithinPartitions("fit", "node")
    # one row for each open node: bounded by the trees that grow, not by rows
    found = added.mapInArrow(splits, _SPLITS).toArrow().to_pandas()
    for number, trees in grown.items():
        own = found[found["fit"] == number].set_index("node").reindex(trees.open)
        own = own.fillna({"feature": -1, "cut": 0})
        trees.grow(own[["mean", "feature", "cut", "left", "right"]].to_numpy().T)


def _scores_by_levels(blocks: list[DataFrame], fits: dict[tuple[int, int], Fit], features: int) -> DataFrame:
    order = sorted({t for t, _ in fits})

    def begun(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.to_pylist()
            margins = pa.array([np.zeros((len(order), len(r["y"]))).tobytes() for r in rows], pa.binary())
            yield batch.set_column(batch.schema.get_field_index("margin"), "margin", margins)

    state = materialize(reduce(DataFrame.union, blocks).mapInArrow(begun, _BLOCK), "tree-blocks")
    for step in range(max(f.steps for f in fits.values())):
        grown = {f.number: Trees(f.trees(step)) for f in fits.values() if len(f.trees(step))}
        depth = {f.number: f.trial["max_depth"] for f in fits.values()}
        for level in range(max(depth[n] for n in grown)):
            for number, trees in grown.items():
                if level >= depth[number]:
                    trees.open = trees.open[:0]
            if not any(len(t.open) for t in grown.values()):
                break
            _level(state, fits, grown, step, features)

        def moved(batches: Iterator[pa.RecordBatch], step=step, grown=grown) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                out = []
                for row in batch.to_pylist():
                    block = Block.read(row, features)
                    margin = block.margin.copy()
                    for i, trial in enumerate(order):
                        fit = fits[trial, row["fold"]]
                        if fit.number in grown:
                            trees = grown[fit.number]
                            leaf = trees.value[trees.places(block.bins, len(fit.trees(step)))]
                            margin[i] += fit.tree_weight(step) * leaf.sum(axis=0)
                    out.append(margin.tobytes())
                yield batch.set_column(batch.schema.get_field_index("margin"), "margin", pa.array(out, pa.binary()))

        state = materialize(state.mapInArrow(moved, _BLOCK), "tree-blocks")

    def last(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                block = Block.read(row, features)
                for i, trial in enumerate(order):
                    yield _held_scores(trial, row["fold"], block.y, block.held, block.margin[i])

    return state.mapInArrow(last, _SCORES)


def bin_edges(rows: DataFrame) -> list[np.ndarray]:
    """For each slot of ``features`` up to :data:`BINS` - 1 values that cut it into bins of about equally many rows."""
    x = rows.select(vector_to_array("features").alias("x"))
    d = len(x.first()["x"])
    shares = [i / BINS for i in range(1, BINS)]
    found = x.agg(*[F.percentile_approx(F.col("x")[j], shares, 10_000).alias(f"q{j}") for j in range(d)], *[F.max(F.col("x")[j]).alias(f"m{j}") for j in range(d)]).first()
    return [np.array(sorted({q for q in found[f"q{j}"] if q < found[f"m{j}"]})) for j in range(d)]


def fold_blocks(rows: DataFrame, fold: int, edges: list[np.ndarray], key: str, n: int, block_rows: int) -> DataFrame:
    """The rows (key, churn, held, features) of a fold as blocks with binned features."""

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, size = [], 0
        for batch in batches:
            for at in range(0, batch.num_rows, block_rows):
                waiting.append(arrays(batch.slice(at, block_rows)))
                size += len(waiting[-1][0])
                if size >= block_rows:
                    yield one(waiting)
                    waiting, size = [], 0
        if waiting:
            yield one(waiting)

    def arrays(batch: pa.RecordBatch) -> list[np.ndarray]:
        x = np.asarray(batch.column("x").flatten()).reshape(batch.num_rows, -1)
        bins = np.stack([np.searchsorted(e, x[:, j], "left") for j, e in enumerate(edges)], axis=1).astype(np.uint8)
        get = lambda c: batch.column(c).to_numpy(zero_copy_only=False)
        return [get("uid"), get("churn").astype(np.uint8), get("held").astype(bool), bins]

    def one(parts: list[list[np.ndarray]]) -> pa.RecordBatch:
        whole = [np.ascontiguousarray(np.concatenate(p)) for p in zip(*parts)]
        columns = [pa.array([fold], pa.int32()), *[pa.array([a.tobytes()], pa.binary()) for a in whole], pa.array([None], pa.binary())]
        return pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in _BLOCK.split(", ")])

    plain = rows.select(
        F.xxhash64(key).alias("uid"), F.col("churn").cast("int").alias("churn"), "held", vector_to_array("features").alias("x")
    )
    return plain.repartition(max(1, -(-n // block_rows)), "uid").sortWithinPartitions("uid").mapInArrow(packed, _BLOCK)


def grouped_auc(scores: DataFrame) -> DataFrame:
    """trial, fold and the exact area under the ROC curve of their counted scores; null when a class is missing."""
    group = ["trial", "fold"]
    of = lambda churn: F.sum(F.when(F.col("churn") == churn, F.col("rows")).otherwise(0))
    freq = scores.groupBy(*group, "score").agg(of(1).alias("pos"), of(0).alias("neg"))
    ranked = running_sums(value_buckets(freq, group, "score", 8), group, "_bucket", ["score"], ["pos", "neg"])
    outranked = F.sum(F.col("pos") * (F.col("neg_before") + F.col("neg") / 2))
    pairs = F.max("pos_total").cast("double") * F.max("neg_total")
    return ranked.groupBy(*group).agg(F.try_divide(outranked, pairs).alias("roc_auc"))


def cross_validated_auc(
    folds: list[DataFrame],
    weights: list[dict[str, tuple[float, float]]],
    trials: list[dict],
    key: str = "customer_id",
    seed: int = 42,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """trial, fold and the held-out ROC-AUC of every trial on every fold.

    A fold holds key, churn, held and ``features``, prepared on its rows that are
    not held; ``weights`` are its class weights by kind. Trees are grown on the
    rows that are not held, splits are between bins of about equally many of
    them. Boosting follows the logistic loss: the first tree learns the class, a
    later one what the margin leaves of it, each row in a round's sample with the
    trial's probability. Forests draw rows with replacement and choose a split
    from the square root of the features. Both choose features node by node.
    """
    spark = folds[0].sparkSession
    counts, edges = zip(*side_by_side(spark, lambda rows: (rows.count(), bin_edges(rows.filter("NOT held"))), folds))
    n, d = max(counts), [len(e) for e in edges]
    if len(set(d)) > 1:  # a level that some folds never see
        parts = [cross_validated_auc([r], [w], trials, key, seed, block_rows).withColumn("fold", F.lit(f)) for f, (r, w) in enumerate(zip(folds, weights))]
        out = parts[0]
        for p in parts[1:]:
            out = out.union(p)
        return out
    stored = [fold_blocks(rows, f, edges[f], key, counts[f], min(block_rows, PIECE_ROWS)) for f, rows in enumerate(folds)]
    blocks = side_by_side(spark, lambda b: materialize(b, "fold-blocks"), stored)
    pairs = [(t, f) for t in range(len(trials)) for f in range(len(folds))]
    alone = n <= block_rows
    # the wave does not change a tree; a single tree at a time keeps the sums of a level small
    wave = WAVE if alone else 1
    fits = {
        (t, f): Fit(i, trials[t], weights[f][trials[t]["kind"]], d[0], seed, wave) for i, (t, f) in enumerate(pairs)
    }
    grow = _scores_alone if alone else _scores_by_levels
    return grouped_auc(materialize(grow(blocks, fits, d[0]), "held-scores"))
