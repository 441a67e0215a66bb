"""Boosted trees grown best first: the leaf whose split gains most is split next, until there are enough leaves.

Rows are binned once and written. A node's histogram holds the number of its rows and the sum of their residuals per
feature and bin, and tells its best split. One aggregate a round gives the histograms of all nodes that
best-first growth is sure to split next; only a split's smaller side is counted, the other is what is left of its
parent. A tree of 31 leaves takes about as many rounds as it is deep, whatever the number of rows.

Residuals are whole numbers (a label times ``scale``), so sums are exact: the same table gives the same trees on
any cluster and in any order of rows. Of equal gains the first feature and lowest bin win, and the leaf that was
made first. The driver holds histograms, at most leaves x features x bins numbers.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelcast.models.matrix import FEATURES
from panelcast.models.trees import boosted_from_nodes
from panelcast.session import saved

# The usual settings of histogram boosting (fixed values).
LEAVES, SMALLEST_LEAF, BINS = 31, 20, 255
# Trees after which the residuals are written anew, so that plans stay short.
SAVE_EVERY = 5


@dataclass
class Split:
    gain: float
    feature: int
    bin: int
    low: tuple[int, int]
    """Rows and residual sum of the lower side."""
    high: tuple[int, int]


def best_split(n: np.ndarray, g: np.ndarray, smallest: int) -> Split | None:
    """The best split of a node from its histogram, rows of features by bins; None if no split gains."""
    below_n, below_g = np.cumsum(n, axis=1)[:, :-1], np.cumsum(g, axis=1)[:, :-1]
    all_n, all_g = int(n[0].sum()), int(g[0].sum())
    above_n, above_g = all_n - below_n, all_g - below_g
    able = (below_n >= smallest) & (above_n >= smallest)
    if not able.any():
        return None
    a, b = below_g.astype(float), above_g.astype(float)
    gains = a * a / np.maximum(below_n, 1) + b * b / np.maximum(above_n, 1) - float(all_g) * float(all_g) / all_n
    gains = np.where(able, gains, -1.0)
    f, k = np.unravel_index(int(np.argmax(gains)), gains.shape)
    if gains[f, k] <= 0:
        return None
    return Split(float(gains[f, k]), int(f), int(k), (int(below_n[f, k]), int(below_g[f, k])), (int(above_n[f, k]), int(above_g[f, k])))


@dataclass
class Node:
    n: int
    g: int
    depth: int
    split: Split | None = None
    low: int = -1
    high: int = -1


class Tree:
    """A tree under growth. ``known`` nodes have had their histogram; the others' best split isn't known yet."""

    def __init__(self, n: int, g: int, leaves: int, smallest: int, deepest: int | None):
        self.nodes = [Node(n, g, 0)]
        self.leaves, self.smallest = leaves, smallest
        self.deepest = math.inf if deepest is None else deepest
        self.histograms: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        self.known: set[int] = set()

    def splittable(self, node: int) -> bool:
        own = self.nodes[node]
        return own.n >= 2 * self.smallest and own.depth < self.deepest

    def learn(self, node: int, n: np.ndarray, g: np.ndarray) -> None:
        own = self.nodes[node]
        own.split = best_split(n, g, self.smallest)
        self.known.add(node)
        if own.split:
            self.histograms[node] = (n, g)
            own.low, own.high = len(self.nodes), len(self.nodes) + 1
            self.nodes += [Node(*side, own.depth + 1) for side in (own.split.low, own.split.high)]

    def grown(self) -> tuple[set[int], list[int]]:
        """The nodes that best-first growth splits, as far as is known, and leaves it meets whose split it must know."""
        split, asked, queue = set(), [], []
        if 0 not in self.known:
            return split, [0]
        # (gain, order in which the leaf was made)
        made = 0
        if self.nodes[0].split:
            queue.append((-self.nodes[0].split.gain, made, 0))
        while queue and len(split) + 1 < self.leaves:
            _, _, at = heapq.heappop(queue)
            split.add(at)
            for child in (self.nodes[at].low, self.nodes[at].high):
                made += 1
                if child not in self.known:
                    asked.append(child)
                elif self.nodes[child].split:
                    heapq.heappush(queue, (-self.nodes[child].split.gain, made, child))
        return split, asked

    def place(self, split: set[int], bins: Sequence[Column]) -> Column:
        """The leaf of a row, as an expression of its bins."""

        def under(at: int) -> Column:
            if at not in split:
                return F.lit(at)
            own = self.nodes[at]
            return F.when(bins[own.split.feature] <= own.split.bin, under(own.low)).otherwise(under(own.high))

        return under(0)


def edges(rows: DataFrame, features: Sequence[str], bins: int = BINS) -> list[list[float]]:
    """Thresholds of each feature: all its values but the largest, or quantiles if it has more than ``bins`` values."""
    many = rows.agg(*(F.approx_count_distinct(f, 0.02).alias(f"d{i}") for i, f in enumerate(features))).first()
    few = [i for i in range(len(features)) if many[i] <= bins * 0.9]
    fractions = [k / bins for k in range(1, bins)]
    values = [F.collect_set(F.col(f).cast("double")) if i in few else F.percentile_approx(F.col(f).cast("double"), fractions, 100 * bins) for i, f in enumerate(features)]
    found = rows.agg(*(v.alias(f"v{i}") for i, v in enumerate(values)), *(F.max(F.col(f).cast("double")).alias(f"m{i}") for i, f in enumerate(features))).first()
    return [sorted(set(found[f"v{i}"] or []) - {found[f"m{i}"]}) for i in range(len(features))]


def binned(rows: DataFrame, features: Sequence[str], cuts: Sequence[Sequence[float]]) -> list[Column]:
    """How many thresholds lie below each feature's value: a value is at most its bin's threshold."""
    return [_rank(F.col(f).cast("double"), own) for f, own in zip(features, cuts, strict=True)]


def _rank(value: Column, cuts: Sequence[float]) -> Column:
    """By binary search over the rising cuts."""
    if not cuts:
        return F.lit(0)
    held = F.array(*(F.lit(float(c)) for c in cuts))
    steps = F.array(*(F.lit(1 << i) for i in reversed(range(len(cuts).bit_length()))))
    return F.aggregate(steps, F.lit(0), lambda at, s: F.when(F.get(held, at + s - 1) < value, at + s).otherwise(at))


def _histograms(rows: DataFrame, place: Column, wanted: Sequence[int], features: int, sizes: Sequence[int]) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Counts and residual sums per feature and bin of the rows in each wanted node: one aggregate."""
    width = max(sizes) + 1
    cell = F.explode(F.array(*(F.lit(i * width) + F.col(f"b{i}") for i in range(features))))
    inside = rows.select("r", *(f"b{i}" for i in range(features)), place.alias("node")).where(F.col("node").isin(list(wanted)))
    sums = inside.select("node", "r", cell.alias("cell")).groupBy("node", "cell").agg(F.count("*").alias("n"), F.sum("r").alias("g")).toArrow()
    out = {w: (np.zeros((features, width), np.int64), np.zeros((features, width), np.int64)) for w in wanted}
    for node, at, n, g in zip(*(sums[c].to_pylist() for c in ("node", "cell", "n", "g"))):
        out[node][0].flat[at], out[node][1].flat[at] = n, g
    return out


def grow(rows: DataFrame, tree: Tree, features: int, sizes: Sequence[int]) -> set[int]:
    """Grow ``tree`` best first on ``rows`` (r, b0, b1, ...); the nodes it splits."""
    bins = [F.col(f"b{i}") for i in range(features)]
    while True:
        split, asked = tree.grown()
        if not asked:
            return split
        # the lower side of each new split and its twin are asked for together; the smaller is counted
        wanted, pairs = [], []
        for at in [0] if asked == [0] else sorted({p for p in split if tree.nodes[p].low in asked}):
            sides = (at,) if asked == [0] else (tree.nodes[at].low, tree.nodes[at].high)
            if any(map(tree.splittable, sides)):
                least = min(sides, key=lambda k: (tree.nodes[k].n, k))
                wanted.append(least)
                pairs.append((at, least, [k for k in sides if k != least]))
        tree.known.update(k for k in asked if not tree.splittable(k))
        counted = _histograms(rows, tree.place(split, bins), wanted, features, sizes) if wanted else {}
        for at, least, others in pairs:
            found = {least: counted[least]} | {k: tuple(w - h for w, h in zip(tree.histograms[at], counted[least], strict=True)) for k in others}
            for k, hist in sorted(found.items()):
                if tree.splittable(k):
                    tree.learn(k, *hist)


def _whole(x: float) -> int:
    return math.floor(x + 0.5)


def leaf_values(tree: Tree, split: set[int], rate: float) -> dict[int, int]:
    out, todo = {}, [0]
    while todo:
        at = todo.pop()
        own = tree.nodes[at]
        if at in split:
            todo += [own.low, own.high]
        else:
            out[at] = _whole(rate * float(own.g) / own.n)
    return out


def _branch(tree: Tree, split: set[int], values: dict[int, int], cuts: Sequence[Sequence[float]], number: int, scale: float) -> list[tuple]:
    """``trees.NODES`` rows, numbered branch by branch."""
    rows: list[list] = []

    def add(at: int) -> int:
        row = [number, len(rows), -1, None, -1, -1, 0.0]
        rows.append(row)
        if at in split:
            own = tree.nodes[at]
            row[2], row[3] = own.split.feature, float(cuts[own.split.feature][own.split.bin])
            row[4], row[5] = add(own.low), add(own.high)
        else:
            row[6] = values[at] / scale
        return row[1]

    add(0)
    return [tuple(r) for r in rows]


def scale_for(n: int, largest: float) -> float:
    """The largest power of two with which sums of ``n`` labels stay below 2^61."""
    return 2.0 ** min(30, 60 - math.ceil(math.log2(max(1, n))) - math.ceil(math.log2(max(1.0, 2 * largest))))


def fit_trees(
    train: DataFrame, features: Sequence[str], label: str, iterations: int = 150, rate: float = 0.1,
    leaves: int = LEAVES, smallest: int = SMALLEST_LEAF, depth: int | None = None, bins: int = BINS, scale: float | None = None,
) -> PipelineModel:
    """Least-squares boosting from the mean label, ``rate`` of each leaf's mean residual at a time."""
    cuts = edges(train, features, bins)
    sizes = [len(c) for c in cuts]
    facts = train.agg(F.count(label).alias("n"), F.max(F.abs(F.col(label).cast("double"))).alias("m")).first()
    scale = scale_for(facts.n, facts.m or 0.0) if scale is None else scale
    names = [f"b{i}" for i in range(len(features))]
    whole = F.floor(F.col(label).cast("double") * F.lit(scale) + 0.5).cast("bigint")
    rows = saved(train.where(F.col(label).isNotNull()).select(whole.alias("y"), *(b.alias(n) for b, n in zip(binned(train, features, cuts), names))), "binned")
    total = rows.agg(F.sum("y").alias("s")).first().s
    base = _whole(total / facts.n)
    g = total - base * facts.n
    rows = rows.select((F.col("y") - F.lit(base)).alias("r"), *names)
    nodes = [(0, 0, -1, None, -1, -1, base / scale)]
    for k in range(1, iterations + 1):
        tree = Tree(facts.n, g, leaves, smallest, depth)
        split = grow(rows, tree, len(features), sizes)
        values = leaf_values(tree, split, rate)
        nodes += _branch(tree, split, values, cuts, k, scale)
        told = F.create_map(*(F.lit(x) for pair in values.items() for x in pair))
        off = F.element_at(told, tree.place(split, [F.col(n) for n in names])).cast("bigint")
        rows = rows.select((F.col("r") - off).alias("r"), *names)
        g -= sum(values[at] * tree.nodes[at].n for at in values)
        if k % SAVE_EVERY == 0 and k < iterations:
            rows = saved(rows, "residuals")
    estimator = GBTRegressor(featuresCol=FEATURES, labelCol=label, maxIter=iterations, stepSize=rate)
    model = boosted_from_nodes(train.sparkSession, nodes, iterations + 1, len(features), estimator)
    matrix = VectorAssembler(inputCols=list(features), outputCol=FEATURES, handleInvalid="error")
    return PipelineModel([*Pipeline(stages=[matrix]).fit(train).stages, model])
