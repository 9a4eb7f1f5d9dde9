"""Decision trees of a whole grid search, grown level by level together.

The scripts fit every (grid point, fold) alone. Here all impurities and
all parts grow at once: one job per level counts, for every (impurity, part,
open node, feature, bin), the rows of either class; the driver picks each
node's best split from these counts, whose size depends on the grid and the
depth, never on the data. Smaller depths are read off the deepest tree: splits
are chosen from the top, so a shallower tree is its prefix. One pass scores
all of them.

Split candidates are those of Spark ML's trees: midpoints between distinct
values of a part's training rows, at most ``max_bins`` - 1 of them at even
strides of the row count, from all rows up to ``SPLIT_ROWS`` and from a
hash sample of about that size beyond (Spark ML samples there, too). Gains
are compared at 12 decimals; ties go to the first feature, then to the
smallest threshold.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from maillens.operators.partials import partitions, sum_arrays

SPLIT_ROWS = 10_000     # training rows from which on split candidates come from a sample
GAIN_DECIMALS = 12
_SALT, _SHARES = "bins:", 1_000_000


def fit_one(train: DataFrame, impurity: str, max_depth: int, max_bins: int = 32,
            seed: int = 42):
    """Option: one tree by Spark ML's own trainer."""
    est = DecisionTreeClassifier(featuresCol="features", labelCol="label",
                                 impurity=impurity, maxDepth=max_depth,
                                 maxBins=max_bins, seed=seed)
    return est.fit(train)


# ---------------------------------------------------------------- split candidates


def split_points(values: np.ndarray, max_bins: int) -> np.ndarray:
    """Thresholds for one feature: a threshold stands behind the distinct
    value at which the running count comes closest to the next stride."""
    distinct, count = np.unique(values, return_counts=True)
    middle = (distinct[:-1] + distinct[1:]) / 2.0
    if len(middle) <= max_bins - 1:
        return middle
    stride = len(values) / max_bins
    running = np.cumsum(count).astype(np.float64)
    picked, target = [], stride
    for i in range(len(middle)):
        if abs(running[i] - target) < abs(running[i + 1] - target):
            picked.append(i)
            target += stride
    return middle[picked]


def split_candidates(data: DataFrame, features: list[str], k: int, max_bins: int) -> list[list[np.ndarray]]:
    """Thresholds per part and feature, from one bounded set of rows."""
    from maillens.operators.selection import bucket

    train = data.where(F.col("part") < k)
    n = train.count()
    if n > SPLIT_ROWS:
        share = -(-SPLIT_ROWS * _SHARES // n)
        train = train.where(bucket(F.col("key"), _SALT) % _SHARES < share)
    rows = train.select("part", *features).toPandas()          # about SPLIT_ROWS rows
    part = rows["part"].to_numpy()
    return [[split_points(rows.loc[part != m, f].to_numpy(np.float64), max_bins) if (part != m).any()
             else np.zeros(0) for f in features] for m in range(k + 1)]


# ---------------------------------------------------------------- growing


@dataclass
class Tree:
    """Nodes in heap order (children of i: 2i and 2i + 1, root 1)."""

    impurity: str
    part: int
    split: dict[int, tuple[int, float]] = field(default_factory=dict)    # node -> (feature, threshold)
    majority: dict[int, float] = field(default_factory=dict)


def _impurity(kind: str, p: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Gini or entropy of nodes with ``p`` of ``n`` rows of class 1."""
    with np.errstate(divide="ignore", invalid="ignore"):
        q1, q0 = p / n, (n - p) / n
        if kind == "gini":
            return 1.0 - q0 * q0 - q1 * q1
        bits = lambda q: np.where(q > 0, q * np.log(np.where(q > 0, q, 1.0)) / np.log(2.0), 0.0)
        return -bits(q0) - bits(q1)


def best_split(kind: str, hist: np.ndarray, thresholds: list[np.ndarray]) -> tuple[int, float] | None:
    """(feature, threshold) of the largest gain; ``hist`` is (features, bins,
    class). None where no split gains."""
    best = None
    n, p = hist[0].sum(), hist[0, :, 1].sum()
    whole = _impurity(kind, p, n)
    for f, cuts in enumerate(thresholds):
        if not len(cuts):
            continue
        left = np.cumsum(hist[f, :len(cuts)], axis=0)
        ln, lp = left.sum(axis=1), left[:, 1]
        rn, rp = n - ln, p - lp
        ok = (ln > 0) & (rn > 0)
        if not ok.any():
            continue
        gain = whole - (ln / n) * _impurity(kind, lp, ln) - (rn / n) * _impurity(kind, rp, rn)
        gain = np.where(ok, np.round(gain, GAIN_DECIMALS), -1.0)
        at = int(gain.argmax())
        if gain[at] > 0 and (best is None or gain[at] > best[0]):
            best = gain[at], f, float(cuts[at])
    return None if best is None else best[1:]


def _walk(trees: list[Tree], x: np.ndarray, depth: int) -> list[np.ndarray]:
    """Each row's node in every tree after ``depth`` splits at most."""
    out = []
    for tree in trees:
        feature, cut = np.full(1 << depth, -1), np.zeros(1 << depth)
        for i, (f, c) in tree.split.items():
            feature[i], cut[i] = f, c
        node = np.ones(len(x), np.int64)
        rows = np.arange(len(x))
        for _ in range(depth):
            rows = rows[feature[node[rows]] >= 0]
            at = node[rows]
            node[rows] = 2 * at + (x[rows, feature[at]] > cut[at])
        out.append(node)
    return out


def _histogram_fn(trees: list[Tree], open_: list[list[int]], depth: int, features: list[str], k: int,
                  cuts: list[list[np.ndarray]], bins: int):
    d = len(features)
    starts = np.cumsum([0] + [len(o) for o in open_])

    def run(batches: Iterator[pd.DataFrame]) -> np.ndarray:
        total = np.zeros((starts[-1], d, bins, 2))
        for pdf in batches:
            x = pdf[features].to_numpy(np.float64)
            y, part = pdf["label"].to_numpy().astype(np.int64), pdf["part"].to_numpy()
            nodes = _walk(trees, x, depth)
            binned: dict[int, np.ndarray] = {}
            for t, tree in enumerate(trees):
                if not open_[t]:
                    continue
                place = np.full(2 << depth, -1, np.int64)
                place[open_[t]] = np.arange(len(open_[t]))
                use = np.flatnonzero((part < k) & (part != tree.part) & (place[nodes[t]] >= 0))
                if tree.part not in binned:
                    binned[tree.part] = np.stack([np.searchsorted(c, x[:, f]) for f, c in enumerate(cuts[tree.part])])
                slot = place[nodes[t][use]]
                size = len(open_[t]) * bins * 2
                for f in range(d):
                    at = (slot * bins + binned[tree.part][f, use]) * 2 + y[use]
                    total[starts[t]:starts[t + 1], f] += np.bincount(at, minlength=size).reshape(-1, bins, 2)
        return total

    return run


def grow(data: DataFrame, kinds: list[str], features: list[str], k: int, max_depth: int,
         max_bins: int = 32) -> list[Tree]:
    """Trees of every impurity and part (0..k), one job per level.

    ``data`` holds (key, label 0/1, part, features...); part m's tree is
    trained on the rows with part < k and part != m. A part without training
    rows has a root without a split that predicts 0.
    """
    cuts = split_candidates(data, features, k, max_bins)
    trees = [Tree(kind, m) for kind in kinds for m in range(k + 1)]
    open_ = [[1] for _ in trees]
    slim, tasks = data.select("label", "part", *features), partitions(data)
    for depth in range(max_depth + 1):
        shape = (sum(map(len, open_)), len(features), max_bins, 2)
        fn = _histogram_fn(trees, open_, depth, features, k, cuts, max_bins)
        hist = sum_arrays(slim, fn, int(np.prod(shape)), tasks).reshape(shape)
        at, following = 0, []
        for tree, nodes in zip(trees, open_, strict=True):
            children: list[int] = []
            for node in nodes:
                zero, one = hist[at, 0].sum(axis=0)
                tree.majority[node] = float(one > zero)
                split = best_split(tree.impurity, hist[at], cuts[tree.part]) if depth < max_depth else None
                if split is not None:
                    tree.split[node] = split
                    children += [2 * node, 2 * node + 1]
                at += 1
            following.append(children)
        open_ = following
        if not any(open_):
            break
    return trees


# ---------------------------------------------------------------- scoring


def as_expression(tree: Tree, features: list[str], max_depth: int) -> Column:
    """Prediction of the tree cut at ``max_depth``, as nested conditions on the
    feature columns."""
    def walk(node: int) -> Column:
        if node not in tree.split or node >= 1 << max_depth:
            return F.lit(tree.majority[node])
        f, cut = tree.split[node]
        return F.when(F.col(features[f]) <= cut, walk(2 * node)).otherwise(walk(2 * node + 1))

    return walk(1)


def cross_validate(data: DataFrame, grid: list[dict], features: list[str], k: int) -> DataFrame:
    """Predictions (grid_index, part, label, prediction) of every grid
    point trained on the training rows outside each part (parts 0..k).

    Grid points of the same ``max_bins`` grow together; every row is scored
    once, by all models of its part."""
    grown: dict[tuple[str, int, int], Tree] = {}
    for bins in sorted({int(g["max_bins"]) for g in grid}):
        points = [g for g in grid if int(g["max_bins"]) == bins]
        kinds = sorted({g["impurity"] for g in points})
        depth = max(int(g["max_depth"]) for g in points)
        for tree in grow(data, kinds, features, k, depth, bins):
            grown[tree.impurity, bins, tree.part] = tree
    scores = []
    for g in grid:
        by_part = F.lit(None).cast("double")
        for m in range(k + 1):
            tree = grown[g["impurity"], int(g["max_bins"]), m]
            by_part = F.when(F.col("part") == m, as_expression(tree, features, int(g["max_depth"]))).otherwise(by_part)
        scores.append(F.struct(F.lit(g["grid_index"]).alias("grid_index"), by_part.alias("prediction")))
    return (data.select("part", "label", F.explode(F.array(*scores)).alias("s"))
            .select("s.grid_index", "part", "label", "s.prediction"))
