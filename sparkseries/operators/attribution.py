"""Shapley values of tree ensembles, from the arrays of their trees.

Path-dependent: an absent feature follows both branches of its splits, weighted by the training
rows that took them. A leaf of value v whose path asks m different features gives feature f

    v * (o_f - z_f) * sum over sets S of the other ones of |S|! (m - |S| - 1)! / m! * prod(o in S) * prod(z not in S)

with o = 1 if the row passes all of the path's splits on a feature, else 0, and z the share of
the training rows that pass them. The sums over sets of one size are the coefficients of a product of
m - 1 linear terms, so a leaf costs m products per feature, for a whole Arrow batch at a time.

The trees are shipped to the tasks: their size is that of the model, not of the data. A missing
value (null or NaN) fails every `x <= threshold`, as in the models' own prediction.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class Leaf(NamedTuple):
    """A leaf's value (with its tree's weight) and, per feature on its path, the half-open interval
    low < x <= high and the share of the training rows that pass its splits."""

    value: float
    feature: np.ndarray
    low: np.ndarray
    high: np.ndarray
    share: np.ndarray


class Tree(NamedTuple):
    """Arrays of a binary tree: feature is -1 in a leaf; rows with x <= threshold go left."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    cover: np.ndarray


def model_trees(model: PipelineModel) -> tuple[list[Tree], list[float]]:
    """Trees and weights of a fitted pipeline whose last stage (or its best model) has trees."""
    stage = model.stages[-1]
    stage = getattr(stage, "bestModel", stage)
    return [_arrays(t._call_java("rootNode")) for t in stage.trees], [float(w) for w in stage.treeWeights]


def _arrays(root) -> Tree:
    rows: list[list[float]] = []
    waiting = [(root, None, 0)]
    while waiting:
        node, parent, side = waiting.pop()
        at = len(rows)
        if parent is not None:
            rows[parent][2 + side] = at
        leaf = node.getClass().getSimpleName() == "LeafNode"
        cover = float(node.impurityStats().count())
        if leaf:
            rows.append([-1, 0.0, -1, -1, float(node.prediction()), cover])
            continue
        split = node.split()
        rows.append([split.featureIndex(), float(split.threshold()), -1, -1, float(node.prediction()), cover])
        waiting += [(node.leftChild(), at, 0), (node.rightChild(), at, 1)]
    feature, threshold, left, right, value, cover = (np.array(c) for c in zip(*rows))
    return Tree(feature.astype(int), threshold, left.astype(int), right.astype(int), value, cover)


def leaves(tree: Tree, weight: float = 1.0) -> list[Leaf]:
    out = []
    waiting = [(0, {})]  # feature -> (low, high, share)
    while waiting:
        at, path = waiting.pop()
        f = int(tree.feature[at])
        if f < 0:
            known = sorted(path)
            out.append(Leaf(weight * float(tree.value[at]), np.array(known, int), *(np.array([path[k][i] for k in known], float) for i in range(3))))
            continue
        low, high, share = path.get(f, (-math.inf, math.inf, 1.0))
        t = float(tree.threshold[at])
        for child, bounds in ((int(tree.left[at]), (low, min(high, t))), (int(tree.right[at]), (max(low, t), high))):
            ratio = float(tree.cover[child] / tree.cover[at]) if tree.cover[at] else 0.0
            waiting.append((child, {**path, f: (*bounds, share * ratio)}))
    return out


def base_value(found: Sequence[Leaf]) -> float:
    """The prediction with all features absent."""
    return float(sum(leaf.value * leaf.share.prod() for leaf in found))


def passes(leaf: Leaf, x: np.ndarray) -> np.ndarray:
    """Rows x path features: whether the row passes the path's splits on the feature."""
    v = x[:, leaf.feature]
    above = ~(v <= leaf.low) | np.isneginf(leaf.low)  # missing values go right
    return above & ((v <= leaf.high) | np.isposinf(leaf.high))


def shapley_values(found: Sequence[Leaf], x: np.ndarray) -> np.ndarray:
    """Rows x features contributions."""
    out = np.zeros(x.shape)
    weights: dict[int, np.ndarray] = {}
    for leaf in found:
        m = len(leaf.feature)
        if not m:
            continue
        if m not in weights:
            weights[m] = np.array([math.factorial(s) * math.factorial(m - s - 1) / math.factorial(m) for s in range(m)])
        o = passes(leaf, x).astype(float)
        for f in range(m):
            sums = np.zeros((len(x), m))  # by size of the set
            sums[:, 0] = 1.0
            for size, j in enumerate((j for j in range(m) if j != f), 1):
                sums[:, 1 : size + 1] = sums[:, 1 : size + 1] * leaf.share[j] + sums[:, :size] * o[:, j : j + 1]
                sums[:, 0] *= leaf.share[j]
            out[:, leaf.feature[f]] += leaf.value * (o[:, f] - leaf.share[f]) * (sums @ weights[m])
    return out


def tree_contributions(df: DataFrame, model: PipelineModel, features: Sequence[str]) -> DataFrame:
    """All rows and columns of `df` plus `base` and one `<feature>_contribution` per feature; base plus
    contributions is the model's prediction. `features` in the order of the model's vector."""
    trees, weights = model_trees(model)
    found = [leaf for tree, weight in zip(trees, weights) for leaf in leaves(tree, weight)]
    base = base_value(found)
    added = [f"{f}_contribution" for f in features]
    rest = [c for c in df.columns if c not in (*added, "base")]
    values = [f"_v{i}" for i in range(len(features))]
    rows = df.select(*rest, *[F.col(f).cast("double").alias(v) for f, v in zip(features, values)])

    def explain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                x = np.stack([c.to_numpy(zero_copy_only=False).astype(float) for c in part.columns[len(rest):]], axis=1)
                parts = shapley_values(found, x)
                arrays = [*part.columns[: len(rest)], pa.array(np.full(part.num_rows, base)), *(pa.array(c) for c in parts.T)]
                yield pa.RecordBatch.from_arrays(arrays, [*rest, "base", *added])

    schema = df.select(*rest, F.lit(0.0).alias("base"), *[F.lit(0.0).alias(c) for c in added]).schema
    return rows.mapInArrow(explain, schema)
