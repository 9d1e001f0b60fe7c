"""Shapley values of trees against their definition over all sets of features."""

import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkseries.operators import attribution as A
from sparkseries.operators import ensemble, models


def random_tree(rng, depth, n_features):
    """A tree with its cover from random shares; a feature may be asked several times on a path."""
    rows = []

    def grow(level, cover):
        at = len(rows)
        rows.append(None)
        if level == depth or rng.random() < 0.15 and level:
            rows[at] = (-1, 0.0, -1, -1, rng.normal(), cover)
            return at
        left = grow(level + 1, cover * (share := rng.uniform(0.1, 0.9)))
        right = grow(level + 1, cover * (1 - share))
        rows[at] = (int(rng.integers(n_features)), rng.normal(), left, right, 0.0, cover)
        return at

    grow(0, 1000.0)
    return A.Tree(*(np.array(c) for c in zip(*rows)))


def expectation(tree, x, known, at=0):
    """The prediction of a tree when only the features in `known` are known."""
    f = int(tree.feature[at])
    if f < 0:
        return tree.value[at]
    left, right = int(tree.left[at]), int(tree.right[at])
    if f in known:
        return expectation(tree, x, known, left if x[f] <= tree.threshold[at] else right)
    return sum(tree.cover[c] / tree.cover[at] * expectation(tree, x, known, c) for c in (left, right))


def by_definition(trees, weights, x):
    n = len(x)
    value = {s: sum(w * expectation(t, x, set(s)) for t, w in zip(trees, weights)) for r in range(n + 1) for s in itertools.combinations(range(n), r)}
    out = np.zeros(n)
    for f in range(n):
        for s in value:
            if f not in s:
                weight = math.factorial(len(s)) * math.factorial(n - len(s) - 1) / math.factorial(n)
                out[f] += weight * (value[tuple(sorted((*s, f)))] - value[s])
    return out, value[()]


@pytest.mark.parametrize("depth", [1, 3, 6])
def test_shapley_values_equal_their_definition(depth):
    rng = np.random.default_rng(depth)
    trees, weights = [random_tree(rng, depth, 5) for _ in range(4)], [1.0, 0.1, 0.5, -2.0]
    found = [leaf for t, w in zip(trees, weights) for leaf in A.leaves(t, w)]
    x = rng.normal(size=(12, 5))
    x[3, 1] = x[7, 4] = np.nan
    x[5] = trees[0].threshold[0]  # on a threshold
    got = A.shapley_values(found, x)
    for row, parts in zip(x, got):
        want, base = by_definition(trees, weights, row)
        assert np.allclose(parts, want, atol=1e-9) and A.base_value(found) == pytest.approx(base)


def test_contributions_add_up_to_the_prediction(spark):
    names = ["a", "b", "c"]
    rng = np.random.default_rng(3)
    rows = [(int(i % 3), float(v[0]), float(v[1]), float(v[2]), float(2 * v[0] - v[1] * (v[2] > 0)), "old") for i, v in enumerate(rng.normal(size=(400, 3)))]
    df = spark.createDataFrame(rows, "key int, a double, b double, c double, y double, base string").repartition(3)
    model = ensemble.fit_trees(df, names, "y", max_depth=4, n_trees=6)
    out = A.tree_contributions(model.transform(df).drop("features"), model, names)
    worst = out.select(F.max(F.abs(F.col("base") + sum(F.col(f"{n}_contribution") for n in names) - F.col("prediction")))).first()[0]
    assert worst < 1e-9 and out.count() == 400
    mean = {r.feature: r.mean_abs_contribution for r in models.mean_attribution(out, ["key"], names).where("key = 0").collect()}
    assert mean["a"] > mean["b"] > 0
    assert A.tree_contributions(df.limit(0), model, names).count() == 0


def test_missing_values_go_where_the_model_sends_them():
    """A missing value fails x <= threshold, in prediction and attribution."""
    rng = np.random.default_rng(8)
    tree = random_tree(rng, 4, 3)
    found = A.leaves(tree)
    x = np.array([[np.nan, 0.3, np.nan], [np.nan] * 3])
    total = A.shapley_values(found, x).sum(axis=1) + A.base_value(found)
    assert np.allclose(total, [expectation(tree, row, {0, 1, 2}) for row in x])
