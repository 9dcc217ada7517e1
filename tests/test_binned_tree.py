"""One binned decision tree for all depths against plain recursion, and in the search."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from txnlens.operators import binned_forest, binned_tree as B, modelling as M

COLUMNS = ["a", "b", "c"]


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(7)
    x = rng.integers(0, 9, (900, 3)).astype(float)
    y = ((x[:, 0] > 4) ^ (x[:, 1] > 5) ^ (rng.random(900) < 0.2)).astype(int) & (x[:, 2] < 7)
    df = spark.createDataFrame([(int(t), *map(float, r)) for t, r in zip(y, x)], "is_fraud int, a double, b double, c double")
    return df.repartition(3).cache(), x, y


def plain(x, y, weights, least, depth):
    """Nested (feature, threshold, left, right), or the shares of the weighted classes."""
    counts = np.bincount(y, minlength=2)
    leaf = counts * weights / (counts * weights).sum()
    if depth == 0 or np.count_nonzero(counts) < 2:
        return leaf
    kept = lambda c: ((c * weights) ** 2).sum() / (c * weights).sum()
    best = (1e-14, None)
    for f in range(x.shape[1]):
        for t in np.unique(x[:, f])[:-1]:
            left = x[:, f] <= t
            if min(left.sum(), (~left).sum()) < least:
                continue
            gain = (kept(np.bincount(y[left], minlength=2)) + kept(np.bincount(y[~left], minlength=2)) - kept(counts)) / (counts * weights).sum()
            if gain > best[0] * (1 + 1e-9):
                best = (gain, (f, t, left))
    if best[1] is None:
        return leaf
    f, t, left = best[1]
    return f, t, *(plain(x[s], y[s], weights, least, depth - 1) for s in (left, ~left))


def same(table, at, want):
    if not isinstance(want, tuple):
        assert table.feature[at] == -1 and np.allclose(table.value[at], want)
        return
    assert (table.feature[at], table.threshold[at]) == want[:2]
    same(table, table.children[at, 0], want[2])
    same(table, table.children[at, 1], want[3])


@pytest.mark.parametrize("task_rows,least", [(10_000, 1), (200, 1), (60, 4)])
def test_trees_of_all_depths_equal_plain_recursion(spark, rows, monkeypatch, task_rows, least):
    df, x, y = rows
    monkeypatch.setattr(B, "TASK_ROWS", task_rows)
    data = binned_forest.bin_rows(df.select(F.col("is_fraud").cast("double").alias("y"), F.array(*COLUMNS).alias("x")), 3, 2)
    weights = len(y) / (2 * np.bincount(y))
    tree, depths = B.grow_tree(data, weights, least, 8)
    assert depths.max() > 4
    for depth in (0, 1, 3, 8):
        same(B.upper_part(tree, depths, depth), 0, plain(x, y, weights, least, depth))


def test_search_grows_one_tree_for_each_leaf_size(spark, rows, monkeypatch):
    df, *_ = rows
    train, val = df.where("(a + 2 * b + c) % 5 > 0"), df.where("(a + b) % 3 > 0")
    kept = M.tune_model(train, val, COLUMNS, "DecisionTreeClassifier", 12)
    grown, grow = [], B.grow_tree
    monkeypatch.setattr(B, "grow_tree", lambda data, weights, least, depth: grown.append(least) or grow(data, weights, least, depth))
    monkeypatch.setattr(M, "TREE_ROWS", 1)
    found = M.tune_model(train, val, COLUMNS, "DecisionTreeClassifier", 12)
    assert len(grown) == len(set(grown)) <= 5 and len(found) == 12
    assert found[0].train == pytest.approx(kept[0].train, abs=0.02) and found[0].test["macro_f1"] >= kept[0].test["macro_f1"] - 0.02
    assert found[0].test == pytest.approx(M.evaluate(found[0].model, val))
    spark_model = M.fit_model(train, COLUMNS, "DecisionTreeClassifier", found[0].params, balanced=True)
    assert M.evaluate(spark_model, val)["macro_f1"] == pytest.approx(found[0].test["macro_f1"], abs=0.03)
    held = M.tune_model(train, val, COLUMNS, "DecisionTreeClassifier", 3, hold_best=True)[0]
    assert held.test == pytest.approx(M.evaluate(held.model, val))
