"""Shapley values of tree scores against their definition."""

import itertools
import math

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from txnlens.operators import attribution as A, modelling as M

COLUMNS = ["a", "b", "c", "d"]


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(5)
    x = rng.integers(0, 6, (300, 4)).astype(float)
    y = ((x[:, 0] > 2) & (x[:, 1] < 4) | (x[:, 2] + rng.normal(0, 1, 300) > 4)).astype(int)
    return spark.createDataFrame([(i, *map(float, r), int(t)) for i, (r, t) in enumerate(zip(x, y))],
                                 "id int, a double, b double, c double, d double, is_fraud int")


def expected(tree, at, x, known):
    """The score if only the known features are; the others follow the training rows."""
    r = tree[at]
    if r["left_child"] < 0:
        return r["value"] * r["weight"]
    left, right = (expected(tree, r[c], x, known) for c in ("left_child", "right_child"))
    if r["feature"] in known:
        return left if x[r["feature"]] <= r["threshold"] else right
    return (left * tree[r["left_child"]]["cover"] + right * tree[r["right_child"]]["cover"]) / r["cover"]


def by_definition(trees, x, n):
    out = np.zeros(n)
    f = lambda s: sum(expected(t, 0, x, s) for t in trees)
    for i in range(n):
        others = [j for j in range(n) if j != i]
        for size in range(n):
            for s in itertools.combinations(others, size):
                w = math.factorial(size) * math.factorial(n - size - 1) / math.factorial(n)
                out[i] += w * (f({*s, i}) - f(set(s)))
    return out


@pytest.mark.parametrize("name,params,scale", [
    ("DecisionTreeClassifier", {"max_depth": 4}, 1.0), ("RandomForestClassifier", {"n_estimators": 3, "max_depth": 4}, 1 / 3),
    ("GradientBoostingClassifier", {"n_estimators": 3, "max_depth": 3}, 1.0)])
def test_equals_the_definition_and_sums_to_the_score(spark, rows, name, params, scale):
    model = M.fit_model(rows, COLUMNS, name, params)
    trees = {}
    for r in A.node_table(model.stages[-1], spark).collect():
        trees.setdefault(r["tree"], {})[r["node"]] = r
    got = {r["id"]: r for r in A.explain_rows(rows, model, "id").collect()}
    scored = model.transform(rows)
    margin = vector_to_array("rawPrediction")[1] if name.startswith("Grad") else vector_to_array("probability")[1]
    for r in scored.select("id", *COLUMNS, margin.alias("s")).collect():
        own = got[r["id"]]
        assert own["base"] + sum(own["contributions"]) == pytest.approx(r["s"], abs=1e-9)
        if r["id"] < 25:
            want = by_definition(list(trees.values()), [r[c] for c in COLUMNS], 4) * scale
            assert np.allclose(own["contributions"], want, atol=1e-9)
    table = {r["feature"]: r["mean_abs"] for r in A.attribution(rows, model).collect()}
    mean = np.abs([got[i]["contributions"] for i in got]).mean(axis=0)
    assert [table[c] for c in COLUMNS] == pytest.approx(list(mean))


def test_linear_models_and_single_leaves(spark, rows):
    model = M.fit_model(rows, COLUMNS, "LogisticRegression")
    assert {r["feature"] for r in A.attribution(rows, model).collect()} == set(COLUMNS)
    leaf = M.fit_model(rows.withColumn("a", F.lit(1.0)), ["a"], "DecisionTreeClassifier")
    got = A.explain_rows(rows.withColumn("a", F.lit(1.0)), leaf, "id").collect()
    assert {tuple(r["contributions"]) for r in got} == {(0.0,)}
    with pytest.raises(ValueError, match="no tree attribution"):
        A.explain_rows(rows, model)


@pytest.mark.parametrize("depth", [1, 5, 8])
def test_listed_patterns_give_the_values_of_single_rows(monkeypatch, depth):
    rng = np.random.default_rng(depth)
    feature = np.array([rng.permutation(12)[:depth] for _ in range(70)])
    low = rng.normal(-0.5, 0.5, feature.shape)
    paths = [A.Paths(feature, low, low + rng.uniform(0.5, 2, feature.shape), rng.uniform(0, 1, feature.shape),
                               rng.normal(size=70))]
    x = rng.normal(size=(700, 12))
    calls, parts = [], A._parts
    monkeypatch.setattr(A, "_parts", lambda inside, *a: calls.append(len(inside)) or parts(inside, *a))
    many = A.shapley(x, paths, 12)
    assert set(calls) == {1 << depth}  # each pattern once, however many rows
    assert np.array_equal(many, np.concatenate([A.shapley(x[i:i + 1], paths, 12) for i in range(700)]))
