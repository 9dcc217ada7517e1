"""Exact distribution operators against numpy, in one and in many value ranges."""

from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from txnlens.operators import distribution as D


@pytest.fixture(scope="module")
def sample(spark):
    rng = np.random.default_rng(7)
    a = np.round(rng.lognormal(3, 1, 900), 2)
    a[:300] = 20.0  # one value holds a third of the rows
    b = rng.integers(0, 12, 900).astype(float)
    rows = [(float(x), float(y) if i % 10 else None) for i, (x, y) in enumerate(zip(a, b))]
    return spark.createDataFrame(rows, "a double, b double"), a, np.array([r[1] for r in rows if r[1] is not None])


@pytest.mark.parametrize("rows_per_range", [1_000_000, 40])
def test_quantiles_are_numpy_percentiles(sample, rows_per_range):
    df, a, b = sample
    grid = [(i, n) for n in (7, 50) for i in range(n + 1)]
    counts = D.numeric_counts({"n": df}, ["a", "b"])
    found = {(r["feature"], r["num"], r["den"]): r["value"]
             for r in D.quantiles(counts, "n", grid, rows_per_range).collect()}
    assert len(found) == 2 * len(grid)
    for name, values in (("a", a), ("b", b)):
        for num, den in grid:
            assert found[name, num, den] == pytest.approx(np.percentile(values, 100 * num / den), abs=1e-9)


@pytest.mark.parametrize("rows_per_range", [1_000_000, 25])
def test_counts_at_points(spark, sample, rows_per_range):
    df, a, _ = sample
    points = [-1.0, 20.0, 20.005, float(a.max()), 1e9]
    counts = D.numeric_counts({"n": df.select("a")}, ["a"])
    frame = spark.createDataFrame([("a", p) for p in points], "feature string, value double")
    found = {r["value"]: (r["n_lt"], r["n_le"]) for r in D.counts_at(counts, frame, ["n"], rows_per_range).collect()}
    assert found == {p: (int((a < p).sum()), int((a <= p).sum())) for p in points}


@pytest.mark.parametrize("rows_per_range", [1_000_000, 30])
def test_running_counts_and_next_value(sample, rows_per_range):
    df, a, _ = sample
    counts = D.numeric_counts({"n": df.select("a")}, ["a"])
    rows = D.running_counts(counts, ["n"], rows_per_range).orderBy("value").collect()
    values, n = np.unique(a, return_counts=True)
    assert [r["value"] for r in rows] == list(values)
    assert [r["n_to"] for r in rows] == list(np.cumsum(n))
    assert [r["next_value"] for r in rows] == [*values[1:], None]


def test_nulls_and_nan_are_missing(spark):
    df = spark.createDataFrame([(1.0,), (None,), (float("nan"),), (3.0,)], "x double")
    assert D.numeric_counts({"n": df}, ["x"]).agg(F.sum("n")).first()[0] == 2
    rows = {r["prob"]: r["value"] for r in D.column_quantiles(df, ["x"], [0.0, 0.5, 1.0]).collect()}
    assert rows == {0.0: 1.0, 0.5: 2.0, 1.0: 3.0}


def test_empty_column_has_no_quantiles(spark):
    df = spark.createDataFrame([(None,)], "x double")
    assert D.column_quantiles(df, ["x"], [0.5]).count() == 0


def test_single_value(spark):
    df = spark.createDataFrame([(4.0,)], "x double")
    assert [r["value"] for r in D.column_quantiles(df, ["x"], [0.25, 0.99]).collect()] == [4.0, 4.0]
    assert Fraction(str(0.99)) == Fraction(99, 100)


@pytest.mark.parametrize("accuracy, slack", [(10_000, 2.0), (20, 2.0), (20, 0.0)])
def test_bracketed_quantiles_are_exact(sample, accuracy, slack):
    """Also with a sketch too coarse to be right, where the values fall outside the brackets."""
    df, a, b = sample
    grid = [(i, 50) for i in range(51)] + [(i, 7) for i in range(8)]
    found = D.wide_quantiles(df, ["a", "b"], grid, accuracy, slack)
    got = {(r["feature"], r["num"], r["den"]): r["value"] for r in found.collect()}
    assert len(got) == 2 * len(grid)
    for name, values in (("a", a), ("b", b)):
        for num, den in grid:
            assert got[name, num, den] == pytest.approx(np.percentile(values, 100 * num / den), abs=1e-9)


def test_few_and_many_values_give_the_same_quantiles(sample):
    df, _, _ = sample
    rows = lambda many: sorted(map(tuple, D.column_quantiles(df, ["a", "b"], [0.1, 0.5, 0.99], many).collect()))
    assert rows(10**9) == rows(0) == rows(100)


def test_scanned_counts_at_points(sample):
    df, a, _ = sample
    points = [-1.0, 20.0, 20.005, float(a.max()), 1e9]
    found = {r["value"]: (r["n_lt"], r["n_le"]) for r in D.scan_counts_at({"n": df}, {"a": points}).collect()}
    assert found == {p: (int((a < p).sum()), int((a <= p).sum())) for p in points}


def test_both_ways_agree_on_infinities_and_nan(spark):
    from txnlens.operators import distribution as D
    from txnlens.operators.profiling import describe_table, null_rates
    from txnlens.operators.selection import anova_f, correlation_matrix

    inf = float("inf")
    values = [-inf, -inf, -1.5, -0.0, 0.0, 0.0, 2.0, 3.5, 7.0, inf, inf, inf, float("nan"), None]
    df = spark.createDataFrame([(x,) for x in values], "x double")
    probabilities = [0.0, 0.5, 0.9, 1.0]
    told = [{r["prob"]: r["value"] for r in D.column_quantiles(df, ["x"], probabilities, many_values=n).collect()}
            for n in (0, 10**6)]
    assert told[0] == told[1] and told[0][1.0] == inf and told[0][0.0] == -inf
    points = {"x": [-inf, -0.0, 1.0, 3.5, inf]}
    frame = spark.createDataFrame([("x", p) for p in points["x"]], "feature string, value double")
    slow = D.counts_at(D.numeric_counts({"n": df}, ["x"]), frame, ["n"])
    both = [{r["value"]: (r["n_lt"], r["n_le"]) for r in t.collect()} for t in (slow, D.scan_counts_at({"n": df}, points))]
    assert both[0] == both[1] == {-inf: (0, 2), 0.0: (3, 6), 1.0: (6, 6), 3.5: (7, 8), inf: (9, 12)}

    gaps = spark.createDataFrame([(1.0, 2.0, 0), (2.0, 4.5, 0), (4.0, 7.0, 1), (float("nan"), 1.0, 1), (3.0, 5.0, 1)],
                                 "a double, b double, is_fraud int")
    clean = gaps.withColumn("a", D.number("a"))
    for f in (lambda d: describe_table(d, ["a", "b"]), lambda d: null_rates(d, ["a"]),
              lambda d: correlation_matrix(d, ["a", "b"]), lambda d: anova_f(d, ["a", "b"])):
        assert sorted(map(str, f(gaps).collect())) == sorted(map(str, f(clean).collect()))
    assert null_rates(gaps, ["a"]).first()["n_null"] == 1
