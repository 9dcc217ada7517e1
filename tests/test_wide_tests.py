"""Two-sample tests of wide columns against the value counts."""

import numpy as np
import pytest

from txnlens.operators import drift as D
from txnlens.operators.wide_tests import wide_two_sample


def frame(spark, rng, n, shift, scale):
    gap = rng.random(n) < 0.05
    rows = [(float(rng.normal(shift, scale)), None if g else float(rng.integers(0, 5) + shift), float(rng.random()),
             float("nan") if g else float(rng.exponential())) for g in gap]
    return spark.createDataFrame(rows, "moved double, few double, same double, holes double").repartition(3)


@pytest.mark.parametrize("points", [4, 50])
@pytest.mark.parametrize("shift,scale", [(0.0, 1.0), (0.3, 1.0), (0.0, 2.0), (50.0, 1.0)])
def test_same_as_from_value_counts(spark, points, shift, scale):
    rng = np.random.default_rng(4)
    ref, ana = frame(spark, rng, 700, 0.0, 1.0), frame(spark, rng, 500, shift, scale)
    columns = ["moved", "few", "same", "holes"]
    counts = D.sample_counts(ref, ana, columns)
    ks = {r["feature"]: r for r in D.ks_two_sample(counts).collect()}
    ws = {r["feature"]: r for r in D.wasserstein_normed(counts).collect()}
    got = {r["feature"]: r for r in wide_two_sample(ref, ana, columns, points).collect()}
    assert set(got) == set(columns)
    for c in columns:
        assert got[c]["ks_stat"] == pytest.approx(ks[c]["ks_stat"], abs=1e-12)
        assert got[c]["area"] / max(got[c]["std"], 0.001) == pytest.approx(ws[c]["distance"], rel=1e-9, abs=1e-12)


def test_both_ways_give_one_report(spark):
    rng = np.random.default_rng(6)
    ref, ana = frame(spark, rng, 1200, 0.0, 1.0), frame(spark, rng, 400, 0.5, 1.0)
    columns = ["moved", "few", "same", "holes"]
    plain = {r["feature"]: r for r in D.two_sample_tests(ref, ana, columns).collect()}
    wide = {r["feature"]: r for r in D.two_sample_tests(ref, ana, columns, many_values=100).collect()}
    assert set(plain) == set(wide) == set(columns)
    for c in columns:
        assert (plain[c]["method"], plain[c]["drifted"]) == (wide[c]["method"], wide[c]["drifted"])
        assert plain[c]["score"] == pytest.approx(wide[c]["score"], rel=1e-9)
