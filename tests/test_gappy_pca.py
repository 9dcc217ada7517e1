"""Principal components of rows with gaps against numpy."""

import numpy as np
import pytest

from txnlens.operators import drift as D, gappy_pca as G

COLUMNS = ["a", "b", "c"]


def frame(spark, x):
    rows = [tuple(None if np.isnan(v) else float(v) for v in r) for r in x]
    return spark.createDataFrame(rows, "a double, b double, c double").repartition(3)


def made(rng, n, holes):
    z = rng.normal(0, 1, (n, 1))
    x = z @ np.array([[1.0, 0.8, -0.5]]) + rng.normal(0, 0.4, (n, 3))
    x[rng.random((n, 3)) < holes] = np.nan
    return x


def em_row_by_row(x, iterations=400):
    mean, cov = np.nanmean(x, axis=0), np.diag(np.nanvar(x, axis=0))
    x = x[~np.isnan(x).all(axis=1)]
    for _ in range(iterations):
        filled, extra = x.copy(), np.zeros((3, 3))
        for r in filled:
            m = np.isnan(r)
            if m.any():
                s = np.linalg.solve(cov[np.ix_(~m, ~m)], cov[np.ix_(~m, m)])
                r[m] = mean[m] + (r[~m] - mean[~m]) @ s
                extra[np.ix_(m, m)] += cov[np.ix_(m, m)] - cov[np.ix_(m, ~m)] @ s
        mean = filled.mean(axis=0)
        cov = ((filled - mean).T @ (filled - mean) + extra) / len(x)
    return mean, cov


def test_complete_rows_give_the_usual_components(spark):
    x = made(np.random.default_rng(1), 300, 0.0)
    data = G.pattern_moments(frame(spark, x), COLUMNS)
    mean, cov = G.fit_covariance(data)
    assert np.allclose(mean, x.mean(axis=0)) and np.allclose(cov, np.cov(x.T, bias=True))
    assert (data.rows, data.gaps) == (300, 0)
    assert np.allclose(G.components(cov, 2), D.pca_loadings(frame(spark, x), COLUMNS, 2))


def test_gaps_agree_with_row_by_row_iterations(spark):
    x = made(np.random.default_rng(2), 400, 0.25)
    x[0] = np.nan
    df = frame(spark, x)
    data = G.pattern_moments(df, COLUMNS)
    assert (data.rows, data.gaps) == (400, int(np.isnan(x).any(axis=1).sum()))
    mean, cov = G.fit_covariance(data)
    want_mean, want_cov = em_row_by_row(x)
    assert np.allclose(mean, want_mean, atol=1e-7) and np.allclose(cov, want_cov, atol=1e-7)
    # the direction is that of the whole table, which dropping rows would only know from 40 % of them
    loadings = G.components(cov, 2)
    assert abs(np.dot(loadings[0], np.array([1.0, 0.8, -0.5]) / np.linalg.norm([1.0, 0.8, -0.5]))) > 0.99
    scores = G.project_expected(df, COLUMNS, loadings, mean, cov, data.present).collect()
    got = sorted((r["PC1"], r["PC2"]) for r in scores)
    filled = x.copy()
    for r in filled:
        m = np.isnan(r)
        if m.any():
            turn = np.linalg.solve(cov[np.ix_(~m, ~m)], cov[np.ix_(~m, m)]) if not m.all() else np.zeros((0, 3))
            r[m] = mean[m] + (r[~m] - mean[~m]) @ turn
    assert np.allclose(got, sorted(map(tuple, filled @ np.array(loadings).T)), atol=1e-9)


def test_drift_report_counts_gaps(spark):
    rng = np.random.default_rng(3)
    ref, ana = frame(spark, made(rng, 500, 0.1)), frame(spark, made(rng, 400, 0.0) + 3)
    rows = D.pca_psi(ref, ana, COLUMNS, bins=10).collect()
    assert {r["component"] for r in rows} == {"PC1", "PC2"} and all(r["ref_gaps"] > 0 and r["ana_gaps"] == 0 for r in rows)
    assert max(r["psi_score"] for r in rows) > 0.25
    same = D.pca_psi(ref, ref, COLUMNS, bins=10).collect()
    assert [r["psi_score"] for r in same] == pytest.approx([0.0, 0.0], abs=1e-9)
