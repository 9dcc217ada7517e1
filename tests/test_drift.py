import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from txnlens.operators import drift as D
from txnlens.operators.encoding import category_counts, shares_of
from txnlens.operators.rowindex import with_row_index
from txnlens.plans import drift_watch


def brute_psi(ref, ana, b, edges="quantiles"):
    if edges == "quantiles":
        e = np.percentile(ref, np.arange(b + 1) / b * 100)
    else:
        e = np.linspace(ref.min(), ref.max(), b + 1)
    pe = np.maximum(np.histogram(ref, e)[0] / len(ref), 1e-4)
    pa = np.maximum(np.histogram(ana, e)[0] / len(ana), 1e-4)
    return float(((pe - pa) * np.log(pe / pa)).sum())


@pytest.fixture(scope="module")
def samples(spark):
    rng = np.random.default_rng(3)
    ref = {"amt": rng.normal(100, 10, 800), "lat": rng.uniform(25, 49, 800).round(0)}
    ana = {"amt": rng.normal(104, 12, 500), "lat": rng.uniform(20, 49, 500).round(0)}
    frame = lambda s: spark.createDataFrame(list(zip(s["amt"].tolist(), s["lat"].tolist())), "amt double, lat double")
    return ref, ana, frame(ref), frame(ana)


@pytest.mark.parametrize("edges", ["quantiles", "width"])
def test_psi_matches_numpy(samples, edges):
    ref, ana, r, a = samples
    got = {(x["feature"], x["bins"]): x["psi"] for x in D.psi_sweep(r, a, ["amt", "lat"], [5, 10, 50], edges).collect()}
    # the rounded column has values on the bin edges, where the two edge formulas may differ in the last digit
    for b in (5, 10, 50):
        assert got["amt", b] == pytest.approx(brute_psi(ref["amt"], ana["amt"], b, edges), abs=1e-9)
    assert len(got) == 6


@pytest.mark.parametrize("edges", ["quantiles", "width"])
def test_scanned_psi_equals_counted_psi(samples, edges):
    _, _, r, a = samples
    rows = lambda many: {(x["feature"], x["bins"]): x["psi"] for x in
                         D.psi_sweep(r, a, ["amt", "lat"], [5, 20, 50], edges, many_values=many).collect()}
    counted, scanned, mixed = rows(10**9), rows(0), rows(100)
    assert len(counted) == 6
    assert scanned == pytest.approx(counted, abs=1e-12) and mixed == pytest.approx(counted, abs=1e-12)


def test_psi_of_a_sample_with_itself_is_zero(samples):
    _, _, r, _ = samples
    assert all(abs(x["psi_score"]) < 1e-12 for x in D.psi(r, r, ["amt", "lat"]).collect())


def test_psi_with_repeated_edges(spark):
    ref, ana = np.array([1.0] * 60 + [2.0] * 30 + [9.0] * 10), np.array([1.0] * 20 + [2.0] * 60 + [9.0] * 10 + [50.0] * 10)
    frame = lambda v: spark.createDataFrame([(float(x),) for x in v], "x double")
    got = D.psi(frame(ref), frame(ana), ["x"], 10).first()["psi_score"]
    assert got == pytest.approx(brute_psi(ref, ana, 10), abs=1e-9)


def kneedle(x, y, s=1.0):
    """Plain transcription of the published steps for a concave decreasing curve."""
    n = len(x)
    xs, ys = (x - x.min()) / (x.max() - x.min()), (y - y.min()) / (y.max() - y.min())
    d = ys[::-1] - xs
    peaks = [i for i in range(n) if d[i] >= d[max(i - 1, 0)] and d[i] >= d[min(i + 1, n - 1)]]
    lows = [i for i in range(n) if d[i] <= d[max(i - 1, 0)] and d[i] <= d[min(i + 1, n - 1)]]
    threshold = at = None
    for i in range(n - 1):
        if i in peaks:
            threshold, at = d[i] - s * np.diff(xs).mean(), i
        if i in lows and at is not None:
            threshold = 0.0
        if at is not None and d[i + 1] < threshold:
            return int(x[::-1][at])
    return int(x[y.argmax()])


@pytest.mark.parametrize("seed", range(6))
def test_knee_matches_plain_algorithm(spark, seed):
    rng = np.random.default_rng(seed)
    x = np.arange(5, 51)
    y = 1 / (1 + np.exp((x - 30) / 4)) + rng.normal(0, 0.02 * seed, len(x))
    df = spark.createDataFrame([("f", int(b), float(p)) for b, p in zip(x, y)], "feature string, bins bigint, psi double")
    assert D.knee_bins(df).first()["bins"] == kneedle(x, y)


def test_flat_curve_has_no_knee(spark):
    df = spark.createDataFrame([("f", b, 0.5) for b in range(5, 10)], "feature string, bins bigint, psi double")
    assert D.knee_bins(df).first()["bins"] == 5


def test_ks_and_wasserstein(samples):
    ref, ana, r, a = samples
    counts = D.sample_counts(r, a, ["amt"])
    points = np.sort(np.concatenate([ref["amt"], ana["amt"]]))
    f = lambda v: np.searchsorted(np.sort(v), points, side="right") / len(v)
    gap = np.abs(f(ref["amt"]) - f(ana["amt"]))
    ks = D.ks_two_sample(counts).first()
    assert ks["ks_stat"] == pytest.approx(gap.max())
    lam = math.sqrt(800 * 500 / 1300) * gap.max()
    assert ks["p_value"] == pytest.approx(2 * sum((-1) ** (k - 1) * math.exp(-2 * k * k * lam * lam) for k in range(1, 101)), abs=1e-12)
    ws = D.wasserstein_normed(counts).first()
    assert ws["distance"] == pytest.approx((gap[:-1] * np.diff(points)).sum() / ref["amt"].std())


def test_same_samples_do_not_drift(samples):
    _, _, r, _ = samples
    counts = D.sample_counts(r, r, ["amt", "lat"])
    tests = D.drift_tests(counts)
    assert {x["method"] for x in tests.collect()} == {"ks"}
    assert D.dataset_drift_share(tests).first().asDict() == {"n_columns": 2, "n_drifted": 0, "drift_share": 0.0, "dataset_drift": False}


def brute_js(p, q):
    total = 0.0
    for c in set(p) | set(q):
        a, b = p.get(c, 0.0), q.get(c, 0.0)
        m = (a + b) / 2
        total += (a * math.log2(a / m) if a else 0) / 2 + (b * math.log2(b / m) if b else 0) / 2
    return math.sqrt(max(total, 0.0))


def shares(values):
    return {v: values.count(v) / len(values) for v in set(values)}


def test_js_chunks_against_plain_python(spark):
    rng = np.random.default_rng(1)
    ref = [str(x) for x in rng.choice(list("abcde"), 300)]
    ana = [str(x) for x in rng.choice(list("cdefg"), 257)]
    r = spark.createDataFrame([(v,) for v in ref], "city string")
    a = spark.createDataFrame([(i // 40, f"k{i:04d}", v) for i, v in enumerate(ana)], "datetime int, trans_num string, city string")
    # shuffled input, and many rows with the same leading key
    rows = D.js_categorical_chunks(r, a.orderBy(F.rand(5)), ["city"], 100).orderBy("chunk_index").collect()
    assert [(x["start_index"], x["end_index"]) for x in rows] == [(0, 99), (100, 199), (200, 256)]
    for i, x in enumerate(rows):
        assert x["distance"] == pytest.approx(brute_js(shares(ana[i * 100:(i + 1) * 100]), shares(ref)), abs=1e-9)
        assert x["alert"] == (x["distance"] > 0.25)


def test_js_bounds_and_disjoint(spark):
    parts = spark.createDataFrame([("w", "f", "x", 5), ("v", "f", "y", 5)], "g string, feature string, value string, n bigint")
    ref = shares_of(category_counts(spark.createDataFrame([("y",)], "f string"), ["f"]))
    assert {r["g"]: r["distance"] for r in D.js_distances(parts, ref, ["g"]).collect()} == {"w": 1.0, "v": 0.0}


@pytest.mark.parametrize("partitions", [1, 3, 16])
def test_row_index_is_global(spark, partitions):
    df = spark.range(500).selectExpr("id % 3 = 0 as hot", "cast(id as string) k").repartition(5)
    rows = with_row_index(df, ["hot", "k"], partitions=partitions).collect()
    order = sorted(rows, key=lambda r: (r["hot"], r["k"]))
    assert [r["row_index"] for r in order] == list(range(500))


def test_wide_report(spark):
    long = spark.createDataFrame([("city", 0, 0, 9, 0.5, True), ("zip", 0, 0, 9, 0.1, False)],
                                 "feature string, chunk_index bigint, start_index bigint, end_index bigint, distance double, alert boolean")
    row = D.widen_chunks(long, ["city", "zip"]).first().asDict()
    assert row["city_value"] == 0.5 and row["city_alert"] and not row["zip_alert"]


def test_pca_psi_against_numpy(spark):
    rng = np.random.default_rng(9)
    base = rng.normal(size=(600, 2))
    ref = np.column_stack([base[:, 0], base[:, 0] * 0.8 + 0.3 * base[:, 1], rng.normal(size=600) * 0.1 + base[:, 1]])
    ana = ref[:400] + 0.3
    cols = ["a", "b", "c"]
    frame = lambda m: spark.createDataFrame([tuple(map(float, x)) for x in m], "a double, b double, c double")
    got = [r["psi_score"] for r in D.pca_psi(frame(ref), frame(ana), cols, bins=10).orderBy("component").collect()]
    z, za = (ref - ref.mean(0)) / ref.std(0), (ana - ref.mean(0)) / ref.std(0)
    vectors = np.linalg.eigh(np.cov(z.T))[1][:, ::-1][:, :2]
    vectors = vectors * np.sign(vectors[np.abs(vectors).argmax(0), range(2)])
    want = [brute_psi(z @ vectors[:, j], za @ vectors[:, j], 10) for j in range(2)]
    assert got == pytest.approx(want, abs=1e-6)


def test_watch_job(spark):
    """A shop that doubles its prices and sells in one town only; all else cycles through the same values."""
    def rows(n, price, towns):
        return [(f"k{i}", i, float(price * (20 + i % 17)), 40 + i % 5 / 10, -90 + i % 7 / 10, 1000 * (1 + i % 9),
                 41 + i % 3 / 10, -91 + i % 4 / 10, "books", "FM"[i % 2], towns[i % len(towns)], "OH", "44100") for i in range(n)]

    schema = ("trans_num string, datetime int, amt double, lat double, long double, city_pop bigint, merch_lat double, "
              "merch_long double, category string, gender string, city string, state string, zip string")
    ref, ana = spark.createDataFrame(rows(252, 1, "pqrst"), schema), spark.createDataFrame(rows(200, 2, "p"), schema)
    result = drift_watch.watch(ref, ana, chunk_size=100)
    scores = {r["feature"]: r["psi_score"] for r in result.psi.collect()}
    assert len(scores) == 6 and all(s >= 0 for s in scores.values())
    decision = {r["feature"]: r for r in result.decision.collect()}
    assert decision["amt"]["drifted"] and all(r["trigger_retraining"] for r in decision.values())
    assert [r["component"] for r in result.pca.orderBy("component").collect()] == ["PC1", "PC2"]
    assert result.chunks.where("alert and feature = 'city'").count() == 2
    assert {r["feature"]: r["drifted"] for r in result.tests.collect()}["amt"]
    assert result.dataset.first()["n_columns"] == 6
