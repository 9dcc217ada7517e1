"""Profiles merged from the states of appended batches."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from txnlens.operators.profile_states import column_states, merge_states, verified_top
from txnlens.operators.profiling import profile_table
from txnlens.sources.feature_tables import FeatureTables

EXACT = ["n_rows", "n_null", "min_value", "max_value", "mean", "std", "n_zero"]


def batch(spark, rng, n, first):
    rows = [(str(first + i), float(rng.normal(first, 2)) if rng.random() > 0.1 else float("nan"), int(rng.integers(0, 4)),
             None if rng.random() < 0.2 else f"v{min(int(rng.exponential(3)), 40)}") for i in range(n)]
    return spark.createDataFrame(rows, "trans_num string, amt double, level int, kind string").withColumn(
        "datetime", F.expr("timestamp_ntz'2024-01-01'"))


def by_column(df):
    return {r["column_name"]: r.asDict() for r in df.collect()}


def same(a, b):
    return a == b if a is None or b is None else a == pytest.approx(b, rel=1e-9)


def test_merged_states_agree_with_the_whole_table(spark):
    rng = np.random.default_rng(1)
    parts = [batch(spark, rng, n, 10_000 * n) for n in (400, 900, 1)]
    empty = parts[0].limit(0)
    whole = parts[0].unionByName(parts[1]).unionByName(parts[2])
    states = column_states(parts[0])
    for p in (*parts[1:], empty):
        states = states.unionByName(column_states(p))
    got, want = by_column(merge_states(states)), by_column(profile_table(whole))
    assert set(got) == set(want)
    for c, w in want.items():
        for f in EXACT:
            assert same(got[c][f], w[f]), (c, f)
        assert got[c]["n_distinct"] == pytest.approx(w["n_distinct"], rel=0.05, abs=1)
        if w["median"] is not None:
            values = np.sort([r[0] for r in whole.where(f"{c} is not null and not isnan(double({c}))").select(c).collect()])
            for q, share in (("q1", 0.25), ("median", 0.5), ("q3", 0.75)):
                low, high = (np.searchsorted(values, got[c][q], side) / len(values) for side in ("left", "right"))
                assert low - 0.02 <= share <= high + 0.02
    top = by_column(verified_top(whole, states))
    for c in ("level", "kind"):
        w = want[c]
        assert top[c]["top_count"] == w["top_count"]
        assert top[c]["top_value"] == (w["top_text"] if c == "kind" else str(float(w["top_number"])))


def test_nothing_but_nulls_and_empty_tables(spark):
    df = spark.createDataFrame([(None, None)], "a double, b string")
    for rows, n in ((df, 1), (df.limit(0), 0)):
        got = by_column(merge_states(column_states(rows)))
        assert {c: (r["n_rows"], r["n_null"], r["mean"], r["median"], r["n_distinct"]) for c, r in got.items()} == {
            "a": (n, n, None, None, 0), "b": (n, n, None, None, 0)}


def test_an_append_reads_only_its_own_rows(spark, tmp_path):
    rng = np.random.default_rng(2)
    store = FeatureTables(spark, str(tmp_path))
    store.write(batch(spark, rng, 50, 0), "numbers")
    assert store.profile("numbers").count() == 4
    # earlier rows are out of reach for the second append and its profile
    folder = tmp_path / "name=numbers" / "version=1"
    for f in folder.glob("batch=*/*.parquet"):
        f.write_bytes(b"")
    store.write(batch(spark, rng, 70, 1000), "numbers")
    got = by_column(store.profile("numbers"))
    assert got["trans_num"]["n_rows"] == 120 and got["trans_num"]["n_distinct"] == pytest.approx(120, abs=3)


def test_verified_profile_of_a_feature_table(spark, tmp_path):
    rng = np.random.default_rng(3)
    store = FeatureTables(spark, str(tmp_path))
    for i in range(3):
        store.write(batch(spark, rng, 200, 1000 * i), "numbers")
    rows = spark.read.parquet(store.path("numbers", 1))
    want = {r["kind"]: r["count"] for r in rows.where("kind is not null").groupBy("kind").count().collect()}
    top = by_column(store.profile("numbers", verified=True))["kind"]
    assert top["top_count"] == max(want.values()) == want[top["top_value"]]
