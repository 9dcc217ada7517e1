"""Forests over binned blocks: counts and splits against plain Python, importance of known columns."""

import numpy as np
import pytest

from txnlens.operators import binned_forest as B, selection


def gini(labels):
    n = len(labels)
    return 1 - sum((np.count_nonzero(labels == k) / n) ** 2 for k in set(labels.tolist())) if n else 0.0


def test_counts_and_best_split_agree_with_plain_python():
    rng = np.random.default_rng(3)
    bins, classes = 5, 3
    x, y = rng.integers(0, bins, (4, 300)), rng.integers(0, classes, 300)
    codes = (x * classes + y).astype(np.uint8)
    rows = rng.integers(0, 300, 300)
    nodes = [[2, 1, 1, 2], [-1, -1, -1, -1], [-1, -1, -1, -1]]
    drawn = {1: np.array([0, 3]), 2: np.array([1, 0])}
    found = B.counts_of(codes, classes, rows, nodes, drawn, bins)
    for node, own in ((1, rows[x[2, rows] <= 1]), (2, rows[x[2, rows] > 1])):
        counts = found[node].reshape(2, bins, classes)
        for i, f in enumerate(drawn[node]):
            for b in range(bins):
                for k in range(classes):
                    assert counts[i, b, k] == np.count_nonzero((x[f, own] == b) & (y[own] == k))
        gains = {}
        for i, f in enumerate(drawn[node]):
            for c in range(bins - 1):
                low = x[f, own] <= c
                left, right = y[own][low], y[own][~low]
                if len(left) and len(right):
                    gains[i, c] = gini(y[own]) - (len(left) * gini(left) + len(right) * gini(right)) / len(own)
        best = B.best_split(counts)
        assert best[2] == pytest.approx(max(gains.values())) and gains[best[:2]] == pytest.approx(best[2])
        assert best[3] == len(own)


def test_nothing_to_split():
    assert B.best_split(np.array([[[3, 4], [0, 0]]])) is None
    assert B.best_split(np.zeros((1, 2, 2), int)) is None


def labelled(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(3000, 6))
    y = (x[:, 1] + 0.7 * x[:, 4] > 0).astype(int)
    x[:, 5] = 2.0  # tells nothing
    return spark.createDataFrame([(int(k), *map(float, r)) for k, r in zip(y, x)], "is_fraud int, " + ", ".join(
        f"c{i} double" for i in range(6))).repartition(3), [f"c{i}" for i in range(6)]


def test_many_rows_are_ranked_on_binned_blocks(spark, monkeypatch):
    rows, columns = labelled(spark)
    few = {r["feature"]: r["importance"] for r in selection.rf_importance(rows, columns, trees=20).collect()}
    monkeypatch.setattr(selection, "BINNED_ROWS", 1)
    monkeypatch.setattr(selection, "_importances", None)  # Spark's forest is not asked
    monkeypatch.setattr(B, "_BLOCK_ROWS", 256)
    got = selection.rf_importance(rows, columns, trees=20).collect()
    many = {r["feature"]: r["importance"] for r in got}
    assert [r["feature"] for r in got[:2]] == ["c1", "c4"] and many["c5"] == 0 and sum(many.values()) == pytest.approx(1)
    assert all(abs(few[c] - many[c]) < 0.1 for c in columns)
    left = selection.rfe(rows, columns, 2, trees=20).collect()
    assert [(r["feature"], r["position"]) for r in left] == [("c1", 1), ("c4", 4)]


def test_selection_bins_its_rows_once(spark, monkeypatch):
    rows, columns = labelled(spark)
    monkeypatch.setattr(selection, "BINNED_ROWS", 1)
    monkeypatch.setattr(B, "_BLOCK_ROWS", 256)
    binned, bins, grown, grow = [], selection.bin_rows, [], selection.importances

    def counted(*args):
        binned.append(args)
        return bins(*args)

    def forest(data, kept, *args):
        grown.append(tuple(kept))
        return grow(data, kept, *args)

    monkeypatch.setattr(selection, "bin_rows", counted)
    monkeypatch.setattr(selection, "importances", forest)
    got = selection.select_features(rows, columns, k_best=2, n_features=2, top_n=2, trees=10).collect()
    assert len(binned) == 1 and [len(k) for k in grown] == [6, 5, 4, 3]  # the forest over all columns serves both
    importance = {r["feature"]: r["importance"] for r in selection.rf_importance(rows, columns, trees=10).collect()}
    left = {r["feature"] for r in selection.rfe(rows, columns, 2, trees=10).collect()}
    assert {r["feature"]: r["importance"] for r in got} == importance and {r["feature"] for r in got if r["in_rfe"]} == left


def test_blocks_hold_every_row_once(spark, monkeypatch):
    rows, columns = labelled(spark)
    monkeypatch.setattr(B, "_BLOCK_ROWS", 256)
    data = B.bin_rows(B.forest_rows(selection.assemble(rows, columns), "is_fraud"), 6, 2)
    blocks = data.blocks.collect()
    assert sum(r["n"] for r in blocks) == 3000 and max(r["n"] for r in blocks) == 256
    assert len({(r["part"], r["place"]) for r in blocks}) == len(blocks)
    ones = sum(int((np.frombuffer(r["codes"], data.code_type).reshape(6, -1)[0] % 2).sum()) for r in blocks)
    assert ones == rows.where("is_fraud = 1").count()
