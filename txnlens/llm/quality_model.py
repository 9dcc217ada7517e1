"""Quality classifier: a generalised additive model with pairwise interactions.

Features of a text are cut into bins; cyclic boosting grows one shallow tree for each feature in turn on the gradient of
the logistic loss and adds it to that feature's lookup table; the strongest pairs of features get tables of their own.
A score is a sum of looked-up values, taken for a whole batch at once.

The model is fitted on at most ``MOST_ROWS`` different labelled documents (key and text) outside the held-out fold (a
documented bound for the fit; keys and documents are taken in the order of a hash). Everything else covers all rows. Defined cases: null and empty
texts have features of 0 and get a score like any other; without labelled rows, or with one class only, every score is
the smoothed share of label 1; a document with several labels counts with the smallest; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnlens.llm.bytesets import row_words, text_buffer, window_hashes
from txnlens.llm.folds import held_out

MOST_ROWS = 20_000
BINS = 32
PAIR_BINS = 8
PAIRS = 6
ROUNDS = 120
PAIR_ROUNDS = 60
RATE = 0.1
SHRINK = 5.0
FEATURES = ("log_words", "word_length", "symbols", "bars", "digits", "upper", "punctuation", "exclamations", "newlines",
            "beyond_ascii", "short_words", "distinct_words", "repeated_windows", "long_words")

_CLASS = {
    "symbols": b"#*$%&<>{}[]~^\\", "bars": b"|", "digits": b"0123456789", "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "punctuation": b".,;:?", "exclamations": b"!", "newlines": b"\n", "beyond_ascii": bytes(range(128, 256)),
}


def features(raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row of features for each text."""
    out = np.zeros((len(offsets) - 1, len(FEATURES)))
    column = {name: k for k, name in enumerate(FEATURES)}

    def sums(flags: np.ndarray, edges: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
        return total[edges[1:]] - total[edges[:-1]]
    for first, last, words in row_words(raw, offsets):
        edge = offsets[first:last + 1] - offsets[first]
        size = np.maximum(edge[1:] - edge[:-1], 1)
        rows = slice(first, last)
        for name, members in _CLASS.items():
            table = np.zeros(256, bool)
            table[list(members)] = True
            out[rows, column[name]] = sums(table[words.raw], edge) / size
        n = np.diff(words.rows)
        some = np.maximum(n, 1)
        length = words.ends - words.starts
        out[rows, column["log_words"]] = np.log1p(n)
        out[rows, column["word_length"]] = sums(length, words.rows) / some
        out[rows, column["short_words"]] = sums(length <= 3, words.rows) / some
        out[rows, column["long_words"]] = sums(length >= 12, words.rows) / some
        hashes = words.hashes()
        windows = window_hashes(hashes, 3)
        for i, (a, b) in enumerate(zip(words.rows[:-1], words.rows[1:])):
            if b > a:
                out[first + i, column["distinct_words"]] = len(np.unique(hashes[a:b])) / (b - a)
            if b - a > 2:
                out[first + i, column["repeated_windows"]] = 1 - len(np.unique(windows[a:b - 2])) / (b - a - 2)
    return out


def _cut(g: np.ndarray, h: np.ndarray) -> tuple[float, int]:
    """Best place to cut a row of bins in two, with its gain."""
    if len(g) < 2:
        return 0.0, 0
    a, b = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    gain = a**2 / (b + SHRINK) + (g.sum() - a)**2 / (h.sum() - b + SHRINK) - g.sum()**2 / (h.sum() + SHRINK)
    k = int(np.argmax(gain))
    return float(gain[k]), k + 1


def _tree(g: np.ndarray, h: np.ndarray, depth: int) -> np.ndarray:
    """Values of a shallow tree over bins (one or two dimensions)."""
    if depth:
        best = max(((*_cut(g.sum(axis=tuple(k for k in range(g.ndim) if k != axis)),
                           h.sum(axis=tuple(k for k in range(g.ndim) if k != axis))), axis) for axis in range(g.ndim)))
        if best[0] > 1e-9:
            parts = [_tree(x, y, depth - 1) for x, y in
                     zip(np.split(g, [best[1]], best[2]), np.split(h, [best[1]], best[2]))]
            return np.concatenate(parts, best[2])
    return np.full(g.shape, -RATE * g.sum() / (h.sum() + SHRINK))


class AdditiveModel:
    """Bin edges, one table for each feature, and tables for the strongest pairs."""

    def __init__(self, x: np.ndarray, y: np.ndarray):
        share = (y.sum() + 1) / (len(y) + 2)
        self.base = float(np.log(share / (1 - share)))
        self.edges = [np.unique(np.quantile(c, np.linspace(0, 1, BINS + 1)[1:-1])) if len(y) else np.empty(0) for c in x.T]
        self.coarse = [np.unique(np.quantile(c, np.linspace(0, 1, PAIR_BINS + 1)[1:-1])) if len(y) else np.empty(0)
                       for c in x.T]
        self.tables = [np.zeros(len(e) + 1) for e in self.edges]
        self.pairs: list[tuple[int, int, np.ndarray]] = []
        if 0 < y.sum() < len(y):
            self._fit(x, y)

    def _fit(self, x: np.ndarray, y: np.ndarray) -> None:
        fine, coarse = self._bins(x, self.edges), self._bins(x, self.coarse)
        score = np.full(len(y), self.base)

        def slopes():
            p = 1 / (1 + np.exp(-score))
            return p - y, p * (1 - p)
        for _ in range(ROUNDS):
            for f, table in enumerate(self.tables):
                g, h = slopes()
                step = _tree(np.bincount(fine[f], g, len(table)), np.bincount(fine[f], h, len(table)), 2)
                table += step
                score += step[fine[f]]
        g, h = slopes()
        ranked = []
        for a in range(len(self.tables)):
            for b in range(a):
                shape = (len(self.coarse[a]) + 1, len(self.coarse[b]) + 1)
                both = coarse[a] * shape[1] + coarse[b]
                gg, hh = np.bincount(both, g, shape[0] * shape[1]), np.bincount(both, h, shape[0] * shape[1])
                ranked.append((float((gg**2 / (hh + SHRINK)).sum()), a, b, shape))
        for _, a, b, shape in sorted(ranked, reverse=True)[:PAIRS]:
            self.pairs.append((a, b, np.zeros(shape)))
        for _ in range(PAIR_ROUNDS):
            for a, b, table in self.pairs:
                g, h = slopes()
                both = coarse[a] * table.shape[1] + coarse[b]
                step = _tree(np.bincount(both, g, table.size).reshape(table.shape),
                             np.bincount(both, h, table.size).reshape(table.shape), 2)
                table += step
                score += step.ravel()[both]

    @staticmethod
    def _bins(x: np.ndarray, edges: list[np.ndarray]) -> list[np.ndarray]:
        return [np.searchsorted(e, c, side="right") for e, c in zip(edges, x.T)]

    def scores(self, x: np.ndarray) -> np.ndarray:
        fine, coarse = self._bins(x, self.edges), self._bins(x, self.coarse)
        total = np.full(len(x), self.base)
        for table, place in zip(self.tables, fine):
            total += table[place]
        for a, b, table in self.pairs:
            total += table[coarse[a], coarse[b]]
        return 1 / (1 + np.exp(-total))


def feature_rows(docs: DataFrame, text: str, label: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = features(*text_buffer(batch.column(1)))
            yield pa.RecordBatch.from_pydict({"y": batch.column(0), "x": pa.array(list(x), pa.list_(pa.float64()))})
    return docs.select(F.col(label).cast("double").alias("y"), F.col(text).cast("string").alias("t")) \
        .mapInArrow(run, "y double, x array<double>")


def labelled_texts(docs: DataFrame, sample: DataFrame, label: str, key: str, text: str, most: int) -> DataFrame:
    """(label, ``_t``): at most ``most`` different documents of the small table ``sample`` (``_k``, label).

    Keys and hashes of texts are ranked first; only then are texts read, so copies of a key's text count once.
    """
    t = F.col(text).cast("string")
    rows = docs.select(F.col(key).alias("_d"), t.alias("_t"), F.xxhash64(t).alias("_h")) \
        .join(F.broadcast(sample), F.col("_d") == F.col("_k"))
    chosen = rows.select("_k", "_h").distinct().orderBy(F.xxhash64("_k", "_h"), "_k", "_h").limit(most)
    return rows.join(F.broadcast(chosen), ["_k", "_h"]).dropDuplicates(["_k", "_h"]).select(label, "_t")


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality",
        most: int = MOST_ROWS) -> AdditiveModel:
    """Learns from labelled rows outside the held-out fold; at most ``most`` keys and ``most`` documents."""
    known = labels.where(F.col(label).isNotNull() & F.col(key).isNotNull() & ~held_out(key))
    sample = known.groupBy(F.col(key).alias("_k")).agg(F.min(label).alias("_y")) \
        .orderBy(F.xxhash64("_k"), "_k").limit(most)
    got = feature_rows(labelled_texts(docs, sample, "_y", key, text, most), "_t", "_y").toPandas()
    got = got.sort_values("x", key=lambda c: c.map(tuple), kind="stable")
    x = np.array(got["x"].tolist(), float).reshape(len(got), len(FEATURES))
    return AdditiveModel(x, got["y"].to_numpy(float))


def score(docs: DataFrame, model: AdditiveModel, *keys: str, text: str = "text") -> DataFrame:
    """Keys and the chance of label 1 for each row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = model.scores(features(*text_buffer(batch.column(len(keys)))))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(got)], [*keys, "score"])
    source = docs.select(*keys, F.col(text).cast("string").alias("_text"))
    kinds = ", ".join(f"`{k}` {source.schema[k].dataType.simpleString()}" for k in keys)
    return source.mapInArrow(run, f"{kinds}, score double")
