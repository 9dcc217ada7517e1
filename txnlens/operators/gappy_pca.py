"""Principal components of rows with missing values, by expectation-maximisation.

Rows with the same columns present form a pattern. One pass sums each pattern's rows, values and products; all the
expectations need from the data is in these moments, so the iterations run over patterns (at most 2^columns, few in practice)
and no row is read twice. Given mean and covariance, the missing values of a row are expected where its present ones put
them, and what stays unsure adds to the covariance. A row's score on a component is its expected one, linear in the values it has.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from txnlens.functions.stats import number

#: Numbers in the moments of all patterns that may come to the driver (64 MB).
MOST_NUMBERS = 8_000_000
TOLERANCE = 1e-10
#: Iterations over the patterns' moments; the likelihood grows with each.
MOST_ITERATIONS = 5_000


@dataclass
class Moments:
    """By pattern: which columns are present, rows, sums and sums of products (0 where a column is missing)."""

    present: np.ndarray
    n: np.ndarray
    sums: np.ndarray
    products: np.ndarray

    @property
    def rows(self) -> int:
        return int(self.n.sum())

    @property
    def gaps(self) -> int:
        return int(self.n[~self.present.all(axis=1)].sum())


def _pattern(columns) -> Column:
    return F.concat(*[F.when(number(c).isNull(), F.lit("0")).otherwise(F.lit("1")) for c in columns])


def pattern_moments(df: DataFrame, columns) -> Moments:
    columns = list(columns)
    k = len(columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.stack([c.to_numpy(zero_copy_only=False) for c in batch.columns], axis=1).astype(float)
            known = ~np.isnan(x)
            x = np.where(known, x, 0.0)
            kinds, own = np.unique(known, axis=0, return_inverse=True)
            for i, kind in enumerate(kinds):
                part = x[own.ravel() == i]
                v = np.concatenate([[len(part)], part.sum(axis=0), (part.T @ part).ravel()])
                yield pa.RecordBatch.from_pydict({"pattern": pa.array(["".join("01"[int(b)] for b in kind)] * len(v)),
                                                  "pos": pa.array(np.arange(len(v), dtype=np.int32)), "v": pa.array(v)})

    sums = df.select(*[number(c).alias(c) for c in columns]).mapInArrow(run, "pattern string, pos int, v double") \
        .groupBy("pattern", "pos").agg(F.sum("v").alias("v"))
    size = k * k + k + 1
    found: dict[str, np.ndarray] = {}
    for r in sums.toLocalIterator():
        if r["pattern"] not in found:
            if (len(found) + 1) * size > MOST_NUMBERS:
                raise ValueError(f"the moments of the missing patterns have more than {MOST_NUMBERS} numbers")
            found[r["pattern"]] = np.zeros(size)
        found[r["pattern"]][r["pos"]] = r["v"]
    names = sorted(found)
    table = np.array([found[p] for p in names]).reshape(len(names), size)
    return Moments(np.array([[c == "1" for c in p] for p in names], bool).reshape(len(names), k), table[:, 0],
                   table[:, 1:k + 1], table[:, k + 1:].reshape(len(names), k, k))


def expectation(present: np.ndarray, mean: np.ndarray, cov: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For one pattern the matrix that turns present deviations into expected ones, and the covariance that stays."""
    o, m = np.flatnonzero(present), np.flatnonzero(~present)
    turn = np.zeros_like(cov)
    turn[o, o] = 1.0
    left = np.zeros_like(cov)
    if len(m):
        slope = cov[np.ix_(m, o)] @ np.linalg.pinv(cov[np.ix_(o, o)], hermitian=True) if len(o) else np.zeros((len(m), 0))
        turn[np.ix_(m, o)] = slope
        left[np.ix_(m, m)] = cov[np.ix_(m, m)] - slope @ cov[np.ix_(o, m)]
    return turn, left


def fit_covariance(data: Moments) -> tuple[np.ndarray, np.ndarray]:
    """Mean and covariance of greatest likelihood; rows without any value say nothing."""
    some = data.present.any(axis=1)
    present, n, sums, products = (a[some] for a in (data.present, data.n, data.sums, data.products))
    seen = np.maximum((present * n[:, None]).sum(axis=0), 1)
    mean = sums.sum(axis=0) / seen
    cov = np.diag(np.maximum(np.einsum("pii->i", products) / seen - mean * mean, 1e-12))
    total = n.sum()
    for _ in range(MOST_ITERATIONS if total else 0):
        first, second = np.zeros_like(mean), np.zeros_like(cov)
        for p, rows, s, q in zip(present, n, sums, products):
            turn, left = expectation(p, mean, cov)
            low = np.where(p, mean, 0.0)
            dev = s - rows * low
            square = q - np.outer(s, low) - np.outer(low, s) + rows * np.outer(low, low)
            first += turn @ dev
            second += turn @ square @ turn.T + rows * left
        shift = first / total
        new = second / total - np.outer(shift, shift)
        change = max(np.abs(shift).max(), np.abs(new - cov).max())
        mean, cov = mean + shift, new
        if change < TOLERANCE:
            break
    return mean, cov


def components(cov: np.ndarray, k: int) -> list[list[float]]:
    """k leading eigenvectors; the largest entry of each is made positive."""
    _, vectors = np.linalg.eigh(cov)
    out = []
    for j in range(1, k + 1):
        w = vectors[:, -j]
        out.append((w * (1.0 if w[np.abs(w).argmax()] > 0 else -1.0)).tolist())
    return out


def project_expected(df: DataFrame, columns, loadings: list[list[float]], mean: np.ndarray, cov: np.ndarray,
                     patterns: np.ndarray) -> DataFrame:
    """Expected scores (PC1, PC2, ..) of every row; ``patterns`` are those that occur in ``df``."""
    rows = []
    for p in patterns:
        turn, _ = expectation(p, mean, cov)
        weights = [np.asarray(w) @ turn for w in loadings]
        fixed = [float(np.asarray(w) @ mean - v @ np.where(p, mean, 0.0)) for w, v in zip(loadings, weights)]
        rows.append(("".join("01"[int(b)] for b in p), fixed, [v.tolist() for v in weights]))
    # as many rows as patterns, whose moments were bounded
    table = df.sparkSession.createDataFrame(rows, "pattern string, fixed array<double>, weights array<array<double>>")
    values = F.array(*[F.coalesce(number(c), F.lit(0.0)) for c in columns])
    told = df.select(_pattern(columns).alias("pattern"), values.alias("x")).join(F.broadcast(table), "pattern")
    score = lambda j: F.col("fixed")[j] + F.aggregate(
        F.zip_with("x", F.col("weights")[j], lambda v, w: v * w), F.lit(0.0), lambda a, v: a + v)
    return told.select(*[score(j).alias(f"PC{j + 1}") for j in range(len(loadings))])
