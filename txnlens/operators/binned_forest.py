"""Feature importance of random forests over many rows, from counts of binned values.

The rows are stored once as blocks of bin numbers, a byte a value; recursive elimination grows all its forests on these blocks.
All trees of a forest grow together, level by level. Tasks count the rows of each open node by drawn feature, bin and class
and send one array a tree; the arrays are summed where the splits are chosen, and one row a node comes to the driver.
Every tree learns from rows drawn with replacement, as many from a block as it has. As in Spark's forests a node looks at the
root of the number of features, splits by Gini impurity, and importance is the gain times the node's rows, normed by tree.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, functions as F

from txnlens.operators.boosting import weighted_cuts
from txnlens.operators.table_trees import drawn_features
from txnlens.session import materialize

BINS = 32
MOST_CLASSES = 50
_BLOCK_ROWS = 65_536
_BLOCK_BYTES = 4_000_000
_BLOCK_SCHEMA = "part int, place int, n int, codes binary"
_BEST_SCHEMA = "tree int, node int, feature int, cut int, gain double, n double, left_pure boolean, right_pure boolean"


class BinnedRows:
    """Blocks of (bin, class) codes, one run of bytes a feature."""

    def __init__(self, blocks: DataFrame, width: int, bins: int, classes: int, cuts: list[np.ndarray] | None = None):
        self.blocks, self.width, self.bins, self.classes, self.cuts = blocks, width, bins, classes, cuts

    @property
    def code_type(self) -> np.dtype:
        return np.dtype(np.uint8 if self.bins * self.classes <= 256 else np.uint16)


def bin_rows(rows: DataFrame, width: int, classes: int) -> BinnedRows:
    """Stored blocks of the (y, x) rows; a value's bin is the first cut point that it doesn't exceed."""
    cuts = weighted_cuts(rows.select("y", F.lit(1.0).alias("w"), "x", F.lit(0.0).alias("margin"),
                                     F.lit(0).cast("bigint").alias("id")), width, BINS)
    out = BinnedRows(None, width, max(map(len, cuts)), classes, cuts)
    most, kind = max(1, min(_BLOCK_ROWS, _BLOCK_BYTES // max(width, 1))), out.code_type
    shared = rows.sparkSession.sparkContext.broadcast(cuts)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, place, held, size = TaskContext.get().partitionId(), 0, [], 0

        def block(codes: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({
                "part": pa.array([part], pa.int32()), "place": pa.array([place], pa.int32()),
                "n": pa.array([codes.shape[1]], pa.int32()), "codes": pa.array([codes.tobytes()], pa.binary())})

        for batch in batches:
            y = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            x = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            codes = np.empty((width, len(y)), kind)
            for f, points in enumerate(shared.value):
                codes[f] = np.minimum(np.searchsorted(points, x[:, f]), len(points) - 1) * classes + y
            held.append(codes)
            size += len(y)
            if size >= most:
                whole = np.concatenate(held, axis=1)
                while whole.shape[1] >= most:
                    yield block(whole[:, :most])
                    place += 1
                    whole = whole[:, most:]
                held, size = [whole], whole.shape[1]
        if size:
            yield block(np.concatenate(held, axis=1))

    out.blocks = materialize(rows.select("y", "x").mapInArrow(pack, _BLOCK_SCHEMA), "bins")
    return out


class _Tree:
    """A tree that grows: nodes by number, each with feature, cut, left and right child (-1 for none)."""

    def __init__(self):
        self.nodes: list[list[int]] = [[-1, -1, -1, -1]]
        self.place = [0]  # as in a heap
        self.open = [0]

    def split(self, node: int, feature: int, cut: int) -> tuple[int, int]:
        left = len(self.nodes)
        self.nodes[node] = [feature, cut, left, left + 1]
        self.nodes += [[-1, -1, -1, -1], [-1, -1, -1, -1]]
        self.place += [2 * self.place[node] + 1, 2 * self.place[node] + 2]
        return left, left + 1


def counts_of(codes: np.ndarray, classes: int, rows: np.ndarray, nodes: list[list[int]], drawn: dict[int, np.ndarray],
              bins: int) -> dict[int, np.ndarray]:
    """For each open node that has some of the ``rows`` the counts by drawn feature, bin and class."""
    out, todo = {}, [(0, rows)]
    while todo:
        node, own = todo.pop()
        if node in drawn:
            out[node] = np.stack([np.bincount(codes[f].take(own), minlength=bins * classes) for f in drawn[node]])
            continue
        feature, cut, left, right = nodes[node]
        if feature >= 0 and len(own):
            low = codes[feature].take(own) < (cut + 1) * classes
            todo += [(left, own.take(np.flatnonzero(low))), (right, own.take(np.flatnonzero(~low)))]
    return out


def best_split(counts: np.ndarray) -> tuple | None:
    """(feature's place, cut, gain, rows, left pure, right pure) of the largest gain in Gini impurity, from counts by feature,
    bin and class; ties go to the first. None if nothing is gained."""
    left = counts.cumsum(axis=1)[:, :-1].astype(float)
    whole = counts[0].sum(axis=0).astype(float)
    right = whole - left
    n, a, b = whole.sum(), left.sum(axis=2), right.sum(axis=2)
    if not n or not left.shape[1]:
        return None
    kept = lambda c, m: np.divide((c * c).sum(axis=2), m, out=np.zeros_like(m), where=m > 0)
    gain = np.where((a > 0) & (b > 0), (kept(left, a) + kept(right, b) - (whole * whole).sum() / n) / n, -1.0)
    f, c = np.unravel_index(np.argmax(gain), gain.shape)
    if gain[f, c] <= 1e-15:
        return None
    return int(f), int(c), float(gain[f, c]), float(n), *(bool(np.count_nonzero(s[f, c]) < 2) for s in (left, right))


def importances(data: BinnedRows, kept: list[int], trees: int, depth: int, seed: int) -> list[float]:
    """The importance of each kept feature in a forest that sees those only; they add up to 1 if any row can be split."""
    most = math.ceil(math.sqrt(len(kept)))
    grown, scores = [_Tree() for _ in range(trees)], np.zeros((trees, data.width))
    for _ in range(depth):
        drawn = [{n: np.array(kept)[drawn_features(seed, t, tree.place[n], len(kept), most)] for n in tree.open}
                 for t, tree in enumerate(grown)]
        if not any(drawn):
            break
        for r in _level(data, grown, drawn, seed):
            tree = grown[r["tree"]]
            left, right = tree.split(r["node"], r["feature"], r["cut"])
            scores[r["tree"], r["feature"]] += r["gain"] * r["n"]
            tree.open += [c for c, pure in ((left, r["left_pure"]), (right, r["right_pure"])) if not pure]
    total = scores.sum(axis=1, keepdims=True)
    mean = np.divide(scores, total, out=np.zeros_like(scores), where=total > 0).sum(axis=0)
    return [float(mean[f] / (mean.sum() or 1.0)) for f in kept]


def _level(data: BinnedRows, grown: list[_Tree], drawn: list[dict[int, np.ndarray]], seed: int) -> list:
    """The splits of all open nodes that gain from one, in the order of trees and nodes."""
    width, bins, classes, kind = data.width, data.bins, data.classes, data.code_type
    shared = data.blocks.sparkSession.sparkContext.broadcast(([t.nodes for t in grown], drawn))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nodes, wanted = shared.value
        slots = [{n: i for i, n in enumerate(d)} for d in wanted]
        sums = {t: np.zeros((len(d), len(next(iter(d.values()))), bins * classes), np.int64) for t, d in enumerate(wanted) if d}
        for batch in batches:
            for part, place, n, raw in zip(*(c.to_pylist() for c in batch.columns[:3]), batch.column(3)):
                codes = np.frombuffer(raw.as_buffer(), kind).reshape(width, n)
                for t, total in sums.items():
                    rows = np.random.default_rng([seed, t, part, place]).integers(0, n, n, dtype=np.uint32).astype(np.intp)
                    for node, found in counts_of(codes, classes, rows, nodes[t], wanted[t], bins).items():
                        total[slots[t][node]] += found
        for t, total in sums.items():
            yield pa.RecordBatch.from_pydict({"tree": pa.array([t], pa.int32()),
                                              "counts": pa.array([total.tobytes()], pa.binary())})

    def choose(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        own = shared.value[1][key[0]]
        total = sum(np.frombuffer(c, np.int64) for c in part["counts"]).reshape(len(own), -1, bins, classes)
        out = []
        for (node, features), counts in zip(own.items(), total):
            best = best_split(counts)
            if best is not None:
                out.append((key[0], node, int(features[best[0]]), *best[1:]))
        return pd.DataFrame(out, columns=["tree", "node", "feature", "cut", "gain", "n", "left_pure", "right_pure"])

    found = data.blocks.mapInArrow(count, "tree int, counts binary").groupBy("tree").applyInPandas(choose, _BEST_SCHEMA)
    for tree in grown:
        tree.open = []
    return sorted(found.collect(), key=lambda r: (r["tree"], r["node"]))


def forest_rows(assembled: DataFrame, target: str, vector: str = "features") -> DataFrame:
    """(y, x) of an assembled frame."""
    return assembled.select(F.col(target).cast("double").alias("y"), vector_to_array(vector).alias("x"))
