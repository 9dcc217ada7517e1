"""A decision tree over many rows, from counts of binned values, grown once for all depths.

The upper nodes are split from counts that tasks make of the stored blocks; once a node has few enough rows, these go to
one task, which grows all that is below. A tree of a smaller depth is the upper part of the same tree, since no split
depends on what lies below it, so one tree and one pass of the rows give the scores of every depth.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from txnlens.operators.binned_forest import BinnedRows
from txnlens.operators.table_trees import NodeTable

#: Rows of a node up to which one task grows all below it.
TASK_ROWS = 250_000
_MOST_OPEN = 512
_NODE = np.dtype([("feature", np.int32), ("cut", np.int32), ("left", np.int32), ("right", np.int32)])


def splits(counts: np.ndarray, weights: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each node (gained, feature, cut) of the largest gain in Gini impurity from counts by node, feature, bin and class;
    both sides hold at least ``least`` rows, and ties go to the first feature and cut."""
    left = counts.cumsum(axis=2)[:, :, :-1]
    whole = counts[:, :1].sum(axis=2)[:, :, None]
    right = whole - left
    fits = (left.sum(axis=3) >= least) & (right.sum(axis=3) >= least)
    a, b, w = left * weights, right * weights, (whole * weights)[:, 0, 0]
    kept = lambda c: (c * c).sum(axis=3) / np.maximum(c.sum(axis=3), 1e-300)
    before = (w * w).sum(axis=1) / np.maximum(w.sum(axis=1), 1e-300)
    gain = np.where(fits, (kept(a) + kept(b) - before[:, None, None]) / np.maximum(w.sum(axis=1), 1e-300)[:, None, None], -1.0)
    flat = gain.reshape(len(gain), -1)
    best = flat.argmax(axis=1)
    feature, cut = np.unravel_index(best, gain.shape[1:])
    return flat[np.arange(len(flat)), best] > 1e-14, feature, cut


def _counted(codes: np.ndarray, rows: np.ndarray, place: np.ndarray, nodes: int, bins: int, classes: int) -> np.ndarray:
    """Rows by node, feature, bin and class; ``place`` is each row's node."""
    out = np.empty((nodes, len(codes), bins, classes))
    base = place * (bins * classes)
    for f in range(len(codes)):
        out[:, f] = np.bincount(base + codes[f].take(rows), minlength=nodes * bins * classes).reshape(nodes, bins, classes)
    return out


def grown_below(codes: np.ndarray, depth: int, bins: int, classes: int, weights: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """(nodes, counts by class) of the tree of these rows, which has ``depth`` levels of splits at most."""
    kinds = (codes[0] % classes).astype(np.int64)
    nodes, counts = [np.array([(-1, -1, -1, -1)], _NODE)], [np.bincount(kinds, minlength=classes)[None]]
    size, order = 1, np.arange(codes.shape[1])
    open_, sizes = np.array([0]), np.array([codes.shape[1]])  # the open nodes and the runs of rows they have in ``order``
    for _ in range(depth):
        whole = np.concatenate(counts)
        ends = np.cumsum(sizes)
        # a node of one class, or too small to be parted, stays as it is
        use = (np.count_nonzero(whole[open_], axis=1) > 1) & (sizes >= 2 * least)
        kept = np.flatnonzero(use)
        if not len(kept):
            break
        below, runs, next_ = [], [], []
        start = 0
        while start < len(kept):
            some = kept[start:start + _MOST_OPEN]
            start += len(some)
            own = np.concatenate([order[ends[k] - sizes[k]:ends[k]] for k in some])
            place = np.repeat(np.arange(len(some)), sizes[some])
            found, feature, cut = splits(_counted(codes, own, place, len(some), bins, classes), weights, least)
            low = codes[feature[place], own] < (cut[place] + 1) * classes
            side = np.where(found[place], place * 2 + ~low, -1)
            inside = np.flatnonzero(side >= 0)
            rank = np.cumsum(found) - 1
            child = rank[place[inside]] * 2 + (side[inside] & 1)
            moved = own[inside][np.argsort(child, kind="stable")]
            k = int(found.sum())
            told = np.bincount(child * classes + kinds[own[inside]], minlength=2 * k * classes).reshape(2 * k, classes)
            at = open_[some[found]]
            first = size + 2 * np.arange(k)
            below.append((at, feature[found], cut[found], first))
            nodes.append(np.full(2 * k, -1, np.int32).repeat(4).view(_NODE))
            counts.append(told)
            next_.append(size + np.arange(2 * k))
            runs.append((moved, told.sum(axis=1)))
            size += 2 * k
        table = np.concatenate(nodes)
        for at, feature, cut, first in below:
            table["feature"][at], table["cut"][at], table["left"][at], table["right"][at] = feature, cut, first, first + 1
        nodes, counts = [table], [np.concatenate(counts)]
        order, sizes, open_ = np.concatenate([r[0] for r in runs]), np.concatenate([r[1] for r in runs]), np.concatenate(next_)
        if not len(open_):
            break
    return np.concatenate(nodes), np.concatenate(counts)


def _reached(codes: np.ndarray, nodes: np.ndarray, classes: int) -> np.ndarray:
    """The node that each row of a block ends at."""
    at, rows = np.zeros(codes.shape[1], np.int64), np.arange(codes.shape[1])
    while True:
        rows = rows[nodes["feature"][at[rows]] >= 0]
        if not len(rows):
            return at
        n = nodes[at[rows]]
        at[rows] = np.where(codes[n["feature"], rows] < (n["cut"] + 1) * classes, n["left"], n["right"])


def grow_tree(data: BinnedRows, weights: np.ndarray, least: int, depth: int) -> tuple[NodeTable, np.ndarray]:
    """The tree of the stored rows and each node's depth; leaves' values are shares of the weighted classes."""
    bins, classes, width, kind = data.bins, data.classes, data.width, data.code_type
    context = data.blocks.sparkSession.sparkContext
    blocks = data.blocks.coalesce(2 * context.defaultParallelism)

    def codes_of(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
        for batch in batches:
            for n, raw in zip(batch.column(2).to_pylist(), batch.column(3)):
                yield np.frombuffer(raw.as_buffer(), kind).reshape(width, n)

    nodes, counts, level = np.array([(-1, -1, -1, -1)], _NODE), np.zeros((1, classes)), np.zeros(1, np.int64)
    open_ = np.array([0])
    while len(open_):  # each of them has more than TASK_ROWS rows, so there are few
        shared = context.broadcast((nodes, open_))

        def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            table, wanted = shared.value
            slot = np.full(len(table), -1)
            slot[wanted] = np.arange(len(wanted))
            total = np.zeros((len(wanted), width, bins, classes))
            for codes in codes_of(batches):
                place = slot[_reached(codes, table, classes)]
                rows = np.flatnonzero(place >= 0)
                if len(rows):
                    total += _counted(codes, rows, place[rows], len(wanted), bins, classes)
            yield pa.RecordBatch.from_pydict({"counts": pa.array([total.tobytes()], pa.binary())})

        total = sum(np.frombuffer(r["counts"]) for r in blocks.mapInArrow(count, "counts binary").collect())  # one row a task
        total = total.reshape(len(open_), width, bins, classes)
        if len(nodes) == 1:
            counts = total[:, 0].sum(axis=1)
        found, feature, cut = splits(total, weights, least)
        large = []
        for k, at in enumerate(open_):
            if not found[k] or level[at] >= depth:
                continue
            left = total[k, feature[k], :cut[k] + 1].sum(axis=0)
            nodes[at] = (feature[k], cut[k], len(nodes), len(nodes) + 1)
            for side in (left, counts[at] - left):
                if side.sum() > TASK_ROWS and np.count_nonzero(side) > 1 and level[at] + 1 < depth:
                    large.append(len(nodes))
                nodes, counts = np.append(nodes, np.array([(-1, -1, -1, -1)], _NODE)), np.vstack([counts, side])
                level = np.append(level, level[at] + 1)
        open_ = np.array(large, int)
        shared.unpersist()

    more = (nodes["feature"] < 0) & (np.count_nonzero(counts, axis=1) > 1) & (level < depth) & (counts.sum(axis=1) <= TASK_ROWS)
    shared = context.broadcast((nodes, level, more))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, _level, more = shared.value
        for codes in codes_of(batches):
            at = _reached(codes, table, classes)
            rows = np.flatnonzero(more[at])
            rows = rows[np.argsort(at[rows], kind="stable")]
            found, first = np.unique(at[rows], return_index=True)
            ends = [*first[1:], len(rows)]
            yield pa.RecordBatch.from_pydict({
                "node": pa.array(found, pa.int32()),
                "codes": pa.array([np.ascontiguousarray(codes[:, rows[a:b]]).tobytes() for a, b in zip(first, ends)], pa.binary())})

    def finish(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        codes = np.concatenate([np.frombuffer(c, kind).reshape(width, -1) for c in part["codes"]], axis=1)
        below, told = grown_below(codes, depth - int(shared.value[1][key[0]]), bins, classes, weights, least)
        return pd.DataFrame({"node": [key[0]], "nodes": [below.tobytes()], "counts": [told.astype(np.int64).tobytes()]})

    # a number of parts of its own: by bytes few tasks would do, but the work is large
    dealt = blocks.mapInArrow(deal, "node int, codes binary").repartition(4 * int(more.sum()) + 1, "node").groupBy("node").applyInPandas(
        finish, "node int, nodes binary, counts binary")
    tables, every, size = [nodes], [counts], len(nodes)
    for r in dealt.collect():  # as large as the model
        below, told = np.frombuffer(r["nodes"], _NODE).copy(), np.frombuffer(r["counts"], np.int64).reshape(-1, classes)
        for side in ("left", "right"):  # the root of what is below is the node itself
            below[side] = np.where(below[side] > 0, below[side] - 1 + size, -1)
        nodes[r["node"]] = below[0]
        tables.append(below[1:])
        every.append(told[1:])
        size += len(below) - 1
    table, counts = np.concatenate(tables), np.concatenate(every)
    weighted = counts * weights
    threshold = np.zeros(len(table))
    for f, points in enumerate(data.cuts):
        own = table["feature"] == f
        threshold[own] = points[table["cut"][own]]
    children = np.stack([table["left"], table["right"]], axis=1).astype(np.int64)
    tree = NodeTable(np.array([0]), table["feature"].astype(np.int64), threshold, children,
                     weighted / np.maximum(weighted.sum(axis=1, keepdims=True), 1e-300))
    return tree, depths_of(tree)


def depths_of(tree: NodeTable) -> np.ndarray:
    out, at, d = np.zeros(len(tree.feature), np.int64), np.array([0]), 0
    while len(at):
        out[at] = d
        at, d = tree.children[at[tree.feature[at] >= 0]].ravel(), d + 1
    return out


def upper_part(tree: NodeTable, depths: np.ndarray, depth: int) -> NodeTable:
    """The tree down to a depth."""
    kept = np.flatnonzero(depths <= depth)
    place = np.full(len(depths) + 1, -1)
    place[kept] = np.arange(len(kept))
    inner = depths[kept] < depth
    return NodeTable(tree.roots, np.where(inner, tree.feature[kept], -1), tree.threshold[kept],
                     np.where(inner[:, None], place[tree.children[kept]], -1), tree.value[kept])


def scores_by_depth(rows: DataFrame, tree: NodeTable, depth: int) -> list[dict[str, float]]:
    """For each depth from 0 on accuracy and macro means of the (y, x) rows, as ``classification_metrics`` has them."""
    shared = rows.sparkSession.sparkContext.broadcast((tree, tree.value.argmax(axis=1)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t, best = shared.value
        total: dict[tuple, int] = {}
        for batch in batches:
            n = batch.num_rows
            y = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            x = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(n, -1)
            at, wide = np.zeros(n, np.int64), int(t.value.shape[1])
            for d in range(depth + 1):
                for code, k in zip(*np.unique(y * wide + best[at], return_counts=True)):
                    key = (d, int(code) // wide, int(code) % wide)
                    total[key] = total.get(key, 0) + int(k)
                inner = np.flatnonzero(t.feature[at] >= 0)
                node = at[inner]
                at[inner] = t.children[node, np.where(x[inner, t.feature[node]] <= t.threshold[node], 0, 1)]
        if total:
            d, a, b = zip(*total)
            yield pa.RecordBatch.from_pydict({"d": pa.array(d, pa.int32()), "y": pa.array(a, pa.int64()),
                                              "p": pa.array(b, pa.int64()), "n": pa.array(total.values(), pa.int64())})

    found = rows.mapInArrow(run, "d int, y bigint, p bigint, n bigint").groupBy("d", "y", "p").agg(F.sum("n").alias("n")).collect()
    shared.unpersist()
    out = []
    for d in range(depth + 1):
        own = {(r["y"], r["p"]): r["n"] for r in found if r["d"] == d}
        known = sorted({k for pair in own for k in pair})
        hits = np.array([own.get((k, k), 0) for k in known], float)
        true = np.array([sum(n for (y, _), n in own.items() if y == k) for k in known], float)
        told = np.array([sum(n for (_, p), n in own.items() if p == k) for k in known], float)
        share = lambda a, b: float(np.divide(a, b, out=np.zeros_like(a), where=b > 0).mean()) if len(a) else 0.0
        out.append({"accuracy": float(hits.sum() / max(true.sum(), 1)), "macro_precision": share(hits, told),
                    "macro_recall": share(hits, true), "macro_f1": share(2 * hits, true + told)})
    return out
