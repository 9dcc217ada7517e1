"""Shapley values of tree scores, from the node tables of Spark's fitted trees.

A leaf's path holds every feature once, with the interval its splits leave and the share of training rows that go its way.
With the features outside a coalition averaged over those shares, the leaf's part of a feature's Shapley value is an integral
over t from 0 to 1 of the product of ``share (1 - t) + inside t`` over the path's other features. That is a polynomial,
so a few Gauss-Legendre points give it exactly, in time that grows with the square of a path's length.

The paths of a model are a table of bounded size (leaves x depth), shared with all tasks; rows stay where they are and only
sums by feature are shuffled. The explained score is the probability of class 1 of decision trees and forests, and the margin
of boosted trees. Features are numbers; a model with categorical splits is refused.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml import PipelineModel
from pyspark.ml.classification import DecisionTreeClassificationModel, GBTClassificationModel, RandomForestClassificationModel
from pyspark.sql import DataFrame, SparkSession, functions as F

from txnlens.operators.scoring import linear_attribution, model_columns
from txnlens.session import scratch_path

#: Largest model whose paths are shared with the tasks, in path entries (28 bytes each).
MOST_ENTRIES = 4_000_000
_ROWS = 256
_CELLS = 400_000
#: Longest paths whose patterns are all listed.
_LISTED_DEPTH = 8


@dataclass
class Paths:
    """Leaves with paths of one length: features, open lower and closed upper bounds, shares, and leaf values."""

    feature: np.ndarray
    low: np.ndarray
    high: np.ndarray
    share: np.ndarray
    value: np.ndarray


def node_table(model, spark: SparkSession) -> DataFrame:
    """(tree, weight, node, left_child, right_child, feature, threshold, categories, cover, value) of a fitted tree model."""
    folder = scratch_path(spark, "trees")
    model.write().save(folder)
    nodes = spark.read.parquet(f"{folder}/data")
    if isinstance(model, DecisionTreeClassificationModel):
        nodes = nodes.select(F.lit(0).alias("tree"), F.lit(1.0).alias("weight"), F.struct("*").alias("n"))
    else:
        weights = spark.createDataFrame([(i, float(w)) for i, w in enumerate(model.treeWeights)], "tree int, weight double")
        nodes = nodes.select(F.col("treeID").alias("tree"), F.col("nodeData").alias("n")).join(F.broadcast(weights), "tree")
    stats = F.col("n.impurityStats")
    if isinstance(model, GBTClassificationModel):
        cover, value = stats[0], F.col("n.prediction")
    else:
        cover = F.aggregate(stats, F.lit(0.0), lambda a, x: a + x)
        value = F.get(stats, F.lit(1)) / cover
    return nodes.select("tree", "weight", F.col("n.id").alias("node"), F.col("n.leftChild").alias("left_child"),
                        F.col("n.rightChild").alias("right_child"), F.col("n.split.featureIndex").alias("feature"),
                        F.get(F.col("n.split.leftCategoriesOrThreshold"), F.lit(0)).alias("threshold"),
                        F.col("n.split.numCategories").alias("categories"), cover.alias("cover"), value.alias("value"))


def paths_of(nodes: DataFrame, scale: float = 1.0) -> tuple[float, list[Paths]]:
    """The mean score over the training rows, and the paths by length. The node table of a model comes to the driver."""
    trees: dict[int, dict[int, tuple]] = {}
    for r in nodes.collect():  # as large as the model, which the driver holds anyway
        if r["left_child"] >= 0 and r["categories"] >= 0:
            raise ValueError("categorical splits have no attribution")
        trees.setdefault(r["tree"], {})[r["node"]] = r
    found: dict[int, list[tuple]] = {}
    base, entries = 0.0, 0
    for tree in trees.values():
        waiting = [(0, {}, 1.0)]
        while waiting:
            at, path, reach = waiting.pop()
            r = tree[at]
            if r["left_child"] < 0:
                value = r["value"] * r["weight"] * scale
                base += reach * value
                if path:
                    found.setdefault(len(path), []).append((path, value))
                    entries += len(path)
                    if entries > MOST_ENTRIES:
                        raise ValueError(f"the model's paths have more than {MOST_ENTRIES} entries")
                continue
            for child, inner in ((r["left_child"], True), (r["right_child"], False)):
                low, high, share = path.get(r["feature"], (-np.inf, np.inf, 1.0))
                part = tree[child]["cover"] / r["cover"] if r["cover"] else 0.0
                bounds = (low, min(high, r["threshold"])) if inner else (max(low, r["threshold"]), high)
                waiting.append((child, {**path, r["feature"]: (*bounds, share * part)}, reach * part))
    out = []
    for rows in found.values():
        table = np.array([[(f, *b) for f, b in p.items()] for p, _ in rows], float)
        out.append(Paths(table[:, :, 0].astype(np.int64), table[:, :, 1], table[:, :, 2], table[:, :, 3],
                         np.array([v for _, v in rows])))
    return base, out


def _parts(inside: np.ndarray, share: np.ndarray, value: np.ndarray) -> np.ndarray:
    """What each leaf adds to the value of each feature of its path, by row; ``inside`` says which intervals hold the row."""
    depth = share.shape[1]
    points, weights = np.polynomial.legendre.leggauss((depth + 1) // 2)  # exact for the path's polynomial
    total = np.zeros_like(inside)
    for t, w in zip((points + 1) / 2, weights / 2):
        factor = share * (1 - t) + inside * t
        before = np.ones_like(factor)
        before[:, :, 1:] = np.cumprod(factor[:, :, :-1], axis=2)
        after = np.ones_like(factor)
        after[:, :, :-1] = np.cumprod(factor[:, :, :0:-1], axis=2)[:, :, ::-1]
        total += w * before * after
    return total * (inside - share) * value[:, None]


def shapley(x: np.ndarray, paths: list[Paths], features: int) -> np.ndarray:
    """Values by row and feature.

    What a leaf adds depends only on which of its path's intervals hold the row, so with more rows than such patterns it is
    worked out once a pattern and looked up for the rows.
    """
    out = np.zeros((len(x), features))
    for p in paths:
        depth = p.feature.shape[1]
        listed = depth <= _LISTED_DEPTH and 1 << depth < len(x)
        block = max(1, _CELLS // (_ROWS * depth))
        for a in range(0, len(p.value), block):
            feature, share, value = p.feature[a:a + block], p.share[a:a + block], p.value[a:a + block]
            flat = feature.ravel()
            order = np.argsort(flat, kind="stable")
            begin = np.flatnonzero(np.append(True, np.diff(flat[order]) != 0))
            if listed:
                bits = 1 << np.arange(depth)
                patterns = (np.arange(1 << depth)[:, None] & bits > 0).astype(float)
                table = _parts(np.repeat(patterns[:, None], len(value), axis=1), share, value)
            for r in range(0, len(x), _ROWS):
                own = x[r:r + _ROWS][:, feature]
                inside = (own > p.low[a:a + block]) & (own <= p.high[a:a + block])
                part = table[inside @ bits, np.arange(len(value))] if listed else _parts(inside.astype(float), share, value)
                out[r:r + _ROWS, flat[order][begin]] += np.add.reduceat(part.reshape(len(own), -1)[:, order], begin, axis=1)
    return out


def _shared(model: PipelineModel, spark: SparkSession):
    learner = model.stages[-1]
    kinds = (DecisionTreeClassificationModel, RandomForestClassificationModel, GBTClassificationModel)
    if not isinstance(learner, kinds):
        raise ValueError(f"no tree attribution for {type(learner).__name__}")
    if learner.numClasses != 2:
        raise ValueError("tree attribution explains scores of two classes")
    scale = 1.0 / len(learner.trees) if isinstance(learner, RandomForestClassificationModel) else 1.0
    base, paths = paths_of(node_table(learner, spark), scale)
    return base, spark.sparkContext.broadcast(paths)


def _matrix(batch: pa.RecordBatch, first: int) -> np.ndarray:
    return np.stack([c.cast(pa.float64()).to_numpy(zero_copy_only=False) for c in batch.columns[first:]], axis=1)


def explain_rows(df: DataFrame, model: PipelineModel, *keys: str) -> DataFrame:
    """(keys, base, contributions): base plus the contributions, in the order of the model's columns, is the row's score."""
    columns = model_columns(model)
    base, paths = _shared(model, df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = shapley(_matrix(batch, len(keys)), paths.value, len(columns))
            parts = pa.array(list(values), pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([*batch.columns[:len(keys)], pa.array(np.full(len(values), base)), parts],
                                             [*keys, "base", "contributions"])
    source = df.select(*keys, *columns)
    kinds = "".join(f"`{k}` {source.schema[k].dataType.simpleString()}, " for k in keys)
    return source.mapInArrow(run, f"{kinds}base double, contributions array<double>")


def tree_attribution(df: DataFrame, model: PipelineModel) -> DataFrame:
    """(feature, mean_abs): mean of the absolute Shapley value per column of a tree model, largest first."""
    columns = model_columns(model)
    _base, paths = _shared(model, df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(len(columns)), 0
        for batch in batches:
            total += np.abs(shapley(_matrix(batch, 0), paths.value, len(columns))).sum(axis=0)
            n += batch.num_rows
        yield pa.RecordBatch.from_pydict({"position": pa.array(np.arange(len(columns), dtype=np.int32)),
                                          "total": pa.array(total), "n": pa.array(np.full(len(columns), n))})
    sums = df.select(*columns).mapInArrow(run, "position int, total double, n bigint").groupBy("position").agg(
        (F.sum("total") / F.sum("n")).alias("mean_abs"))
    name = F.element_at(F.array(*[F.lit(c) for c in columns]), F.col("position") + 1)
    return sums.select(name.alias("feature"), "mean_abs").orderBy(F.desc("mean_abs"), "feature")


def attribution(df: DataFrame, model: PipelineModel) -> DataFrame:
    """(feature, mean_abs) of a linear or tree model."""
    if hasattr(model.stages[-1], "coefficients"):
        return linear_attribution(df, model)
    return tree_attribution(df, model)
