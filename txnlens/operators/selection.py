"""Feature selection: correlation, one-way F scores, forest importance, recursive elimination, combination."""

from __future__ import annotations

from functools import reduce
from itertools import combinations

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler, VectorSlicer
from pyspark.ml.stat import Correlation
from pyspark.sql import DataFrame, functions as F
from pyspark.storagelevel import StorageLevel

from txnlens.functions.stats import number
from txnlens.operators.binned_forest import MOST_CLASSES, BinnedRows, bin_rows, forest_rows, importances
from txnlens.operators.ingest import drop_listed_features
from txnlens.roles import TARGET

CORRELATION_LIMIT = 0.7
#: From so many rows on importance comes from forests over binned blocks; Spark's take about ten times as long.
BINNED_ROWS = 250_000
_PAIRS_IN_ONE_PASS = 200
_PAIR_SCHEMA = "feature_a string, feature_b string, abs_corr double"


def correlation_matrix(df: DataFrame, columns) -> DataFrame:
    """(feature_a, feature_b, abs_corr) for all ordered pairs, each over rows where both are present.

    Null where a column is constant. Columns without nulls go through one distributed matrix product, which
    also serves very wide frames; only pairs with a column that has nulls need aggregates of their own.
    """
    columns = list(columns)
    x = df.select(*[number(c).alias(c) for c in columns])  # NaN is a gap like null
    # one row: nulls and spread per column
    one = x.agg(*[F.count_if(F.col(c).isNull()).alias(f"n_{i}") for i, c in enumerate(columns)],
                *[F.stddev_pop(c).alias(f"s_{i}") for i, c in enumerate(columns)]).first()
    holes = {c for i, c in enumerate(columns) if one[f"n_{i}"]}
    varying = {c for i, c in enumerate(columns) if one[f"s_{i}"]}
    whole = [c for c in columns if c not in holes and c in varying]
    found = {(a, b): None for a in columns for b in columns if not {a, b} <= varying}
    found |= {(c, c): 1.0 for c in varying}
    if len(whole) > 1:
        found |= _vector_correlation(x, whole)
    parts = [df.sparkSession.createDataFrame([(a, b, r) for (a, b), r in found.items()], _PAIR_SCHEMA)]
    pairs = [(a, b) for a, b in combinations(columns, 2) if {a, b} & holes and {a, b} <= varying]
    parts += [_pairwise_correlation(x, pairs[i:i + _PAIRS_IN_ONE_PASS]) for i in range(0, len(pairs), _PAIRS_IN_ONE_PASS)]
    return reduce(DataFrame.unionByName, parts)


def _vector_correlation(x: DataFrame, columns) -> dict[tuple[str, str], float | None]:
    """The matrix has one cell per pair of columns and comes to the driver."""
    vectors = VectorAssembler(inputCols=columns, outputCol="v").transform(x.select(*columns)).select("v")
    m = Correlation.corr(vectors, "v").head()[0].toArray()
    return {(a, b): abs(float(m[i, j])) for i, a in enumerate(columns) for j, b in enumerate(columns)}


def _pairwise_correlation(x: DataFrame, pairs) -> DataFrame:
    # regr_r2(y, x) is null for a constant x and 1 for a constant y, so both directions are asked
    one = x.agg(*[f.alias(f"{side}_{i}") for i, (a, b) in enumerate(pairs)
                  for side, f in (("u", F.regr_r2(a, b)), ("v", F.regr_r2(b, a)))])
    cells = []
    for i, (a, b) in enumerate(pairs):
        r = F.sqrt(F.when(F.col(f"u_{i}").isNotNull() & F.col(f"v_{i}").isNotNull(), F.col(f"u_{i}")))
        cells += [F.struct(F.lit(p).alias("feature_a"), F.lit(q).alias("feature_b"), r.alias("abs_corr"))
                  for p, q in ((a, b), (b, a))]
    return one.select(F.inline(F.array(*cells)))


def high_corr_pairs(matrix: DataFrame, limit: float = CORRELATION_LIMIT) -> DataFrame:
    return matrix.where((F.col("abs_corr") > limit) & (F.col("feature_a") < F.col("feature_b")))


def anova_f(df: DataFrame, columns, target: str = TARGET) -> DataFrame:
    """(feature, position, f_score): one-way F per column from per-class counts, means and variances."""
    columns = list(columns)
    per_class = df.groupBy(target).agg(
        *[F.count(number(c)).alias(f"n_{i}") for i, c in enumerate(columns)],
        *[F.avg(number(c)).alias(f"m_{i}") for i, c in enumerate(columns)],
        *[F.var_pop(number(c)).alias(f"v_{i}") for i, c in enumerate(columns)])
    long = per_class.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.lit(i).alias("position"), F.col(f"n_{i}").alias("n"),
                 F.col(f"m_{i}").alias("m"), F.col(f"v_{i}").alias("v")) for i, c in enumerate(columns)])))
    # between and within sums of squares; the between part is taken around the weighted mean
    one = long.where("n > 0").groupBy("feature", "position").agg(
        F.count(F.lit(1)).alias("k"), F.sum("n").alias("n"), F.sum(F.col("n") * F.col("v")).alias("within"),
        (F.sum(F.col("n") * F.col("m")) / F.sum("n")).alias("grand"),
        F.collect_list(F.struct("n", "m")).alias("classes"))
    between = F.aggregate("classes", F.lit(0.0), lambda acc, c: acc + c["n"] * F.pow(c["m"] - F.col("grand"), 2))
    score = F.try_divide(between / (F.col("k") - 1), F.col("within") / (F.col("n") - F.col("k")))
    return one.select("feature", "position", score.alias("f_score"))


def select_k_best(scores: DataFrame, k: int = 10) -> DataFrame:
    """The k columns with the largest F, listed in table order; equal scores prefer the later column."""
    best = scores.orderBy(F.col("f_score").desc_nulls_last(), F.col("position").desc()).limit(k)
    return best.orderBy("position")


def assemble(df: DataFrame, columns, target: str = TARGET, out: str = "features") -> DataFrame:
    """Target as a double and one vector of the columns."""
    vectors = VectorAssembler(inputCols=list(columns), outputCol=out).transform(df)
    return vectors.select(F.col(target).cast("double").alias(target), out)


def _forest(features: str, target: str, trees: int, depth: int, seed: int) -> RandomForestClassifier:
    return RandomForestClassifier(featuresCol=features, labelCol=target, numTrees=trees, maxDepth=depth, seed=seed)


def _importances(df: DataFrame, vector: str, target: str, trees: int, depth: int, seed: int) -> list[float]:
    model = _forest(vector, target, trees, depth, seed).fit(df)
    return [float(x) for x in model.featureImportances.toArray()]


def _binned(frame: DataFrame, target: str, width: int) -> BinnedRows | None:
    """Stored blocks of an assembled frame; None if Spark's forest is to be taken, for few rows or labels that it may refuse."""
    label = F.col(target)
    one = frame.agg(F.count("*").alias("n"), F.count(target).alias("known"), F.min(label).alias("low"), F.max(label).alias("high"),
                    F.count_if(label != F.floor(label)).alias("odd")).first()
    if one["n"] < BINNED_ROWS or one["known"] < one["n"] or one["odd"] or one["low"] < 0 or one["high"] >= MOST_CLASSES:
        return None
    return bin_rows(forest_rows(frame, target), width, max(2, int(one["high"]) + 1))


def _scores(frame: DataFrame, data: BinnedRows | None, width: int, kept: list[int], target: str, trees: int, depth: int,
            seed: int) -> list[float]:
    """The importance of each kept column, from the blocks if there are any."""
    if data is not None:
        return importances(data, kept, trees, depth, seed)
    if len(kept) == width:
        return _importances(frame, "features", target, trees, depth, seed)
    sliced = VectorSlicer(inputCol="features", outputCol="kept", indices=kept).transform(frame)
    return _importances(sliced, "kept", target, trees, depth, seed)


def _ranked(frame: DataFrame, columns: list[str], scores: list[float]) -> DataFrame:
    rows = sorted(zip(columns, scores), key=lambda r: -r[1])
    return frame.sparkSession.createDataFrame(rows, "feature string, importance double")


def _eliminated(frame: DataFrame, data: BinnedRows | None, columns: list[str], n_features: int, target: str, trees: int,
                depth: int, seed: int, first: list[float] | None = None) -> DataFrame:
    """(feature, position) of the columns that elimination leaves; each round grows a distributed forest on what is kept.

    ``first`` are the scores of all columns where they are known already.
    """
    kept = list(range(len(columns)))
    while len(kept) > n_features:
        scores = first or _scores(frame, data, len(columns), kept, target, trees, depth, seed)
        kept.pop(min(range(len(kept)), key=lambda i: scores[i]))
        first = None
    return frame.sparkSession.createDataFrame([(columns[i], i) for i in kept], "feature string, position int")


def rf_importance(df: DataFrame, columns, target: str = TARGET, trees: int = 100, depth: int = 5,
                  seed: int = 42) -> DataFrame:
    """(feature, importance) in descending order."""
    columns = list(columns)
    frame = assemble(df, columns, target)
    data = _binned(frame, target, len(columns))
    return _ranked(frame, columns, _scores(frame, data, len(columns), list(range(len(columns))), target, trees, depth, seed))


def rfe(df: DataFrame, columns, n_features: int = 10, target: str = TARGET, trees: int = 100, depth: int = 5,
        seed: int = 42) -> DataFrame:
    """(feature, position): what is left after repeatedly dropping the least important column.

    The assembled frame is stored once, as blocks of bins if it is large.
    """
    columns = list(columns)
    frame = assemble(df, columns, target).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        data = _binned(frame, target, len(columns)) if len(columns) > n_features else None
        return _eliminated(frame, data, columns, n_features, target, trees, depth, seed)
    finally:
        frame.unpersist()


def combine_selections(importance: DataFrame, k_best: DataFrame, eliminated: DataFrame, method: str = "union",
                       top_n: int = 10) -> DataFrame:
    """Ranked (feature, importance, in_top, in_k_best, in_rfe, selected) over all columns."""
    top = importance.orderBy(F.desc("importance"), "feature").limit(top_n).select(
        "feature", F.lit(True).alias("in_top"))
    flagged = (
        importance.join(F.broadcast(top), "feature", "left")
        .join(F.broadcast(k_best.select("feature", F.lit(True).alias("in_k_best"))), "feature", "left")
        .join(F.broadcast(eliminated.select("feature", F.lit(True).alias("in_rfe"))), "feature", "left")
        .na.fill(False))
    if method == "intersection":
        selected = F.col("in_k_best") & F.col("in_rfe")
    elif method == "weighted":
        selected = F.col("in_top") | F.col("in_k_best") | F.col("in_rfe")
    else:
        selected = F.col("in_k_best") | F.col("in_rfe")
    return flagged.withColumn("selected", selected).orderBy(F.desc("importance"), "feature")


def select_features(df: DataFrame, columns, drifted=(), target: str = TARGET, method: str = "union", k_best: int = 10,
                    n_features: int = 10, top_n: int = 10, trees: int = 100, depth: int = 5,
                    seed: int = 42) -> DataFrame:
    """Drop drifted columns, score the rest three ways on one stored frame, and combine.

    Importance and elimination read the same blocks of bins if the frame is large, and the frame is let go before forests
    grow; the forest over all columns is the first of the elimination.
    """
    stable = [c for c in drop_listed_features(df, drifted).columns if c in set(columns)]
    frame = df.select(target, *stable).persist(StorageLevel.MEMORY_AND_DISK)
    assembled = assemble(frame, stable, target)
    try:
        best = select_k_best(anova_f(frame, stable, target), k_best)
        best = df.sparkSession.createDataFrame(best.collect(), best.schema)  # k rows
        data = _binned(assembled, target, len(stable))
        if data is None:
            assembled.persist(StorageLevel.MEMORY_AND_DISK)
        else:
            frame.unpersist()
        scores = _scores(assembled, data, len(stable), list(range(len(stable))), target, trees, depth, seed)
        importance = _ranked(assembled, stable, scores)
        left = _eliminated(assembled, data, stable, n_features, target, trees, depth, seed, scores)
    finally:
        assembled.unpersist()
        frame.unpersist()
    return combine_selections(importance, best, left, method, top_n)
