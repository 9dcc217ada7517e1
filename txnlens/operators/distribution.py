"""Exact distributions of numeric columns: value counts, running counts, quantiles, counts below a point.

Most operators start from the counts of distinct values, so a value that fills a third of the table is one
row here. Running counts are taken inside value ranges of bounded size and then shifted by the totals of the
ranges before them, so no task ever holds all values of a column.

Columns with very many distinct values are not shuffled at all: a sketch brackets each wanted quantile, one
more pass keeps the values inside the brackets and only counts those between them, and the exact quantile is
picked from what was kept.
"""

from __future__ import annotations

import math
from fractions import Fraction
from functools import reduce

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import DoubleType, FloatType

from txnlens.functions.stats import number
from txnlens.session import materialize

ROWS_PER_RANGE = 200_000
MAX_RANGES = 2000
MANY_VALUES = 1_000_000
SKETCH_ACCURACY = 10_000
_RANK_BINS = 1024


def missing(df: DataFrame, column: str) -> Column:
    """True for null and, in floating columns, for NaN."""
    absent = F.col(column).isNull()
    floating = isinstance(df.schema[column].dataType, (DoubleType, FloatType))
    return absent | F.isnan(column) if floating else absent


def numeric_counts(samples: dict[str, DataFrame], columns) -> DataFrame:
    """(feature, value, one count per sample) over all distinct values, as a stored table.

    Nulls and NaN count as missing and are left out.
    """
    def tagged(name: str, df: DataFrame) -> DataFrame:
        flags = [F.lit(int(name == other)).cast("bigint").alias(other) for other in samples]
        return df.select(*flags, *[F.col(c).cast("double").alias(c) for c in columns])

    rows = reduce(DataFrame.unionByName, [tagged(n, d) for n, d in samples.items()])
    long = rows.unpivot(list(samples), list(columns), "feature", "value")
    counts = (
        long.where(F.col("value").isNotNull() & ~F.isnan("value"))
        .groupBy("feature", "value")
        .agg(*[F.sum(n).alias(n) for n in samples])
    )
    return materialize(counts, "counts")


def _ranges(counts: DataFrame, rows_per_range: int) -> DataFrame | None:
    """Cut points (feature, cuts) that part each feature's distinct values; None if one range will do."""
    largest = counts.groupBy("feature").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
    pieces = min(MAX_RANGES, math.ceil(largest / rows_per_range))
    if pieces <= 1:
        return None
    shares = [i / pieces for i in range(1, pieces)]
    cuts = counts.groupBy("feature").agg(
        F.percentile_approx("value", shares, max(10_000, 20 * pieces)).alias("cuts")).collect()
    return counts.sparkSession.createDataFrame([(r["feature"], r["cuts"]) for r in cuts],
                                               "feature string, cuts array<double>")


def running_counts(counts: DataFrame, names, rows_per_range: int = ROWS_PER_RANGE,
                   marks: DataFrame | None = None) -> DataFrame:
    """Add ``<name>_to`` (count up to and including the row) and ``next_value`` to value counts.

    ``marks`` are extra rows (feature, value, kind) with count 0: kind 0 sorts before the equal value,
    kind 2 after it; the rows of ``counts`` have kind 1.
    """
    cuts = _ranges(counts, rows_per_range)
    rows = counts.withColumn("kind", F.lit(1))
    if marks is not None:
        zeros = [F.lit(0).cast("bigint").alias(n) for n in names]
        rows = rows.select("feature", "value", *names, "kind").unionByName(
            marks.select("feature", "value", *zeros, "kind"))
    order = ["value", "kind"]
    if cuts is None:
        w = Window.partitionBy("feature").orderBy(*order)
        upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        return rows.withColumns({**{f"{n}_to": F.sum(n).over(upto) for n in names},
                                 "next_value": F.lead("value").over(w)})
    part = F.size(F.filter("cuts", lambda c: c <= F.col("value")))
    rows = rows.join(F.broadcast(cuts), "feature").withColumn("part", part).drop("cuts")
    before = Window.partitionBy("feature").orderBy("part")
    offsets = (
        rows.groupBy("feature", "part")
        .agg(*[F.sum(n).alias(f"{n}_in") for n in names], F.min("value").alias("first_value"))
        .select("feature", "part", F.lead("first_value").over(before).alias("after"),
                *[F.coalesce(F.sum(f"{n}_in").over(before.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
                  .alias(f"{n}_before") for n in names])
    )
    w = Window.partitionBy("feature", "part").orderBy(*order)
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = rows.withColumns({**{f"{n}_to": F.sum(n).over(upto) for n in names},
                              "next_value": F.lead("value").over(w)})
    # offsets has one row per feature and range
    joined = local.join(F.broadcast(offsets), ["feature", "part"])
    return joined.withColumns({
        **{f"{n}_to": F.col(f"{n}_to") + F.col(f"{n}_before") for n in names},
        "next_value": F.coalesce("next_value", "after"),
    }).drop("part", "after", *[f"{n}_before" for n in names])


def totals(counts: DataFrame, names) -> DataFrame:
    return counts.groupBy("feature").agg(*[F.sum(n).alias(f"{n}_total") for n in names])


def quantiles(counts: DataFrame, name: str, grid, rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """(feature, num, den, value, sure): linearly interpolated quantiles at the fractions num/den.

    A fraction falls between two ranks; the rows that hold these ranks are found by an equi-join on
    coarse rank bins, so the cost per row does not grow with the number of fractions. If ``counts`` has a
    ``gap`` column, a quantile that falls on a gap row is not ``sure``.
    """
    gap = F.col("gap") if "gap" in counts.columns else F.lit(False)
    rows = (running_counts(counts.select("feature", "value", name, gap.alias("gap")), [name], rows_per_range)
            .where(F.col(name) > 0))
    size = totals(counts, [name]).withColumnRenamed(f"{name}_total", "total").where("total > 0")
    width = F.expr(f"greatest(1, total div {_RANK_BINS})")
    # one row per feature and fraction
    asked = (
        size.select("feature", "total", F.explode(F.split(F.lit(" ".join(f"{a}/{b}" for a, b in grid)), " ")).alias("g"))
        .select("feature", "total", F.split("g", "/")[0].cast("bigint").alias("num"),
                F.split("g", "/")[1].cast("bigint").alias("den"))
        .withColumns({"low": F.expr("num * (total - 1) div den"),
                      "part": F.expr("((num * (total - 1)) % den) / cast(den as double)")})
        .withColumn("high", F.expr("least(low + 1, total - 1)"))
    )
    ranks = (
        asked.select("feature", "num", "den", "part", "total",
                     F.explode(F.array(F.struct(F.lit("low").alias("side"), F.col("low").alias("rank")),
                                       F.struct(F.lit("high").alias("side"), F.col("high").alias("rank"))))
                     .alias("r"))
        .select("feature", "num", "den", "part", F.col("r.side").alias("side"), F.col("r.rank").alias("rank"),
                F.expr(f"r.rank div greatest(1, total div {_RANK_BINS})").alias("bin"))
    )
    spans = (
        rows.join(F.broadcast(size), "feature")
        .select("feature", "value", "gap", (F.col(f"{name}_to") - F.col(name)).alias("start"),
                (F.col(f"{name}_to") - 1).alias("stop"), width.alias("width"))
        .withColumn("bin", F.explode(F.expr("sequence(start div width, stop div width)")))
    )
    hits = spans.join(F.broadcast(ranks), ["feature", "bin"]).where("rank between start and stop")
    picked = hits.groupBy("feature", "num", "den", "part").agg(
        F.max(F.when(F.col("side") == "low", F.col("value"))).alias("a"),
        F.max(F.when(F.col("side") == "high", F.col("value"))).alias("b"), (~F.max("gap")).alias("sure"))
    return picked.select("feature", "num", "den", # between equal ranks nothing is computed, so an infinity stays one
                         F.expr("if(a = b or part = 0, a, a + (b - a) * part)").alias("value"), "sure")


Brackets = dict[str, list[tuple[float, float]]]


def split_by_distinct(df: DataFrame, columns, many_values: int = MANY_VALUES) -> tuple[list[str], list[str]]:
    """(columns whose value counts make a small table, columns with more than ``many_values``), by estimate."""
    one = df.agg(*[F.approx_count_distinct(number(c)).alias(f"d_{i}") for i, c in enumerate(columns)]).first()
    few = [c for i, c in enumerate(columns) if one[f"d_{i}"] <= many_values]
    return few, [c for c in columns if c not in few]


def brackets(df: DataFrame, columns, grid, accuracy: int = SKETCH_ACCURACY, slack: float = 2.0) -> Brackets:
    """Ascending, disjoint value ranges that hold the quantiles of the grid, from one sketch pass.

    A sketched quantile is off by at most 1/accuracy of the ranks; the brackets reach ``slack`` times as far.
    """
    off = slack / accuracy
    shares = sorted({min(1.0, max(0.0, a / b + d)) for a, b in grid for d in (-off, off)})
    frame = df.select(*[number(c).alias(f"x_{i}") for i, c in enumerate(columns)])
    wanted = f"array({', '.join(f'{x!r}D' for x in shares)})"
    # one row; the arrays are as long as the grid
    one = frame.agg(*[F.expr(f"percentile_approx(x_{i}, {wanted}, {accuracy})").alias(f"q_{i}")
                      for i in range(len(columns))]).first()
    found: Brackets = {}
    for i, c in enumerate(columns):
        at = dict(zip(shares, one[f"q_{i}"] or []))
        merged: list[tuple[float, float]] = []
        for a, b in sorted(grid, key=lambda g: g[0] / g[1]) if at else ():
            low, high = at[max(0.0, a / b - off)], at[min(1.0, a / b + off)]
            if merged and low <= math.nextafter(merged[-1][1], math.inf):
                merged[-1] = (merged[-1][0], max(high, merged[-1][1]))
            else:
                merged.append((low, high))
        if merged:
            found[c] = merged
    return found


def _split_points(points) -> list[float]:
    """Ascending split points from -inf to inf, three at least."""
    inner = sorted({x + 0.0 for x in points} - {-math.inf, math.inf}) or [0.0]
    return [-math.inf, *inner, math.inf]


def _bucketed(df: DataFrame, splits: dict[str, list[float]], keep=()) -> DataFrame:
    """(keep.., feature, value, k): the bucket of each value among its column's ascending split points.

    The points reach from -inf to inf; a value of inf has a bucket of its own, numbered as the last point.
    """
    columns = list(splits)
    # -0.0 is 0.0 here as in a grouping
    plain = lambda x: F.when(x == 0, F.lit(0.0)).otherwise(x)
    rows = df.select(*keep, *[plain(F.col(c).cast("double")).alias(c) for c in columns])
    ks = [f"_k_{i}" for i in range(len(columns))]
    placed = Bucketizer(splitsArray=[splits[c] for c in columns], inputCols=columns, outputCols=ks,
                        handleInvalid="keep").transform(rows)
    cells = F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).alias("value"),
                                         F.when(F.col(c) == math.inf, F.lit(float(len(splits[c]) - 1)))
                                         .otherwise(F.col(k)).alias("k")) for c, k in zip(columns, ks)]))
    long = placed.select(*keep, cells.alias("cell")).select(*keep, "cell.*")
    return long.where(F.col("value").isNotNull() & ~F.isnan("value")).withColumn("k", F.col("k").cast("int"))


def bracket_counts(df: DataFrame, inside: Brackets) -> DataFrame:
    """Stored (feature, value, n, gap): counts of the values inside the brackets and one row per gap between."""
    inf = math.inf
    splits = {c: _split_points(x for low, high in b for x in (low, math.nextafter(high, inf)))
              for c, b in inside.items()}
    # a bucket is kept value by value if it begins in a bracket; a gap row stands at the split below it
    starts = df.sparkSession.createDataFrame(
        [(c, i, x, not any(low <= x <= high for low, high in inside[c])) for c, s in splits.items()
         for i, x in enumerate(s)], "feature string, k int, start double, gap boolean")
    rows = _bucketed(df, splits).join(F.broadcast(starts), ["feature", "k"])
    value = F.when(F.col("gap"), F.col("start")).otherwise(F.col("value"))
    return materialize(rows.select("feature", value.alias("value"), "gap").groupBy("feature", "value", "gap").agg(
        F.count(F.lit(1)).alias("n")).select("feature", "value", "n", "gap"), "counts")


def wide_quantiles(df: DataFrame, columns, grid, accuracy: int = SKETCH_ACCURACY, slack: float = 2.0) -> DataFrame:
    """Exact quantiles of columns with very many values from two scans and no shuffle of the values."""
    inside = brackets(df, columns, grid, accuracy, slack)
    if not inside:
        return df.sparkSession.createDataFrame([], "feature string, num bigint, den bigint, value double")
    found = materialize(quantiles(bracket_counts(df, inside), "n", grid), "quantiles")
    unsure = [r["feature"] for r in found.where("not sure").select("feature").distinct().collect()]  # column names
    exact = found.drop("sure")
    if unsure:
        again = quantiles(numeric_counts({"n": df}, unsure), "n", grid).drop("sure")
        exact = exact.where(~F.col("feature").isin(unsure)).unionByName(again)
    return exact


def column_quantiles(df: DataFrame, columns, probabilities, many_values: int = MANY_VALUES) -> DataFrame:
    """(feature, prob, value) for plain probabilities such as 0.25 or 0.99."""
    fractions = {float(p): Fraction(str(p)) for p in probabilities}
    grid = [(f.numerator, f.denominator) for f in fractions.values()]
    few, wide = split_by_distinct(df, columns, many_values)
    parts = [quantiles(numeric_counts({"n": df}, few), "n", grid).drop("sure")] if few else []
    parts += [wide_quantiles(df, wide, grid)] if wide else []
    found = reduce(DataFrame.unionByName, parts)
    prob = F.coalesce(*[F.when((F.col("num") == f.numerator) & (F.col("den") == f.denominator), F.lit(p))
                        for p, f in fractions.items()])
    return found.select("feature", prob.alias("prob"), "value")


def scan_counts_at(samples: dict[str, DataFrame], points: dict[str, list[float]]) -> DataFrame:
    """Like :func:`counts_at`, by one scan that counts each row's bucket among the points."""
    names = list(samples)
    splits = {c: _split_points(y for x in xs for y in (x, math.nextafter(x + 0.0, math.inf)))
              for c, xs in points.items()}
    place = {c: {x: k for k, x in enumerate(s)} for c, s in splits.items()}
    flagged = [df.select(*[F.lit(int(n == o)).cast("bigint").alias(o) for o in names], *points)
               for n, df in samples.items()]
    counts = _bucketed(reduce(DataFrame.unionByName, flagged), splits, names).groupBy("feature", "k").agg(
        *[F.sum(n).alias(n) for n in names])
    spark = counts.sparkSession
    # as many rows as split points
    grid = spark.createDataFrame([(c, k) for c, s in splits.items() for k in range(len(s))], "feature string, k int")
    w = Window.partitionBy("feature").orderBy("k").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    through = grid.join(counts, ["feature", "k"], "left").select(
        "feature", "k", *[F.sum(F.coalesce(n, F.lit(0))).over(w).alias(n) for n in names])

    def upto(c: str, x: float) -> int:
        """The last bucket with values up to x; that of inf is the last of all."""
        return len(splits[c]) - 1 if x == math.inf else place[c][math.nextafter(x + 0.0, math.inf)] - 1

    wanted = spark.createDataFrame([(c, x, place[c][x + 0.0] - 1, upto(c, x)) for c, xs in points.items() for x in set(xs)],
                                   "feature string, value double, k_lt int, k_le int")
    for side in ("lt", "le"):
        some = through.select("feature", F.col("k").alias(f"k_{side}"), *[F.col(n).alias(f"{n}_{side}") for n in names])
        wanted = wanted.join(some, ["feature", f"k_{side}"], "left")
    return wanted.na.fill(0, [f"{n}_{side}" for n in names for side in ("lt", "le")]).drop("k_lt", "k_le")


def counts_at(counts: DataFrame, points: DataFrame, names, rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """(feature, value, ``<name>_lt``, ``<name>_le``): counts below, and up to, each point."""
    distinct = points.select("feature", "value").distinct()
    marks = distinct.withColumn("kind", F.explode(F.array(F.lit(0), F.lit(2))))
    run = running_counts(counts, names, rows_per_range, marks).where("kind <> 1")
    pick = lambda n, kind: F.max(F.when(F.col("kind") == kind, F.col(f"{n}_to")))
    return run.groupBy("feature", "value").agg(
        *[pick(n, 0).alias(f"{n}_lt") for n in names], *[pick(n, 2).alias(f"{n}_le") for n in names])
