"""Two-sample tests of columns with very many values, without shuffling them.

Sketched quantiles of both samples part a column into thin ranges. One scan counts and sums the values of each range, so
both running shares are exact at its ends. Inside a range the shares can't differ by more than its ends allow: ranges that
can't hold the largest gap need no look inside for the Kolmogorov-Smirnov statistic, and where the difference keeps its sign
the area between the shares follows from counts and sums. Only values of the other ranges are grouped, so results equal
those over all value counts.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window, functions as F

from txnlens.functions.stats import number
from txnlens.operators.distribution import _bucketed, _split_points
from txnlens.session import materialize

#: Quantiles of each sample that part a column; a range holds about this share of a sample.
POINTS = 1000
_ACCURACY = 10


def range_points(ref: DataFrame, ana: DataFrame, columns, points: int = POINTS) -> dict[str, list[float]]:
    """Split points by column: sketched quantiles of both samples, each with the next larger number."""
    shares = f"array({', '.join(f'{i / points!r}D' for i in range(points + 1))})"
    found: dict[str, set] = {c: set() for c in columns}
    for df in (ref, ana):
        frame = df.select(*[number(c).alias(f"x_{i}") for i, c in enumerate(columns)])
        # one row; the arrays are as long as the grid
        one = frame.agg(*[F.expr(f"percentile_approx(x_{i}, {shares}, {_ACCURACY * points})").alias(f"q_{i}")
                          for i in range(len(columns))], *[f(f"x_{i}").alias(f"{f.__name__}_{i}") for f in (F.min, F.max)
                                                            for i in range(len(columns))]).first()
        for i, c in enumerate(columns):
            ends = [x for x in (one[f"min_{i}"], one[f"max_{i}"]) if x is not None]
            found[c] |= {float(x) + 0.0 for x in [*(one[f"q_{i}"] or []), *ends]}
    return {c: _split_points(y for x in xs for y in (x, math.nextafter(x, math.inf))) for c, xs in found.items()}


def wide_two_sample(ref: DataFrame, ana: DataFrame, columns, points: int = POINTS) -> DataFrame:
    """(feature, ks_stat, area, std, n, m): largest gap and area between the running shares, spread and sizes.

    Values are finite; missing ones are left out.
    """
    columns = list(columns)
    spark = ref.sparkSession
    splits = range_points(ref, ana, columns, points)
    tagged = ref.select(F.lit(1).alias("ref"), *columns).unionByName(ana.select(F.lit(0).alias("ref"), *columns))
    placed = _bucketed(tagged, splits, ["ref"])
    is_ref = F.col("ref") == 1
    of = lambda f, flag, v: f(F.when(flag, v))
    cells = placed.groupBy("feature", "k").agg(
        F.count_if(is_ref).alias("a"), F.count_if(~is_ref).alias("b"), of(F.sum, is_ref, F.col("value")).alias("a_sum"),
        of(F.sum, ~is_ref, F.col("value")).alias("b_sum"))
    # as many rows as split points: each range with its bounds; a range from a point to the next number is that point
    grid = spark.createDataFrame(
        [(c, k, s[k], s[k + 1], s[k + 1] == math.nextafter(s[k], math.inf)) for c, s in splits.items()
         for k in range(len(s) - 1)], "feature string, k int, low double, high double, single boolean")
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    cells = materialize(grid.join(F.broadcast(cells), ["feature", "k"], "left").select(
        "feature", "k", "low", "high", "single", *[zero(c) for c in ("a", "b", "a_sum", "b_sum")]), "ranges")
    whole = cells.groupBy("feature").agg(F.sum("a").alias("n"), F.sum("b").alias("m"))
    order = Window.partitionBy("feature").orderBy("k")
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    run = cells.join(F.broadcast(whole), "feature").withColumns(
        {"f1": F.sum("a").over(upto) / F.col("n"), "g1": F.sum("b").over(upto) / F.col("m")})
    run = run.withColumns({"f0": F.col("f1") - F.col("a") / F.col("n"), "g0": F.col("g1") - F.col("b") / F.col("m")})
    # shares are sums of whole numbers over one total, so what is left of rounding is far below a row's share
    slack = F.lit(1e-12)
    least = F.max(F.abs(F.col("f1") - F.col("g1"))).over(Window.partitionBy("feature"))
    most = F.greatest(F.col("f1") - F.col("g0"), F.col("g1") - F.col("f0"))
    turns = (F.col("f0") - F.col("g1") < -slack) & (F.col("f1") - F.col("g0") > slack)
    run = run.withColumns({"least": least, "inside": ~F.col("single") & (F.col("a") + F.col("b") > 0)}).withColumn(
        "look", F.col("inside") & ((most > F.col("least") + slack) | turns))
    # the area of a range reaches from its lower point to the next point
    width = F.col("high") - F.col("low")
    plain = F.abs((F.col("f0") - F.col("g0")) * width + (F.col("a") * F.col("high") - F.col("a_sum")) / F.col("n")
                  - (F.col("b") * F.col("high") - F.col("b_sum")) / F.col("m"))
    outer = (F.col("low") == -math.inf) | (F.col("high") == math.inf)
    run = materialize(run.withColumn("area", F.when(outer | F.col("single") | F.col("look"), 0.0).otherwise(plain)), "ranges")

    asked = run.where("look").select("feature", "k", "low", "high", "f0", "g0", "n", "m")
    values = placed.join(F.broadcast(asked), ["feature", "k"]).groupBy("feature", "k", "value").agg(
        F.count_if(is_ref).alias("a"), F.count_if(~is_ref).alias("b"), *[F.first(c).alias(c) for c in asked.columns[2:]])
    each = Window.partitionBy("feature", "k").orderBy("value")
    through = each.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    gap = F.abs(F.col("f0") + F.sum("a").over(through) / F.col("n") - F.col("g0") - F.sum("b").over(through) / F.col("m"))
    steps = values.withColumns({"gap": gap, "next": F.coalesce(F.lead("value").over(each), F.col("high")),
                                "first": F.row_number().over(each) == 1})
    before = F.when(F.col("first"), F.abs(F.col("f0") - F.col("g0")) * (F.col("value") - F.col("low"))).otherwise(0.0)
    looked = steps.groupBy("feature").agg(F.max("gap").alias("gap"),
                                          F.sum(F.col("gap") * (F.col("next") - F.col("value")) + before).alias("more"))
    spread = ref.agg(*[F.stddev_pop(number(c)).alias(c) for c in columns]).unpivot([], columns, "feature", "std")
    found = run.groupBy("feature").agg(F.max("least").alias("least"), F.sum("area").alias("area"), F.first("n").alias("n"),
                                       F.first("m").alias("m"))
    return found.join(looked, "feature", "left").join(spread, "feature").select(
        "feature", F.greatest("least", F.coalesce("gap", F.lit(0.0))).alias("ks_stat"),
        (F.col("area") + F.coalesce("more", F.lit(0.0))).alias("area"), "std", "n", "m")
