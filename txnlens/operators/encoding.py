"""Encoders and the scaler, each as a fit that returns a small table and an apply that takes it."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from txnlens.functions.dates import cycle
from txnlens.functions.stats import number
from txnlens.operators.lookup import join_lookup, lookup_sizes
from txnlens.roles import CYCLE_LENGTHS
from txnlens.session import materialize

MAX_ONEHOT = 1000


def category_counts(df: DataFrame, columns) -> DataFrame:
    """(feature, value, n) over the non-null values of several columns in one pass."""
    text = df.select(*[F.col(c).cast("string").alias(c) for c in columns])
    long = text.unpivot([], list(columns), "feature", "value").where("value is not null")
    return long.groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n"))


def shares_of(counts: DataFrame) -> DataFrame:
    """Add each value's share of its feature; the totals have one row per feature."""
    total = counts.groupBy("feature").agg(F.sum("n").alias("total"))
    return counts.join(F.broadcast(total), "feature").select(
        "feature", "value", "n", (F.col("n") / F.col("total")).alias("share"))


def fit_onehot(df: DataFrame, columns, counts: DataFrame | None = None) -> DataFrame:
    """(feature, value, position): the categories of each column in ascending order, from 1.

    Refuses columns that are not low-cardinality before any list is built.
    """
    counts = category_counts(df, columns) if counts is None else counts
    limit = MAX_ONEHOT * len(columns)
    rows = counts.where(F.col("feature").isin(*columns)).select("feature", "value").take(limit + 1)
    listed = {c: sorted(r["value"] for r in rows if r["feature"] == c) for c in columns}
    if len(rows) > limit or any(len(v) > MAX_ONEHOT for v in listed.values()):
        raise ValueError(f"a one-hot column has more than {MAX_ONEHOT} categories; use frequency encoding")
    return df.sparkSession.createDataFrame(
        [(c, v, i) for c, values in listed.items() for i, v in enumerate(values, 1)],
        "feature string, value string, position int")


def onehot_name(column: str, value: str) -> str:
    return column if column == "invalid_zip" else f"{column}_{value}"


def onehot_plan(categories: DataFrame, columns) -> dict[str, list[str]]:
    """The fitted categories by column, at most MAX_ONEHOT each."""
    rows = sorted(categories.collect(), key=lambda r: r["position"])
    return {c: [r["value"] for r in rows if r["feature"] == c] for c in columns}


def apply_onehot(df: DataFrame, categories: DataFrame | dict, columns) -> DataFrame:
    """0/1 columns for all categories but the first; unknown values give zeros; sources are dropped."""
    plan = categories if isinstance(categories, dict) else onehot_plan(categories, columns)
    text = {c: F.col(c).cast("string") for c in columns}
    added = {onehot_name(c, v): F.coalesce((text[c] == F.lit(v)).cast("double"), F.lit(0.0))
             for c in columns for v in plan[c][1:]}
    kept = [F.col(c) for c in df.columns if c not in columns]
    return df.select(*kept, *[e.alias(n) for n, e in added.items()])


def onehot_columns(plan: dict[str, list[str]]) -> list[str]:
    return [onehot_name(c, v) for c, vals in plan.items() for v in vals[1:]]


def fit_freq(df: DataFrame, columns, counts: DataFrame | None = None) -> DataFrame:
    """Stored table (feature, value, n, share) with the share of each value among non-null ones."""
    counts = category_counts(df, columns) if counts is None else counts
    return materialize(shares_of(counts.where(F.col("feature").isin(*columns))), "shares")


def apply_freq(df: DataFrame, shares: DataFrame, columns, sizes: dict[str, int] | None = None) -> DataFrame:
    """``<column>_freq`` for each column, 0 for unseen or missing values; sources are dropped.

    ``sizes`` are the rows of ``shares`` per feature, counted here if not given.
    """
    sizes = lookup_sizes(shares, "feature") if sizes is None else sizes
    out = df
    for c in columns:
        known = shares.where(F.col("feature") == c).select("value", F.col("share").alias(f"{c}_freq"))
        out = join_lookup(out, known, c, "value", sizes.get(c, 0), f"{c}_freq")
    return out.na.fill(0.0, [f"{c}_freq" for c in columns]).drop(*columns)


def cyclic_encode(df: DataFrame, periods: dict[str, int] = CYCLE_LENGTHS) -> DataFrame:
    """``<c>_sin`` and ``<c>_cos`` for each cyclic column; sources are dropped."""
    added = {}
    for c, period in periods.items():
        added[f"{c}_sin"], added[f"{c}_cos"] = cycle(c, period)
    return df.withColumns(added).drop(*periods)


def fit_standard(df: DataFrame, columns) -> DataFrame:
    """(feature, mean, std) with the population deviation, all columns in one pass; NaN counts as missing."""
    one = df.agg(*[F.avg(number(c)).alias(f"{c}__mean") for c in columns],
                 *[F.stddev_pop(number(c)).alias(f"{c}__std") for c in columns])
    return one.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(f"{c}__mean").alias("mean"), F.col(f"{c}__std").alias("std"))
        for c in columns])))


def apply_standard(df: DataFrame, stats: DataFrame | dict, columns=None) -> DataFrame:
    """(x - mean) / std; a constant column is only centred. ``columns`` defaults to the fitted ones."""
    fitted = stats if isinstance(stats, dict) else {
        r["feature"]: (r["mean"], r["std"]) for r in stats.collect()}  # one row per column
    columns = [c for c in df.columns if c in fitted] if columns is None else columns
    return df.withColumns({c: (F.col(c) - F.lit(fitted[c][0])) / F.lit(fitted[c][1] or 1.0) for c in columns})
