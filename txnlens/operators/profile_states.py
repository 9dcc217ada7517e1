"""Profiles kept as mergeable states, one for each appended batch, so that an append reads only its own rows.

A column's state holds counts, bounds, mean and squared deviations (which merge exactly), and sketches of bounded size for
distinct values, quantiles and frequent values (which merge within their error). A profile of the whole table is merged
from the states alone. :func:`verified_top` counts the candidates for the most frequent value exactly, by one scan that
shuffles nothing but those counts; exact distinct counts stay with :func:`txnlens.operators.profiling.profile_table`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from txnlens.functions.stats import number
from txnlens.operators.distribution import missing
from txnlens.operators.profiling import numeric_columns, text_columns

#: Values that a frequent-items sketch follows; one with more than 1/750 of the rows is never missed.
TRACKED = 1000
#: Candidates that are counted exactly.
CANDIDATES = 100
_KLL = 400
_HLL = 14


def profiled_columns(df: DataFrame, columns=None) -> tuple[list[str], list[str]]:
    """(numeric, text) columns that have a profile."""
    keep = set(columns or df.columns)
    return [c for c in numeric_columns(df) if c in keep], [c for c in text_columns(df) if c in keep]


def column_states(df: DataFrame, columns=None) -> DataFrame:
    """One row per numeric or text column with its state, from one pass over the rows."""
    numeric, text = profiled_columns(df, columns)
    # plain names, since the sketches are asked for in SQL
    names = {c: f"c_{i}" for i, c in enumerate(numeric + text)}
    rows = df.select(*[number(c).cast("double").alias(names[c]) if c in numeric else
                       F.when(~missing(df, c), F.col(f"`{c}`")).alias(names[c]) for c in names])
    aggs = []
    for c, x in names.items():
        is_number = c in numeric
        none = "cast(null as double)"
        value = f"if({x} = 0, 0.0D, {x})" if is_number else x  # -0.0 is 0.0
        fields = {
            "n_rows": "count(1)", "n": f"count({x})", "n_zero": f"count_if({x} = 0)" if is_number else "cast(null as bigint)",
            "min_value": f"min({x})" if is_number else none, "max_value": f"max({x})" if is_number else none,
            "mean": f"avg({x})" if is_number else none, "m2": f"var_pop({x}) * count({x})" if is_number else none,
            "distinct": f"hll_sketch_agg(cast({value} as string), {_HLL})",
            "ranks": f"kll_sketch_agg_double({x}, {_KLL})" if is_number else "cast(null as binary)",
            "frequent": f"approx_top_k_accumulate(cast({value} as string), {TRACKED})",
        }
        aggs += [F.expr(sql).alias(f"{x}__{f}") for f, sql in fields.items()]
    one = rows.agg(*aggs)
    return one.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.lit(c in numeric).alias("is_number"),
                 *[F.col(f"{x}__{f}").alias(f) for f in fields]) for c, x in names.items()])))


def merge_states(states: DataFrame) -> DataFrame:
    """(column_name, n_rows, n_null, ..) of all rows behind the states; a state is a few kilobytes, whatever its rows."""
    n, mean = F.col("n"), F.col("mean")
    whole = states.groupBy("column_name").agg(F.try_divide(F.sum(n * mean), F.sum(F.when(mean.isNotNull(), n))).alias("mean"))
    both = states.join(whole.withColumnRenamed("mean", "whole"), "column_name")
    some = F.col("n") > 0
    merged = both.groupBy("column_name", "is_number").agg(
        F.sum("n_rows").alias("n_rows"), (F.sum("n_rows") - F.sum("n")).alias("n_null"), F.sum("n_zero").alias("n_zero"),
        F.min("min_value").alias("min_value"), F.max("max_value").alias("max_value"), F.first("whole").alias("mean"),
        F.sum("n").alias("n"),
        F.sum(F.when(some, F.col("m2") + n * F.pow(mean - F.col("whole"), 2))).alias("m2"),
        F.expr("hll_sketch_estimate(hll_union_agg(distinct))").alias("n_distinct"),
        F.expr(f"approx_top_k_estimate(approx_top_k_combine(frequent, {TRACKED}), 1)").alias("top"),
        F.expr("kll_merge_agg_double(ranks) filter (where is_number and n > 0)").alias("ranks"))
    quartile = F.when(F.col("is_number") & (F.col("n") > 0),
                      F.expr("kll_sketch_get_quantile_double(ranks, array(0.25D, 0.5D, 0.75D))"))
    top = F.get("top", F.lit(0))
    return merged.withColumn("q", quartile).select(
        "column_name", "n_rows", "n_null", "min_value", "max_value", "mean",
        F.sqrt(F.try_divide(F.col("m2"), F.when(F.col("n") > 1, F.col("n") - 1))).alias("std"), "n_zero", "n_distinct",
        F.col("q")[0].alias("q1"), F.col("q")[1].alias("median"), F.col("q")[2].alias("q3"),
        top["item"].alias("top_value"), top["count"].alias("top_count"))


def verified_top(rows: DataFrame, states: DataFrame, columns=None) -> DataFrame:
    """(column_name, top_value, top_count): the most frequent of the sketches' candidates, counted in the rows.

    Ties go to the smaller value, numbers as numbers. The candidates are at most CANDIDATES for each column.
    """
    numeric, text = profiled_columns(rows, columns)
    top = states.groupBy("column_name").agg(
        F.expr(f"approx_top_k_estimate(approx_top_k_combine(frequent, {TRACKED}), {CANDIDATES})").alias("top"))
    wanted = top.select("column_name", F.explode("top.item").alias("value"))
    plain = lambda c: F.when(number(c).cast("double") == 0, F.lit(0.0)).otherwise(number(c).cast("double")).cast("string")
    cells = [F.struct(F.lit(c).alias("column_name"), (plain(c) if c in numeric else F.col(f"`{c}`")).alias("value"))
             for c in numeric + text]
    found = rows.select(F.inline(F.array(*cells))).join(F.broadcast(wanted), ["column_name", "value"]) \
        .groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n"))
    best = F.min_by(F.struct("value", "n"), F.struct(-F.col("n"), F.expr("try_cast(value as double)"), "value"))
    return found.groupBy("column_name").agg(best.alias("b")).select(
        "column_name", F.col("b.value").alias("top_value"), F.col("b.n").alias("top_count"))

