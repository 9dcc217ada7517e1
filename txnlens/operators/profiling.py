"""Column profiles: null shares, value counts, histograms, quartiles, and full table profiles."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import NumericType, StringType

from txnlens.operators.distribution import column_quantiles, missing, number, numeric_counts, quantiles
from txnlens.operators.encoding import category_counts, shares_of

QUARTILES = ((1, 4), (1, 2), (3, 4))


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)]


def text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]


def _to_rows(one: DataFrame, columns, fields) -> DataFrame:
    """One wide row of ``<column>__<field>`` values to one row per column."""
    return one.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column_name"), *[F.col(f"`{c}__{f}`").alias(f) for f in fields])
        for c in columns])))


def null_rates(df: DataFrame, columns=None) -> DataFrame:
    """(column_name, n_null, null_rate) for all columns in one pass; NaN counts as null."""
    columns = list(columns or df.columns)
    one = df.agg(*[F.count_if(missing(df, c)).alias(f"{c}__n_null") for c in columns],
                 *[F.avg(missing(df, c).cast("int")).alias(f"{c}__null_rate") for c in columns])
    return _to_rows(one, columns, ["n_null", "null_rate"])


def assert_no_nulls(df: DataFrame, columns=None) -> DataFrame:
    """The columns that hold any null; an empty result is the pass."""
    return null_rates(df, columns).where("n_null > 0").select("column_name", "n_null")


def columns_with_nulls(df: DataFrame) -> list[str]:
    return [r["column_name"] for r in assert_no_nulls(df).collect()]  # one row per column at most


def value_counts(df: DataFrame, columns) -> DataFrame:
    """(feature, value, n, share) of the non-null values."""
    return shares_of(category_counts(df, columns))


def rare_category_report(df: DataFrame, columns, threshold: float = 0.01) -> DataFrame:
    return value_counts(df, columns).groupBy("feature").agg(
        F.count(F.lit(1)).alias("n_unique"), F.count_if(F.col("share") < threshold).alias("n_rare"))


def value_length_histogram(df: DataFrame, column: str = "zip") -> DataFrame:
    return df.groupBy(F.length(F.col(column).cast("string")).alias("len")).agg(F.count(F.lit(1)).alias("n"))


def histogram_numeric(df: DataFrame, columns, bins: int = 50) -> DataFrame:
    """(feature, bin, low, high, n): equal-width bins from minimum to maximum, the last one closed.

    Bins without a value are listed with 0.
    """
    columns = list(columns)
    # one row per column
    edges = _to_rows(df.agg(*[F.min(number(c)).alias(f"{c}__low") for c in columns],
                            *[F.max(number(c)).alias(f"{c}__high") for c in columns]), columns, ["low", "high"])
    bounds = {r["column_name"]: (r["low"], r["high"]) for r in edges.collect() if r["low"] is not None}

    def slot(c: str):
        low, high = bounds[c]
        width = (high - low) or 1.0
        at = F.floor((number(c) - low) / width * bins)
        return F.when(at >= bins, F.lit(bins - 1).cast("bigint")).otherwise(at)

    used = list(bounds)
    long = df.select(*[slot(c).alias(c) for c in used]).unpivot([], used, "feature", "bin").where("bin is not null")
    counts = long.groupBy("feature", "bin").agg(F.count(F.lit(1)).alias("n"))
    frame = df.sparkSession.createDataFrame([(c, lo, hi) for c, (lo, hi) in bounds.items()],
                                            "feature string, lo double, hi double")
    grid = frame.withColumn("bin", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(bins - 1).cast("bigint"))))
    step = (F.col("hi") - F.col("lo")) / bins
    return grid.join(counts, ["feature", "bin"], "left").select(
        "feature", "bin", (F.col("lo") + F.col("bin") * step).alias("low"),
        (F.col("lo") + (F.col("bin") + 1) * step).alias("high"), F.coalesce("n", F.lit(0)).alias("n"))


def box_stats(df: DataFrame, column: str = "amt") -> DataFrame:
    """Quartiles, interquartile range, upper fence, 99th percentile and maximum."""
    q = column_quantiles(df, [column], [0.25, 0.75, 0.99, 1.0])
    at = lambda p: F.max(F.when(F.col("prob") == p, F.col("value")))
    return (
        q.groupBy("feature").agg(at(0.25).alias("q1"), at(0.75).alias("q3"), at(0.99).alias("p99"),
                                 at(1.0).alias("max_value"))
        .withColumn("iqr", F.col("q3") - F.col("q1"))
        .withColumn("upper_fence", F.col("q3") + 1.5 * F.col("iqr"))
    )


def describe_table(df: DataFrame, columns=None) -> DataFrame:
    """count, mean, sample deviation, minimum, exact quartiles and maximum per numeric column."""
    columns = list(columns or numeric_columns(df))
    fields = {"n": F.count, "mean": F.avg, "std": F.stddev_samp, "min_value": F.min, "max_value": F.max}
    one = df.agg(*[f(number(c)).alias(f"{c}__{name}") for c in columns for name, f in fields.items()])
    moments = _to_rows(one, columns, list(fields)).withColumnRenamed("column_name", "feature")
    q = column_quantiles(df, columns, [0.25, 0.5, 0.75])
    at = lambda p: F.max(F.when(F.col("prob") == p, F.col("value")))
    quartiles = q.groupBy("feature").agg(at(0.25).alias("q1"), at(0.5).alias("median"), at(0.75).alias("q3"))
    return moments.join(quartiles, "feature", "left")


def _quartile_columns(counts: DataFrame) -> DataFrame:
    at = lambda num, den: F.max(F.when((F.col("num") == num) & (F.col("den") == den), F.col("value")))
    return quantiles(counts, "n", QUARTILES).groupBy("feature").agg(
        at(1, 4).alias("q1"), at(1, 2).alias("median"), at(3, 4).alias("q3"))


def profile_table(df: DataFrame, columns=None, exact: bool = True) -> DataFrame:
    """One row per numeric or text column.

    ``exact=False`` estimates the distinct counts and quartiles in the one pass and leaves out the most
    frequent value, for a first look at very large tables.
    """
    keep = [c for c in (columns or df.columns) if c in numeric_columns(df) + text_columns(df)]
    numeric = [c for c in keep if c in numeric_columns(df)]
    text = [c for c in keep if c not in numeric]
    null_double = F.lit(None).cast("double")
    aggs = []
    for c in keep:
        x = number(c) if c in numeric else null_double
        aggs += [
            F.count(F.lit(1)).alias(f"{c}__n_rows"), F.count_if(missing(df, c)).alias(f"{c}__n_null"),
            F.min(x).alias(f"{c}__min_value"), F.max(x).alias(f"{c}__max_value"), F.avg(x).alias(f"{c}__mean"),
            F.stddev_samp(x).alias(f"{c}__std"),
            (F.count_if(F.col(c) == 0) if c in numeric else F.lit(None).cast("bigint")).alias(f"{c}__n_zero"),
        ]
        if not exact:
            quart = F.percentile_approx(x, [0.25, 0.5, 0.75], 10_000)
            aggs += [F.approx_count_distinct(x if c in numeric else F.col(c)).alias(f"{c}__n_distinct"),
                     *[quart[i].alias(f"{c}__{q}") for i, q in enumerate(("q1", "median", "q3"))]]
    fields = ["n_rows", "n_null", "min_value", "max_value", "mean", "std", "n_zero"]
    if not exact:
        return _to_rows(df.agg(*aggs), keep, fields + ["n_distinct", "q1", "median", "q3"])
    base = _to_rows(df.agg(*aggs), keep, fields)
    return base.join(_exact_parts(df, numeric, text), "column_name", "left")


def _exact_parts(df: DataFrame, numeric, text) -> DataFrame:
    """Distinct count, most frequent value and quartiles from the counts of distinct values."""
    # most frequent value; ties go to the smaller one
    top = lambda v: F.min(F.struct((-F.col("n")).alias("rank"), v.alias("value")))
    parts = []
    if numeric:
        counts = numeric_counts({"n": df}, numeric)
        found = counts.groupBy("feature").agg(F.count(F.lit(1)).alias("n_distinct"),
                                              top(F.col("value")).alias("top"))
        parts.append(found.join(_quartile_columns(counts), "feature").select(
            "feature", "n_distinct", "q1", "median", "q3", F.lit(None).cast("string").alias("top_text"),
            F.col("top.value").alias("top_number"), (-F.col("top.rank")).alias("top_count")))
    if text:
        counts = category_counts(df, text)
        found = counts.groupBy("feature").agg(F.count(F.lit(1)).alias("n_distinct"),
                                              top(F.col("value")).alias("top"))
        none = F.lit(None).cast("double")
        parts.append(found.select(
            "feature", "n_distinct", none.alias("q1"), none.alias("median"), none.alias("q3"),
            F.col("top.value").alias("top_text"), none.alias("top_number"), (-F.col("top.rank")).alias("top_count")))
    return reduce(DataFrame.unionByName, parts).withColumnRenamed("feature", "column_name")


def table_statistics(df: DataFrame, bins: int = 20) -> dict[str, DataFrame]:
    """The statistics kept with a feature table: profile, histograms and correlations."""
    from txnlens.operators.selection import correlation_matrix

    numbers = numeric_columns(df)
    return {"profile": profile_table(df), "histograms": histogram_numeric(df, numbers, bins),
            "correlations": correlation_matrix(df, numbers)}
