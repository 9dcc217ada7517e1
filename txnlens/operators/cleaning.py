"""Cleaning and imputation. ``fit_*`` returns a small table, ``apply_*`` takes it."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import NumericType, StringType

from txnlens.operators.distribution import column_quantiles
from txnlens.operators.lookup import join_lookup, lookup_sizes
from txnlens.session import materialize

SENTINEL = -9999


def cap_min(df: DataFrame, column: str = "age", minimum: int = 16) -> DataFrame:
    c = F.col(column)
    return df.withColumn(column, F.when(c < minimum, F.lit(minimum)).otherwise(c).cast(df.schema[column].dataType))


def fill_sentinel(df: DataFrame, value: int = SENTINEL, skip=()) -> DataFrame:
    """Nulls of numeric and text columns become the sentinel; timestamps keep their nulls."""
    kinds = {f.name: f.dataType for f in df.schema.fields if f.name not in skip}
    numeric = [n for n, t in kinds.items() if isinstance(t, NumericType)]
    text = [n for n, t in kinds.items() if isinstance(t, StringType)]
    return df.na.fill(value, numeric).na.fill(str(value), text)


def fit_mode_lookup(df: DataFrame, keys=("city", "state"), value: str = "merch_zipcode") -> DataFrame:
    """Most frequent non-null value per key, ties to the smallest value, for all keys in one pass.

    Counts per (key, value) come first, so a hot key is already condensed when its best value is picked.
    """
    long = (
        df.where(F.col(value).isNotNull())
        .select(F.col(value).alias("_value"), *[F.col(k).cast("string").alias(k) for k in keys])
        .unpivot(["_value"], list(keys), "level", "key")
        .where("key is not null")
    )
    counts = long.groupBy("level", "key", "_value").agg(F.count(F.lit(1)).alias("n"))
    best = F.min(F.struct((-F.col("n")).alias("rank"), F.col("_value").alias("mode")))
    return materialize(counts.groupBy("level", "key").agg(best.alias("best")).select(
        "level", "key", F.col("best.mode").alias("mode"), (-F.col("best.rank")).alias("n")), "modes")


def impute_hierarchical(df: DataFrame, lookup: DataFrame, keys=("city", "state"),
                        value: str = "merch_zipcode", sizes: dict[str, int] | None = None) -> DataFrame:
    """Fill nulls from the first key that knows a value; what no key knows stays null."""
    sizes = lookup_sizes(lookup, "level") if sizes is None else sizes
    out = df
    for k in keys:
        level = lookup.where(F.col("level") == k).select("key", F.col("mode").alias("_mode"))
        out = join_lookup(out, level, k, "key", sizes.get(k, 0))
        out = out.withColumn(value, F.coalesce(F.col(value), F.col("_mode"))).drop("_mode")
    return out


def missing_flag(df: DataFrame, column: str = "merch_zipcode", flag: str = "zip_missing") -> DataFrame:
    return df.withColumn(flag, F.col(column).isNull().cast("int"))


def fit_quantile_cap(df: DataFrame, column: str = "amt", quantile: float = 0.99) -> DataFrame:
    """One row: the linearly interpolated quantile."""
    return column_quantiles(df, [column], [quantile]).select("feature", F.col("value").alias("cap"))


def apply_cap(df: DataFrame, cap: DataFrame | float, column: str = "amt") -> DataFrame:
    """Cut values above the cap and recompute the log column from the cut values."""
    limit = cap if isinstance(cap, (int, float)) else cap.where(F.col("feature") == column).first()["cap"]
    c = F.col(column)
    cut = df.withColumn(column, F.when(c > F.lit(limit), F.lit(float(limit))).otherwise(c))
    return cut.withColumn(f"log_{column}", F.log1p(column))
