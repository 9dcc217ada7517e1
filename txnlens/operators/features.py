"""Derived features."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from txnlens.functions import binning, dates
from txnlens.functions.geo import haversine_km
from txnlens.functions.text import mismatches
from txnlens.operators.encoding import category_counts, shares_of
from txnlens.operators.lookup import join_lookup
from txnlens.roles import CARD_PATTERN, EVENT_TIME, ZIP_PATTERN, Roles
from txnlens.session import materialize

RARE_SHARE = 0.01
OTHER = "Other"


def add_distance(df: DataFrame) -> DataFrame:
    return df.withColumn("distance", haversine_km("lat", "long", "merch_lat", "merch_long"))


def add_calendar_parts(df: DataFrame, time: str = EVENT_TIME) -> DataFrame:
    return df.withColumns(dates.calendar_parts(time))


def add_is_weekend(df: DataFrame, weekday: str = "weekday") -> DataFrame:
    return df.withColumn("is_weekend", dates.is_weekend(weekday))


def add_log_features(df: DataFrame, columns=("amt", "city_pop")) -> DataFrame:
    """``log_<column>`` = ln(1 + x); null where x is -1 or less, such as a sentinel."""
    return df.withColumns({f"log_{c}": F.log1p(c) for c in columns})


def add_amt_per_km(df: DataFrame) -> DataFrame:
    return df.withColumn("amt_per_km", F.col("amt") / (F.col("distance") + F.lit(0.01)))


def fit_rare_labels(df: DataFrame, column: str = "state", threshold: float = RARE_SHARE) -> DataFrame:
    """The labels (feature, value, share) whose share among non-null values is below the threshold."""
    shares = shares_of(category_counts(df, [column]))
    return materialize(shares.where(F.col("share") < threshold).select("feature", "value", "share"), "rare")


def apply_rare_labels(df: DataFrame, rare: DataFrame, column: str = "state", rows: int | None = None) -> DataFrame:
    """``<column>_grouped``: rare labels become 'Other', all else, also null, stays."""
    marks = rare.where(F.col("feature") == column).select("value", F.lit(True).alias("_rare"))
    joined = join_lookup(df, marks, column, "value", rows)
    grouped = F.when(F.col("_rare"), F.lit(OTHER)).otherwise(F.col(column))
    return joined.withColumn(f"{column}_grouped", grouped).drop("_rare")


def rare_label_group(df: DataFrame, column: str = "state", threshold: float = RARE_SHARE) -> DataFrame:
    return apply_rare_labels(df, fit_rare_labels(df, column, threshold), column)


def add_invalid_zip(df: DataFrame, column: str = "zip") -> DataFrame:
    return df.withColumn("invalid_zip", mismatches(column, ZIP_PATTERN))


def add_invalid_cc_num(df: DataFrame, column: str = "cc_num") -> DataFrame:
    return df.withColumn("invalid_cc_num", mismatches(column, CARD_PATTERN))


def add_numeric_features(df: DataFrame) -> DataFrame:
    return df.transform(add_distance).transform(add_log_features).transform(add_amt_per_km)


def feature_engineering(df: DataFrame, rare: DataFrame, roles: Roles = Roles(),
                        rare_rows: int | None = None) -> tuple[DataFrame, Roles]:
    """All derived features in their fixed order, with the roles they add.

    ``rare`` comes from :func:`fit_rare_labels` on training rows, so that scoring groups the same labels.
    """
    out = (
        df.transform(add_numeric_features).transform(add_calendar_parts).transform(add_is_weekend)
        .transform(lambda d: apply_rare_labels(d, rare, rows=rare_rows)).transform(add_invalid_zip)
    )
    added = roles.extended(
        numerical=("distance", "log_amt", "log_city_pop", "amt_per_km"),
        low_cardinality=("is_weekend", "invalid_zip"),
        high_cardinality=("state_grouped",),
        temporal=("hour", "day", "weekday", "month"),
    )
    return out, added


def add_bin_age(df: DataFrame, column: str = "age") -> DataFrame:
    return df.withColumn("bin_age", binning.bin_age(column))


def bin_campaign(df: DataFrame, column: str = "campaign") -> DataFrame:
    return df.withColumn(column, binning.bin_contacts(column))


def add_duration_flags(df: DataFrame, column: str = "duration") -> DataFrame:
    return df.withColumns(binning.duration_flags(column))


def add_pdays_bins(df: DataFrame, column: str = "pdays") -> DataFrame:
    return df.withColumns(binning.pdays_bins(column))


def add_balance_bins(df: DataFrame, column: str = "balance") -> DataFrame:
    return df.withColumns(binning.balance_bins(column))
