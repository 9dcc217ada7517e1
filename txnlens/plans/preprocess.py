"""The whole preprocessing chain as one fit and one apply.

The fit stores the training rows and reads them four times: for the zip lookup, for the counts of all categorical columns,
for the amount's quantile, and for means and deviations. The numeric passes leave out the lookup joins, which
they do not need.

What is learnt about one column's values (share, imputed zip, grouped share) is kept in one lookup, so the
apply is one projection with a single join per categorical column, and it starts no job of its own.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from txnlens import roles as R
from txnlens.functions.dates import lenient_timestamp
from txnlens.operators import cleaning, encoding, features, ingest
from txnlens.operators.lookup import join_lookup, lookup_sizes
from txnlens.roles import Roles
from txnlens.session import materialize

IDENTIFIERS = ("cc_num", "cc_num_hashed", "first_hashed", "last_hashed")
EARLY_DROPS = ("merchant", "first")
GROUPED = "state"
IMPUTE_BY = ("city", "state")
ZIP = "merch_zipcode"


@dataclass
class Fitted:
    """What :func:`fit` learnt.

    ``lookups`` is a stored table (feature, value, n, share, mode, grouped_share) and ``sizes`` its rows per
    feature; ``mode`` is set for the columns that impute the zip, ``grouped_share`` for the grouped column.
    """

    lookups: DataFrame
    sizes: dict[str, int]
    rare_share: float
    amt_cap: float
    onehot: dict[str, list[str]]
    scaling: dict[str, tuple[float, float]]
    roles: Roles

    @property
    def rare(self) -> DataFrame:
        """The labels grouped as 'Other'."""
        return self.lookups.where((F.col("feature") == GROUPED) & (F.col("share") < self.rare_share)).select(
            "feature", "value", "share")

    def save(self, path: str) -> None:
        """The lookups as Parquet, scalars as one JSON row, under ``path``."""
        self.lookups.write.mode("overwrite").parquet(f"{path}/lookups")
        scalars = {n: getattr(self, n) for n in ("sizes", "rare_share", "amt_cap", "onehot", "scaling")}
        scalars["roles"] = {k: getattr(self.roles, k) for k in self.roles.__dataclass_fields__}
        spark = self.lookups.sparkSession
        spark.createDataFrame([(json.dumps(scalars),)], "value string").coalesce(1).write.mode("overwrite").text(
            f"{path}/scalars")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "Fitted":
        s = json.loads(spark.read.text(f"{path}/scalars").first()["value"])
        s["scaling"] = {k: tuple(v) for k, v in s["scaling"].items()}
        s["roles"] = Roles(**{k: tuple(v) for k, v in s["roles"].items()})
        return cls(lookups=spark.read.parquet(f"{path}/lookups"), **s)


def _typed(df: DataFrame) -> DataFrame:
    out = df.withColumn(R.EVENT_TIME, lenient_timestamp(R.EVENT_TIME))
    return ingest.ids_to_string(out, ("zip",)).transform(cleaning.cap_min)


def _filled(df: DataFrame, skip=()) -> DataFrame:
    return cleaning.fill_sentinel(df, skip=(R.KEY, R.TARGET, *skip))


def _settle_zip(df: DataFrame, modes) -> DataFrame:
    """Impute the merchant zip from the mode columns, flag what stays missing, and only then fill the sentinel."""
    found = df.withColumn(ZIP, F.coalesce(F.col(ZIP), *[F.col(m) for m in modes])).drop(*modes)
    return found.transform(cleaning.missing_flag).na.fill(str(cleaning.SENTINEL), [ZIP])


def clean_fit(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(cleaned rows, zip lookup): the cleaning steps on their own."""
    zip_modes = cleaning.fit_mode_lookup(df, IMPUTE_BY)
    sizes = lookup_sizes(zip_modes, "level")
    out = _filled(_typed(df), (ZIP,))
    for c in IMPUTE_BY:
        level = zip_modes.where(F.col("level") == c).select("key", F.col("mode").alias(f"_{c}_mode"))
        out = join_lookup(out, level, c, "key", sizes.get(c, 0))
    return _settle_zip(out, [f"_{c}_mode" for c in IMPUTE_BY]), zip_modes


def _looked_up(df: DataFrame, fitted: Fitted) -> DataFrame:
    """Zip imputation and all shares, one join per categorical column."""
    def join(rows: DataFrame, c: str) -> DataFrame:
        wanted = {"share": f"{c}_freq"}
        if c in IMPUTE_BY:
            wanted["mode"] = f"_{c}_mode"
        if c == GROUPED:
            wanted["grouped_share"] = f"{c}_grouped_freq"
        known = fitted.lookups.where(F.col("feature") == c).select(
            "value", *[F.col(k).alias(v) for k, v in wanted.items()])
        return join_lookup(rows, known, c, "value", fitted.sizes.get(c, 0), f"{c}_freq")

    out = df
    for c in IMPUTE_BY:
        out = join(out, c)
    out = _settle_zip(out, [f"_{c}_mode" for c in IMPUTE_BY])
    for c in fitted.roles.high_cardinality:
        if c not in (*IMPUTE_BY, f"{GROUPED}_grouped"):
            out = join(out, c)
    # an unseen label is not rare but unknown, so its grouped share is 0 as well
    return out.na.fill(0.0, [f"{c}_freq" for c in fitted.roles.high_cardinality])


def _encode(df: DataFrame, fitted: Fitted) -> DataFrame:
    """Typed rows to model-ready columns."""
    return (
        _filled(df, (ZIP,)).transform(features.add_numeric_features)
        .transform(features.add_calendar_parts).transform(features.add_is_weekend)
        .transform(features.add_invalid_zip)
        .transform(lambda d: cleaning.apply_cap(d, fitted.amt_cap))
        .transform(lambda d: _looked_up(d, fitted))
        .transform(lambda d: encoding.apply_onehot(d, fitted.onehot, list(fitted.onehot)))
        .transform(encoding.cyclic_encode)
        .transform(lambda d: encoding.apply_standard(d, fitted.scaling))
    )


def model_columns(fitted: Fitted) -> list[str]:
    """All feature columns of the model-ready table, in table order."""
    return [*fitted.scaling, "zip_missing", *encoding.onehot_columns(fitted.onehot),
            *[f"{c}_freq" for c in fitted.roles.high_cardinality],
            *[f"{c}_{f}" for c in R.CYCLE_LENGTHS for f in ("sin", "cos")]]


def _ordered(df: DataFrame, fitted: Fitted) -> DataFrame:
    kept = [c for c in (R.KEY, R.EVENT_TIME, R.TARGET) if c in df.columns]
    return df.select(*kept, *model_columns(fitted))


def _fitted_roles() -> Roles:
    added = Roles().extended(numerical=("distance", "log_amt", "log_city_pop", "amt_per_km"),
                             low_cardinality=("is_weekend", "invalid_zip"), high_cardinality=(f"{GROUPED}_grouped",))
    return added.without((*EARLY_DROPS, *IDENTIFIERS))


def _lookups(counts: DataFrame, zip_modes: DataFrame, rare_share: float) -> DataFrame:
    """Shares of all values, with the zip modes and grouped shares beside them."""
    shares = encoding.shares_of(counts)
    modes = zip_modes.select(F.col("level").alias("feature"), F.col("key").alias("value"), "mode")
    rare = (F.col("feature") == GROUPED) & ((F.col("share") < rare_share) | (F.col("value") == features.OTHER))
    other = shares.where(rare).agg(F.sum("share").alias("other")).withColumn("feature", F.lit(GROUPED))
    grouped = F.when(rare, F.col("other")).when(F.col("feature") == GROUPED, F.col("share"))
    # one row in other
    return (shares.join(modes, ["feature", "value"], "left").join(F.broadcast(other), "feature", "left")
            .select("feature", "value", "n", "share", "mode", grouped.alias("grouped_share")))


def fit(df: DataFrame, rare_share: float = features.RARE_SHARE, quantile: float = 0.99) -> tuple[DataFrame, Fitted]:
    """Learn all parameters on training rows; returns the model-ready rows and the parameters.

    The rows are stored first: what derives them would else run again, and partly again for each column, in every pass.
    """
    df = materialize(df, "training")
    roles = _fitted_roles()
    cleaned, zip_modes = clean_fit(df)
    flagged = (cleaned.transform(features.add_calendar_parts).transform(features.add_is_weekend)
               .transform(features.add_invalid_zip))
    plain = [c for c in roles.categorical if c != f"{GROUPED}_grouped"]
    counts = materialize(encoding.category_counts(flagged, plain), "counts")
    lookups = materialize(_lookups(counts, zip_modes, rare_share), "lookups")
    onehot = encoding.onehot_plan(encoding.fit_onehot(df, roles.low_cardinality, lookups), roles.low_cardinality)

    numeric = features.add_numeric_features(_filled(_typed(df)))
    cap = float(cleaning.fit_quantile_cap(numeric, "amt", quantile).first()["cap"])
    scaling = {r["feature"]: (r["mean"], r["std"]) for r in encoding.fit_standard(
        cleaning.apply_cap(numeric, cap), roles.numerical).collect()}  # one row per column

    fitted = Fitted(lookups, lookup_sizes(lookups, "feature"), rare_share, cap, onehot, scaling, roles)
    return apply(df, fitted), fitted


def apply(df: DataFrame, fitted: Fitted) -> DataFrame:
    """The model-ready rows of new data under learnt parameters."""
    return _ordered(_encode(_typed(df), fitted), fitted)
