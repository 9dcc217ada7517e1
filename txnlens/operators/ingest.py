"""Ingestion: duplicates, parsing, identifiers, hashing, age, and vertical feature groups."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import NumericType, StringType

from txnlens.functions.dates import age_by_year, age_in_years, lenient_timestamp
from txnlens.functions.text import id_text, sha256_hex
from txnlens.roles import EVENT_TIME, KEY, TARGET, Roles

ID_COLUMNS = ("cc_num", "zip", "merch_zipcode")
HASHED_COLUMNS = ("cc_num", "first", "last")
REDUNDANT_COLUMNS = ("trans_date_trans_time", "unix_time", "dob")


def drop_exact_duplicates(df: DataFrame) -> DataFrame:
    return df.dropDuplicates()


def parse_timestamp(df: DataFrame, source: str = "trans_date_trans_time", to: str = EVENT_TIME) -> DataFrame:
    return df.withColumn(to, lenient_timestamp(source))


def ids_to_string(df: DataFrame, columns=ID_COLUMNS) -> DataFrame:
    present = [c for c in columns if c in df.columns]
    return df.withColumns({c: id_text(c, df.schema[c].dataType) for c in present})


def hash_pii(df: DataFrame, columns=HASHED_COLUMNS) -> DataFrame:
    """Replace each column by ``<column>_hashed``."""
    return df.withColumns({f"{c}_hashed": sha256_hex(c) for c in columns}).drop(*columns)


def derive_age(df: DataFrame, at: str = EVENT_TIME, born: str = "dob") -> DataFrame:
    parsed = df.withColumn("_born", lenient_timestamp(born))
    return parsed.withColumn("age", age_in_years(at, "_born")).drop("_born")


def derive_age_by_year(df: DataFrame, at: str = EVENT_TIME, born: str = "dob") -> DataFrame:
    parsed = df.withColumn("_born", lenient_timestamp(born))
    return parsed.withColumn("age", age_by_year(at, "_born")).drop("_born")


def drop_redundant_columns(df: DataFrame, columns=REDUNDANT_COLUMNS) -> DataFrame:
    return df.drop(*columns)


def filter_by_value(df: DataFrame, column: str = "state", value="NY") -> DataFrame:
    return df.where(F.col(column) == F.lit(value))


def filter_out_of_range(df: DataFrame, column: str, low, high) -> DataFrame:
    """Rows whose value lies outside the inclusive range."""
    return df.where((F.col(column) < low) | (F.col(column) > high))


def filter_regex_mismatch(df: DataFrame, column: str, pattern: str) -> DataFrame:
    return df.where(~F.col(column).cast("string").rlike(pattern))


def drop_columns(df: DataFrame, roles: Roles, columns=("merchant", "first")) -> tuple[DataFrame, Roles]:
    """Drop what is present and take the names out of every role list."""
    return df.drop(*columns), roles.without(columns)


def drop_listed_features(df: DataFrame, drifted) -> DataFrame:
    gone = set(drifted)
    return df.select(*[c for c in df.columns if c not in gone])


def split_feature_groups(df: DataFrame, target: str = TARGET, key: str = KEY,
                         time: str = EVENT_TIME) -> dict[str, DataFrame]:
    """Numeric, text and target columns as three frames, each led by key and event time."""
    fixed = [key, time]
    rest = [f for f in df.schema.fields if f.name not in (*fixed, target)]
    numeric = [f.name for f in rest if isinstance(f.dataType, NumericType)]
    text = [f.name for f in rest if isinstance(f.dataType, StringType)]
    return {
        "numerical": df.select(*fixed, *numeric),
        "categorical": df.select(*fixed, *text),
        "target": df.select(*fixed, target),
    }


SPREAD = "_spread"


def merge_feature_groups(groups: list[DataFrame], on=(KEY,)) -> DataFrame:
    """Left joins on the key; a column both sides have is taken from the left.

    Rows whose key has a null find no partner; they are spread by a second join key that is 0 for all others.
    """
    on = list(on)

    def join(left: DataFrame, right: DataFrame) -> DataFrame:
        shared = [c for c in right.columns if c in left.columns and c not in on]
        # always 0, but not a constant to the optimizer, which would take it out of the join keys
        home = F.pmod(F.xxhash64(*on), F.lit(1))
        return left.join(right.drop(*shared).withColumn(SPREAD, home), [*on, SPREAD], "left")

    if len(groups) == 1:
        return groups[0]
    no_partner = reduce(Column.__or__, [F.col(c).isNull() for c in on])
    spread = F.when(no_partner, F.monotonically_increasing_id()).otherwise(F.lit(0)).cast("bigint")
    return reduce(join, [groups[0].withColumn(SPREAD, spread), *groups[1:]]).drop(SPREAD)


def merge_configured_groups(config: dict, read, on=(KEY, EVENT_TIME)) -> DataFrame:
    """Merge the groups a configuration names; entries that are not groups are skipped."""
    entries = [g for name, g in config.items() if name != "upload_features" and isinstance(g, dict)]
    return merge_feature_groups([read(g["name"], g["version"]) for g in entries], on)
