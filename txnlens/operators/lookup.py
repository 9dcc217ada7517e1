"""Left join of a large table with a fitted lookup table whose size is not known in advance."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

BROADCAST_ROWS = 1_000_000
HOT_SHARE = 1e-4
_SPREAD = 4096
#: Parts of every key of a stream, whose frequent keys cannot be counted before it runs.
_STREAM_SLOTS = 4


def lookup_sizes(lookup: DataFrame, by: str) -> dict[str, int]:
    """Rows per lookup of a stored table that holds several of them."""
    return {r[by]: r["n"] for r in lookup.groupBy(by).agg(F.count(F.lit(1)).alias("n")).collect()}


def join_lookup(df: DataFrame, lookup: DataFrame, column: str, key: str, rows: int | None = None,
                share: str | None = None, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Add the lookup's value columns to every row; rows without a match get nulls.

    A lookup of at most ``broadcast_rows`` rows is broadcast; it is counted here if ``rows`` is not given, so
    it should be a stored table. A larger one is joined by shuffle, where neither rows without a key nor a key that
    is frequent in ``df`` meet in one partition. If ``share`` names the column with each key's
    share of the rows, keys with at least HOT_SHARE (there can be at most 1/HOT_SHARE of them) are broadcast,
    so that no key left for the shuffle can fill a partition.
    """
    values = [c for c in lookup.columns if c != key]
    right = lookup.withColumnRenamed(key, "_lookup_key")
    if (right.count() if rows is None else rows) <= broadcast_rows:
        return df.join(F.broadcast(right), F.col(column) == F.col("_lookup_key"), "left").drop("_lookup_key")
    if share is None:
        return _spread_join(df, right, F.col(column), values)
    hot = right.where(F.col(share) >= HOT_SHARE).select("_lookup_key", *[F.col(v).alias(f"_hot_{v}") for v in values])
    known = df.join(F.broadcast(hot), F.col(column) == F.col("_lookup_key"), "left")
    rest = F.when(F.col("_lookup_key").isNull(), F.col(column))
    joined = _spread_join(known.withColumn("_rest", rest).drop("_lookup_key"),
                          right.where(F.col(share) < HOT_SHARE), F.col("_rest"), values)
    return joined.withColumns({v: F.coalesce(f"_hot_{v}", v) for v in values}).drop(
        "_rest", *[f"_hot_{v}" for v in values])


def heavy_keys(df: DataFrame, key: Column, share: float = HOT_SHARE) -> DataFrame:
    """(_heavy, _slots): the keys that hold at least ``share`` of the rows, and in how many parts they are to be dealt.

    A frequent-items sketch of bounded size misses none of them; there can be 1 / share.
    """
    most = math.ceil(1 / share)
    one = df.select(key.cast("string").alias("k")).where("k is not null").agg(
        F.expr(f"approx_top_k(k, {most}, {4 * most})").alias("top"), F.count(F.lit(1)).alias("n")).first()
    hot = [(t["item"], math.ceil(t["count"] / one["n"] / share)) for t in one["top"] or () if t["count"] >= share * one["n"]]
    return df.sparkSession.createDataFrame(hot, "_heavy string, _slots int")


def _spread_join(df: DataFrame, right: DataFrame, key: Column, values) -> DataFrame:
    """Shuffled left join in which no key can fill a partition.

    Rows whose key is null go to partitions picked by a hash of the row. A key that is frequent in ``df``, whatever its
    share was when the lookup was learned, is dealt into parts, and its lookup row is repeated for each. In a stream
    every key is.
    """
    if df.isStreaming:
        row_hash = F.xxhash64(*[F.col(c) for c in df.columns])
        dealt = F.pmod(row_hash, F.when(key.isNull(), F.lit(_SPREAD)).otherwise(F.lit(_STREAM_SLOTS))).cast("int")
        left = df.withColumns({"_key": F.coalesce(key.cast("string"), F.lit("")), "_slot": F.when(key.isNull(), -1 - dealt).otherwise(dealt)})
        right = right.select(F.col("_lookup_key").cast("string").alias("_key"),
                             F.explode(F.sequence(F.lit(0), F.lit(_STREAM_SLOTS - 1))).alias("_slot"), *values)
        return left.join(right, ["_key", "_slot"], "left").drop("_key", "_slot")
    heavy = F.broadcast(heavy_keys(df, key))
    row_hash = F.xxhash64(*[F.col(c) for c in df.columns])  # the same after a lost task is run again
    left = df.withColumns({"_key": key.cast("string"), "_row": row_hash}).join(heavy, F.col("_key") == F.col("_heavy"), "left")
    slot = F.when(F.col("_key").isNull(), F.pmod("_row", F.lit(_SPREAD)).cast("int")).when(
        F.col("_slots").isNotNull(), F.pmod("_row", F.col("_slots")).cast("int")).otherwise(F.lit(-1))
    left = left.withColumn("_slot", slot).withColumn("_key", F.coalesce("_key", F.lit(""))).drop("_row", "_heavy", "_slots")
    right = right.select(F.col("_lookup_key").cast("string").alias("_key"), *values).join(
        heavy, F.col("_key") == F.col("_heavy"), "left")
    each = F.when(F.col("_slots").isNotNull(), F.sequence(F.lit(0), F.col("_slots") - 1)).otherwise(F.array(F.lit(-1)))
    right = right.select("_key", F.explode(each).alias("_slot"), *values)
    return left.join(right, ["_key", "_slot"], "left").drop("_key", "_slot")
