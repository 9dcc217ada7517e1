"""Joins with large lookups: keys that are frequent only in the new rows."""

import pytest
from pyspark.sql import functions as F

from txnlens.operators.lookup import heavy_keys, join_lookup


@pytest.fixture(scope="module")
def rows(spark):
    # half of the rows have one key, a quarter have none, one key has no partner
    return spark.range(8000).select(F.col("id"), F.expr(
        "case when id % 4 < 2 then 'hot' when id % 4 = 2 then null when id % 8 = 3 then 'unknown' else 'k' || (id % 500) end"
    ).alias("k"))


@pytest.fixture(scope="module")
def lookup(spark):
    return spark.range(500).selectExpr("'k' || id as key", "id as v", "0.00001D as share").unionByName(
        spark.sql("select 'hot' as key, 7L as v, 0.00001D as share"))


def test_heavy_keys_are_found_with_their_parts(spark, rows):
    got = {r["_heavy"]: r["_slots"] for r in heavy_keys(rows, F.col("k"), share=0.01).collect()}
    assert got == {"hot": 67, "unknown": 17}  # of 6000 rows with a key


@pytest.mark.parametrize("share", [None, "share"])
def test_same_rows_as_a_plain_join(spark, rows, lookup, share):
    got = join_lookup(rows, lookup, "k", "key", share=share, broadcast_rows=0)
    want = rows.join(lookup, F.col("k") == F.col("key"), "left").drop("key")
    assert sorted(map(tuple, got.select("id", "k", "v").collect())) == sorted(map(tuple, want.select("id", "k", "v").collect()))


def test_a_key_hot_only_in_new_rows_is_split(spark, rows, lookup):
    kept = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = join_lookup(rows, lookup, "k", "key", share="share", broadcast_rows=0)
        sizes = [r["n"] for r in joined.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", kept)
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # four partitions: without the split one would have half of all rows and more
    assert sum(sizes) == 8000 and max(sizes) < 0.35 * 8000


@pytest.mark.parametrize("share", [None, "share"])
def test_a_stream_is_joined_with_a_lookup_too_large_to_broadcast(spark, rows, lookup, tmp_path, share):
    rows.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))
    joined = join_lookup(stream, lookup, "k", "key", rows=501, share=share, broadcast_rows=0).select("id", "k", "v")
    joined.writeStream.format("parquet").option("path", str(tmp_path / "out")).option(
        "checkpointLocation", str(tmp_path / "progress")).trigger(availableNow=True).start().awaitTermination()
    want = rows.join(lookup, F.col("k") == F.col("key"), "left").select("id", "k", "v")
    assert sorted(map(tuple, spark.read.parquet(str(tmp_path / "out")).collect())) == sorted(map(tuple, want.collect()))
