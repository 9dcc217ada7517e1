"""Feature tables bucketed by key, and null keys of merged groups."""

import pytest
from pyspark.sql import functions as F

from txnlens.operators.ingest import merge_feature_groups
from txnlens.sources.bucketed_features import REFUSE, BucketedFeatures


@pytest.fixture
def shuffled_joins(spark):
    """Joins of small tables as those of large ones."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.fixture
def store(spark, tmp_path):
    return BucketedFeatures(spark, str(tmp_path), "k", "at", buckets=6)


def batch(spark, keys, at, **columns):
    rows = [(str(k) if k is not None else None, at, *[f(k or 0) for f in columns.values()]) for k in keys]
    return spark.createDataFrame(rows, "k string, at bigint, " + ", ".join(f"{c} bigint" for c in columns))


def plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_groups_merge_and_latest_rows_without_a_shuffle(spark, store, shuffled_joins):
    assert store.write(batch(spark, range(100), 1, a=lambda k: k), "one") == 100
    assert store.write(batch(spark, range(50, 120), 2, a=lambda k: -k), "one") == 70
    store.write(batch(spark, range(0, 100, 2), 1, b=lambda k: k * k), "two")
    merged = store.merge(["one", "two"])
    assert "Exchange" not in plan(merged) and "Exchange" not in plan(store.read("one"))
    got = {int(r["k"]): (r["at"], r["a"], r["b"]) for r in merged.collect()}
    assert got == {k: (1 if k < 50 else 2, k if k < 50 else -k, k * k if k % 2 == 0 and k < 100 else None)
                   for k in range(120)}


def test_keys_are_checked_against_all_earlier_batches(spark, store, shuffled_joins):
    store.write(batch(spark, range(10), 1, a=lambda k: k), "one")
    store.write(batch(spark, range(10, 20), 2, a=lambda k: k), "one", repeats=REFUSE)
    for keys, message in (([30, 3], "1 keys are in an earlier"), ([12, 13, 40], "2 keys are in an earlier"),
                          ([50, 50], "null or repeated"), ([None, 60], "null or repeated")):
        with pytest.raises(ValueError, match=message):
            store.write(batch(spark, keys, 3, a=lambda k: k), "one", repeats=REFUSE)
    assert sorted(int(r["k"]) for r in store.read("one").collect()) == list(range(20))
    known = store.open("one")
    assert "Exchange" not in plan(store.known_keys(known, known))
    with pytest.raises(ValueError, match="replace or refuse"):
        store.write(known, "one", repeats="ignore")


def test_a_table_of_another_session_keeps_its_buckets(spark, store, shuffled_joins):
    store.write(batch(spark, range(40), 1, a=lambda k: k), "one")
    store.write(batch(spark, range(40), 1, b=lambda k: k + 1), "two")
    other = spark.newSession()
    other.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    for name in ("one", "two"):
        other.sql(f"drop table {store._table(name, 1)}")  # as a fresh catalog; the files stay
    again = BucketedFeatures(other, store.root, "k", "at", buckets=6)
    merged = again.merge(["one", "two"])
    assert "Exchange" not in plan(merged)
    assert merged.where("b = a + 1").count() == 40
    again.write(batch(other, [1, 99], 5, a=lambda k: 700), "one")
    assert again.read("one").where("a = 700").count() == 2 and again.read("one").count() == 41
    with pytest.raises(ValueError, match="no feature table three"):
        again.read("three")


def test_empty_batch_and_first_write(spark, store):
    assert store.open("none") is None
    assert store.write(batch(spark, [1], 1, a=lambda k: k).limit(0), "one") == 0
    assert store.write(batch(spark, [1], 1, a=lambda k: k), "one", repeats=REFUSE) == 1
    assert store.read("one").count() == 1


def test_null_keys_of_merged_groups_are_spread(spark, shuffled_joins):
    left = spark.range(4000).select(F.when(F.col("id") % 2 == 0, F.col("id")).alias("k"), F.lit(3).alias("x"))
    right = spark.range(0, 4000, 4).select(F.col("id").alias("k"), F.lit(5).alias("y"))
    nulls = spark.createDataFrame([(None, 9)], "k bigint, y int")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        merged = merge_feature_groups([left, right.unionByName(nulls)], on=("k",))
        assert merged.columns == ["k", "x", "y"]
        by_task = merged.where("k is null").groupBy(F.spark_partition_id().alias("p")).count().collect()
        assert sum(r["count"] for r in by_task) == 2000 and max(r["count"] for r in by_task) < 1000
        assert merged.where("k is null and y is not null").count() == 0
        assert merged.count() == 4000 and merged.where("y = 5").count() == 1000
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
