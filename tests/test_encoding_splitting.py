import math

import pytest
from pyspark.sql import functions as F

from checks import views as V
from txnlens.operators import encoding as E, splitting as S
from txnlens.operators.lookup import join_lookup
from txnlens.plans import preprocess as P


@pytest.fixture(scope="module")
def cats(spark):
    return spark.createDataFrame([("b", 0.0), ("a", 1.0), ("c", 0.0), ("a", 0.0), (None, 1.0)], "category string, invalid_zip double")


def test_onehot_drops_first_and_zeroes_unknown(spark, cats):
    fitted = E.fit_onehot(cats, ["category", "invalid_zip"])
    out = E.apply_onehot(cats, fitted, ["category", "invalid_zip"])
    assert out.columns == ["category_b", "category_c", "invalid_zip"]
    new = spark.createDataFrame([("zz", 1.0)], "category string, invalid_zip double")
    assert tuple(E.apply_onehot(new, fitted, ["category", "invalid_zip"]).first()) == (0.0, 0.0, 1.0)


def test_onehot_refuses_wide_columns(spark):
    df = spark.range(E.MAX_ONEHOT + 1).selectExpr("cast(id as string) c")
    with pytest.raises(ValueError, match="frequency"):
        E.apply_onehot(df, E.fit_onehot(df, ["c"]), ["c"])


def test_freq_unseen_and_null_are_zero(spark, cats):
    shares = E.fit_freq(cats, ["category"])
    new = spark.createDataFrame([("a",), ("zz",), (None,)], "category string")
    assert sorted(r["category_freq"] for r in E.apply_freq(new, shares, ["category"]).collect()) == [0.0, 0.0, 0.5]


def test_shuffled_lookup_equals_broadcast_lookup(spark):
    # one value and the nulls each hold a third of the rows
    rows = spark.range(9000).selectExpr(
        "id", "case when id % 3 = 0 then 'hot' when id % 3 = 1 then null else concat('k', id % 4001) end as v")
    shares = E.fit_freq(rows, ["v"]).select("value", F.col("share").alias("v_freq"))
    small = join_lookup(rows, shares, "v", "value", share="v_freq")
    large = join_lookup(rows, shares, "v", "value", share="v_freq", broadcast_rows=0)
    plain = join_lookup(rows, shares, "v", "value", broadcast_rows=0)
    expected = sorted(map(tuple, small.select("id", "v", "v_freq").collect()), key=lambda r: r[0])
    for other in (large, plain):
        assert sorted(map(tuple, other.select("id", "v", "v_freq").collect()), key=lambda r: r[0]) == expected


def test_cycle(spark):
    df = spark.createDataFrame([(6, 0, 12, 31)], "hour int, weekday int, month int, day int")
    row = E.cyclic_encode(df).first().asDict()
    assert len(row) == 8 and row["hour_sin"] == pytest.approx(1) and row["month_cos"] == pytest.approx(1)
    assert row["day_sin"] == pytest.approx(0, abs=1e-12) and row["weekday_cos"] == 1


def test_scaler_uses_population_deviation_and_survives_constants(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "x double, y double")
    out = E.apply_standard(df, E.fit_standard(df, ["x", "y"])).collect()
    assert [tuple(r) for r in out] == [(-1.0, 0.0), (1.0, 0.0)]


@pytest.fixture(scope="module")
def fitted(spark, sf_dir):
    rows = V.ref_txn(spark, sf_dir)
    ready, params = P.fit(rows, rare_share=0.04)
    return rows, ready, params


def test_scaled_columns_have_mean_0_and_deviation_1(fitted):
    _, ready, params = fitted
    names = list(params.scaling)
    row = ready.agg(*[F.avg(c).alias(f"m_{c}") for c in names], *[F.stddev_pop(c).alias(f"s_{c}") for c in names]).first()
    for c in names:
        assert abs(row[f"m_{c}"]) < 1e-9 and row[f"s_{c}"] == pytest.approx(1)


def test_ready_table_has_no_nulls_and_all_columns(fitted):
    rows, ready, params = fitted
    assert ready.columns == ["trans_num", "datetime", "is_fraud", *P.model_columns(params)]
    assert ready.dropna().count() == rows.count()


def test_saved_parameters_give_the_same_rows(spark, fitted, tmp_path):
    rows, ready, params = fitted
    params.save(str(tmp_path / "params"))
    again = P.apply(rows, P.Fitted.load(spark, str(tmp_path / "params")))
    assert ready.exceptAll(again).count() == 0 and again.exceptAll(ready).count() == 0


def test_rows_with_missing_groups_are_kept(spark, fitted):
    rows, _, params = fitted
    odd = rows.limit(20).withColumns({"state": F.lit(None).cast("string"), "city": F.lit("nowhere"),
                                      "merch_zipcode": F.lit(None).cast("string")})
    out = P.apply(odd, params)
    assert out.count() == 20
    assert [tuple(r) for r in out.select("zip_missing", "state_freq", "city_freq", "state_grouped_freq").distinct().collect()] == [(1, 0.0, 0.0, 0.0)]


def brute_split(rows, fraction, seed):
    import hashlib
    parts = {}
    for key, label in rows:
        parts.setdefault(label, []).append((hashlib.sha256(f"{key}{seed}".encode()).hexdigest(), key))
    return {k for label, p in parts.items() for _, k in sorted(p)[:math.ceil(fraction * len(p) - 1e-9)]}


@pytest.mark.parametrize("fraction", [0.2, 0.3, 0.5])
def test_split_is_exact_per_class(spark, fraction):
    rows = [(str(i), int(i % 7 == 0)) for i in range(500)]
    df = spark.createDataFrame(rows, "trans_num string, is_fraud int")
    ref, ana = S.stratified_split(df, fraction, 200)
    got = {r["trans_num"] for r in ana.collect()}
    assert got == brute_split(rows, fraction, 200)
    assert {r["trans_num"] for r in ref.collect()} == {k for k, _ in rows} - got


def test_split_does_not_depend_on_partitioning(spark):
    df = spark.range(1000).selectExpr("cast(id as string) trans_num", "cast(id % 9 = 0 as int) is_fraud")
    one = {tuple(r) for r in S.three_way_split(df.coalesce(1)).collect()}
    assert one == {tuple(r) for r in S.three_way_split(df.repartition(7)).collect()}
    sizes = {}
    for _, label, part in one:
        sizes[label, part] = sizes.get((label, part), 0) + 1
    assert sizes[1, "test"] == math.ceil(112 * 0.2) and sizes[0, "test"] == math.ceil(888 * 0.2)


def test_train_test_refuses_nulls(spark):
    df = spark.createDataFrame([("a", 1, None), ("b", 0, 2.0)], "trans_num string, is_fraud int, x double")
    with pytest.raises(ValueError, match="x"):
        S.train_test_xy(df.withColumn("datetime", F.lit("t")))
    train, test, columns = S.train_test_xy(df.na.fill(0.0).withColumn("datetime", F.lit("t")), 0.5)
    assert columns == ["x"] and train.count() + test.count() == 2


def test_preprocessing_reads_its_input_once(spark, sf_dir, tmp_path):
    V.ref_txn(spark, sf_dir).write.parquet(str(tmp_path / "source"))
    rows, _fitted = P.fit(spark.read.parquet(str(tmp_path / "source")), rare_share=0.04)
    assert rows.inputFiles() and not [f for f in rows.inputFiles() if str(tmp_path) in f]
