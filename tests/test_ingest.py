import hashlib

import pytest
from pyspark.sql import functions as F

from txnlens.functions.dates import whole_days_between
from txnlens.operators import ingest as ops
from txnlens.operators.quality import SuiteFailure
from txnlens.plans import ingest as plan
from txnlens.roles import CATEGORICAL_GROUP, NUMERICAL_GROUP, Roles
from txnlens.sources.transactions import RAW_SCHEMA, read_transactions_csv

ROW = ("2020-06-21 12:14:25", 2291163933867244, "shop", "travel", 2.86, "Jeff", "Elliott", "M", "1 Lane", "Columbia",
       "SC", "02920", 33.9, -80.9, 333497, "Mechanic", "1968-03-19", "t1", 1371816865, 33.98, -81.2, 0, None)


@pytest.fixture(scope="module")
def raw(spark):
    bad = list(ROW)
    bad[0], bad[16], bad[17] = "not a time", "never", "t2"
    return spark.createDataFrame([ROW, ROW, tuple(bad)], RAW_SCHEMA)


def test_ingest_chain(raw):
    rows = {r["trans_num"]: r for r in plan.ingest(raw).collect()}
    assert set(rows) == {"t1", "t2"}
    good = rows["t1"]
    assert good["cc_num_hashed"] == hashlib.sha256(b"2291163933867244").hexdigest()
    assert good["first_hashed"] == hashlib.sha256(b"Jeff").hexdigest()
    assert good["age"] == 52 and good["zip"] == "02920" and good["merch_zipcode"] is None
    assert rows["t2"]["datetime"] is None and rows["t2"]["age"] is None
    assert len(plan.ingest(raw).columns) == 22


def test_groups(raw):
    groups = plan.checked_groups(plan.ingest(raw))
    assert set(groups["numerical"].columns) == set(NUMERICAL_GROUP)
    assert set(groups["categorical"].columns) == set(CATEGORICAL_GROUP)
    assert groups["numerical"].columns[:2] == ["trans_num", "datetime"]
    with pytest.raises(SuiteFailure, match="unexpected"):
        plan.checked_groups(plan.ingest(raw).withColumn("extra", F.lit(1)))
    with pytest.raises(SuiteFailure, match="missing"):
        plan.checked_groups(plan.ingest(raw).drop("amt"))


def test_days_round_down(spark):
    rows = spark.createDataFrame(
        [("2020-01-01 00:00:00", "2020-01-02 12:00:00"), ("2020-01-03 00:00:00", "2020-01-01 12:00:00"),
         ("2020-01-03 12:00:00", "2020-01-01 12:00:00"), ("2020-01-01 12:00:00", "2020-01-03 12:00:00")], "e string, s string")
    out = rows.selectExpr("cast(e as timestamp_ntz) e", "cast(s as timestamp_ntz) s").select(
        whole_days_between("e", "s").alias("d"))
    assert [r["d"] for r in out.collect()] == [-2, 1, 2, -2]


def test_float_ids_print_as_whole_numbers(spark):
    df = spark.createDataFrame([(630451534402.0, None)], "cc_num double, zip double")
    assert ops.ids_to_string(df).first().asDict() == {"cc_num": "630451534402", "zip": None}


def test_drop_columns_leaves_roles_clean(spark):
    df = spark.createDataFrame([(1, "a", "b")], "amt int, merchant string, job string")
    out, roles = ops.drop_columns(df, Roles(), ["merchant", "job", "absent"])
    assert out.columns == ["amt"]
    assert "merchant" not in roles.categorical and "job" not in roles.categorical
    assert roles.numerical == Roles().numerical


def test_merge_keeps_left_copy(spark):
    left = spark.createDataFrame([("k1", 1), ("k2", 2)], "trans_num string, v int")
    right = spark.createDataFrame([("k1", 9, "x")], "trans_num string, v int, w string")
    rows = {r["trans_num"]: (r["v"], r["w"]) for r in ops.merge_feature_groups([left, right]).collect()}
    assert rows == {"k1": (1, "x"), "k2": (2, None)}


def test_csv_keeps_leading_zeros(spark, raw, tmp_path):
    raw.write.option("header", True).csv(str(tmp_path / "raw"))
    back = read_transactions_csv(spark, str(tmp_path / "raw"))
    assert back.dtypes == raw.dtypes
    assert sorted(map(str, back.collect())) == sorted(map(str, raw.collect()))
