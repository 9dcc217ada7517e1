import math

import pytest
from pyspark.sql import functions as F

from txnlens.functions import binning
from txnlens.operators import cleaning as C, features as E


def test_cap_min_keeps_nulls(spark):
    df = spark.createDataFrame([(3,), (16,), (40,), (None,)], "age bigint")
    assert [r["age"] for r in C.cap_min(df).collect()] == [16, 16, 40, None]
    assert C.cap_min(df).dtypes == df.dtypes


def test_sentinel_fills_numbers_and_text(spark):
    df = spark.createDataFrame([(None, None, None)], "a double, s string, t timestamp_ntz")
    assert C.fill_sentinel(df).first().asDict() == {"a": -9999.0, "s": "-9999", "t": None}


@pytest.fixture(scope="module")
def zips(spark):
    rows = [("c1", "s1", "b"), ("c1", "s1", "a"), ("c1", "s1", None), ("c2", "s1", None), ("c3", "s2", None),
            (None, "s1", None), ("c4", "s1", "b")]
    return spark.createDataFrame(rows, "city string, state string, merch_zipcode string")


def test_mode_ties_go_to_the_smallest(zips):
    got = {(r["level"], r["key"]): r["mode"] for r in C.fit_mode_lookup(zips).collect()}
    assert got == {("city", "c1"): "a", ("city", "c4"): "b", ("state", "s1"): "b"}


def test_impute_goes_from_city_to_state(zips):
    out = C.missing_flag(C.impute_hierarchical(zips, C.fit_mode_lookup(zips)))
    got = {(r["city"], r["state"], r["merch_zipcode"], r["zip_missing"]) for r in out.collect()}
    assert ("c1", "s1", "a", 0) in got and ("c2", "s1", "b", 0) in got
    assert (None, "s1", "b", 0) in got and ("c3", "s2", None, 1) in got
    assert out.count() == zips.count()


def test_cap_and_log(spark):
    df = spark.createDataFrame([(float(x),) for x in range(1, 11)] + [(None,)], "amt double")
    cap = C.fit_quantile_cap(df, "amt", 0.9)
    assert cap.first()["cap"] == pytest.approx(9.1)
    rows = [r.asDict() for r in C.apply_cap(df, cap).collect()]
    assert max(r["amt"] for r in rows if r["amt"] is not None) == pytest.approx(9.1)
    assert all(r["log_amt"] == pytest.approx(math.log1p(r["amt"])) for r in rows if r["amt"] is not None)
    assert rows[-1] == {"amt": None, "log_amt": None}


def test_distance(spark):
    df = spark.createDataFrame([(0.0, 0.0, 0.0, 180.0), (52.2296756, 21.0122287, 52.406374, 16.9251681), (1.0, 1.0, 1.0, 1.0)],
                               "lat double, long double, merch_lat double, merch_long double")
    got = [r["distance"] for r in E.add_distance(df).collect()]
    assert got[0] == pytest.approx(math.pi * 6371)
    assert got[1] == pytest.approx(278.458, abs=1e-2)
    assert got[2] == 0


def test_calendar_and_weekend(spark):
    df = spark.sql("select timestamp_ntz '2024-06-02 23:59:59' datetime union all select timestamp_ntz '2024-06-03 00:00:00'")
    rows = [r.asDict() for r in df.transform(E.add_calendar_parts).transform(E.add_is_weekend).orderBy("datetime").collect()]
    assert [(r["hour"], r["day"], r["weekday"], r["month"], r["is_weekend"]) for r in rows] == [(23, 2, 6, 6, 1), (0, 3, 0, 6, 0)]


def test_log_of_sentinel_is_null(spark):
    df = spark.createDataFrame([(0.0, 9), (-9999.0, 9)], "amt double, city_pop bigint")
    assert [r["log_amt"] for r in E.add_log_features(df).collect()] == [0.0, None]


def test_rare_labels(spark):
    df = spark.createDataFrame([("x",)] * 6 + [("y",)] * 3 + [("z",), (None,)], "state string")
    got = E.rare_label_group(df, "state", 0.3).groupBy("state_grouped").count()
    # z has 1/10 of the non-null rows, y exactly 3/10, which is not below the threshold
    assert {r["state_grouped"]: r["count"] for r in got.collect()} == {"x": 6, "y": 3, "Other": 1, None: 1}


def test_invalid_zip(spark):
    df = spark.createDataFrame([("12345",), ("12345-6789",), ("1234",), ("12345\n",), (None,)], "zip string")
    assert [r["invalid_zip"] for r in E.add_invalid_zip(df).collect()] == [0.0, 0.0, 1.0, 1.0, 1.0]


def test_binnings(spark):
    ages = spark.createDataFrame([(a,) for a in (17, 18, 35, 36, 60, 61)], "age int")
    assert [r["bin_age"] for r in E.add_bin_age(ages).collect()] == [0, 1, 1, 2, 2, 3]
    calls = spark.createDataFrame([(c,) for c in (0, 1, 2, 3, 4, 9)], "campaign int")
    assert [r["campaign"] for r in E.bin_campaign(calls).collect()] == [0, 1, 2, 2, 3, 3]
    flags = [tuple(r)[1:] for r in E.add_duration_flags(spark.createDataFrame([(5,), (10,), (11,)], "duration int")).collect()]
    assert flags == [(1, 0, 0), (0, 1, 0), (0, 0, 1)]
    days = spark.createDataFrame([(d,) for d in (-1, 0, 60, 61, 180, 181)], "pdays int")
    got = [tuple(r)[1:] for r in E.add_pdays_bins(days).collect()]
    assert got[0] == (1, pytest.approx(-1 / 30)) and [g[1] for g in got[1:]] == [1.0, 1.0, 2.0, 2.0, 3.0]
    money = spark.createDataFrame([(b,) for b in (-5, 0, 1, 100, 500, 2000, 5000)], "balance int")
    got = [tuple(r)[1:] for r in E.add_balance_bins(money).collect()]
    assert [g[3] for g in got] == [0, 0, 1, 2, 3, 4, 5]
    assert got[0][:3] == (1, 0, 0) and got[1][:3] == (0, 1, 0) and got[2][:3] == (0, 0, 1)
    assert set(binning.duration_flags("x")) == {"t_min", "t_e_min", "e_min"}


def test_feature_columns_add_up(spark):
    df = spark.createDataFrame([(10.0, 2.0)], "amt double, distance double")
    assert E.add_amt_per_km(df).first()["amt_per_km"] == pytest.approx(10 / 2.01)
    assert df.select(F.lit(1)).count() == 1
