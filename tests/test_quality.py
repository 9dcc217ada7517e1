import json

import pytest

from txnlens.operators import profiling, quality as Q
from txnlens.operators.quality import Rule


@pytest.fixture(scope="module")
def table(spark):
    rows = [("a", 5.0, "M", "12345", 1), ("b", None, "F", "1234", 0), ("b", 200.0, "X", None, 1), (None, 7.0, "M", "12345-6789", 0)]
    return spark.createDataFrame(rows, "trans_num string, amt double, gender string, zip string, is_fraud bigint")


def by_rule(report):
    return {r["rule"]: r for r in report.collect()}


def test_rules_count_unexpected_values(table):
    rules = [Rule(Q.NOT_NULL, "amt", mostly=0.75), Rule(Q.BETWEEN, "amt", 0, 100), Rule(Q.IN_SET, "gender", values=("M", "F")),
             Rule(Q.UNIQUE, "trans_num"), Rule(Q.REGEX, "zip", pattern=r"^\d{5}(-\d{4})?\z"),
             Rule(Q.DISTINCT_IN_SET, "gender", values=("M", "F")), Rule(Q.NOT_NULL, "absent"),
             Rule(Q.OF_TYPE, "amt", type_name="float64"), Rule(Q.OF_TYPE, "absent", type_name="object"),
             Rule(Q.BETWEEN, "amt", 0, 100, mostly=0.5)]
    got = by_rule(Q.run_suite(table, rules))
    assert len(got) == len(rules)
    assert (got[0]["success"], got[0]["unexpected_count"], got[0]["unexpected_percent"]) == (True, 1, 25.0)
    assert (got[1]["success"], got[1]["unexpected_count"]) == (False, 1)
    assert got[1]["unexpected_percent"] == pytest.approx(100 / 3)
    assert (got[2]["success"], got[2]["unexpected_count"]) == (False, 1)
    assert (got[3]["success"], got[3]["unexpected_count"], got[3]["element_count"]) == (False, 2, 4)
    assert (got[4]["success"], got[4]["unexpected_count"]) == (False, 1)
    assert (got[5]["success"], got[5]["unexpected_value"], got[5]["observed_value"]) == (False, '["X"]', '["F","M","X"]')
    assert (got[6]["success"], got[6]["element_count"]) == (False, None)
    assert got[7]["success"] and not got[8]["success"]
    assert got[9]["success"]


def test_strftime(spark):
    df = spark.createDataFrame([("2020-01-02 03:04:05",), ("2020-1-2 3:04:05",), ("2020-13-01 00:00:00",), ("x",), (None,)], "t string")
    got = by_rule(Q.run_suite(df, [Rule(Q.STRFTIME, "t", pattern="%Y-%m-%d %H:%M:%S")]))
    assert got[0]["unexpected_count"] == 2


def test_empty_table_passes(spark, table):
    got = by_rule(Q.run_suite(table.limit(0), [Rule(Q.BETWEEN, "amt", 0, 1), Rule(Q.UNIQUE, "trans_num"), Rule(Q.NOT_NULL, "amt")]))
    assert all(r["success"] and r["element_count"] == 0 for r in got.values())


def test_many_unexpected_values_are_not_cut_short(spark):
    df = spark.range(Q.LISTED_VALUES + 5).selectExpr("cast(id as string) v")
    rule = Rule(Q.DISTINCT_IN_SET, "v", values=("0",))
    got = by_rule(Q.run_suite(df, [rule]))[0]
    assert not got["success"] and got["unexpected_count"] == Q.LISTED_VALUES + 4
    assert len(json.loads(got["unexpected_value"])) == Q.LISTED_VALUES
    assert got["listed_all"] is False
    few = Q.run_suite(df.limit(20), [rule]).first()
    assert few["listed_all"] is True
    assert Q.observed_values(df, rule).count() == Q.LISTED_VALUES + 5


def test_suite_has_57_rules():
    assert len(Q.ingested_suite()) == 57


def test_strict_mode(spark, table):
    with pytest.raises(Q.SuiteFailure):
        Q.run_suite(table, [Rule(Q.COLUMN_SET, values=("trans_num",))], strict=True)
    with pytest.raises(Q.SuiteFailure, match="trans_num"):
        Q.run_suite(table, [Rule(Q.NOT_NULL, "amt")], strict=True)
    with pytest.raises(Q.SuiteFailure, match="double"):
        Q.run_suite(table.selectExpr("trans_num", "cast(amt as string) amt", "is_fraud"), [Rule(Q.NOT_NULL, "amt")], strict=True)


def test_report_titles(table):
    report = Q.validation_report(Q.run_suite(table, [Rule(Q.NOT_NULL, "amt")]))
    assert report.columns == ["Success", "Expectation Type", "Column", "Column Pair", "Max Value", "Min Value",
                              "Element Count", "Unexpected Count", "Unexpected Percent", "Value Set",
                              "Unexpected Value", "Observed Value"]


def test_suggested_suite_holds_on_its_own_table(table):
    rules = Q.suggest_suite(table)
    assert Rule(Q.NOT_NULL, "is_fraud") in rules and Rule(Q.BETWEEN, "amt", 5.0, 200.0) in rules
    assert Q.failed_rules(Q.run_suite(table, rules)).count() == 0


def test_null_columns(table):
    assert sorted(profiling.columns_with_nulls(table)) == ["amt", "trans_num", "zip"]


def test_profile_estimates_agree_on_small_tables(table):
    exact = {r["column_name"]: r for r in profiling.profile_table(table).collect()}
    quick = {r["column_name"]: r for r in profiling.profile_table(table, exact=False).collect()}
    assert exact["gender"]["n_distinct"] == quick["gender"]["n_distinct"] == 3
    assert exact["gender"]["top_text"] == "M" and exact["gender"]["top_count"] == 2
    assert exact["amt"]["median"] == 7.0 and exact["amt"]["n_null"] == 1


def test_histogram_closes_last_bin(spark):
    df = spark.createDataFrame([(float(x),) for x in (0, 1, 2, 10, 10)] + [(None,)], "x double")
    got = {r["bin"]: r["n"] for r in profiling.histogram_numeric(df, ["x"], 5).collect()}
    assert got == {0: 2, 1: 1, 2: 0, 3: 0, 4: 2}
    constant = spark.createDataFrame([(3.0,), (3.0,)], "x double")
    assert {r["bin"]: r["n"] for r in profiling.histogram_numeric(constant, ["x"], 2).collect()} == {0: 2, 1: 0}


def test_ingest_and_validate_job(spark, sf_dir):
    from checks import views as V
    from txnlens.plans.ingest import ingest_and_validate

    raw = V.raw_txn(spark, sf_dir)
    reference, analysis, report = ingest_and_validate(raw)
    n = raw.count()
    assert reference.count() + analysis.count() == n and abs(analysis.count() - 0.2 * n) <= 2
    rows = {(r["expectation"], r["column_name"]): r for r in report.collect()}
    assert len(rows) == 57
    assert rows[Q.UNIQUE, "trans_num"]["success"] and rows[Q.UNIQUE, "trans_num"]["element_count"] == analysis.count()
    assert not rows[Q.IN_SET, "state"]["success"] and not rows[Q.REGEX, "zip"]["success"]


def test_nan_is_missing(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (float("nan"),), (None,), (float("nan"),)], "x double")
    rules = [Rule(Q.NOT_NULL, "x"), Rule(Q.BETWEEN, "x", 0, 3), Rule(Q.UNIQUE, "x"), Rule(Q.DISTINCT_IN_SET, "x", values=(1.0, 2.0))]
    got = by_rule(Q.run_suite(df, rules))
    assert (got[0]["success"], got[0]["unexpected_count"]) == (False, 3)
    assert got[1]["success"] and got[2]["success"] and got[3]["success"]


def test_unknown_time_directives_are_refused(spark):
    with pytest.raises(ValueError, match="%j"):
        Q.run_suite(spark.createDataFrame([("2020",)], "t string"), [Rule(Q.STRFTIME, "t", pattern="%Y %j")])
