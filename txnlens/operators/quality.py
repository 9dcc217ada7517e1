"""Expectations: declarative rules evaluated over a table and reported one row per rule.

All row-level rules of a suite share one aggregate pass. Uniqueness and distinct-set rules each group their
own column first, so a repeated value arrives condensed. Rules on an absent column fail without counts.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import (DateType, DoubleType, FloatType, IntegerType, LongType, StringType, TimestampNTZType,
                               TimestampType)

from txnlens import roles as R
from txnlens.operators.distribution import missing
from txnlens.session import materialize

# Names of the expectations a suite may hold.
COLUMN_SET = "expect_table_columns_to_match_set"
OF_TYPE = "expect_column_values_to_be_of_type"
NOT_NULL = "expect_column_values_to_not_be_null"
BETWEEN = "expect_column_values_to_be_between"
UNIQUE = "expect_column_values_to_be_unique"
IN_SET = "expect_column_values_to_be_in_set"
DISTINCT_IN_SET = "expect_column_distinct_values_to_be_in_set"
REGEX = "expect_column_values_to_match_regex"
STRFTIME = "expect_column_values_to_match_strftime_format"

SCANNED = (NOT_NULL, BETWEEN, IN_SET, REGEX, STRFTIME)
LISTED_VALUES = 1000
REPORT_SCHEMA = """rule int, expectation string, column_name string, success boolean, element_count bigint,
    unexpected_count bigint, unexpected_percent double, min_value double, max_value double, value_set string,
    unexpected_value string, observed_value string, listed_all boolean"""

# Type names used in rules and the table types they stand for.
_TYPE_NAMES = {
    "int64": (LongType,), "int32": (IntegerType,), "float64": (DoubleType,), "float32": (FloatType,),
    "object": (StringType,), "datetime64[ns]": (TimestampType, TimestampNTZType), "date": (DateType,),
}
_STRFTIME_LETTERS = {"%Y": "yyyy", "%m": "M", "%d": "d", "%H": "H", "%M": "m", "%S": "s"}


@dataclass(frozen=True)
class Rule:
    expectation: str
    column: str | None = None
    low: float | None = None
    high: float | None = None
    values: tuple = ()
    pattern: str | None = None
    type_name: str | None = None
    mostly: float = 1.0


class SuiteFailure(ValueError):
    """A strict check did not hold."""


def _type_name(dtype) -> str:
    for name, kinds in _TYPE_NAMES.items():
        if isinstance(dtype, kinds):
            return name
    return dtype.simpleString()


def _java_format(strftime: str) -> str:
    unknown = set(re.findall("%.", strftime)) - set(_STRFTIME_LETTERS)
    if unknown:
        raise ValueError(f"strftime directives without a translation: {sorted(unknown)}")
    for python, java in _STRFTIME_LETTERS.items():
        strftime = strftime.replace(python, java)
    return strftime


def _unexpected(rule: Rule) -> Column:
    """Condition of an unexpected non-null value."""
    c = F.col(rule.column)
    if rule.expectation == BETWEEN:
        below = F.lit(False) if rule.low is None else c < rule.low
        above = F.lit(False) if rule.high is None else c > rule.high
        return below | above
    if rule.expectation == IN_SET:
        return ~c.isin(*rule.values)
    if rule.expectation == REGEX:
        return ~c.cast("string").rlike(rule.pattern)
    if rule.expectation == STRFTIME:
        return F.try_to_timestamp(c.cast("string"), F.lit(_java_format(rule.pattern))).isNull()
    raise ValueError(rule.expectation)


def _value_set(rule: Rule) -> Column:
    if not rule.values:
        return F.lit(None).cast("string")
    return F.lit("[" + ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in rule.values) + "]")


def _row(i: int, rule: Rule, *, success, elements=None, unexpected=None, percent=None, bad_values=None,
         observed=None, listed_all=None) -> list[Column]:
    def typed(value, kind):
        return (value if isinstance(value, Column) else F.lit(value)).cast(kind)

    return [
        F.lit(i).alias("rule"), F.lit(rule.expectation).alias("expectation"),
        typed(rule.column, "string").alias("column_name"), typed(success, "boolean").alias("success"),
        typed(elements, "bigint").alias("element_count"), typed(unexpected, "bigint").alias("unexpected_count"),
        typed(percent, "double").alias("unexpected_percent"), typed(rule.low, "double").alias("min_value"),
        typed(rule.high, "double").alias("max_value"), _value_set(rule).alias("value_set"),
        typed(bad_values, "string").alias("unexpected_value"), typed(observed, "string").alias("observed_value"),
        typed(listed_all, "boolean").alias("listed_all"),
    ]


def _judge(base: Column, bad: Column, mostly: float) -> tuple[Column, Column]:
    """(success, unexpected percent) out of ``base`` values; nothing to check is a success."""
    share = F.try_divide(bad, base)
    good = F.try_divide(base - bad, base)  # one division: 1 - share would round
    return F.coalesce(good >= F.lit(mostly), F.lit(True)), F.coalesce(share * 100, F.lit(0.0))


def _scan_report(df: DataFrame, rules: list[tuple[int, Rule]]) -> DataFrame:
    columns = list(dict.fromkeys(r.column for _, r in rules))
    known = {c: f"known_{i}" for i, c in enumerate(columns)}
    aggs = [F.count(F.lit(1)).alias("n")] + [F.count_if(~missing(df, c)).alias(a) for c, a in known.items()]
    aggs += [F.count_if(~missing(df, r.column) & _unexpected(r)).alias(f"bad_{i}")
             for i, r in rules if r.expectation != NOT_NULL]
    structs = []
    for i, r in rules:
        if r.expectation == NOT_NULL:
            base, bad = F.col("n"), F.col("n") - F.col(known[r.column])
        else:
            base, bad = F.col(known[r.column]), F.col(f"bad_{i}")
        success, percent = _judge(base, bad, r.mostly)
        structs.append(F.struct(*_row(i, r, success=success, elements=F.col("n"), unexpected=bad, percent=percent)))
    return df.agg(*aggs).select(F.inline(F.array(*structs)))


def _unique_report(df: DataFrame, i: int, rule: Rule) -> DataFrame:
    groups = df.groupBy(F.when(~missing(df, rule.column), F.col(rule.column)).alias("v")).agg(F.count(F.lit(1)).alias("k"))
    one = groups.agg(F.coalesce(F.sum("k"), F.lit(0)).alias("n"),
                     F.coalesce(F.sum(F.when(F.col("v").isNotNull(), F.col("k"))), F.lit(0)).alias("base"),
                     F.coalesce(F.sum(F.when(F.col("v").isNotNull() & (F.col("k") > 1), F.col("k"))), F.lit(0))
                     .alias("bad"))
    return uniqueness_row(one, i, rule)


def uniqueness_row(one: DataFrame, i: int, rule: Rule) -> DataFrame:
    """The report row of a uniqueness rule from one row with the elements ``n``, the values ``base`` and the repeated ``bad``."""
    success, percent = _judge(F.col("base"), F.col("bad"), rule.mostly)
    return one.select(*_row(i, rule, success=success, elements=F.col("n"), unexpected=F.col("bad"), percent=percent))


def observed_values(df: DataFrame, rule: Rule) -> DataFrame:
    """(value, n, allowed): every distinct value of a distinct-set rule, however many there are."""
    return (df.where(~missing(df, rule.column))
            .groupBy(F.col(rule.column).alias("value")).agg(F.count(F.lit(1)).alias("n"))
            .withColumn("allowed", F.col("value").isin(*rule.values)))


def _distinct_report(df: DataFrame, i: int, rule: Rule) -> DataFrame:
    """Exact number of unexpected values; the lists show the first LISTED_VALUES of each kind in order.

    ``listed_all`` tells whether that is all of them; :func:`observed_values` has every one. The values are grouped once
    and stored.
    """
    seen = materialize(observed_values(df, rule), "observed")
    stats = seen.agg(F.lit(i).alias("i"), F.count_if(~F.col("allowed")).alias("bad"))
    # the allowed values are bounded by the rule, the others by the length of the list
    good = seen.where("allowed").agg(F.lit(i).alias("i"), F.collect_list("value").alias("good"))
    other = seen.where("not allowed").orderBy("value").limit(LISTED_VALUES).agg(
        F.lit(i).alias("i"), F.collect_list("value").alias("other"))
    one = stats.join(good, "i").join(other, "i")
    return one.select(*_row(
        i, rule, success=F.col("bad") == 0, unexpected=F.col("bad"), bad_values=F.to_json(F.array_sort("other")),
        observed=F.to_json(F.array_sort(F.concat("good", "other"))), listed_all=F.col("bad") <= LISTED_VALUES))


def check_columns(df: DataFrame, expected) -> tuple[list[str], list[str]]:
    """(missing, extra) columns in the order given."""
    missing = [c for c in expected if c not in df.columns]
    extra = [c for c in df.columns if c not in set(expected)]
    return missing, extra


def expect_columns(df: DataFrame, expected) -> DataFrame:
    """The frame itself if its columns are the expected set, else an error naming the difference."""
    missing, extra = check_columns(df, expected)
    if missing:
        raise SuiteFailure(f"missing columns: {missing}")
    if extra:
        raise SuiteFailure(f"unexpected columns: {extra}")
    return df


def expect_schema(df: DataFrame, rules: list[Rule], numbers: list[int] | None = None) -> DataFrame:
    """Report rows of the rules that need the schema only: the column set and column types."""
    spark = df.sparkSession
    found = []
    for i, r in zip(numbers or range(len(rules)), rules):
        observed, wrong, value_set = None, None, None
        if r.expectation == COLUMN_SET:
            missing, extra = check_columns(df, r.values)
            success = not missing and not extra
            observed, wrong, value_set = str(list(df.columns)), str(missing + extra), str(list(r.values))
        else:
            success = r.column in df.columns and _type_name(df.schema[r.column].dataType) == r.type_name
            observed = _type_name(df.schema[r.column].dataType) if r.column in df.columns else None
        found.append((i, r.expectation, r.column, success, None, None, None, None, None, value_set, wrong, observed, None))
    return spark.createDataFrame(found, REPORT_SCHEMA)


def run_suite(df: DataFrame, rules: list[Rule], strict: bool = False, key: str = R.KEY,
              target: str = R.TARGET) -> DataFrame:
    """Evaluate a suite; one row per rule.

    The table is read once for all row-level rules and once per uniqueness or distinct-set rule, so pass a
    stored table rather than a long plan.

    ``strict`` raises :class:`SuiteFailure` if the column set differs, the key has nulls or repeats, the
    target is not 0 or 1, or the amount is not a double.
    """
    numbered = list(enumerate(rules))
    by_schema = [(i, r) for i, r in numbered if r.expectation in (COLUMN_SET, OF_TYPE)]
    absent = [(i, r) for i, r in numbered if r.column and r.column not in df.columns
              and r.expectation not in (COLUMN_SET, OF_TYPE)]
    rest = [(i, r) for i, r in numbered if (i, r) not in by_schema and (i, r) not in absent]
    parts = []
    if by_schema:
        parts.append(expect_schema(df, [r for _, r in by_schema], [i for i, _ in by_schema]))
    if absent:
        rows = [(i, r.expectation, r.column, False) + (None,) * 9 for i, r in absent]
        parts.append(df.sparkSession.createDataFrame(rows, REPORT_SCHEMA))
    scanned = [(i, r) for i, r in rest if r.expectation in SCANNED]
    if scanned:
        parts.append(_scan_report(df, scanned))
    parts += [_unique_report(df, i, r) for i, r in rest if r.expectation == UNIQUE]
    parts += [_distinct_report(df, i, r) for i, r in rest if r.expectation == DISTINCT_IN_SET]
    report = reduce(DataFrame.unionByName, parts)
    if strict:
        _check_strict(df, report, rules, key, target)
    return report


def _check_strict(df: DataFrame, report: DataFrame, rules: list[Rule], key: str, target: str) -> None:
    wanted = next((r.values for r in rules if r.expectation == COLUMN_SET), None)
    if wanted:
        expect_columns(df, wanted)
    if not isinstance(df.schema["amt"].dataType, DoubleType):
        raise SuiteFailure("amt is not a double")
    hard = [Rule(NOT_NULL, key), Rule(UNIQUE, key), Rule(NOT_NULL, target), Rule(IN_SET, target, values=(0, 1))]
    for row in run_suite(df, hard).where("not success").collect():  # at most four rows
        raise SuiteFailure(f"{row['expectation']} failed on {row['column_name']}")


def suite_summary(report: DataFrame) -> DataFrame:
    return report.groupBy("success").agg(F.count(F.lit(1)).alias("n"))


def failed_rules(report: DataFrame) -> DataFrame:
    return report.where("not success").select("rule", "expectation", "column_name", "unexpected_percent")


def validation_report(report: DataFrame) -> DataFrame:
    """The report under its twelve published column titles."""
    return report.select(
        F.col("success").alias("Success"), F.col("expectation").alias("Expectation Type"),
        F.coalesce("column_name", F.lit("")).alias("Column"), F.lit("('', '')").alias("Column Pair"),
        F.col("max_value").alias("Max Value"), F.col("min_value").alias("Min Value"),
        F.col("element_count").alias("Element Count"), F.col("unexpected_count").alias("Unexpected Count"),
        F.col("unexpected_percent").alias("Unexpected Percent"), F.col("value_set").alias("Value Set"),
        F.coalesce("unexpected_value", F.lit("[]")).alias("Unexpected Value"),
        F.col("observed_value").alias("Observed Value"),
    )


# Ready-made suites

def _numeric_type(column: str) -> str:
    return "int64" if column in ("age", "city_pop") else "float64"


def numerical_suite() -> list[Rule]:
    columns = [c for c in R.NUMERICAL_GROUP if c not in (R.KEY, R.EVENT_TIME)]
    rules = [r for c in columns for r in (Rule(OF_TYPE, c, type_name=_numeric_type(c)), Rule(NOT_NULL, c, mostly=0.95))]
    rules.append(Rule(OF_TYPE, R.EVENT_TIME, type_name="datetime64[ns]"))
    return rules + [Rule(BETWEEN, c, low, high) for c, (low, high) in R.VALID_RANGES.items()]


def categorical_suite() -> list[Rule]:
    columns = [c for c in R.CATEGORICAL_GROUP if c not in (R.KEY, R.EVENT_TIME)]
    rules = [r for c in columns for r in (Rule(OF_TYPE, c, type_name="object"), Rule(NOT_NULL, c, mostly=0.95))]
    return rules + [Rule(DISTINCT_IN_SET, "gender", values=R.GENDERS), Rule(DISTINCT_IN_SET, "state", values=R.STATES)]


def target_suite(target: str = R.TARGET) -> list[Rule]:
    return [Rule(OF_TYPE, target, type_name="int64"), Rule(DISTINCT_IN_SET, target, values=(0, 1))]


def ingested_suite(target: str = R.TARGET, states=R.STATES) -> list[Rule]:
    """The 57 rules of the ingested table; hashed columns are checked under their hashed names."""
    text = [c for c in R.CATEGORICAL_GROUP if c not in (R.KEY, R.EVENT_TIME)]
    columns = tuple(text) + ("age", "amt", "lat", "long", "city_pop", "merch_lat", "merch_long", R.EVENT_TIME,
                             R.KEY, target)
    rules = [Rule(COLUMN_SET, values=columns), Rule(OF_TYPE, R.KEY, type_name="object"), Rule(UNIQUE, R.KEY)]
    for c, (low, high) in R.VALID_RANGES.items():
        rules += [Rule(OF_TYPE, c, type_name=_numeric_type(c)), Rule(BETWEEN, c, low, high),
                  Rule(NOT_NULL, c, mostly=1.0 if c in ("amt", "age") else 0.95)]
    for c in text:
        rules += [Rule(OF_TYPE, c, type_name="object"), Rule(NOT_NULL, c, mostly=0.95)]
    return rules + [
        Rule(IN_SET, "gender", values=R.GENDERS), Rule(IN_SET, "state", values=tuple(states)),
        Rule(OF_TYPE, R.EVENT_TIME, type_name="datetime64[ns]"),
        Rule(STRFTIME, R.EVENT_TIME, pattern=R.STRFTIME_FORMAT),
        Rule(REGEX, "zip", pattern=R.ZIP_PATTERN), Rule(REGEX, "cc_num_hashed", pattern=r"^[0-9a-f]{64}\z"),
        Rule(OF_TYPE, target, type_name="int64"), Rule(IN_SET, target, values=(0, 1)), Rule(NOT_NULL, target),
    ]


def suggest_suite(df: DataFrame, profile: DataFrame | None = None, max_categories: int = 20) -> list[Rule]:
    """Rules that the table itself satisfies: not null, unique, numeric range, small value sets."""
    from txnlens.operators.profiling import category_counts, profile_table

    rows = (profile if profile is not None else profile_table(df)).collect()  # one row per column
    small = [r["column_name"] for r in rows if r["top_text"] is not None and r["n_distinct"] <= max_categories]
    sets: dict[str, list] = {c: [] for c in small}
    if small:  # at most max_categories values per column
        for v in category_counts(df, small).collect():
            sets[v["feature"]].append(v["value"])
    rules = []
    for r in sorted(rows, key=lambda r: df.columns.index(r["column_name"])):
        c = r["column_name"]
        if r["n_null"] == 0:
            rules.append(Rule(NOT_NULL, c))
        if r["n_rows"] and r["n_distinct"] == r["n_rows"]:
            rules.append(Rule(UNIQUE, c))
        if r["min_value"] is not None:
            rules.append(Rule(BETWEEN, c, r["min_value"], r["max_value"]))
        if c in sets:
            rules.append(Rule(IN_SET, c, values=tuple(sorted(sets[c]))))
    return rules
