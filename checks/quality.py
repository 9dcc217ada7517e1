"""Expectations and profiles."""

from checks import views as V
from checks.registry import query
from txnlens.operators import profiling, quality as Q
from txnlens.operators.quality import Rule
from txnlens.roles import GENDERS, STATES, VALID_RANGES, ZIP_PATTERN
from txnlens.session import materialize

REPORT = ["rule", "expectation", "column_name", "success", "element_count", "unexpected_count", "unexpected_percent"]


def report_sql(rules, source: str) -> str:
    """One SELECT per (rule, expectation, column, base, bad, mostly); counts are SQL expressions on the table."""
    rows = []
    for i, expectation, column, base, bad, mostly in rows_of(rules):
        share = f"(case when {base} = 0 then 0 else ({bad}) / ({base})::double end)"
        rows.append(f"""select {i}::int as rule, '{expectation}' as expectation, '{column}' as column_name,
            1 - {share} >= {mostly} as success, count(*) as element_count, cast({bad} as bigint) as unexpected_count,
            round({share} * 100, 6) as unexpected_percent from {source}""")
    return " union all ".join(rows)


def rows_of(rules):
    for r in rules:
        yield r


def not_null(i, c, mostly=1.0):
    return (i, "expect_column_values_to_not_be_null", c, "count(*)", f"count(*) filter ({c} is null)", mostly)


def where(i, expectation, c, bad, mostly=1.0):
    return (i, expectation, c, f"count({c})", f"count(*) filter ({c} is not null and {bad})", mostly)


BETWEEN, IN_SET = "expect_column_values_to_be_between", "expect_column_values_to_be_in_set"
REGEX, STRF = "expect_column_values_to_match_regex", "expect_column_values_to_match_strftime_format"
UNIQUE = "expect_column_values_to_be_unique"


def unique(i, c, source):
    repeated = (f"(select coalesce(sum(k), 0) from (select count(*) as k from {source} "
                f"where {c} is not null group by {c} having count(*) > 1))")
    return (i, UNIQUE, c, f"count({c})", repeated, 1.0)


def ranges(start, source_ranges):
    return [where(start + i, BETWEEN, c, f"({c} < {lo} or {c} > {hi})") for i, (c, (lo, hi)) in enumerate(source_ranges)]


def stored(spark, sf):
    """The ingested table as a suite meets it: written once, then read by each rule that needs a pass."""
    return materialize(V.ingested(spark, sf), "ingested")


def short(report):
    return V.rounded(report.select(*REPORT), "unexpected_percent")


NUMERIC = ["age", "amt", "lat", "long", "city_pop", "merch_lat", "merch_long"]
TEXT = ["cc_num_hashed", "merchant", "category", "first_hashed", "last_hashed", "gender", "street", "city", "state",
        "zip", "job", "merch_zipcode"]
TYPED = ([("trans_num", "object")] + [(c, "int64" if c in ("age", "city_pop") else "float64") for c in NUMERIC]
         + [(c, "object") for c in TEXT] + [("datetime", "datetime64[ns]"), ("is_fraud", "int64")])
TYPE_SQL = """case typeof(any_value({c})) when 'BIGINT' then 'int64' when 'DOUBLE' then 'float64'
    when 'VARCHAR' then 'object' when 'TIMESTAMP' then 'datetime64[ns]' end"""


@query("expect_schema", V.sql(" union all ".join(
    [f"""select 0 as rule, 'expect_table_columns_to_match_set' as expectation, null::varchar as column_name,
         count(*) = 1 as success, null::varchar as observed_value
         from (select {', '.join(f'min({c})' for c, _ in TYPED)} from ingested)"""]
    + [f"""select {i}, 'expect_column_values_to_be_of_type', '{c}', {TYPE_SQL.format(c=c)} = '{t}',
           {TYPE_SQL.format(c=c)} from ingested""" for i, (c, t) in enumerate(TYPED, 1)]), "ingested"))
def _(spark, sf):
    from pyspark.sql import functions as F

    rules = [r for r in Q.ingested_suite() if r.expectation in (Q.COLUMN_SET, Q.OF_TYPE)]
    report = Q.expect_schema(V.ingested(spark, sf), rules)
    typed = F.when(F.col("expectation") == Q.OF_TYPE, F.col("observed_value"))
    return report.select("rule", "expectation", "column_name", "success", typed.alias("observed_value"))


@query("expect_not_null", V.sql(report_sql(
    [not_null(0, "amt"), not_null(1, "age"), not_null(2, "is_fraud"), not_null(3, "merch_zipcode", 0.95)],
    "ingested"), "ingested"))
def _(spark, sf):
    rules = [Rule(Q.NOT_NULL, c) for c in ("amt", "age", "is_fraud")] + [Rule(Q.NOT_NULL, "merch_zipcode", mostly=0.95)]
    return short(Q.run_suite(V.ingested(spark, sf), rules))


@query("expect_between", V.sql(report_sql(ranges(0, VALID_RANGES.items()), "txn"), "txn"))
def _(spark, sf):
    return short(Q.run_suite(V.txn(spark, sf), [Rule(Q.BETWEEN, c, lo, hi) for c, (lo, hi) in VALID_RANGES.items()]))


@query("expect_unique", V.sql(report_sql(
    [unique(0, "trans_num", "raw_txn_dup"), unique(1, "cc_num", "raw_txn_dup")], "raw_txn_dup"), "raw_txn_dup"))
def _(spark, sf):
    return short(Q.run_suite(V.raw_txn_dup(spark, sf), [Rule(Q.UNIQUE, "trans_num"), Rule(Q.UNIQUE, "cc_num")]))


STATE_LIST = ", ".join(f"'{s}'" for s in STATES)


@query("expect_values_in_set", V.sql(report_sql([
    where(0, IN_SET, "gender", "gender not in ('M', 'F', 'U')"),
    where(1, IN_SET, "state", f"state not in ({STATE_LIST})"), where(2, IN_SET, "is_fraud", "is_fraud not in (0, 1)")],
    "txn"), "txn"))
def _(spark, sf):
    rules = [Rule(Q.IN_SET, "gender", values=GENDERS), Rule(Q.IN_SET, "state", values=STATES),
             Rule(Q.IN_SET, "is_fraud", values=(0, 1))]
    return short(Q.run_suite(V.txn(spark, sf), rules))


@query("expect_distinct_in_set", V.sql(f"""
    select 0 as rule, 'gender' as column_name, true as success, '[]' as unexpected_value,
           cast(to_json(list_sort(list(distinct gender))) as varchar) as observed_value, true as listed_all from txn
    union all
    select 1, 'state', bool_and(state in ({STATE_LIST})),
           cast(to_json(list_sort(list(distinct state) filter (state not in ({STATE_LIST})))) as varchar),
           cast(to_json(list_sort(list(distinct state))) as varchar),
           count(distinct state) filter (state not in ({STATE_LIST})) <= 1000 from txn""", "txn"))
def _(spark, sf):
    rules = [Rule(Q.DISTINCT_IN_SET, "gender", values=GENDERS), Rule(Q.DISTINCT_IN_SET, "state", values=STATES)]
    return Q.run_suite(V.txn(spark, sf), rules).select("rule", "column_name", "success", "unexpected_value",
                                                       "observed_value", "listed_all")


@query("expect_regex", V.sql(report_sql([
    where(0, REGEX, "zip", r"not regexp_matches(zip, '^\d{5}(-\d{4})?$')"),
    where(1, REGEX, "cc_num", r"not regexp_matches(cc_num, '^\d{13,19}$')")], "txn"), "txn"))
def _(spark, sf):
    rules = [Rule(Q.REGEX, "zip", pattern=ZIP_PATTERN), Rule(Q.REGEX, "cc_num", pattern=r"^\d{13,19}\z")]
    return short(Q.run_suite(V.txn(spark, sf), rules))


@query("expect_strftime", V.sql(report_sql([
    where(0, STRF, "trans_date_trans_time", "try_strptime(trans_date_trans_time, '%Y-%m-%d %H:%M:%S') is null"),
    where(1, STRF, "dob", "try_strptime(dob, '%Y-%m-%d') is null")], "raw_txn"), "raw_txn"))
def _(spark, sf):
    rules = [Rule(Q.STRFTIME, "trans_date_trans_time", pattern="%Y-%m-%d %H:%M:%S"),
             Rule(Q.STRFTIME, "dob", pattern="%Y-%m-%d")]
    return short(Q.run_suite(V.raw_txn(spark, sf), rules))


def suite_sql() -> str:
    """The value rules of the ingested suite under the numbers they have there, and the type rules as constants."""
    value_rules, typed = [unique(2, "trans_num", "ingested")], [(0, "expect_table_columns_to_match_set", None), (
        1, "expect_column_values_to_be_of_type", "trans_num")]
    i = 3
    for c in NUMERIC:
        lo, hi = VALID_RANGES[c]
        typed.append((i, "expect_column_values_to_be_of_type", c))
        value_rules += [where(i + 1, BETWEEN, c, f"({c} < {lo} or {c} > {hi})"),
                        not_null(i + 2, c, 1.0 if c in ("amt", "age") else 0.95)]
        i += 3
    for c in TEXT:
        typed.append((i, "expect_column_values_to_be_of_type", c))
        value_rules.append(not_null(i + 1, c, 0.95))
        i += 2
    value_rules += [where(i, IN_SET, "gender", "gender not in ('M', 'F', 'U')"),
                    where(i + 1, IN_SET, "state", f"state not in ({STATE_LIST})"),
                    where(i + 3, STRF, "datetime", "datetime is null"),
                    where(i + 4, REGEX, "zip", r"not regexp_matches(zip, '^\d{5}(-\d{4})?$')"),
                    where(i + 5, REGEX, "cc_num_hashed", "length(cc_num_hashed) <> 64"),
                    where(i + 7, IN_SET, "is_fraud", "is_fraud not in (0, 1)"), not_null(i + 8, "is_fraud")]
    typed += [(i + 2, "expect_column_values_to_be_of_type", "datetime"),
              (i + 6, "expect_column_values_to_be_of_type", "is_fraud")]
    constant = " union all ".join(
        f"select {n}, '{e}', {'null' if c is None else repr(c)}, true, null, null, null" for n, e, c in typed)
    return report_sql(value_rules, "ingested") + " union all " + constant


@query("run_suite", V.sql(suite_sql(), "ingested"))
def _(spark, sf):
    return short(Q.run_suite(stored(spark, sf), Q.ingested_suite()))


@query("validation_report", V.sql(f"""
    select s.success as "Success", s.expectation as "Expectation Type", coalesce(s.column_name, '') as "Column",
           '('''', '''')' as "Column Pair",
           s.element_count as "Element Count", s.unexpected_count as "Unexpected Count",
           s.unexpected_percent as "Unexpected Percent" from ({suite_sql()}) s""", "ingested"))
def _(spark, sf):
    out = Q.validation_report(Q.run_suite(stored(spark, sf), Q.ingested_suite(), strict=True))
    return V.rounded(out.drop("Max Value", "Min Value", "Value Set", "Unexpected Value", "Observed Value"),
                     "Unexpected Percent")


@query("suite_summary", V.sql(f"select success, count(*) as n from ({suite_sql()}) group by success", "ingested"))
def _(spark, sf):
    return Q.suite_summary(Q.run_suite(stored(spark, sf), Q.ingested_suite()))


GROUP_COLUMNS = {"numerical": NUMERIC, "categorical": TEXT}


@query("group_suites", V.sql(" union all ".join(
    f"select 'numerical' as suite, * from ({part})" for part in [report_sql(
        [not_null(2 * i + 1, c, 0.95) for i, c in enumerate(NUMERIC)] + ranges(15, VALID_RANGES.items()), "ingested")])
    + " union all " + "select 'categorical', * from (" + report_sql(
        [not_null(2 * i + 1, c, 0.95) for i, c in enumerate(TEXT)], "ingested") + ")", "ingested"))
def _(spark, sf):
    from pyspark.sql import functions as F

    full = stored(spark, sf)
    parts = []
    for name, rules in (("numerical", Q.numerical_suite()), ("categorical", Q.categorical_suite())):
        report = short(Q.run_suite(full, rules)).where("element_count is not null")
        parts.append(report.select(F.lit(name).alias("suite"), "*"))
    return parts[0].unionByName(parts[1])


@query("assert_no_nulls", V.sql("""
    select 'age' as column_name, count(*) as n_null from ingested where age is null having count(*) > 0
    union all
    select 'merch_zipcode', count(*) from ingested where merch_zipcode is null having count(*) > 0""", "ingested"))
def _(spark, sf):
    return profiling.assert_no_nulls(V.ingested(spark, sf))


def profile_sql() -> str:
    numbers = ["age", "amt", "lat", "long", "city_pop", "merch_lat", "merch_long", "is_fraud"]
    text = ["trans_num", "cc_num", "merchant", "category", "gender", "street", "city", "state", "zip", "job",
            "merch_zipcode"]
    parts = []
    for c in numbers:
        parts.append(f"""select '{c}' as column_name, count(*) as n_rows, count(*) - count({c}) as n_null,
            count(distinct {c}) as n_distinct, round(min({c})::double, 6) as min_value,
            round(max({c})::double, 6) as max_value, round(avg({c}), 6) as mean, round(stddev_samp({c}), 6) as std,
            round(quantile_cont({c}::double, 0.25), 6) as q1, round(quantile_cont({c}::double, 0.5), 6) as median,
            round(quantile_cont({c}::double, 0.75), 6) as q3, count(*) filter ({c} = 0) as n_zero,
            null::varchar as top_text, round((select {c} from txn where {c} is not null group by {c}
                order by count(*) desc, {c} limit 1)::double, 6) as top_number,
            (select count(*) from txn where {c} is not null group by {c} order by 1 desc limit 1) as top_count from txn""")
    for c in text:
        parts.append(f"""select '{c}', count(*), count(*) - count({c}), count(distinct {c}), null, null, null, null,
            null, null, null, null, (select {c} from txn where {c} is not null group by {c}
                order by count(*) desc, {c} limit 1), null,
            (select count(*) from txn where {c} is not null group by {c} order by 1 desc limit 1) from txn""")
    return " union all ".join(parts)


@query("profile_table", V.sql(profile_sql(), "txn"))
def _(spark, sf):
    return V.rounded(profiling.profile_table(V.txn(spark, sf)))


def suggested_sql() -> str:
    numbers = ["age", "amt", "lat", "long", "city_pop", "merch_lat", "merch_long", "is_fraud"]
    text = ["trans_num", "cc_num", "merchant", "category", "gender", "street", "city", "state", "zip", "job",
            "merch_zipcode"]
    row = "select '{e}' as expectation, '{c}' as column_name, true as success, count(*) as element_count from txn"
    parts = [(row + " having count({c}) = count(*)").format(e="expect_column_values_to_not_be_null", c=c)
             for c in numbers + text]
    parts += [(row + " having count(distinct {c}) = count(*)").format(e=UNIQUE, c=c) for c in numbers + text]
    parts += [row.format(e=BETWEEN, c=c) for c in numbers]
    parts += [(row + " having count(distinct {c}) between 1 and 20").format(e=IN_SET, c=c) for c in text]
    return " union all ".join(parts)


@query("suggest_suite", V.sql(suggested_sql(), "txn"))
def _(spark, sf):
    rows = materialize(V.txn(spark, sf), "txn")
    report = Q.run_suite(rows, Q.suggest_suite(rows))
    return report.select("expectation", "column_name", "success", "element_count")


@query("value_length_histogram", V.sql(
    "select cast(length(zip) as int) as len, count(*) as n from txn group by 1", "txn"))
def _(spark, sf):
    return profiling.value_length_histogram(V.txn(spark, sf))


@query("null_rate", V.sql(" union all ".join(
    f"""select '{c}' as column_name, count(*) filter ({c} is null) as n_null,
        round(avg(case when {c} is null then 1 else 0 end), 6) as null_rate from ingested"""
    for c in ("merch_zipcode", "age", "zip", "amt")), "ingested"))
def _(spark, sf):
    return V.rounded(profiling.null_rates(V.ingested(spark, sf), ["merch_zipcode", "age", "zip", "amt"]))


CATEGORICAL = ["category", "gender", "city", "state", "zip", "street", "job", "merch_zipcode"]
COUNTS = " union all ".join(
    f"select '{c}' as feature, {c} as value, count(*) as n, count(*) / sum(count(*)) over () as share "
    f"from txn where {c} is not null group by {c}" for c in CATEGORICAL)


@query("value_counts", V.sql(f"select feature, value, n, round(share, 6) as share from ({COUNTS})", "txn"))
def _(spark, sf):
    return V.rounded(profiling.value_counts(V.txn(spark, sf), CATEGORICAL))


@query("rare_category_report", V.sql(f"""
    select feature, count(*) as n_unique, count(*) filter (share < 0.01) as n_rare from ({COUNTS}) group by feature""",
    "txn"))
def _(spark, sf):
    return profiling.rare_category_report(V.txn(spark, sf), CATEGORICAL)


@query("histogram_numeric", V.sql("""
    with v as (select unnest(['age', 'amt', 'lat', 'city_pop']) as feature,
                      unnest([age::double, amt, lat, city_pop::double]) as x from txn),
    e as (select feature, min(x) as lo, max(x) as hi from v group by feature),
    c as (select v.feature, least(floor((x - lo) / (hi - lo) * 50), 49)::bigint as bin, count(*) as n
          from v join e on v.feature = e.feature group by 1, 2),
    g as (select feature, lo, hi, unnest(range(0, 50)) as bin from e)
    select g.feature, g.bin, round(lo + g.bin * ((hi - lo) / 50), 6) as low,
           round(lo + (g.bin + 1) * ((hi - lo) / 50), 6) as high, coalesce(c.n, 0) as n
    from g left join c on g.feature = c.feature and g.bin = c.bin""", "txn"))
def _(spark, sf):
    return V.rounded(profiling.histogram_numeric(V.txn(spark, sf), ["age", "amt", "lat", "city_pop"], 50))


@query("box_stats_iqr", V.sql("""
    select 'amt' as feature, round(q1, 6) as q1, round(q3, 6) as q3, round(p99, 6) as p99,
           round(max_value, 6) as max_value, round(q3 - q1, 6) as iqr, round(q3 + 1.5 * (q3 - q1), 6) as upper_fence
    from (select quantile_cont(amt, 0.25) as q1, quantile_cont(amt, 0.75) as q3, quantile_cont(amt, 0.99) as p99,
                 max(amt) as max_value from txn)""", "txn"))
def _(spark, sf):
    return V.rounded(profiling.box_stats(V.txn(spark, sf)))
